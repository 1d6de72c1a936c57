"""License scans by conditional compression.

A block (a line, or a paragraph of several lines) that names licensing at all is compressed with each template as a
zstandard raw dictionary.  The more of a template a block repeats, the smaller it gets beside its own compression;
templates are ranked by that reduction.  In that order, every template whose weighty words all occur in the block is
confirmed by its exact words: those that are not free text must occur in order, and what the block adds or lacks is reported.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices by license, in natural order.  ``*`` stands for free words (years, holders).  Fixed values.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License 2.0.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Licensed under the BSD 3-Clause License."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "GNU General Public License Version 2, June 1991",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
        "GNU General Public License Version 3, 29 June 2007",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 3 as published by the Free Software Foundation",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation; either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation; version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License version 3 as published by the Free Software Foundation",
        "GNU Affero General Public License Version 3, 19 November 2007",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License",
        "GNU Lesser General Public License Version 2.1, February 1999",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Licensed under the Unlicense."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License - v 2.0"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0.", "Creative Commons Legal Code CC0 1.0 Universal"],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "Licensed under CC-BY-4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution 4.0 International Public License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    ],
    "all-rights-reserved": ["Copyright * All rights reserved.", "All rights reserved."],
}
for _name in [n for n in TEMPLATES if "GPL" in n]:  # the same notices with the right to later versions, and both kinds of identifier
    TEMPLATES[f"{_name}-or-later"] = [*(f"{t}, or (at your option) any later version" for t in TEMPLATES[_name] if "either version" in t), f"SPDX-License-Identifier: {_name}-or-later"]
    TEMPLATES[_name].append(f"SPDX-License-Identifier: {_name}-only")
for _name in [n for n in TEMPLATES if n != "all-rights-reserved" and not n.endswith("-or-later")]:
    TEMPLATES[_name] += [f"SPDX-License-Identifier: {_name}", f"License: {_name}"]
    if "GPL" in _name:  # as in GPLv3
        TEMPLATES[_name].append(f"Licensed under the {_name.removesuffix('.0').replace('-', 'v')}.")
#: Words right before a notice, light words aside, that make it say the contrary.
_NOT = frozenset("not never cannot neither nor longer unlike without reject rejects rejected rejecting refuse refused than except excluding instead".split())
#: Words that may differ without changing what is granted: wording around the license's name.
_LIGHT = frozenset("this work is released licensed under the a an of by to and in with or code file software source form terms subject".split())
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
SCHEMA = "block int, start int, end int, license string, template string, plain_bytes int, dict_bytes int, reduction double, place int, differences string, text string"


#: An identifier's tag with an expression of several identifiers.
_EXPRESSION = re.compile(r"(SPDX-License-Identifier:)((?:[ \t(]*+(?:(?:AND|OR|WITH)[ \t(]++)?[A-Za-z0-9.-]++\+?+[ \t)]*+)(?:(?:AND|OR|WITH)[ \t(]++[A-Za-z0-9.-]++\+?+[ \t)]*+)*+)")


#: Creative Commons names are one word: their ``BY`` is no light word.
_BY = re.compile(r"(?i)(?<![A-Za-z0-9])CC[ \t]+(?=BY(?![A-Za-z0-9]))")


def words_of(text: str) -> list[str]:
    return [m[0].lower() for m in _WORD.finditer(_BY.sub("CC-", text))]


def said_by(block: str) -> list[str]:
    """The block's words; the tag of an SPDX expression is said before each of its identifiers (exceptions after WITH are left out)."""

    def each(m: re.Match) -> str:
        ids = re.sub(r"\bWITH[ \t(]+\S+", " ", m[2])
        ids = [x for x in re.findall(r"[A-Za-z0-9.-]+\+?", ids) if x not in ("AND", "OR", "WITH")]
        return " ".join(f"{m[1]} {x[:-1] + '-or-later' if x.endswith('+') else x}" for x in ids) + " "

    return words_of(_EXPRESSION.sub(each, re.sub("n['’]t\\b", " not", block)))


def _gate() -> str:
    """A pattern that every confirmed block matches: of each template, the longest word that must stand in the block."""
    needed = {max((w for w in words_of(t.replace("*", " ")) if w not in _LIGHT), key=lambda w: (w[0].isalpha(), len(w), w)) for group in TEMPLATES.values() for t in group}
    return "(?i)(?<![A-Za-z0-9])(?:" + "|".join(re.escape(w).replace(r"cc\-by", r"cc[ \t-]+by") for w in sorted(needed)) + ")(?![A-Za-z0-9])"


GATE = _gate()


@cache
def _compressors() -> tuple[zstandard.ZstdCompressor, list[tuple[str, str, list[list[str]], zstandard.ZstdCompressor]]]:
    options = {"level": 9, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    found = [(name, t, [words_of(run) for run in t.split("*")], zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **options)) for name, group in TEMPLATES.items() for t in group]
    return zstandard.ZstdCompressor(**options), found


def blocks_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of each line, then of each run of two or more non-blank lines."""
    lines, paragraphs, at, run = [], [], 0, []
    for line in [*text.split("\n"), ""]:
        if line.strip():
            run.append((at, at + len(line)))
        elif run:
            lines += run
            paragraphs += [(run[0][0], run[-1][1])] if len(run) > 1 else []
            run = []
        at += len(line) + 1
    return lines + paragraphs


def differences(template: list[list[str]], block: list[str]) -> tuple[bool, str]:
    """Whether the block says what the template says, and its other words: ``-missing`` and ``+added within``.

    The template is the runs of words between its free words.  The weighty words of a run must stand in the block in order,
    with no other weighty word between them; runs follow each other with any words between, which are not reported.  Light
    words may vary on either side and between; those before and after are compared with the light words that touch the run.
    A place right after a negation does not count.  Of several such places, the first with the fewest other words is reported; earlier runs are the nearest before it.
    """
    at = [k for k, w in enumerate(block) if w not in _LIGHT]
    said = [block[k] for k in at]
    ends: list[tuple[int, list[str]]] = [(0, [])]  # where the runs so far end, and their other words
    for nth, run in enumerate(template):
        heavy = [k for k, w in enumerate(run) if w not in _LIGHT]
        wanted = [run[k] for k in heavy]
        after, near = [], 0
        for k, w in enumerate(said):
            if ends and w == wanted[0] and said[k : k + len(wanted)] == wanted and ends[0][0] <= k and not (nth == 0 and k and said[k - 1] in _NOT):
                while near + 1 < len(ends) and ends[near + 1][0] <= k:
                    near += 1
                after.append((k + len(wanted), ends[near][1] + _others(run, heavy, block, at, k)))
        ends = after
    return (True, " ".join(min((other for _, other in ends), key=len))) if ends else (False, "")


def _others(run: list[str], heavy: list[int], block: list[str], at: list[int], k: int) -> list[str]:
    """Light words that differ where the weighty words ``heavy`` of the run are those of the block from ``at[k]`` on."""
    n = len(heavy)
    ours = [at[k - 1] if k else -1, *at[k : k + n], at[k + n] if k + n < len(at) else len(block)]
    theirs = [-1, *heavy, len(run)]
    out = []
    for i in range(n + 1):
        a, b = run[theirs[i] + 1 : theirs[i + 1]], block[ours[i] + 1 : ours[i + 1]]
        codes = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        equal = [c for c in codes if c[0] == "equal"]
        first = 0 if i else equal[0][3] if equal else len(b)  # before the notice, only what follows a word of it is added within
        last = len(b) if i < n else equal[-1][4] if equal else 0
        out += [f"-{w}" for tag, x, y, _, _ in codes if tag in ("delete", "replace") for w in a[x:y]]
        out += [f"+{w}" for tag, _, _, x, y in codes if tag in ("insert", "replace") for w in b[max(x, first) : min(y, last)]]
    return out


def _held(template: list[list[str]], said: list[str]) -> bool:
    """Whether all weighty words of a template stand in the block, in any order."""
    return {w for run in template for w in run} - _LIGHT <= set(said)


def scan_text(text: str, gate: re.Pattern) -> list[tuple]:
    """Confirmed licenses of a text, a row for each block and license: the template with the greatest reduction."""
    plain, templates = _compressors()
    out, taken = [], set()
    for k, (start, end) in enumerate(blocks_of(text)):
        block = text[start:end]
        if not gate.search(block) or "\n" in block and all(any(s <= start + m.start() < e for _, s, e in taken) for m in gate.finditer(block)):
            continue  # in a paragraph, each mention is part of a line that is confirmed already
        raw, alone, said = block.encode(), len(plain.compress(block.encode())), said_by(block)
        sizes = [(len(c.compress(raw)), i) for i, (*_, c) in enumerate(templates)]
        place, named = 0, set()
        # a notice with later versions holds the words of the one without, which is then not meant
        later = [t for name, t, wanted, _ in templates if name.endswith("-or-later") and _held(wanted, said) and differences(wanted, said)[0]]
        for size, i in sorted(sizes):
            reduction, place = (alone - size) / alone, place + 1
            name, template, wanted, _ = templates[i]
            if name in named or any(t != template and t.startswith(template) for t in later):
                continue
            exact, other = differences(wanted, said) if _held(wanted, said) else (False, "")
            if exact and not any(n == name and s >= start and e <= end for n, s, e in taken):
                named.add(name)
                taken.add((name, start, end))
                out.append((k, start, end, name, template, alone, size, reduction, place, other, block))
    return out


def license_scan(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row per confirmed license of a block: ``doc_id`` and the columns of ``SCHEMA``.

    ``start`` and ``end`` are code points; a paragraph is reported only for licenses that none of its lines has.  Blocks
    that lack a word which each template needs one of cannot be confirmed and are not compressed.  Null or empty text: no rows.  Null and repeated ids pass through;
    other columns are ignored; an empty table gives no rows.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = re.compile(GATE)
        kinds = {"int": pa.int32(), "string": pa.string(), "double": pa.float64()}
        schema = pa.schema([("doc_id", pa.int64()), *((n, kinds[k]) for n, k in (c.strip().split(" ") for c in SCHEMA.split(",")))])
        for batch in batches:
            rows = [(i, *r) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for r in scan_text(t, gate)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(GATE))
    return rows.mapInArrow(scan, f"doc_id long, {SCHEMA}")
