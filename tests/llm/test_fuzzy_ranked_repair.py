"""SimHash groups, ranked lexical search and conversation repair against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from leafpress.llm import lexical, queries, repair, simhash
from leafpress.storage import new_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}
CLASHING = ["print", "key", "least", "component", "fingerprint", "component_id", "size", "terms", "score", "rank", "query", "n", "h", "nth", "place", "signature", "kind", "col", "audit", "p"]


def clashing(df):
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHING if c not in df.columns))


# SimHash


def print_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Index of the component of each distinct fingerprint, by comparing all with all."""
    names = sorted(set(prints))
    label = list(range(len(names)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i, j in itertools.combinations(range(len(names)), 2):
        if (names[i] ^ names[j]).bit_count() <= 4:
            label[find(i)] = find(j)
    return {x: find(i) for i, x in enumerate(names)}


def near(rng, base, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        base ^= 1 << b
    return base


def test_golay_code_is_perfect():
    low, high, error, weight, _ = simhash.golay()
    assert np.bincount(weight).tolist() == [1, 23, 253, 1771]
    words = np.random.default_rng(5).integers(0, 1 << 23, 400)
    codewords = (np.arange(4096) << 11) | simhash._mod(np.arange(4096) << 11)
    index, far, further = simhash.decoded(words)
    for w, i, f, more in zip(words, index, far, further, strict=True):
        away = np.bitwise_count(codewords ^ w)
        assert np.flatnonzero(away <= 3).tolist() == [i]
        if f:
            assert sorted(more) == np.flatnonzero(away == 4).tolist()


def test_any_four_bits_leave_a_common_key():
    rng = random.Random(3)
    a = [rng.getrandbits(64) for _ in range(3000)] + [0]
    b = [near(rng, x, 4) for x in a]
    found = []
    for prints in (a, b):
        rows, keys = simhash.keys_of(np.array(prints, np.uint64))
        assert np.bincount(rows).max() <= 33
        found.append(set(zip(rows.tolist(), keys.tolist(), strict=True)))
    assert {r for r, _ in found[0] & found[1]} == set(range(len(a)))


def test_fingerprints_equal_the_definition():
    rng = random.Random(1)
    texts = [None, "", " \t", "one", "A  b\nC", "É B c  D e\tf", "no end", "begin", "x " * 2000, " ".join(rng.choice("abcdefgh") * 3 for _ in range(20_000))]
    texts += ["".join(rng.choice("abAB é \n\tß語") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    assert simhash.fingerprint_of(pa.array(texts)).tolist() == [print_of(t) for t in texts]


@pytest.mark.parametrize("group", [simhash.GROUP, 3])
def test_simhash_groups_equal_all_pairs(spark, group, monkeypatch):
    """Random fingerprints with chains and dense clusters; with a small ``group``, most of them meet at midpoints."""
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for base in prints[:6]:
        prints += [near(rng, base, 3) for _ in range(20 if group == 3 else 60)]
    for _ in range(40):  # chains
        prints.append(near(rng, prints[-1], 4))
    prints += prints[:10] + [0, 0]
    rows = [(None if i % 37 == 0 else i, p) for i, p in enumerate(prints)]
    signed = spark.createDataFrame([(i, p - (1 << 64) * (p >> 63)) for i, p in rows], "doc_id long, print long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: signed)
    got = sorted((r["fingerprint"], r["doc_id"] or 0, r["component_id"]) for r in simhash.near_duplicates(None, group=group).collect())
    label, least = components(prints), {}
    for i, p in rows:
        if i is not None:
            least[label[p]] = min(least.get(label[p], i), i)
    assert got == sorted((f"{p:016x}", i or 0, least.get(label[p])) for i, p in rows)


def test_simhash_of_the_table_equals_all_pairs(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: print_of(t) for i, t in docs.items()}
    label, least = components(list(prints.values())), {}
    for i, p in prints.items():
        least[label[p]] = min(least.get(label[p], i), i)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op11_simhash_near_dedup(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[label[p]]) for i, p in prints.items()}


def test_simhash_odd_rows(spark):
    rows = spark.createDataFrame([(5, None), (3, ""), (None, " "), (9, "a b c d"), (9, "a b c d"), (None, "q w e r")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.near_duplicates(clashing(rows)).collect() if r["fingerprint"] == "0" * 16)
    assert got == [(0, 3), (3, 3), (5, 3)]
    whole = simhash.near_duplicates(clashing(rows))
    assert whole.columns == ["doc_id", "fingerprint", "component_id"] and whole.count() == 6
    assert [r["component_id"] for r in whole.where("doc_id = 9").collect()] == [9, 9]
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


# Ranked search


def ranking(docs, items, k):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    held = [(i, x) for i, t in docs if (x := terms(t))]
    n, total = len(held), sum(len(x) for _, x in held)
    df = {}
    for _, x in held:
        for t in set(x):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for place, (i, x) in enumerate(held):
            m = 100 - 90 + 90 * len(x) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * x.count(t) // (1000 * x.count(t) + 8 * m)) for t in wanted if t in df and t in x)
            if score:
                scores.append((-score, i is None, i or 0, place))
        for rank, (s, none, i, _) in enumerate(heapq.nsmallest(k, scores), 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard_docs", "sent_chars"), [(lexical.SHARD_DOCS, lexical.SENT_CHARS), (7, 60)])
def test_search_equals_brute_force(spark, shard_docs, sent_chars):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "B", "cc", "dd9", "é", "中文", "-", "x_y", "A.b", "q" * 300])
    docs = [(None if i % 29 == 0 else i % 90, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 40])))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "- ."), (503, "a " * 20_000), (7, "a"), (7, "a")]
    items = [(1, "a b"), (2, "CC cc é"), (3, None), (4, "nothing"), (5, ""), (None, "dd9"), (1, "x_y"), (6, "q" * 300), (6, "q" * 300)]
    path = new_path(spark, "lexical")
    lexical.write_index(clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3), path, shard_docs=shard_docs)
    got = lexical.search(spark, path, clashing(spark.createDataFrame(items, "item_id long, text string")), k=10, sent_chars=sent_chars).collect()
    assert sorted([tuple(r) for r in got], key=str) == ranking(docs, items, 10)


def test_search_without_documents_or_items(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, q in ((docs.limit(0), items), (docs, items.limit(0)), (docs.selectExpr("doc_id", "'-' as text"), items)):
        path = new_path(spark, "lexical")
        lexical.write_index(d, path)
        assert lexical.search(spark, path, q).count() == 0


def test_top_places_keep_ties():
    rng = np.random.default_rng(2)
    for _ in range(200):
        sums, k = rng.integers(0, 4, rng.integers(1, 40)), int(rng.integers(1, 12))
        assert lexical._best(sums, k).tolist() == [i for i in sorted(range(len(sums)), key=lambda i: (-sums[i], i)) if sums[i]][:k]


def test_ranks_are_cut_before_the_shuffle(spark):
    path = new_path(spark, "lexical")
    lexical.write_index(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), path)
    plan = lexical.search(spark, path, spark.createDataFrame([(1, "a")], "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


# Conversation repair


def cheapest(signature):
    """Least (cost, edits) by trying all edits in order of cost, then text: a search over (turns done, state)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, edits, at, state = heapq.heappop(heap)
        if at == len(signature) and state in (0, 3):
            return cost, edits
        if (at, state) in done:
            continue
        done.add((at, state))
        to = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(heap, (cost + 3, edits + "I", at, to))
        if at < len(signature):
            c = signature[at]
            heapq.heappush(heap, (cost + 4, edits + "D", at + 1, state))
            if c != "d":
                more = 3 * c.isupper()
                heapq.heappush(heap, (cost + 3 + more, edits + "R", at + 1, to))
                if (c.lower(), state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    heapq.heappush(heap, (cost + more, edits + "K", at + 1, {"s": 1, "u": 2, "a": 3}[c.lower()]))


def test_edits_are_the_cheapest_and_shared_by_prefix():
    rng = random.Random(6)
    asked = sorted({"".join(x) for n in range(4) for x in itertools.product("suaxSUAXd", repeat=n)} | {"".join(rng.choice("suaxUAd") for _ in range(rng.randint(4, 14))) for _ in range(400)})
    trie = repair.Trie()
    assert {s: trie.answer(s) for s in asked} == {s: cheapest(s) for s in asked}
    assert trie.made == len({s[:n] for s in asked for n in range(1, len(s) + 1)})


def report_of(rows, damaged=True):
    """The contract, conversation by conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        letters, seen, blank, duplicate, truncated = "", set(), 0, 0, 0
        for _, role, text in held:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            letter = role[0] if role[:1] in ("s", "u", "a") else "x"
            if not core:
                blank, letter = blank + 1, "d"
            elif (role, text) in seen:
                duplicate, letter = duplicate + 1, "d"
            elif core[-1] not in ".!?":
                truncated, letter = truncated + 1, letter.upper()
            seen.add((role, text))
            letters += letter
        first = [r[:1] if r[:1] in ("s", "u", "a") else "x" for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
        turns = {t for t, _, _ in held if t is not None}
        cost, audit = cheapest(letters)
        lines, at, last = [], 0, None
        for edit in audit:
            role = "assistant" if last == "u" else "user"
            if edit == "I":
                lines.append((role, ""))
            else:
                _, own, text = held[at]
                at += 1
                if edit == "D":
                    continue
                lines.append((own if edit == "K" else role, text))
            last = lines[-1][0][0]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, blank, duplicate, truncated, illegal, cost, audit, digest)
    return out


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("damaged", [True, False])
def test_repair_equals_the_definition(spark, damaged):
    rng = random.Random(9)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(0, 9)):
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((conv, rng.choice([turn, turn, 3 * turn, None]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]), rng.choice([None, "", " \n", "Yes.", "no", "Is it? \t", "e ", "é!", "Yes."])))
    rows += [(777, t, "user" if t % 2 == 0 else "assistant", "w" * 20_000 + ".") for t in range(30)] + [(778, None, "user", "a.")] * 40 + [(779, -(1 << 62), "user", "b."), (779, (1 << 62), "assistant", "c.")]
    table = clashing(spark.createDataFrame(rows, CONV))
    got = repair.report(table, repair.damage(table) if damaged else table)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found(got) == report_of(rows, damaged)


def test_long_conversation_is_dealt_to_several_tasks(spark):
    """Its signature is strung together from pieces, with duplicates, gaps and adjacency across their seams."""
    rows = [(1, t + t // 100, ("user", "assistant")[t % 2] if t % 17 else "user", f"turn {t % 997}.") for t in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert found(repair.report(spark.createDataFrame(rows, CONV), spark.createDataFrame(rows, CONV))) == report_of(rows, False)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (2, 0, "user", "")]
    turns = spark.createDataFrame(rows, CONV)
    got = [tuple(r) for r in repair.apply_edits(turns, repair.audits(turns)).orderBy("conv_id", "place").collect()]
    assert got == [(1, 0, "user", ""), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "assistant", "")]  # IKKI, as cheap as RR
    assert found(repair.report(turns, turns)) == report_of(rows, False)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], CONV)
    assert repair.report(none, repair.damage(none)).count() == 0
    one = spark.createDataFrame([(4, 1, "user", "a")], CONV)
    assert found(repair.report(one, none)) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# Mended ones


@pytest.mark.parametrize("name, key", [("op12_lexical_search", ["item_id", "rank"]), ("op13_conversation_repair", ["conv_id"])])
def test_sql_over_the_other_tables(spark, name, key):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours, theirs = queries.queries()[name](spark, SF).toPandas(), c.execute(queries.ORACLES[name]).df()
    ours, theirs = (d[sorted(theirs.columns)].sort_values(key).astype(object).where(d.notna(), None).values.tolist() for d in (ours, theirs))
    assert ours and ours == theirs


def test_packing_keeps_columns_named_like_its_own(spark):
    from leafpress.llm import packing

    table = spark.createDataFrame([(1, "a b c"), (2, None), (2, None), (3, "w " * 3000)], "doc_id long, text string")
    pieces = packing.with_crc(packing.token_pieces(table)).select("*", *(F.lit(7).alias(c) for c in ("before", "rank", "n", "bin")))
    got = packing.pack(pieces).collect()
    assert all(r["before"] == r["rank"] == r["n"] == 7 for r in got)
    placed = {}
    for r in got:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in placed.values():
        assert [a for a, _ in sorted(rows)] == list(itertools.accumulate((n for _, n in sorted(rows)), initial=0))[:-1]
    assert sum(r["doc_id"] == 2 for r in got) == 2


def test_draws_are_bounded_when_ids_are_null_or_repeated(spark, monkeypatch):
    from leafpress.llm import langid, mixing

    rows = spark.range(3000).selectExpr("cast(null as long) as doc_id", "concat('word', id % 1500, ' other text') as text", "'x' as lang", "id % 2 as quality", "0 as toxic")
    counted = spark.sparkContext.accumulator(0)
    features = mixing._features
    monkeypatch.setattr(mixing, "_features", lambda column: counted.add(len(column)) or features(column))
    for table in (rows, rows.withColumn("doc_id", F.expr("7L")), rows.withColumn("doc_id", F.col("quality"))):
        before = counted.value
        mixing.fit_domains(table, mixing.label_domain(), fit_rows=100)
        assert counted.value - before == 100
    before = counted.value
    mixing.fit_domains(rows.withColumn("doc_id", F.monotonically_increasing_id()), mixing.label_domain(), fit_rows=100)
    assert counted.value - before == 100
    assert langid.fit(rows).languages == ["x"]


def test_the_draw_comes_to_the_driver_in_few_bytes_a_feature(spark):
    import tracemalloc

    from leafpress.llm import mixing

    words, n = 400, 3000
    rows = spark.range(n).selectExpr("id as doc_id", f"array_join(transform(sequence(1, {words}), k -> concat('w', pmod(xxhash64(id, k), 100000))), ' ') || ' of' || id % 2 as text", "id % 2 as quality", "0 as toxic")
    mixing.fit_domains(rows.limit(10), mixing.label_domain())  # modules are loaded
    tracemalloc.start()
    try:
        model = mixing.fit_domains(rows, mixing.label_domain())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.weights) > 1 and peak < 40 * words * n


def test_many_spans_in_one_text(spark):
    from leafpress.llm import pii

    text = " ".join(f"é user{i}@mail{i}.com +1 555 {1000 + i} 10.0.{i % 256}.1" for i in range(1500))
    found = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()["pii"]
    plain = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(?:\.[0-9]+){3}")]
    for kind, pattern in plain:
        assert [(s["start"], s["end"]) for s in found if s["kind"] == kind] == [m.span() for m in re.finditer(pattern, text)]


def test_licenses_that_are_said_and_that_are_not():
    from leafpress.llm import licenses

    gate = re.compile(licenses.GATE)
    names = lambda text: {r[3] for r in licenses.scan_text(text, gate)}
    for text, wanted in {
        "Licensed under the Apache License 2.0": {"Apache-2.0"}, "Licensed under the Apache License, Version 2.0.": {"Apache-2.0"}, "License: MIT": {"MIT"}, "License: Apache-2.0": {"Apache-2.0"}, "licensed under the GPLv3": {"GPL-3.0"},
        "License: CC-BY-4.0": {"CC-BY-4.0"}, "Licensed under CC BY 4.0.": {"CC-BY-4.0"}, "Licensed under CC BY-SA 4.0.": {"CC-BY-SA-4.0"}, "SPDX-License-Identifier: ISC": {"ISC"}, "Licensed under the ISC License.": {"ISC"},
        "This is free and unencumbered software released into the public domain.": {"Unlicense"}, "SPDX-License-Identifier: LGPL-2.1-only": {"LGPL-2.1"}, "SPDX-License-Identifier: EPL-2.0": {"EPL-2.0"}, "Released under the MIT License.": {"MIT"},
        "SPDX-License-Identifier: LGPL-2.1-or-later": {"LGPL-2.1-or-later"}, "Licensed under the BSD 2-Clause License.": {"BSD-2-Clause"},
        "CC 4.0 is a number": set(), "unlike the MIT License": set(), "without the MIT License": set(), "we reject the MIT License": set(), "rather than the MIT License": set(), "a license for drivers": set(),
    }.items():
        assert names(text) == wanted, text
