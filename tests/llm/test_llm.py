"""Each operator against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import gzip
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leafpress.llm import ann, langid, licenses, minhash, mixing, packing, pii, queries, repetition, token_files, tokens, warc
from leafpress.storage import materialize, new_path

SF = "/root/testdata/sf0.001"
SMALLEST = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, extra string"


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "x") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " ", "a", "a  b\n\n c", "x" * 5000, "été ß 　中文", "tab\tand\x0bvt", "it's <|endoftext|> 'tis", "1 234,5.6\r\n z"]


# Tokens


def test_word_encoder_equals_the_tokenizer():
    whole = Tokenizer.from_file(tokens.tokenizer_path())
    ours = tokens.WordEncoder(tokens.tokenizer_path())
    ours.words.limit = 300  # most words are learnt again and again
    rnd = random.Random(1)
    signs = [*"ab' .,\n12_-é’ñß²½　中ф\t\xa0 Ạ\x1c\0Z", "  ", "\n\n", " '", "'s", "'ll", "\U0001f600", "<|endoftext|>"]
    texts = ODD + ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    ids, counts = ours.encode(pa.array(texts))
    at = 0
    for t, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)
        at += n
    assert at == len(ids)


def reference_ids(text, end):
    return [*Tokenizer.from_file(tokens.tokenizer_path()).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark):
    texts = ODD + ["some words here"] * 5
    path = new_path(spark, "t")
    token_files.write_token_files(docs(spark, texts).orderBy(F.desc("doc_id")), path)
    at = 0
    for row, (i, t) in zip(token_files.token_index(spark, path).orderBy("doc_id").collect(), enumerate(texts), strict=True):
        ids = reference_ids(t, 0)
        assert tuple(row) == (i, at, len(ids), crc(ids))
        at += len(ids)
    assert token_files.read_token_files(spark, path, "doc_id = 3", ["tokens"]).first()["tokens"] == reference_ids("a", 0)
    none = new_path(spark, "t")
    token_files.write_token_files(docs(spark, []), none)
    assert token_files.read_token_files(spark, none).count() == 0


def test_packing(spark):
    texts = ODD + ["word " * n for n in (1, 5, 400, 1023, 1024, 1025, 5000)] * 3
    pieces = materialize(packing.token_pieces(docs(spark, texts)), "p")
    rows = packing.pack(packing.with_crc(pieces), written=pieces).toPandas()
    for i, t in enumerate(texts):
        ids, got = reference_ids(t, 2), rows[rows.doc_id == i].sort_values("piece")
        assert got.length.sum() == len(ids) and (got.start == got.length.cumsum() - got.length).all()
        assert (got.length.iloc[1:] == 1024).all() and got.length.max() <= 1024
        assert [crc(ids[s : s + n]) for s, n in zip(got.start, got.length, strict=True)] == got.ids_crc32.tolist()
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 1024
    empty = materialize(packing.token_pieces(docs(spark, [])), "p")
    assert packing.pack(empty).count() == 0


def test_fullest_combination_against_all_subsets():
    rnd = random.Random(3)
    for _ in range(200):
        counts = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(rnd.randint(1, 5))}
        room = rnd.randint(1, 60)
        items = [x for x, n in counts.items() for _ in range(n)]
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        found = packing.fullest(counts, room)
        assert sum(x * n for x, n in found.items()) == best and all(counts[x] >= n for x, n in found.items())
    histogram = {int(x): int(n) for x, n in zip(*np.unique(np.random.default_rng(0).integers(1, 1025, 5000), return_counts=True), strict=True)}
    plan = packing.plan_bins(histogram, 1024)
    packed = collections.Counter()
    for combination, bins in plan:
        for x, n in combination.items():
            packed[x] += n * bins
    assert packed == histogram
    assert sum(b for _, b in plan) <= 1.01 * packing.least_bins(histogram, 1024) + 1


# Near-duplicates


def brute_components(rows, words_in, percent):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[k : k + words_in]) for k in range(max(1, len(w) - words_in + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_texts(n=260):
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    out = [*ODD, "One TWO", "one two", "one two"]
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.6:  # a large group of near copies, some of them linked only over others
            w = list(base)
            for _ in range(rnd.randint(0, 12)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        elif kind < 0.8:
            w = passage + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        else:
            w = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 50))]
        out += [" ".join(w)] * rnd.choice([1, 1, 1, 3])
    return out


@pytest.mark.parametrize(("words_in", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, words_in, percent):
    texts = near_texts()
    df = docs(spark, texts).unionByName(spark.createDataFrame([(None, "one two", "en", "")], DOCS))
    found = {r["doc_id"]: r for r in minhash.near_duplicates(df, words_in=words_in, percent=percent).collect()}
    wanted = brute_components(list(enumerate(texts)), words_in, percent)
    assert {i: (found[i]["n_shingles"], found[i]["component_id"]) for i in wanted} == wanted
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found.values())
    assert found[None]["component_id"] is None


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    repeated = docs(spark, ["a b c d e f"]).unionByName(docs(spark, ["a b c d e f"]))
    assert [(r["component_id"], r["kept"]) for r in minhash.near_duplicates(repeated).collect()] == [(0, True)] * 2


# Personal data

BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(re.sub("[ -]", "", v)) <= 19 and luhn(re.sub("[ -]", "", v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(t):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in BASE.items() for m in re.finditer(p, t or "") if ok(m[0]))


def test_pii(spark):
    rnd = random.Random(2)
    signs = [*"ab1230.@+-_ é()\n", "4111 1111 1111 1111", "a@b.co", "1.2.3.4", "+1 (555) 010-0000", "999.1.1.1", "4111111111111111", "\U0001f600"]
    texts = [*ODD, "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8", "00001.0255.3.4", "a." * 4000 + "@x", "1" * 5000, "+" * 50 + "1" * 30] + ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 20))) for _ in range(1500)]
    df = docs(spark, texts).withColumnRenamed("extra", "pii")  # a clashing name is replaced
    rows = pii.find_pii(df).select("doc_id", pii.spans_text("pii", base_only=True).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in rows} == {i: brute_spans(t) for i, t in enumerate(texts)}


def test_pii_of_the_method(spark):
    texts = ["Bank account DE89 3704 0044 0532 0130 00.", "DE89 3704 0044 0532 0130 01", "SSN 123-45-6789", "part 123-45-6789", "call 030-1234-5678 now", "see 030-1234-5678 now", "mail a@b.co twice, card 4111 1111 1111 1111", None]
    rows = pii.redact(pii.find_pii(docs(spark, texts))).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["Bank account [IBAN].", texts[1], "SSN [SSN]", texts[3], "call [LOCAL_PHONE] now", texts[5], "mail [EMAIL] twice, card [CARD]", None]
    assert pii.find_pii(docs(spark, [])).count() == 0


# Archives


def test_warc(spark):
    rows = [(1, "http://a/x", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b/ y\n", ""), (4, "u", None), (5, "u", "z" * 3_000_000), (6, "u", "\r\n\r\nHTTP"), (2, "again", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    path = new_path(spark, "warc")
    warc.write_pages(df, path)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", i), i)
    wanted = sorted((i, len((h or "").encode()), warc.digest_of((h or "").encode()), "revisit" if i < top[h or ""] else "response", top[h or ""] if i < top[h or ""] else -1) for i, _, h in rows)
    found = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or -1) for r in warc.page_records(spark, path).collect())
    assert found == wanted
    heads = warc.read_warc(spark, path, ["record_id", "record_type", "target_uri"]).where("record_type = 'revisit' and target_uri like 'http%'")
    assert sorted(r["target_uri"] for r in heads.collect()) == ["http://a/x", "http://b/ y%0A"]
    assert "".join(r["payload"].decode() for r in warc.read_warc(spark, path, ["record_id", "payload"]).where("record_id = '<urn:page:6>'").collect()) == "\r\n\r\nHTTP"
    none = new_path(spark, "warc")
    warc.write_pages(df.limit(0), none)
    assert warc.page_records(spark, none).count() == 0


def test_skipped_payloads_are_not_read(tmp_path):
    """Bytes read of a file whose records are large: headers only, but for foreign members, which tell no length."""
    rnd = random.Random(5)
    blocks = [bytes(rnd.getrandbits(8) for _ in range(3_000_000)) for _ in range(3)]
    fields = lambda k: {"WARC-Type": "response", "WARC-Record-ID": f"<urn:{k}>"}
    ours = b"".join(warc.record(fields(k), b) for k, b in enumerate(blocks))
    foreign = gzip.compress(b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(ours + foreign + warc.record(fields(9), b"") + foreign)
    with pa.OSFile(str(path)) as file:
        members, heads = warc._Members(file), []
        while (head := members.headers()) is not None:
            heads.append(head["warc-type"])
            members.skip()
        assert heads == ["response"] * 3 + ["request", "response", "request"] and members.bytes_read < 4.5 * warc._READ
    with pa.OSFile(str(path)) as file:
        members, found = warc._Members(file), []
        while (head := members.headers()) is not None:
            found.append(members.block(int(head["content-length"])))
        assert found == [*blocks, b"abc", b"", b"abc"]
    assert [m.split(b"\r\n\r\n", 1)[1][:-4] for m in [gzip.decompress(warc.record(fields(0), b)) for b in (b"", b"x" * 70_000)]] == [b"", b"x" * 70_000]


# Quality


def brute_base(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n")]
    dup = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
    grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    inside = {k + d for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def brute_share(t, n):
    w = WORD.findall(t or "")
    grams = collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    inside = {k + d for k in range(len(w) - n + 1) if grams[tuple(w[k : k + n])] > 1 for d in range(n)}
    return sum(len(w[k]) for k in inside) / max(1, sum(map(len, w)))


def test_quality_rules(spark):
    rnd = random.Random(4)
    texts = ODD + ["é # b\na b\na b\n\n\x0b\n\x0b\na b"] + ["".join(rnd.choice(["a ", "b ", "é ", "c\n", "<x> "]) for _ in range(rnd.randint(1, 90))) for _ in range(300)] + [" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(80))]
    rows = repetition.quality_rules(docs(spark, texts)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        base = brute_base(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base, repr(t)
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert all(abs(r[f"dup_{n}gram_share"] - brute_share(t, n)) < 1e-9 for n in repetition.NGRAM_LIMITS)
    assert rows[-1]["kept"] and not rows[0]["kept"]
    assert repetition.quality_rules(docs(spark, [])).count() == 0


# Languages


def test_kneser_ney_sums_to_one():
    words = ["banana", "bandana", "cab", "abc", "nab"]
    model = langid.LanguageModels(["x"], [langid.CharModel.fit(words, np.array([3.0, 1, 2, 1, 1]))], np.array([9.0]))
    model.merge()
    assert np.isfinite(model.words(["", "b", "ban", "zz", "x" * 500])[0]).all()
    letters = sorted({c for w in words for c in w})
    grams = dict(zip(model.models[0].grams[0].tolist(), model.models[0].probabilities[0].tolist(), strict=True))
    assert len(grams) == len(letters) + 1
    assert abs(sum(grams.values()) + model.models[0].floor - 1) < 1e-9


def direct_kneser_ney(counted):
    """log2 probability of a word by the definition, from dictionaries of strings."""
    order, tables = langid.ORDER, []
    for n in range(1, order + 1):
        table = collections.Counter()
        for w, times in counted.items():
            for end in range(max(1, n - 1), len(w) + 2):
                table[f" {w} "[end - n + 1 : end + 1]] += times
        tables.append(table)
    probability, backoff, floor = [], [], 0.0
    for n in range(order):
        predecessors = collections.Counter(g[1:] for g in tables[n + 1]) if n + 1 < order else {}
        count = {g: predecessors.get(g) or c for g, c in tables[n].items()}
        ones, twos = (sum(c == x for c in count.values()) for x in (1, 2))
        discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
        total, kinds = collections.Counter(), collections.Counter()
        for g, c in count.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        backoff.append({h: discount * kinds[h] / total[h] for h in total})
        if n == 0:
            floor = backoff[0][""] / (len(count) + 1)
            probability.append({g: (c - discount) / total[""] + floor for g, c in count.items()})
        else:
            probability.append({g: (c - discount) / total[g[:-1]] + backoff[n][g[:-1]] * probability[n - 1][g[1:]] for g, c in count.items()})

    def bits(w):
        s, out = f" {w} ", 0.0
        for end in range(1, len(s)):
            p = floor
            for n in range(1, min(order, end + 1) + 1):
                g = s[end - n + 1 : end + 1]
                p = probability[n - 1][g] if g in probability[n - 1] else p * (backoff[n - 1].get(g[:-1], 1.0) if n > 1 else 1.0)
            out += math.log2(p)
        return out

    return bits


def test_models_against_the_definition():
    rnd = random.Random(4)
    word = lambda signs: "".join(rnd.choice(signs) for _ in range(rnd.randint(1, 9)))
    samples = [{word(signs): rnd.randint(1, 4) for _ in range(200)} for signs in ("aabcde", "abbcéz")]
    models = [langid.CharModel.fit(list(x), np.array(list(x.values()), float)) for x in samples]
    both = langid.LanguageModels(["x", "y"], models, np.array([9.0, 9.0]))
    both.merge()
    asked = [*samples[0], *samples[1], *(word("abcdeéqz") for _ in range(200)), "q", "q" * 50]
    found, chars = both.words(asked)
    assert chars.tolist() == [len(w) + 1 for w in asked]
    for k, x in enumerate(samples):
        direct = direct_kneser_ney(x)
        assert np.allclose(found[:, k], [direct(w) for w in asked], atol=1e-3)


def test_letter_runs_are_what_the_pattern_finds():
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice([*"aZ '1_.-\n×÷Éßÿºª²µŁΣσ中٣", " x", "İ"]) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    for group in (texts, [t for t in texts if t is not None and t.encode("utf-8").isascii()], [t for t in texts if t is not None and all(c < "Ā" and not "\x7f" < c < "À" for c in t)]):
        spans, letters = langid.letter_runs(pa.array(group, pa.string()))
        words = [w.decode() for w in spans.bytes_of(np.arange(len(spans.starts)))]
        ends = np.cumsum(spans.counts)
        for t, a, e, has in zip(group, (ends - spans.counts).tolist(), ends.tolist(), letters.tolist(), strict=True):
            assert words[a:e] == re.findall(r"[^\W\d_]+", (t or "").lower()) and has == any(c.isalpha() for c in (t or "")), repr(t)


def test_clashing_names_and_repeated_rows(spark):
    """Operators that keep all columns, on names that they use themselves."""
    df = docs(spark, ["Mail a@b.co now", "Mail a@b.co now", None]).withColumns({c: F.lit(c) for c in ("__text", "__row", "__found", "__found0", "m_email", "spans", "node", "key")})
    found = pii.find_pii(df).toPandas()
    assert [len(x) for x in found.sort_values("doc_id").pii] == [1, 1, 0] and set(df.columns) < set(found.columns)
    named = langid.identify(df, langid.fit(df)).toPandas()
    assert len(named) == 3 and set(df.columns) < set(named.columns) and (named.m_email == "m_email").all()
    twice = df.unionByName(df)
    assert len(licenses.license_scan(docs(spark, ["MIT License"] * 2)).collect()) in (0, 2)
    assert repetition.quality_rules(twice).count() == 6 and minhash.near_duplicates(twice).count() == 6
    pieces = packing.token_pieces(twice)
    assert pieces.count() == 6


def test_language_id(spark):
    en, fr = "the cat sat on the mat with a hat and then it went away", "le chat est assis sur le tapis avec un chapeau et puis il est parti"
    rnd = random.Random(6)
    make = lambda s: " ".join(rnd.sample(s.split(), 8))
    rows = [(i, make(en if i % 2 else fr), "en" if i % 2 else "fr") for i in range(200)] + [(900, None, "en"), (901, "", "en"), (902, "12 34 !?", "fr"), (903, make(en), None), (904, "x" * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    models = langid.fit(df)
    found = {r["doc_id"]: r for r in langid.identify(df, models).collect()}
    assert sum(found[i]["lang_pred"] == l for i, _, l in rows[:200]) >= 198
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"] for i in (900, 901, 902))
    assert found[903]["lang_pred"] == "en" and 0 <= found[903]["score"] <= 1 and found[904]["rejected"]
    few = langid.fit(spark.createDataFrame([(i, f"{w} word", w) for i, w in enumerate(["uno", "due", "tre"])], "doc_id long, text string, lang string"))
    assert np.isfinite(few.limits).all()
    nothing = langid.fit(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(df.limit(0), models).count() == 0


def test_held_out_accuracy(spark):
    rows = queries.op7_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").toPandas()
    assert len(rows) > 20 and (rows.lang == rows.lang_pred).mean() >= 0.95


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_of_the_operators(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"create view {t} as select * from '{SMALLEST}/{t}.parquet'")
    ours, theirs = queries.queries()[name](spark, SMALLEST).toPandas(), c.execute(queries.ORACLES[name]).df()
    key = "page_id" if "page_id" in theirs else "doc_id"
    ours, theirs = (d[sorted(theirs.columns)].sort_values(key).astype(object).where(d.notna(), None).values.tolist() for d in (ours, theirs))
    assert ours == theirs


# Licenses


def test_license_scan(spark):
    texts = [*ODD, "x\nLicensed under the Apache License, Version 2.0.\ny", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 3.0.", "This work is licensed under the\nGNU General Public License, version 3.", "a license to drive", "Released under the MIT License. Enjoy"]
    rows = licenses.license_scan(docs(spark, texts)).collect()
    assert sorted((r["doc_id"] - len(ODD), r["license"]) for r in rows) == [(0, "Apache-2.0"), (1, "CC-BY-NC-4.0"), (2, "CC-BY-4.0"), (4, "GPL-3.0"), (6, "MIT")]
    assert all(texts[r["doc_id"]][r["start"] : r["end"]] == r["text"] and r["dict_bytes"] < r["plain_bytes"] for r in rows)
    assert licenses.license_scan(docs(spark, [])).count() == 0


def licenses_in(text):
    return sorted(r[3] for r in licenses.scan_text(text, re.compile(licenses.GATE)))


def test_the_gate_drops_no_notice():
    """With and without the gate, the same licenses in lines made of pieces of notices."""
    rnd = random.Random(12)
    notices = [t.replace("*", "2024 Acme") for group in licenses.TEMPLATES.values() for t in group] + ["Released under CC BY-NC 4.0.", "mit", "we license it", "Version 2.0", "all of it is reserved"]
    gate, none = re.compile(licenses.GATE), re.compile("")
    for _ in range(150):
        text = "\n".join(rnd.choice(["", "so "]) + " ".join(t if rnd.random() < 0.6 else " ".join(w for w in t.split() if rnd.random() < 0.8) for t in rnd.sample(notices, rnd.randint(1, 2))) for _ in range(rnd.randint(1, 3)))
        found = {(r[3], r[1]) for r in licenses.scan_text(text, none)}
        assert {n for n, _ in found} == {r[3] for r in licenses.scan_text(text, gate)}, text
    assert licenses_in("Released under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]


def test_license_after_other_words():
    """Light words far from a notice do not widen it; headers and openings of the license texts count."""
    header = "# This {} is free software{} you can redistribute it and/or modify\n# it under the terms of the GNU {}General Public License as published by\n# the Free Software Foundation{} either version {} of the License, or"
    prose = "this is the work of a long line in which many ordinary words stand " * 20
    assert licenses_in("This file is part of Foo and is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert licenses_in(f"{prose}This work is licensed under the GNU Affero General Public License, version 3. {prose}") == ["AGPL-3.0"]
    assert licenses_in(header.format("program", ";", "", ";", 2)) == ["GPL-2.0"]
    assert licenses_in(header.format("program", ":", "", ",", 3)) == ["GPL-3.0"]
    assert licenses_in(header.format("library", ":", "Lesser ", ",", 3)) == ["LGPL-3.0"]
    assert licenses_in("Mozilla Public License Version 2.0") == ["MPL-2.0"]
    assert licenses_in("Creative Commons Legal Code\n\nCC0 1.0 Universal") == licenses_in("This work is licensed under the GNU General Public blue License, version 2.") == []
    assert licenses_in("Creative Commons Legal Code\nCC0 1.0 Universal") == ["CC0-1.0"]
    assert all(re.search(licenses.GATE, t) for group in licenses.TEMPLATES.values() for t in group)


def test_all_licenses_of_a_long_line():
    """However many templates rank before it, a notice is tried."""
    prose = "".join(f"w{k * 7919 % 1009} of x{k * 104729 % 997} " for k in range(150))
    named = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-4.0": "Licensed under CC BY 4.0."}
    for text in (prose + " ".join(named.values()), f" {prose}".join(named.values())):
        assert licenses_in(text) == sorted(named)
    assert licenses_in(prose + " ".join(t.replace("*", "2024") for group in licenses.TEMPLATES.values() for t in group)) == sorted(licenses.TEMPLATES)


@pytest.mark.parametrize(("text", "wanted"), [
    ("SPDX-License-Identifier: LGPL-3.0-or-later", ["LGPL-3.0-or-later"]),
    ("// SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-2-Clause", ["Apache-2.0", "BSD-2-Clause", "MIT"]),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0"]),
    ("SPDX-License-Identifier:", []),
    ("This is not licensed under the MIT License.", []),
    ("It isn't released under the MIT License.", []),
    ("It isn't released under the MIT License. The rest is licensed under the MIT License.", ["MIT"]),
    ("This is not free. Licensed under the MIT License.", ["MIT"]),
    ("you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.", ["GPL-2.0-or-later"]),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.", ["GPL-2.0"]),
])
def test_identifiers_later_versions_and_negations(text, wanted):
    assert licenses_in(text) == wanted


def test_license_with_free_words():
    for text in ("Copyright 2024 Acme Corp. All rights reserved.", "x\nCopyright (c) 1999-2024, the Foo Authors and others.\nAll rights reserved.\ny", "All rights reserved.", "A line. All rights reserved. Copyright 2024", "Copyright Acme: all of its rights in this work. " * 9 + "All rights reserved."):
        assert licenses_in(text) == ["all-rights-reserved"], text
    assert licenses_in("Copyright 2024 Acme Corp. All Acme rights reserved.") == licenses_in("Copyright 2024. All our rights reserved, rights reserved") == []
    free = [licenses.words_of(run) for run in "Copyright * All rights reserved.".split("*")]
    said = lambda text: licenses.differences(free, licenses.words_of(text))
    assert said("Copyright 2024 Acme Corp. All rights reserved.") == said("Copyright Copyright 2 All rights reserved. Copyright") == (True, "")
    assert said("All of the rights reserved. Copyright 2024") == said("All rights reserved.") == (False, "")
    assert said("Copyright All rights. Copyright 2024 X. All the rights reserved.") == (True, "+the")


# Mixing


def test_mixing_meets_targets(spark):
    rnd = np.random.default_rng(1)
    p = rnd.dirichlet([0.3, 0.3, 0.3], 3000)
    members = spark.createDataFrame(pd.DataFrame({"doc_id": range(3000), "tokens": rnd.integers(0, 500, 3000), "posterior": p.tolist()}))
    steps = mixing.solve_rates(members, {"a": 0.5, "b": 0.3, "c": 0.2}, total_tokens=400_000)
    assert steps.converged and (steps.rates(p) >= 0).all()
    assert all(abs(t - x) <= 0.002 * 400_000 for t, x in steps.targets.values())
    nothing = mixing.solve_rates(members.limit(0), {"a": 1.0, "b": 1.0, "c": 1.0})
    assert len(nothing.moves) == 0 and nothing.converged


@pytest.mark.parametrize("seed, weights, share", [(0, (0.95, 0.045, 0.005), 0.4), (1, (0.2, 0.2, 0.6), 1.0), (2, (0.999, 0.0, 0.001), 1.0), (3, (1.0, 0.0, 0.0), 0.5)])
def test_rates_against_an_independent_solver(spark, seed, weights, share):
    """Within 200 documents, no other nonnegative rates come nearer to the targets, whether these can be met or not."""
    rnd = np.random.default_rng(seed)
    p = rnd.dirichlet([1.5, 0.3, 0.1], 200)
    t = rnd.integers(1, 900, 200).astype(float)
    members = spark.createDataFrame(pd.DataFrame({"doc_id": range(200), "tokens": t.astype(int), "posterior": p.tolist()}))
    target = np.array(weights) * share * t.sum()
    steps = mixing.solve_rates(members, dict(zip("abc", weights, strict=True)), total_tokens=share * t.sum())
    rates = np.ones(200)  # plain projected gradient, accelerated, without any scaling by a Gram matrix
    a = np.sqrt(t)[:, None] * p
    u = v = np.sqrt(t)
    for k in range(20000):
        new = np.maximum(0, v - a @ (v @ a - target) / np.linalg.eigvalsh(a.T @ a)[-1])
        u, v = new, new + k / (k + 3) * (new - u)
    rates = u / np.sqrt(t)
    least, ours = (np.linalg.norm((r * t) @ p - target) for r in (rates, steps.rates(p)))
    assert ours <= least + 0.002 * target.sum() and steps.converged == (np.abs((steps.rates(p) * t) @ p - target).max() <= mixing.TOLERANCE * target.sum())


def test_mixing_prefers_what_is_labelled_good(spark):
    words = [f"w{i}" for i in range(50)]
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choices(words, k=40)) + (" vile awful" if i % 5 == 0 else ""), int(i % 5 > 0)) for i in range(400)] + [(900, None, None), (901, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good int").withColumn("rate", F.lit("clash"))
    model = mixing.fit_domains(df, F.when(F.col("good") == 1, "good").when(F.col("good") == 0, "toxic"), domains=("good", "toxic"))
    out = {r["doc_id"]: r for r in mixing.mix(df, model, {"good": 0.99, "toxic": 0.01}).collect()}
    assert len(out) == 402 and out[900]["tokens"] == 0
    bad, good = ([out[i]["rate"] for i, _, g in rows[:400] if g == k] for k in (0, 1))
    assert np.mean(bad) < 0.2 < 0.95 < np.mean(good)
    assert mixing.mix(df.limit(0), model, {"good": 0.99, "toxic": 0.01}).count() == 0


# Neighbours


def brute_nearest(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    order = [i for i in np.lexsort((ids, -scores)) if i != query]
    return [int(ids[i]) for i in order[:k]]


def test_chi_square_quantile():
    assert abs(ann.chi_square_quantile(0.95, 10) - 18.307) < 1e-3 and abs(ann.chi_square_quantile(0.5, 2) - 1.386294) < 1e-5


def test_nearest_neighbours(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((8, 24))
    v = np.concatenate([centres[rnd.integers(0, 8, 1500)] + 0.6 * rnd.standard_normal((1500, 24)), np.repeat(centres[:1], 300, axis=0)])
    v *= rnd.uniform(0.5, 2, (len(v), 1)) ** (np.arange(len(v)) < 1500)[:, None]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] * 24), (5080, [1.0, 2.0]), (None, v[0].tolist()), (5100, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = ann.nearest(df, df.where("vec_id % 20 = 0")).toPandas()
    hit = 0
    for q, g in found.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(g.score, v[g.vec_id] @ v[q]) and (g.score.diff().dropna() <= 1e-12).all()
        hit += len(set(g.vec_id) & set(brute_nearest(np.arange(len(v)), v, q, 20)))
    assert found.query_id.nunique() == 90 and hit >= 0.95 * 20 * 90
    few = df.where("vec_id < 5")
    assert ann.nearest(few, few).count() == 20
    assert ann.nearest(df.limit(0), df).count() == 0


# Pipeline


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs_in = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "the and of the a@b.co", "en", None, 5)], docs_in.schema)
    rows = docs_in.unionByName(extra)
    for name, stage in pipeline.STAGES[:-1]:
        before = rows.count()
        rows = materialize(stage(spark, rows, SF), name)
        assert rows.columns == docs_in.columns and rows.count() <= before
    assert rows.where("text like '%@%.%'").count() == 0
    packed = pipeline.STAGES[-1][1](spark, rows, SF).toPandas()
    assert set(packed.doc_id.dropna()) == {r["doc_id"] for r in rows.where("doc_id is not null").select("doc_id").collect()} and packed.groupby("sequence_id").length.sum().max() <= 1024
