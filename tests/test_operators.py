"""Small tables for quality, index, vectors, search, evaluation, audit, sources and the page stream."""

import os

import numpy as np
from pyspark.sql import functions as F

from leafpress.jobs import registry
from leafpress.operators import audit, components, evaluate, index, quality, search, vectors
from leafpress.sources import readers
from leafpress.streaming import pages as stream


def tuples(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_numbers(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 5)] + [("b", 1), ("b", 2), ("c", 2), ("c", 2), ("c", 3)], "book string, number int")
    assert tuples(quality.missing_numbers(df, ["book"])) == [("a", 3), ("a", 4), ("c", 1)]
    assert [(r["book"], r["contiguous"]) for r in quality.contiguous(df, ["book"]).orderBy("book").collect()] == [("a", False), ("b", True), ("c", False)]


def test_errata(spark):
    rows = spark.createDataFrame([(6, "k", "e", "s"), (7, "odd", "e", "s"), (7, "print_missing_number", "", "s"), (7, "print_missing_number", "e", None), (7, "print_missing_number", "e", "s")], "cells int, kind string, evidence string, source string")
    assert [r["reason"] for r in quality.validate_errata(rows).collect()] == ["too few columns", "unknown kind", "no evidence", "no source", None]
    missing = spark.createDataFrame([("a", "C01", 3), ("a", "C02", 4), ("b", "C01", 3)], "book string, scope_id string, missing int")
    errata = spark.createDataFrame([("a", "C02 title", "print_missing_number", "4"), ("*", "C01", "print_missing_number", "3")], "book string, scope string, kind string, value string")
    assert tuples(quality.exempt_missing(missing, errata)) == [("a", 2, 2, True), ("b", 1, 1, True)]
    dup = spark.createDataFrame([("a", "C01", 9, "x"), ("a", "C01", 9, "x"), ("b", "C01", 9, "y"), ("b", "C01", 9, "y")], "book string, scope_id string, number int, recipe_id string")
    named = spark.createDataFrame([("a", "C01", "print_duplicate_number", "9")], "book string, scope string, kind string, value string")
    assert [r["book"] for r in quality.exempt_duplicates(dup, named).collect()] == ["b"]


def test_gates_and_collisions(spark):
    g = spark.createDataFrame([("a", "x", "PASS"), ("a", "y", "SKIP"), ("b", "x", "FAIL"), ("b", "y", "SKIP"), ("c", "x", "PASS")], "book string, gate string, status string")
    assert [(r["book"], r["verdict"]) for r in quality.gate_rollup(g).orderBy("book").collect()] == [("a", "SKIP"), ("b", "FAIL"), ("c", "PASS")]
    recipes = spark.createDataFrame([("a", "r1"), ("a", "r1"), ("a", "r2"), ("a", "r2"), ("a", "r3")], "book string, recipe_id string")
    blocks = spark.createDataFrame([("a", "r1", 1), ("a", "r2", 2)], "book string, recipe_id string, page_from int")
    lines = spark.createDataFrame([("a", 1, 0, "section", None, False, False), ("a", 1, 1, "start", None, False, False), ("a", 2, 0, "section", "main", False, False), ("a", 2, 1, "start", None, False, False)], "book string, page int, line int, mark string, named string, chapter_line boolean, sub_line boolean")
    assert tuples(quality.collision_attribution(recipes, blocks, lines)) == [("a", "r1", "assembly"), ("a", "r2", "transcription")]


def test_components_and_families(spark):
    chain = spark.range(200).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(1000, 999), (None, 5)], "a long, b long"))
    found = components.connected_components(chain).groupBy("component").count()
    assert tuples(found) == [(0, 201), (999, 2)]
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "x string, y string")
    families = index.families(pairs)
    assert [r["members"] for r in families.orderBy("family").collect()] == [["a", "b", "c"], ["d", "e"]]
    stored = spark.createDataFrame([(["a", "b"],)], "members array<string>")
    assert tuples(index.missing_pairs(pairs, stored)) == [("b", "c"), ("d", "e")]
    assert sorted(r["side"] for r in index.family_drift(families, stored).collect()) == ["derived", "derived", "stored"]
    gaps = spark.createDataFrame([("鱼",), ("肉",)], "char string")
    assert tuples(index.uncovered_gaps(gaps, spark.createDataFrame([("炒鱼片",)], "q string"))) == [("肉",)]


def test_vectors(spark):
    now = spark.createDataFrame([("a", "m", "f", "1", "2"), ("b", "m", "f", "1", "2"), ("c", "m", "f", "1", "2")], "book string, model string, dtype string, sig_card string, sig_text string")
    old = spark.createDataFrame([("a", "m", "f", "1", "2", True), ("b", "m", "f", "9", "2", True), ("c", "m", "f", "1", "2", False)], "book string, model string, dtype string, sig_card string, sig_text string, present boolean")
    assert tuples(vectors.signature_status(now, old)) == [("a", [], "PASS"), ("b", ["sig_card"], "SKIP"), ("c", [], "FAIL")]
    inputs = spark.range(70).selectExpr("'a' as book", "'card' as kind", "id as ord", "string(id) as id", "string(id) as text")
    assert vectors.batches(inputs).agg(F.max("batch")).first()[0] == 2
    vecs = vectors.embed(inputs, lambda texts: np.array([[float(t), 1.0] for t in texts]))
    assert sorted(r["vec"][0] for r in vecs.collect()) == [float(i) for i in range(70)]
    zero = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>").select(vectors.l2_normalize("v").alias("n")).collect()
    assert [r["n"] for r in zero] == [None, [0.6, 0.8]]


def test_search(spark):
    queries = spark.createDataFrame([(1, "红烧鱼"), (2, "鱼"), (3, "甲乙")], "query_id int, q string")
    blocks = spark.createDataFrame([(10, 0, "红烧鱼块"), (11, 0, "红烧肉"), (12, 0, "清蒸鱼"), (13, 0, "甲 乙丙")], "record_id int, block_id int, text string")
    keys = spark.createDataFrame([("红烧鱼", 11, 5)], "key string, record_id int, ord int")
    lex = {(r["query_id"], r["record_id"]): r["score"] for r in search.lexical_layer(queries, blocks).collect()}
    assert lex == {(1, 10): 2.0, (1, 11): 0.5, (3, 13): 2.0}  # one character alone hits nothing longer
    hits = search.search(queries, blocks, keys, k=5)
    assert [(r["record_id"], r["pinned"]) for r in hits.where("query_id = 1").orderBy("rank").collect()] == [(11, True), (10, False)]
    assert search.apply_rerank(hits, spark.createDataFrame([], "query_id int, record_id int, rerank double")).where("rank <> old_rank").count() == 0
    flipped = search.apply_rerank(hits.withColumn("pinned", F.lit(False)), spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.1)], "query_id int, record_id int, rerank double"))
    assert [r["record_id"] for r in flipped.where("query_id = 1").orderBy("rank").collect()] == [10, 11]
    flags = {r["query_id"]: r["layers"] for r in search.layers_used(hits).collect()}
    assert flags[1] == {"terms": True, "lex": True, "vector": False}


def test_evaluate(spark):
    cases = spark.createDataFrame([("a", "q", None, None, None), ("z", "q", 1, True, False)], "book string, q string, topn int, expect_none boolean, needs_vectors boolean")
    books = spark.createDataFrame([("a",)], "book string")
    assert tuples(evaluate.registered_cases(cases, books)) == [("a", "q", 3, False, False)]
    verdicts = spark.createDataFrame([("PASS",), ("SKIP",)], "verdict string")
    assert tuples(evaluate.verdict_counts(verdicts)) == [(1, 0, 1, 3)]


def test_audit(spark):
    docs = spark.createDataFrame([("a", "x\ny\nat C:\\dir"), ("b", "mail me@ex.org"), ("c", "re.compile(r'D:/x')"), ("d", None), ("e", "t sk-" + "a" * 16), ("f", "密钥sk-" + "a" * 16), ("g", "sk-" + "a" * 16 + "é")], "path string, text string")
    hits = audit.apply_exemptions(audit.scan_patterns(docs), spark.createDataFrame([("b", "declared")], "path string, reason string"))
    assert tuples(audit.audit_verdict(docs, hits)) == [("a", "FAIL", "drive path@L3"), ("b", "PASS", ""), ("c", "PASS", ""), ("d", "PASS", ""), ("e", "FAIL", "token@L1"), ("f", "PASS", ""), ("g", "PASS", "")]
    assert {r["verdict"] for r in audit.audit_verdict(docs, hits.where("false"), have_literals=False).collect()} == {"SKIP"}
    files = spark.createDataFrame([("scripts/a.py", 1, "s"), ("x/out/b", 2, "t"), ("vectors_1.npy", 3, "u")], "path string, bytes long, sha256 string")
    assert [(r["reason"], r["layer"]) for r in audit.assign_layer(audit.classify_files(files, light=True)).orderBy("bytes").collect()] == [(None, "00-engine"), ("run products", "90-other"), ("vectors left out", "90-other")]
    recorded = spark.createDataFrame([("scripts/a.py", 1, "s"), ("x/out/b", 2, "T"), ("gone", 1, "g")], "path string, bytes long, sha256 string")
    assert tuples(audit.verify_manifest(files, recorded)) == [("gone", "missing"), ("scripts/a.py", "ok"), ("vectors_1.npy", "extra"), ("x/out/b", "bad")]


def test_readers(spark, tmp_path):
    files = spark.createDataFrame([("f", "# note\n\na\t b \tc\nx\n"), ("g", "")], "path string, text string")
    assert [tuple(r)[1:] for r in readers.tsv_rows(files, ["p", "q"]).orderBy("line").collect()] == [(3, 3, "a", "b"), (4, 1, "x", None)]
    head = spark.createDataFrame([("f", "\nk\tv\n1\t2\n3\n")], "path string, text string")
    assert [tuple(r)[2:] for r in readers.header_rows(head, ["v", "k", "none"]).orderBy("line").collect()] == [("2", "1", ""), ("", "3", "")]
    rules = spark.createDataFrame([("f", "[s]\nab # c\n\n#x\n")], "path string, text string")
    assert [r["literal"] for r in readers.rule_rows(rules).collect()] == ["ab"]
    (tmp_path / "b1").write_bytes(b"abc")
    assert [(r["bytes"], r["sha256"][:8]) for r in readers.read_files(spark, str(tmp_path)).collect()] == [(3, "ba7816bf")]


def test_page_stream(spark, tmp_path):
    root, out = tmp_path / "kb", str(tmp_path / "out")
    for book, n in (("B01", 0), ("B02", 0)):
        os.makedirs(root / book / "_pages", exist_ok=True)
        (root / book / "_pages" / f"p{n:04d}.md").write_text("@@RECIPE_START 1 甲\n@@SECTION 主料\nx\n")
    run = lambda: stream.start(spark, str(root), str(tmp_path / "pages"), out, str(tmp_path / "cp")).awaitTermination()
    run()
    count = lambda: {r["book"]: r["count"] for r in spark.read.parquet(f"{out}/recipes").groupBy("book").count().collect()}
    assert count() == {"B01": 1, "B02": 1}
    (root / "B01" / "_pages" / "p0001.md").write_text("@@RECIPE_START 2 乙\n")
    run()
    assert count() == {"B01": 2, "B02": 1}


def brute_ranks(asked, found):
    """Records of each query by their best block, and one more if the record holds all of the query; ``found``: texts of blocks."""
    norm, grams = lambda x: "".join(x.split()), lambda x: {x[i : i + 2] for i in range(len(x) - 1)}
    out = {}
    for i, q in asked:
        q = norm(q)
        shares = {r: [(k, len(grams(q) & grams(norm(b))) / len(grams(q))) for k, b in enumerate(blocks) if grams(q) & grams(norm(b))] for r, blocks in found.items()}
        scores = {r: (-max(s for _, s in x) - (q in norm("".join(found[r]))), min(k for k, _ in x), r) for r, x in shares.items() if x}
        out[i] = sorted(scores, key=scores.get)
    return out


def test_flagship_asks_whole_passages(spark, tmp_path):
    """Documents with only the head, only the rest, or all of a passage, in one line or across lines."""
    head, rest = "the quick brown fox jumps over the lazy dog and then it", " sits waltzing by grumpy zebras; vexing MMXIX,\nBQZ KWY!"
    asked = [(1, head + rest), (2, "zz top")]
    docs = {1: head, 2: "a\n" + rest, 3: "x " + (head + rest).replace("\n", " ") + " y", 4: "nothing here but THE dog", 5: "b\nc\n" + head + rest, 6: head + "\n" + head[::-1], 7: "ZZ", 8: "azz topaz"}
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(docs.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    hits = registry.queries()[registry.FLAGSHIP](spark, str(tmp_path)).orderBy("query_id", "rank").collect()
    wanted = brute_ranks(asked, {d: text.split("\n") for d, text in docs.items()})
    assert wanted[1][:2] == [3, 5]
    assert [(r["query_id"], r["record_id"]) for r in hits] == [(i, d) for i, _ in asked for d in wanted[i][:5]]


def test_conversations_with_whole_passages(spark, tmp_path):
    """First turns that differ after the head are no exact hits; a turn with only the head does not hold the passage."""
    text = "a long first turn that many begin with, and which ends here"
    turns = [(1, 0, text), (2, 0, text.replace("here", "elsewhere")), (3, 0, "x"), (3, 1, f"well, {text}!"), (4, 0, text[:40]), (5, 0, "begin with, and which ends here"), (6, 0, "zzz")]
    spark.createDataFrame([(9, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert {r["record_id"]: r["score"] >= 1 for r in run("lexical_layer_whole")} == {1: True, 2: False, 3: True, 4: False, 5: False}
    found = sorted(run("search_conversations_whole"), key=lambda r: r["rank"])
    assert [r["record_id"] for r in found if r["pinned"]] == [1]
    wanted = brute_ranks([(9, text)], {c: [t for k, _, t in turns if k == c] for c in range(1, 7)})[9]
    assert [r["record_id"] for r in found] == wanted
    assert [r["record_id"] for r in sorted(run("reranked_whole"), key=lambda r: r["old_rank"])] == wanted


def test_email_rule_reads_long_runs_once_and_finds_what_the_plain_pattern_finds(spark):
    import random
    import re

    plain, rng = re.compile(r"\b[\w.+-]+@[\w-]+\.[a-z]{2,}\b", re.I), random.Random(5)
    texts = ["".join(rng.choice("ab.+-@ c1_\n" + "é中４²" * (k % 2)) for _ in range(30)) for k in range(600)] + ["é@x.com", "a@b.com邮箱", "寄a@b.com ", "密钥 a@é.co", "A" * 200_000, "+-" * 50_000 + "@x.com", ".a@b.co", "a@b@c.co"]
    docs = spark.createDataFrame(list(enumerate(texts)), "path int, text string")
    found = {r["path"]: r["line"] for r in audit.scan_patterns(docs, rules=(audit.RULES[2],)).collect()}
    assert found == {k: t[: m.start()].count("\n") + 1 for k, t in enumerate(texts) if (m := plain.search(t))}


def test_series_without_values_lack_them(spark):
    rows = spark.createDataFrame([("ab-1", "t", "o", "s"), (None, "", None, "s"), ("Ab", "t", "o", "s"), ("a--b", "t", "o", "s")], "id string, title string, out_root string, source_root string")
    found = [(r["missing"], r["id_ok"]) for r in quality.series_check(rows).collect()]
    assert found == [([], True), (["id", "title", "out_root"], False), ([], False), ([], False)]


def test_digest_of_a_layer_does_not_depend_on_how_rows_are_dealt(spark):
    rows = [(f"f{k}", "L", k, f"s{k}") for k in range(300)]
    schema = "path string, layer string, bytes long, sha256 string"
    a = audit.layer_digests(spark.createDataFrame(rows, schema).repartition(7)).collect()
    assert a == audit.layer_digests(spark.createDataFrame(rows[::-1], schema)).collect()
    assert a != audit.layer_digests(spark.createDataFrame(rows[1:], schema)).collect()
    assert audit.verify_layers(spark.createDataFrame([], schema), spark.createDataFrame(a)).collect()[0]["state"] == "missing"
    assert audit.layer_digests(spark.createDataFrame([], schema)).count() == 0
