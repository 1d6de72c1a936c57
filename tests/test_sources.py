"""Files written and read back."""

import numpy as np
from pyspark.sql import functions as F

from leafpress.operators import quality, search, vector_store
from leafpress.sources import readers


def test_vectors(spark, tmp_path):
    rows = [("B01", "card", "r2", [0.5, 1.0]), ("B01", "card", "r1", [1.0, 0.0]), ("B01", "text", "t1", [0.0, 1.0]), ("B02", "card", "r1", [0.25, 0.25])]
    df = spark.createDataFrame(rows, "book string, kind string, id string, vec array<float>")
    readers.write_vectors(df, str(tmp_path / "v"))
    back = readers.read_vectors(spark, str(tmp_path / "v"))
    assert sorted(tuple(r) for r in back.select("book", "kind", "id", "vec").collect()) == sorted(rows)
    assert [(r["id"], r["vec"]) for r in readers.read_vectors(spark, str(tmp_path / "v"), "B01", "card").collect()] == [("r1", [1.0, 0.0]), ("r2", [0.5, 1.0])]


def test_json_lines_and_log(spark, tmp_path):
    first, second = (spark.createDataFrame([(k, s)], "page int, status string") for k, s in ((1, "ok"), (2, "早")))
    path = str(tmp_path / "log")
    readers.append_log(first, path)
    readers.append_log(second, path)
    assert sorted((r["page"], r["status"]) for r in readers.read_jsonl(spark, path, "page int, status string").collect()) == [(1, "ok"), (2, "早")]


def test_corpus_and_index(spark, tmp_path):
    blocks = spark.createDataFrame([("B01", 2, "b"), ("B01", 1, "a"), ("B02", 1, "c")], "book string, block int, text string")
    recipes = spark.createDataFrame([("B01", 1, 1, "n", None, ["x", "y"])], "book string, ordinal int, number int, name string, name_toc string, blocks array<string>")
    readers.write_corpus({"recipes": recipes, "blocks": blocks, "glossary": blocks.limit(0)}, str(tmp_path / "c"))
    text = spark.read.text(str(tmp_path / "c/all"))
    assert [r["value"] for r in text.where("book = 'B01'").collect()] == ["a", "b"]
    listing = readers.book_listing(recipes)
    assert listing.first()["name_toc"] == "—" and listing.first()["blocks"] == 2
    readers.write_index(recipes, recipes, listing, str(tmp_path / "i"))
    assert [r["name"] for r in readers.read_jsonl(spark, str(tmp_path / "i/listing"), "name string").collect()] == ["n"]


def test_large_batches_of_queries_give_the_same_layer(spark, monkeypatch):
    words = ["甲乙丙", "乙", "", "ab c", "甲乙", "丙甲乙丙", "zz"]
    queries = spark.createDataFrame([(i, w) for i, w in enumerate([*words, None])], "query_id long, q string")
    blocks = spark.createDataFrame([(i // 3, i, w) for i, w in enumerate([*words, None, "丙", "abc 甲", "x甲乙丙"])], "record_id long, block_id long, text string")
    rows = lambda: sorted(map(tuple, search.lexical_layer(queries, blocks).select("query_id", "record_id", F.round("score", 9), "tie").collect()))
    small = rows()
    monkeypatch.setattr(search, "SENT_CELLS", 0)
    assert rows() == small and len(small) > 5


def test_rank_of_wanted_and_sizes(spark):
    hits = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "query_id long, record_id string, rank int")
    wanted = spark.createDataFrame([(1, "a"), (1, "c"), (2, "a")], "query_id long, want string")
    assert sorted((r["query_id"], r["want"], r["rank_of_want"]) for r in search.rank_of(hits, wanted).collect()) == [(1, "a", 2), (1, "c", None), (2, "a", None)]
    recorded = spark.createDataFrame([("x", 3), ("y", 4), ("z", 5)], "path string, bytes long")
    files = spark.createDataFrame([("x", 3), ("y", 9)], "path string, bytes long")
    assert {r["path"]: r["passes"] for r in quality.size_check(recorded, files).collect()} == {"x": True, "y": False, "z": None}
    steps = spark.createDataFrame([("step", "12"), ("step", "１２"), ("step", "12 a"), ("step", "1234"), ("group", "1")], "type string, text string")
    assert sorted(r["text"] for r in quality.pseudo_steps(steps).collect()) == ["12", "１２"]


def test_pages_are_read_and_compacted(spark, tmp_path):
    """Page files with odd texts give the same rows read one by one and from parts; only new and changed ones are taken in again."""
    root, out = tmp_path / "kb", str(tmp_path / "out")
    texts = {(b, p): f"{b} 第{p}页\r\n" + "行\n" * (p * 7) for b in ("B01", "007") for p in range(12)} | {("B01", 12): ""}
    for (b, p), t in texts.items():
        folder = root / b / "_pages"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"p{p:04d}.md").write_bytes(t.encode())
    (root / "B01/_pages/pxx.md").write_text("no page")
    rows = lambda df: {(r["book"], r["page"]): r["text"] for r in df.collect()}
    n_files = len(texts) - 1  # an empty file gives no row
    del texts["B01", 12]
    assert rows(readers.read_pages(spark, str(root))) == texts
    assert readers.compact_pages(spark, str(root), out, part_bytes=300) == n_files
    assert rows(readers.read_compacted(spark, out)) == texts
    parts = [r["n"] for r in spark.read.parquet(f"{out}/pages").groupBy(F.input_file_name()).agg(F.sum(F.octet_length("text")).alias("n")).collect()]
    assert 3 < len(parts) < len(texts)
    assert readers.compact_pages(spark, str(root), out) == 0
    texts["B01", 3] = "neu"
    (root / "B01/_pages/p0003.md").write_text("neu")
    assert readers.compact_pages(spark, str(root), out) == 1
    assert rows(readers.read_compacted(spark, out)) == texts
    assert spark.read.parquet(f"{out}/manifest").count() == n_files + 1


def test_store_encodes_only_what_changed(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def encode(texts):
        calls.add(1)
        return np.array([[float(len(t)), float(sum(map(ord, t)) % 97)] for t in texts])

    path = str(tmp_path / "store")
    schema = "book string, kind string, id string, text string, extra int"
    rows = [(f"b{k % 3}", "text", f"i{k}", f"text {k}", 1) for k in range(300)] + [(None, "card", "n", "null book", 1), ("b0", "card", "none", None, 1)]

    def stored(inputs, model="m"):
        before = calls.value
        got = {(r["book"], r["kind"], r["id"]): r["vec"][0] for r in vector_store.refresh(spark.createDataFrame(inputs, schema), path, encode, model, "f32").collect()}
        assert got == {(b, k, i): float(len(t)) for b, k, i, t, _ in inputs if t is not None}
        return calls.value - before

    assert stored(rows) == -(-301 // 32)
    assert stored(rows) == 0  # nothing changed: no version, no call
    changed = [(b, k, i, "longer than before" if i == "i7" else t, 1) for b, k, i, t, _ in rows]
    assert stored(changed) == 1
    assert stored(changed[1:]) == 0  # one is gone
    assert stored(changed[1:], model="m2") == -(-300 // 32)
    told = [tuple(r) for r in vector_store.versions(spark, path).orderBy("version").collect()]
    assert told == [(1, 301, 301, 0), (2, 301, 1, 1), (3, 300, 0, 1), (4, 300, 300, 300)]
    assert vector_store.read_store(spark, path, 1).count() == 301


def test_rerank_with_a_function(spark):
    hits = spark.createDataFrame([(1, 10, 1, "q"), (1, 11, 2, "q"), (1, 12, 3, "q")], "query_id long, record_id long, rank int, q string")
    texts = spark.createDataFrame([(10, "short"), (11, "the longest text"), (12, "longer")], "record_id long, text string")
    scored = search.rerank_with(hits, texts, lambda qs, ts: [float(len(t)) for t in ts], depth=2)
    assert sorted(map(tuple, scored.collect())) == [(1, 10, 5.0), (1, 11, 16.0)]
