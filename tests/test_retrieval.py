"""The index of bigrams, the threshold fusion and components against plain definitions."""

import itertools
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafpress.operators import gram_index, lines, search
from leafpress.operators.components import connected_components, star_components
from leafpress.storage import new_path

SF = "/root/testdata/sf0.001"


def layer_rows(df):
    return sorted(map(tuple, df.select("query_id", "record_id", F.round("score", 9), "tie").collect()))


@pytest.fixture(scope="module")
def blocks(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(0, 3)))
    rows = [(i // 4, i % 4, rng.choice([None, "", "a"]) if i % 17 == 0 else " ".join(word() for _ in range(rng.randint(0, 12)))) for i in range(400)]
    asked = [(i, " ".join(word() for _ in range(rng.randint(0, 8)))) for i in range(30)] + [(100, None), (101, ""), (102, "zz"), (103, rows[5][2]), (104, "a")]
    table = spark.createDataFrame(rows, "record_id long, block_id long, text string")
    return table.withColumn("gram", F.lit("clash")).repartition(3), spark.createDataFrame(asked, "query_id long, q string")


@pytest.mark.parametrize("shard_blocks", [gram_index.SHARD_BLOCKS, 13])
def test_index_gives_the_lexical_layer(spark, blocks, shard_blocks):
    table, asked = blocks
    path = new_path(spark, "grams")
    gram_index.write_index(table, path, shard_blocks)
    full = search.lexical_layer(asked, table)
    assert layer_rows(gram_index.top(spark, path, asked, None)) == layer_rows(full)
    for k in (1, 5):
        assert layer_rows(gram_index.top(spark, path, asked, k)) == layer_rows(gram_index.cut(full, "query_id", k))


def test_index_takes_queries_in_batches(spark, blocks, monkeypatch):
    table, asked = blocks
    path = new_path(spark, "grams")
    gram_index.write_index(table, path)
    whole = layer_rows(gram_index.top(spark, path, asked, 3))
    monkeypatch.setattr(gram_index, "SENT_POINTS", 200)
    assert len(list(gram_index.batches(spark, path, asked))) > 1
    assert layer_rows(gram_index.top(spark, path, asked, 3)) == whole


def test_index_of_nothing(spark, blocks):
    table, asked = blocks
    for t, q in ((table.limit(0), asked), (table, asked.limit(0))):
        path = new_path(spark, "grams")
        gram_index.write_index(t, path)
        assert gram_index.top(spark, path, q, 3).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_heavy_lists_and_texts_are_not_read(spark, tmp_path):
    """A batch reads less than half of the postings of its bigrams, and a second one works when the texts are gone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("0 as book", "doc_id as page", "text")
    lines.to_lines(docs).selectExpr("page as record_id", "line as block_id", "st as text").write.parquet(str(tmp_path / "lines"))
    table, path = spark.read.parquet(str(tmp_path / "lines")), new_path(spark, "grams")
    gram_index.write_index(table, path)
    # passages that some lines hold in part
    held = table.where("length(text) > 60").orderBy(F.xxhash64("text"), "record_id").limit(12).collect()
    asked = spark.createDataFrame([(i, r["text"][10:60]) for i, r in enumerate(held)], "query_id long, q string")
    expected = layer_rows(gram_index.cut(search.lexical_layer(asked, table), "query_id", 1))
    batch = next(gram_index.batches(spark, path, asked))
    need = batch.needs(1)
    ones = np.ones_like(need)
    read = batch.wanted(batch.sizes - batch.left_out(need), need).agg(F.sum("n")).first()[0]
    everything = batch.wanted(batch.sizes, ones).agg(F.sum("n")).first()[0]
    assert 2 * read < everything
    shutil.rmtree(tmp_path / "lines")
    assert layer_rows(gram_index.top(spark, path, asked, 1)) == expected
    assert layer_rows(gram_index.top(spark, path, asked, 1)) == expected


# Fusion


def ranked(layer):
    """{(query, record): rank} of (query, record, score, tie)."""
    out = {}
    for q, rows in itertools.groupby(sorted(layer, key=lambda r: (r[0], -r[2], r[3], r[1])), key=lambda r: r[0]):
        out |= {(q, r[1]): n for n, r in enumerate(rows, 1)}
    return out


def fused(layers, k):
    ranks = {name: ranked(rows) for name, rows in layers.items()}
    out = []
    for q in sorted({q for r in ranks.values() for q, _ in r}):
        found = []
        for record in {d for r in ranks.values() for x, d in r if x == q}:
            own = [ranks.get(name, {}).get((q, record)) for name in search.LAYERS]
            score = sum((1 / (60 + r) if r else 0.0) for r in own)
            first = next((i, r) for i, r in enumerate(own) if r)
            found.append((own[0] is None, own[0] or 0, -score, first, record))
        out += [(q, f[4], n, round(-f[2], 12), not f[0]) for n, f in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize(("k", "first"), [(3, 1), (5, 16)])
def test_fusion_equals_ranking_everything(spark, k, first):
    """Layers that agree, that contradict each other so that many rounds are needed, that are short, and queries with one layer only."""
    rng = random.Random(k)
    n = 150
    lex = [(q, d, rng.choice([0.1, 0.2, rng.random()]), d % 7) for q in range(6) for d in range(n) if q != 4 and rng.random() < (0.9 if q else 0.02)]
    vec = {q: np.array([rng.uniform(-1, 1) for _ in range(3)]) for q in (0, 1, 2, 3, 4)}
    cards = {d: np.array([rng.uniform(-1, 1) for _ in range(3)]) if d % 9 else np.array([0.5, 0.5, 0.5]) for d in range(n)}
    lex += [(7, d, float(d), 0) for d in range(n)]  # opposite orders
    vec[7] = np.array([1.0, 0.0, 0.0])
    dots = [(q, d, round(float(sum(a * b for a, b in zip(v, c, strict=True))), 12), d) for q, v in vec.items() for d, c in cards.items()]
    terms = [(1, 3, 1.0, 3), (1, 2, 1.0, 2), *((2, d, 1.0, d) for d in range(40))]
    schema = "query_id long, record_id long, score double, tie long"
    table = lambda rows: search.TableLayer(spark.createDataFrame(rows, schema))
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in vec.items()], "query_id long, qvec array<double>")
    vector = search.VectorLayer(queries, spark.createDataFrame([(d, d, c.tolist()) for d, c in cards.items()], "record_id long, ord long, vec array<double>"))
    for layers, plain in (
        ({"terms": table(terms), "lex": table(lex), "vector": vector}, {"terms": terms, "lex": lex, "vector": dots}),
        ({"lex": table(lex), "vector": vector}, {"lex": lex, "vector": dots}),
        ({"lex": table(lex)}, {"lex": lex}),
    ):
        got = search.fuse(layers, k, first).select("query_id", "record_id", "rank", F.round("score", 12), "pinned").collect()
        assert sorted(map(tuple, got), key=lambda r: (r[0], r[2])) == fused(plain, k)


def test_fusion_ranks_no_list_as_a_whole(spark, monkeypatch):
    """Where layers agree, their heads are enough."""
    asked = []
    heads = search.TableLayer.heads
    monkeypatch.setattr(search.TableLayer, "heads", lambda self, m, queries=None: asked.append(m) or heads(self, m, queries))
    rows = spark.range(5000).selectExpr("1L as query_id", "id as record_id", "double(-id) as score", "id as tie")
    layers = {"lex": search.TableLayer(rows), "vector": search.TableLayer(rows)}
    assert [r["record_id"] for r in search.fuse(layers, 5).orderBy("rank").collect()] == [0, 1, 2, 3, 4]
    assert asked == [16, 16]
    plan = layers["lex"].heads(16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_search_from_an_index(spark, blocks):
    table, asked = blocks
    path = new_path(spark, "grams")
    gram_index.write_index(table, path)
    keys = table.where("block_id = 0 and text is not null").selectExpr("regexp_replace(text, ' ', '') as key", "record_id", "record_id as ord")
    rows = lambda index: sorted(map(tuple, search.search(asked, table, keys, k=4, index=index).select("query_id", "record_id", "rank", F.round("score", 9), "pinned").collect()))
    assert rows(path) == rows(None)


# Components


def least_reachable(pairs):
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("hub", [200_000, 3])
def test_components_equal_union_find(spark, hub):
    rng = random.Random(2)
    shuffled = rng.sample(range(300, 400), 100)
    pairs = [(i, i + 1) for i in range(80)] + list(itertools.pairwise(shuffled)) + [(1000, i) for i in range(500, 560)] + [(i, 600) for i in range(601, 660)]
    pairs += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(130)] + [(None, 1), (1, None), (7000, 7000), (1, 2), (2, 1)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    for labels in (star_components(edges, hub=hub), connected_components(edges)) if hub > 3 else (star_components(edges, hub=hub),):
        assert {r["node"]: r["component"] for r in labels.collect()} == least_reachable(pairs)
    assert star_components(edges.limit(0), hub=hub).count() == 0


def test_a_star_of_many_leaves_is_not_one_task(spark):
    """The hub is the largest node, so every leaf is handed over; its edges are joined where they lie."""
    leaves = 300_000
    labels = star_components(spark.range(leaves).selectExpr("id as a", "9000000L as b"))
    assert labels.selectExpr("count(*)", "max(component)").first() == (leaves + 1, 0)


# Clusters of vectors


@pytest.mark.parametrize(("kind", "most"), [("clustered", 0.5), ("scattered", 1.0)])
def test_clusters_give_the_best_products(spark, kind, most, monkeypatch):
    """Equal to all products, ties and copies included; where vectors lie in clusters, most products are not computed."""
    from leafpress.operators import clustered, vectors

    monkeypatch.setattr(clustered, "VECTOR_BLOCK", 40)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 8)) * 5
    points = middle[rng.integers(0, 12, 600)] + rng.normal(size=(600, 8)) * 0.3 if kind == "clustered" else rng.normal(size=(600, 8))
    points[50:90] = points[50]  # copies tie
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(1000, None)], "id long, vec array<double>")
    asked = spark.createDataFrame([(i, points[i].tolist()) for i in range(0, 600, 37)] + [(7000, [0.0] * 8), (7001, None)], "query_id long, qvec array<double>")
    held = clustered.cluster(table, centres=40)
    for k in (1, 7, 700):
        got = clustered.dot_topk(asked, held, k)
        share = got.first()["share"]
        assert share <= (most if k < 700 else 1.0)
        expected = vectors.dot_topk(asked.where("qvec is not null"), table.where("vec is not null"), k)
        rows = lambda df: sorted(map(tuple, df.select("query_id", "rank", "id", F.round("score", 9)).collect()))
        assert rows(got) == rows(expected)
    none = clustered.cluster(table.limit(0))
    assert clustered.dot_topk(asked, none, 3).count() == 0
