"""Literal automata, gaps as ranges, and products compared by digests."""

import random

import pytest
from pyspark.sql import functions as F

from leafpress.operators import audit, literals, quality


@pytest.mark.parametrize("few", [literals.FEW, 0])
def test_literals_one_by_one_and_by_automaton(spark, few, monkeypatch):
    monkeypatch.setattr(literals, "FEW", few)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab\né") for _ in range(rng.randint(0, n)))
    docs = [(i, rng.choice([None, "", word(60)]) if i % 5 == 0 else word(60)) for i in range(80)]
    rules = [(i, word(3)) for i in range(40)] + [(90, None), (91, "ab"), (92, "ab"), (93, "a" * 70)]
    table = spark.createDataFrame(docs, "path long, text string").withColumn("literal", F.lit(1))
    got = audit.scan_literals(table, spark.createDataFrame(rules, "literal_id long, literal string")).collect()
    assert sorted(map(tuple, got)) == sorted((p, i, t[: t.index(x)].count("\n") + 1) for p, t in docs if t is not None for i, x in rules if x is not None and x in t)
    chosen = [x for _, x in rules if x][:6]
    flags = quality.portable_scan(table, chosen, []).select("path", "banned", "watermark").collect()
    assert {r["path"]: (r["banned"], r["watermark"]) for r in flags} == {p: (t is not None and any(x in t for x in chosen), False) for p, t in docs}


def test_a_hundred_thousand_literals_in_one_pass(spark):
    rules = spark.range(100_000).selectExpr("id as literal_id", "concat('key-', id, ';') as literal")
    docs = spark.range(300).selectExpr("id as path", "concat('x\\n', repeat('text ', 50), 'key-', id * 331, ';') as text")
    got = audit.scan_literals(docs, rules).collect()
    assert sorted(map(tuple, got)) == [(i, i * 331, 2) for i in range(300) if i * 331 < 100_000]


def test_rule_tables_that_are_too_large_are_refused(spark, monkeypatch):
    monkeypatch.setattr(literals, "MOST", 10)
    with pytest.raises(ValueError, match="more than 10"):
        audit.scan_literals(spark.createDataFrame([(1, "a")], "path long, text string"), spark.range(11).selectExpr("id as literal_id", "string(id) as literal"))


def test_gaps_are_ranges(spark):
    rows = [("a", 2), ("a", 5), ("a", 5), ("a", None), ("b", 1), ("b", 2), ("c", 2_000_000_000), ("d", None), ("e", 0), ("e", -4), (None, 3)]
    table = spark.createDataFrame(rows, "book string, number int")
    assert sorted(map(str, quality.missing_ranges(table, ["book"]).collect())) == sorted(map(str, spark.createDataFrame([("a", 1, 1), ("a", 3, 4), ("c", 1, 1_999_999_999), (None, 1, 2)], "book string, first long, last long").collect()))
    few = table.where("book is null or book <> 'c'")
    assert sorted(map(str, (r["missing"] for r in quality.missing_numbers(few, ["book"]).collect()))) == ["1", "1", "2", "3", "4"]


def test_products_of_equal_groups_deal_no_rows(spark):
    rows = [(k % 4, k, None if k % 3 == 0 else f"t{k % 5}") for k in range(60)] * 2 + [(None, 1, "x")]
    a = spark.createDataFrame(rows, "g int, k int, t string")
    b = spark.createDataFrame(list(reversed(rows)), "g int, k int, t string").repartition(5)
    equal = quality.products_equal(a, b, ["g"])
    assert {r["g"]: (r["only_a"], r["only_b"], r["equal"]) for r in equal.collect()} == {g: (0, 0, True) for g in (0, 1, 2, 3, None)}
    assert "Exchange" not in equal._jdf.queryExecution().executedPlan().toString()
    changed = spark.createDataFrame([(g, k, t if k != 7 else None) for g, k, t in rows[:-1]] + [(2, 2, None)], "g int, k int, t string")
    got = {r["g"]: (r["only_a"], r["only_b"], r["equal"]) for r in quality.products_equal(a, changed, ["g"]).collect()}
    assert got == {0: (0, 0, True), 1: (0, 0, True), 2: (0, 1, False), 3: (2, 2, False), None: (1, 0, False)}
    # a null is not an empty text, nor a value of the next column
    x, y = spark.createDataFrame([(1, None, "a")], "g int, p string, q string"), spark.createDataFrame([(1, "a", None)], "g int, p string, q string")
    assert quality.products_equal(x, y, ["g"]).first()[1:] == (1, 1, False)
