"""Retrieval judged against expected answers, with the three outcomes PASS, FAIL and SKIP."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.functions import text as T


def derived_cases(recipes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(book, q, want, topn) that a corpus implies: its first record's name and number, each name in the contents that
    differs, and the first eight characters of the first step of the first record that has blocks."""
    first = recipes.groupBy("book").agg(F.min_by(F.struct("recipe_id", "name", "number"), "ordinal").alias("r")).select("book", "r.*")
    named = first.selectExpr("book", "name as q", "recipe_id as want", "1 as topn")
    numbered = first.selectExpr("book", "concat('#', number) as q", "recipe_id as want", "1 as topn")
    listed = recipes.where("name_toc <> '' and name_toc <> name").selectExpr("book", "name_toc as q", "recipe_id as want", "3 as topn")
    owner = recipes.where("size(blocks) > 0").groupBy("book").agg(F.min_by("recipe_id", "ordinal").alias("recipe_id"))
    steps = blocks.where("type = 'step'").join(owner, ["book", "recipe_id"]).groupBy("book", "recipe_id").agg(F.min_by("text", "block").alias("t"))
    return named.unionByName(numbered).unionByName(listed).unionByName(steps.select("book", F.substring(T.norm("t"), 1, 8).alias("q"), F.col("recipe_id").alias("want"), F.lit(3).alias("topn")))


def registered_cases(cases: DataFrame, books: DataFrame) -> DataFrame:
    """Cases of the given books, with defaults."""
    return cases.join(books.select("book"), "book", "left_semi").withColumn("topn", F.coalesce("topn", F.lit(3))).withColumn("expect_none", F.coalesce("expect_none", F.lit(False))).withColumn("needs_vectors", F.coalesce("needs_vectors", F.lit(False)))


def case_verdict(ranked: DataFrame, have_vectors: str = "have_vectors") -> DataFrame:
    """Add ``v_state`` (with vectors), ``d_state`` (without) and ``verdict`` to cases with ``rank_v`` and ``rank_d``."""
    ok = lambda rank: F.when(F.col("expect_none"), F.col(rank).isNull()).otherwise(F.coalesce(F.col(rank) <= F.col("topn"), F.lit(False)))
    judged = lambda rank: F.when(ok(rank), "PASS").otherwise("FAIL")
    rows = ranked.withColumn("v_state", F.when(F.col(have_vectors), judged("rank_v")).otherwise(F.when(F.col("needs_vectors"), "SKIP").otherwise("untested"))).withColumn("d_state", F.when(F.col("needs_vectors"), "not set").otherwise(judged("rank_d")))
    states = F.array("v_state", "d_state")
    return rows.withColumn("verdict", F.when(F.array_contains(states, "FAIL"), "FAIL").when(F.array_contains(states, "SKIP"), "SKIP").otherwise("PASS"))


def rerank_ab(runs: DataFrame) -> DataFrame:
    """One row of (case_id, topn, rank_off, rank_on): hits either way, regressions, improvements, and whether none regressed."""
    ok = lambda c: F.coalesce(F.col(c) <= F.coalesce("topn", F.lit(4)), F.lit(False))
    rows = runs.withColumn("off", ok("rank_off")).withColumn("on", ok("rank_on"))
    return rows.agg(F.count("*").alias("cases"), F.count_if("off").alias("ok_off"), F.count_if("on").alias("ok_on"), F.count_if(F.expr("off and not on")).alias("regressions"), F.count_if(F.expr("on and not off")).alias("improvements")).withColumn("passes", F.col("regressions") == 0)


def recall_by_mode(rows: DataFrame) -> DataFrame:
    """(book, mode, hits, cases, recall) of (book, mode, rank, topn); book null: all books."""
    hit = F.coalesce(F.col("rank") <= F.col("topn"), F.lit(False)).cast("int")
    counted = rows.withColumn("hit", hit).groupingSets([["book", "mode"], ["mode"]], "book", "mode").agg(F.sum("hit").alias("hits"), F.count("*").alias("cases"))
    return counted.withColumn("recall", F.round(F.col("hits") / F.col("cases"), 6))


def verdict_counts(results: DataFrame) -> DataFrame:
    """Totals of the three verdicts, and the final status: 2 with failures, 3 with skips, else 0."""
    n = lambda v: F.count_if(F.col("verdict") == v)
    return results.agg(n("PASS").alias("passed"), n("FAIL").alias("failed"), n("SKIP").alias("skipped")).withColumn("status", F.expr("case when failed > 0 then 2 when skipped > 0 then 3 else 0 end"))
