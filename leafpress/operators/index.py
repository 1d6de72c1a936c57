"""Lookup keys of records, and families of interchangeable characters from differing witnesses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators.components import star_components

#: Kinds of ledger entries that compare names; fixed values.
NAME_KINDS = ("name", "name_toc", "name_body", "alias")


def terms(recipes: DataFrame) -> DataFrame:
    """(book, key, recipe_ids in order): ``#number`` and the normalised names of each record."""
    keys = F.array_distinct(F.array(F.concat(F.lit("#"), F.col("number").cast("string")), T.norm("name"), T.norm("name_toc"), T.norm("name_body")))
    rows = recipes.select("book", "ordinal", "recipe_id", F.explode(keys).alias("key")).where("key <> ''")
    return rows.groupBy("book", "key").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "recipe_id"))), lambda x: x["recipe_id"]).alias("recipe_ids"))


def ledger_pairs(ledger: DataFrame, witnesses: list[str], kinds: tuple[str, ...] = NAME_KINDS) -> DataFrame:
    """Distinct (x, y): two characters that differ between two witnesses of one name, of settled rows."""
    names = F.filter(F.array(*(T.witness_name(w) for w in witnesses)), lambda x: x.isNotNull())
    rows = ledger.where(F.col("kind").isin(*kinds) & ~F.contains(F.coalesce("status", F.lit("")), F.lit("OPEN"))).select(names.alias("n")).where("size(n) >= 2")
    pairs = rows.select("n", F.posexplode("n").alias("i", "a")).select("a", F.explode(F.expr("slice(n, i + 2, size(n))")).alias("b"))
    return pairs.select(T.one_char_diff(F.col("a"), F.col("b")).alias("d")).where("d is not null").select("d.x", "d.y").distinct()


def families(pairs: DataFrame) -> DataFrame:
    """(family, members sorted): connected characters; the family is its first member."""
    rows = star_components(pairs.selectExpr("x as a", "y as b"))
    return rows.groupBy(F.col("component").alias("family")).agg(F.sort_array(F.collect_list("node")).alias("members"))


def missing_pairs(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """Pairs of which a character stands in no stored family."""
    known = stored.select(F.explode("members").alias("c")).distinct()
    found = pairs.join(known.withColumnRenamed("c", "x"), "x", "left_semi").join(known.withColumnRenamed("c", "y"), "y", "left_semi")
    return pairs.join(found, ["x", "y"], "left_anti")


def family_drift(derived: DataFrame, stored: DataFrame) -> DataFrame:
    """(members, side) of families that only one side has."""
    a, b = derived.select("members"), stored.select("members")
    return a.exceptAll(b).withColumn("side", F.lit("derived")).unionByName(b.exceptAll(a).withColumn("side", F.lit("stored")))


def uncovered_gaps(gaps: DataFrame, cases: DataFrame) -> DataFrame:
    """Declared characters that no registered query holds: an equi-join on the queries' characters."""
    held = cases.select(F.explode(F.split("q", "")).alias("char")).distinct()
    return gaps.select("char").distinct().join(held, "char", "left_anti")
