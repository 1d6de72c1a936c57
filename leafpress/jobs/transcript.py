"""Transcript pages made from the order tables, so that assembly can run on tables of any size.

A customer is a book, a year of orders a chapter, an order a record: its ingredients are its parts, its steps its
shipments.  Each 13th order is marked as a section (and must be promoted), each 37th has no number (and must be rejected).
A page holds 40 lines; page 0 is the table of contents.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_A_PAGE = 40

#: The order tables with the numbers that both engines derive from them; runs in Spark and in DuckDB alike.
ORDERS = """
    select concat('K', cast(o_custkey as string)) as book, o_orderkey as okey, year(o_orderdate) as yr,
        row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey) as num,
        row_number() over (partition by o_custkey order by year(o_orderdate), o_orderkey) as seq,
        dense_rank() over (partition by o_custkey order by year(o_orderdate)) as chap,
        o_orderkey % 37 = 0 as refused, o_orderkey % 13 = 0 and o_orderkey % 37 <> 0 as promoted
    from orders"""
ITEMS = """
    select l_orderkey as okey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as item,
        concat('P', cast(l_partkey as string), ' x', cast(cast(l_quantity as int) as string), '。') as part,
        concat('via ', l_returnflag, l_linestatus, '。') as ship
    from lineitem"""
SQL = f"""
    with o as ({ORDERS}), i as ({ITEMS}),
    t as (
        select book, seq, 0 as kind, 0 as item, 0 as sub, concat('@@SECTION 一、', cast(yr as string)) as line from o where num = 1
        union all select book, seq, 1, 0, 0, case when refused then concat('@@RECIPE_START 名', cast(okey as string))
            when promoted then concat('@@SECTION （', cast(num as string), '）名', cast(okey as string))
            else concat('@@RECIPE_START （', cast(num as string), '） 名', cast(okey as string)) end from o
        union all select book, seq, 2, 0, 0, '@@SECTION 〔主料〕' from o
        union all select o.book, o.seq, 3, i.item, 0, i.part from o join i on o.okey = i.okey
        union all select book, seq, 4, 0, 0, '@@SECTION 〔制法〕' from o
        union all select o.book, o.seq, 5, i.item, 0, concat('@@STEP ', cast(i.item as string)) from o join i on o.okey = i.okey
        union all select o.book, o.seq, 5, i.item, 1, i.ship from o join i on o.okey = i.okey
    ),
    n as (select book, line, row_number() over (partition by book order by seq, kind, item, sub) - 1 as k from t)
    select book, cast(1 + floor(k / {LINES_A_PAGE}) as int) as page, cast(k % {LINES_A_PAGE} as int) as at_line, line from n
    union all select book, 0, cast(seq as int), concat('名', cast(okey as string), '……', cast(seq % 900 + 1 as string)) from o"""


def transcript_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book, page, text) of all orders: the lines of ``SQL``, but moved as orders with their items and as stretches of pages, not one by one."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("concat('K', cast(o_custkey as string)) as book", "o_orderkey as okey", "year(o_orderdate) as yr")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey as okey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "concat(l_returnflag, l_linestatus) as flags")
    held = items.repartition("okey").groupBy("okey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "flags"))).alias("items"))
    texts = F.expr("transform(items, x -> struct(concat('P', cast(x.l_partkey as string), ' x', cast(cast(x.l_quantity as int) as string), '。') as part, concat('via ', x.flags, '。') as ship))")
    o = orders.join(held, "okey", "left").select("book", "okey", "yr", texts.alias("items")).selectExpr(
        "book", "okey", "yr", "coalesce(items, array()) as items",
        "row_number() over (partition by book, yr order by okey) as num", "row_number() over (partition by book order by yr, okey) as seq",
    )
    o = o.withColumn("lines", F.expr("""concat(
        if(num = 1, array(concat('@@SECTION 一、', cast(yr as string))), array()),
        array(case when okey % 37 = 0 then concat('@@RECIPE_START 名', cast(okey as string))
            when okey % 13 = 0 then concat('@@SECTION （', cast(num as string), '）名', cast(okey as string))
            else concat('@@RECIPE_START （', cast(num as string), '） 名', cast(okey as string)) end, '@@SECTION 〔主料〕'),
        transform(items, x -> x.part), array('@@SECTION 〔制法〕'),
        flatten(transform(items, (x, i) -> array(concat('@@STEP ', cast(i + 1 as string)), x.ship))))""")).drop("items")
    o = o.withColumn("k", F.expr("coalesce(sum(size(lines)) over (partition by book order by yr, okey, seq rows between unbounded preceding and 1 preceding), 0)"))
    cut = f"""concat(
        array(struct(0 as page, cast(seq as bigint) as at, concat('名', cast(okey as string), '……', cast(seq % 900 + 1 as string)) as text)),
        transform(sequence(k div {LINES_A_PAGE}, (k + size(lines) - 1) div {LINES_A_PAGE}), p -> struct(cast(1 + p as int) as page, k as at,
            nullif(array_join(slice(lines, cast(greatest(p * {LINES_A_PAGE} - k, 0) + 1 as int), cast(least((p + 1) * {LINES_A_PAGE} - k, size(lines)) - greatest(p * {LINES_A_PAGE} - k, 0) as int)), '\n'), '') as text)))"""
    stretches = o.select("book", F.expr(f"inline({cut})"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n")
    return stretches.groupBy("book", "page").agg(text.alias("text"))


def over_tables(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """``sql`` over tables of the folder, without a view of theirs in the session."""
    for name in names:
        sql = re.sub(rf"\bfrom {name}\b", f"from {{{name}}}", sql)
    return spark.sql(sql, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names})


def as_pages(rows: DataFrame) -> DataFrame:
    """(book, page, text) of (book, page, at_line, line)."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at_line", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy("book", "page").agg(text.alias("text"))
