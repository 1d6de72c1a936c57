"""Running sums and last events over books of any size.

Rows of a book are dealt by (book, block); each block is summed up in one row, and only those rows are put in the book's order.
What a row gets is what came before its block together with what came before it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pages, or records, that one block covers.
SPAN = 1024


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys, of which a null is equal to a null."""
    other = right.withColumnsRenamed({k: f"__{k}_r" for k in keys})
    both = F.lit(True)
    for k in keys:
        both = both & F.col(k).eqNullSafe(F.col(f"__{k}_r"))
    return left.join(other, both, how).drop(*(f"__{k}_r" for k in keys))


def before(rows: DataFrame, order: list[str], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, reverse: bool = False, span: int = SPAN) -> DataFrame:
    """Add, per name of ``sums``, the sum over the rows of the book before each row, and per name of ``lasts`` the last value there that is not null.

    ``rows`` (a written table: it is read twice) are ordered by the columns ``order``, of which the first is a number that cuts a book
    into blocks of ``span``; with ``reverse``, rows behind count as before.
    """
    sums, lasts = sums or {}, lasts or {}
    block = F.floor(F.col(order[0]) / span)
    rows = rows.withColumn("__block", -block if reverse else block)
    place = F.struct(*(-F.col(c) if reverse else F.col(c) for c in order))
    latest = lambda v: F.max(F.when(v.isNotNull(), F.struct(place.alias("at"), v.alias("v"))))["v"]
    total = rows.groupBy("book", "__block").agg(*(F.sum(v).alias(n) for n, v in sums.items()), *(latest(v).alias(n) for n, v in lasts.items()))
    ahead = Window.partitionBy("book").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = total.select("book", "__block", *(F.sum(n).over(ahead).alias(f"__{n}") for n in sums), *(F.last(n, ignorenulls=True).over(ahead).alias(f"__{n}") for n in lasts))
    within = Window.partitionBy("book", "__block").orderBy(*(F.desc(c) if reverse else c for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    local = rows.select("*", *(F.sum(v).over(within).alias(n) for n, v in sums.items()), *(F.last(v, ignorenulls=True).over(within).alias(n) for n, v in lasts.items()))
    found = {n: F.coalesce(n, zero) + F.coalesce(f"__{n}", zero) for n in sums} | {n: F.coalesce(n, f"__{n}") for n in lasts}
    return matched(local, carried, ["book", "__block"]).withColumns(found).drop("__block", *(f"__{n}" for n in found))
