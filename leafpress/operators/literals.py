"""Many literals at once: a table of rules becomes an Aho-Corasick automaton that each worker runs over texts in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So few literals are looked for one by one, without Python.
FEW = 32
#: Literals, and their characters together, that an automaton may have: some hundred megabytes a worker.
MOST, MOST_POINTS = 1_000_000, 20_000_000


def bounded(literals: DataFrame) -> list:
    """The rows of a table of literals (literal first), if it is small enough to be sent to all tasks."""
    rows = literals.limit(MOST + 1).collect()
    if len(rows) > MOST or sum(len(r[0]) for r in rows) > MOST_POINTS:
        raise ValueError(f"more than {MOST} literals or {MOST_POINTS} characters of them")
    return rows


def automaton(literals: list[str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for x in literals:
        built.add_word(x, x)
    built.make_automaton()
    return built


class _Sent:
    """An automaton that was sent once and is unpacked once a worker."""

    def __init__(self, literals: list[str]):
        self.packed = SparkContext.getOrCreate().broadcast(automaton(literals))

    def places(self, text: str) -> dict[str, int]:
        """Where each literal ends first, counted from 1 at its first character."""
        found: dict[str, int] = {}
        for end, literal in self.packed.value.iter(text):
            found.setdefault(literal, end - len(literal) + 2)
        return found

    def holds(self, text: str) -> bool:
        return next(self.packed.value.iter(text), None) is not None


def first_places(docs: DataFrame, literals: list[str], text: str) -> DataFrame:
    """The rows of ``docs`` once per literal that their text holds, with ``literal`` and ``at``, its first position from 1."""
    named = sorted({x for x in literals if x})
    everywhere = docs.where(F.col(text).isNotNull()).select("*", F.lit("").alias("literal"), F.lit(1).alias("at")) if "" in literals else None
    if len(named) <= FEW:
        each = F.array(*(F.struct(F.lit(x).alias("literal"), F.instr(F.col(text), F.lit(x)).alias("at")) for x in named)) if named else F.array().cast("array<struct<literal:string,at:int>>")
        rows = docs.select("*", F.explode(F.filter(each, lambda h: h["at"] > 0)).alias("__h")).select(*(F.col(f"`{c}`") for c in docs.columns), "__h.literal", "__h.at")
    else:
        sent = _Sent(named)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, literal, at = [], [], []
                for i, t in enumerate(batch.column(text).to_pylist()):
                    for x, place in sent.places(t).items() if t is not None else ():
                        row.append(i)
                        literal.append(x)
                        at.append(place)
                held = batch.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*held.columns, pa.array(literal, pa.string()), pa.array(at, pa.int32())], [*batch.schema.names, "literal", "at"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        rows = docs.mapInArrow(run, f"{schema}, literal string, at int")
    return rows if everywhere is None else rows.unionByName(everywhere)


def holds_any(literals: list[str], text: str) -> Column:
    """Whether a text holds any of the literals; null for a null text."""
    if "" in literals:
        return F.col(text).isNotNull()
    if len(literals) <= FEW:
        return F.array_max(F.array(*(F.contains(F.col(text), F.lit(x)) for x in literals))) if literals else F.lit(False)
    sent = _Sent(sorted(set(literals)))

    @F.pandas_udf("boolean")
    def look(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else sent.holds(t))

    return look(F.col(text))
