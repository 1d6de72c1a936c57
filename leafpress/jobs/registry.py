"""All queries of the library's own operators, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafpress.jobs import reports, variants  # noqa: F401  they register their queries
from leafpress.jobs.queries import QUERIES

FLAGSHIP = "search_benchmark_whole"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}
