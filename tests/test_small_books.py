"""Books of one page range: the same tables as by ranges, little written, no shuffle files left."""

import os
import random

import pytest
from pyspark.sql import functions as F

from leafpress.jobs import transcript, variants
from leafpress.operators import assemble as A
from leafpress.operators import quality
from leafpress.storage import materialize, shared_dir

SF = "/root/testdata/sf0.001"
SEC, START = "@@SECTION", "@@RECIPE_START"
KINDS = [f"{START} 1 甲", f"{START} （二） 乙", f"{START} 丙", f"{SEC} （3）丁", f"{SEC} 一、章", f"{SEC} 甲乙类", f"{SEC} 主料", f"{SEC} 〔制法〕", f"{SEC} 杂", "制法", "主料：米", "〔调料〕盐", "（2）煮", "1. 炒", "@@STEP", "@@STEP 3", "@@STEP 煎。", "12", "@@FOOTER 4", "@@RECIPE_CONT", "（5） 戊", "注释", "注释\n①词：义", "①词：义", "  空 ", "", "乙……12", "x\x0by", "@@FIGURE f"]


def random_pages(spark, books=60):
    rnd = random.Random(3)
    rows = [(f"b{b}", p, "\n".join(rnd.choices(KINDS, k=rnd.randint(0, 8)))) for b in range(books) for p in range(rnd.randint(1, 5))]
    return spark.createDataFrame(rows, "book string, page int, text string")


def test_same_tables_as_by_ranges(spark):
    pages = random_pages(spark)
    errata = spark.createDataFrame([("b1", "C00 x", "print_duplicate_number", "1"), ("*", "C01", "print_duplicate_number", "2")], "book string, scope string, kind string, value string")
    small, ranged = A.assemble(pages, errata=errata), A.assemble(pages, errata=errata, span=1)
    for name in ("recipes", "blocks", "glossary"):
        columns = small[name].columns
        ours, theirs = (sorted(map(str, c[name].select(*columns).collect())) for c in (small, ranged))
        assert ours == theirs and ours, name
    for ask in (A.drift_counts, lambda c: quality.starts_balance(c["starts"]), lambda c: quality.numbers_in_scope(c["heads"]), lambda c: c["contents"], lambda c: A.promoted_starts(c["heads"])):
        ours, theirs = (sorted(map(str, ask(c).select(*sorted(ask(c).columns)).collect())) for c in (small, ranged))
        assert ours == theirs and ours


def test_little_is_written_for_small_books(spark):
    folder = f"{shared_dir(spark).removeprefix('file:')}/leafpress"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    A.assemble(random_pages(spark, 3))
    assert {n[:-33] for n in set(os.listdir(folder)) - before} == {"pages", "few", "found"}


def test_written_tables_leave_no_shuffle_files(spark):
    from leafpress import storage

    said = spark.conf.get(storage.CLEANUP)
    with storage.shuffles_dropped(spark):
        assert spark.conf.get(storage.CLEANUP) == "true"
    assert spark.conf.get(storage.CLEANUP) == said
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: root.getAllFiles().toString().count("/shuffle_")
    n = files()
    materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted").count()
    assert files() <= n


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pages_are_those_of_the_sql(spark):
    ours = transcript.transcript_pages(spark, SF)
    theirs = transcript.as_pages(transcript.over_tables(spark, SF, transcript.SQL, "orders", "lineitem"))
    assert ours.count() == theirs.count() and not ours.exceptAll(theirs).count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_variant_pages_are_those_of_the_sql(spark):
    """And orders meet by book only: no line is moved."""
    ours = variants.variant_pages(spark, SF)
    theirs = transcript.as_pages(transcript.over_tables(spark, SF, variants._PAGES, "orders"))
    assert ours.count() == theirs.count() and not ours.exceptAll(theirs).count()
    assert "Union" not in ours._jdf.queryExecution().optimizedPlan().toString()
