"""New transcript pages as a stream: each page once, touched books assembled anew from the first page that matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafpress.operators.assemble import BEGIN, assemble
from leafpress.operators.audit import scan_patterns
from leafpress.operators.contract import Contract
from leafpress.storage import materialize

_PAGES = "page int, text string, digest string, seen timestamp, book string"
#: Touched books that are named to the scans of the stored tables; of more, all are looked at.
NAMED = 1000


def stream_pages(spark: SparkSession, root: str) -> DataFrame:
    """(book, page, text) of page files as they land; the stream's checkpoint skips those it has seen."""
    path = F.col("_metadata.file_path")
    rows = spark.readStream.format("text").option("wholetext", "true").load(f"{root}/*/_pages/p*.md")
    return rows.select(F.regexp_extract(path, r"/([^/]+)/_pages/[^/]+$", 1).alias("book"), F.regexp_extract(path, r"p(\d+)\.md$", 1).try_cast("int").alias("page"), F.col("value").alias("text")).where("page is not null")


def _stored(spark: SparkSession, path: str, touched: DataFrame, schema: str | None) -> DataFrame | None:
    """Rows of touched books of a table in folders by book, or None before its first write; folders of other books are not opened."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return None
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    names = [r[0] for r in touched.limit(NAMED + 1).collect()]
    rows = rows.withColumn("book", F.col("book").cast("string"))
    return rows.where(F.col("book").isin(names)) if len(names) <= NAMED else rows.join(touched, "book", "left_semi")


def _newest(pages: DataFrame) -> DataFrame:
    return pages.groupBy("book", "page").agg(F.max_by(F.struct("text", "digest"), "seen").alias("p")).select("book", "page", "p.text", "p.digest")


def _append(tables: dict[str, DataFrame], out: str) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book").parquet(f"{out}/{name}")


def restarts(recipes: DataFrame, touched: DataFrame) -> DataFrame:
    """(book, from_page, from_record, the columns of ``BEGIN`` but ``blocks``): where a book's assembly may start again.

    ``touched`` (book, first) names the first new page.  Assembly starts at the last page before it whose first line opens a record: what lies
    before such a line depends on nothing behind it.  Books without such a page are not in the result.
    """
    heads = recipes.where("line = 0").join(touched, "book").where("page < first").groupBy("book").agg(F.max_by(F.struct("page", "ordinal", "chapter_seq", "chapter", "sub_chapter", "scope_id"), "page").alias("r"))
    sub = F.coalesce(F.regexp_extract("r.scope_id", r"-S(\d+)$", 1).try_cast("long"), F.lit(0))
    return heads.select("book", F.col("r.page").alias("from_page"), F.col("r.ordinal").alias("from_record"), "r.chapter_seq", sub.alias("sub_seq"), "r.chapter", "r.sub_chapter", "r.scope_id", (F.col("r.ordinal") - 1).alias("record"))


def refresh_books(batch: DataFrame, pages_path: str, out: str, contract: Contract | None = None) -> None:
    """Take a batch of pages in: store them and bring ``recipes`` and ``blocks`` of the touched books up to date.

    A page whose text is the stored one changes nothing, and a book with only such pages is not touched.  A page that landed before
    with another text is replaced; a late page takes its place by number.  Books are assembled from the last page before the first new one that
    begins with a record, with the state that the stored records give; earlier pages are not assembled, and of other books nothing is read.
    Pages are stored after the books are written, so that a batch which is played again after a failure is taken in whole.
    """
    spark = batch.sparkSession
    landed = materialize(batch.groupBy("book", "page").agg(F.max("text").alias("text")).withColumns({"digest": F.sha2(F.coalesce("text", F.lit("")), 256), "seen": F.current_timestamp()}), "landed")
    known = _stored(spark, pages_path, landed.select("book").distinct(), _PAGES)
    if known is not None:
        known = materialize(_newest(known), "known")
        landed = materialize(landed.join(known.select("book", "page", F.col("digest").alias("old")), ["book", "page"], "left").where("old is null or old <> digest").drop("old"), "changed")
    touched = materialize(landed.groupBy("book").agg(F.min("page").alias("first")), "touched")
    if not touched.limit(1).count():
        return
    pages = landed.select("book", "page", "text")
    if known is not None:
        pages = pages.unionByName(known.join(pages, ["book", "page"], "left_anti").select("book", "page", "text")).join(touched.select("book"), "book", "left_semi")
    recipes, blocks = (_stored(spark, f"{out}/{n}", touched.select("book"), None) for n in ("recipes", "blocks"))
    if recipes is None or blocks is None:
        corpus = assemble(pages, contract)
        new = {n: corpus[n] for n in ("recipes", "blocks")}
    else:
        recipes, blocks = materialize(recipes, "old_recipes"), materialize(blocks, "old_blocks")
        again = materialize(restarts(recipes, touched), "restarts")
        kept = lambda rows, number: materialize(rows.join(again.select("book", "from_record"), "book").where(F.col(number) < F.col("from_record")).drop("from_record"), "kept")
        old = {"recipes": kept(recipes, "ordinal"), "blocks": kept(blocks, "record")}
        counted = old["blocks"].groupBy("book").agg(F.max("block").alias("blocks"))
        began = materialize(again.join(counted, "book", "left").select("book", *(F.coalesce(n, F.lit(0)).alias(n) if n == "blocks" else n for n in BEGIN)), "began")
        tail = pages.join(again.select("book", "from_page"), "book", "left").where("from_page is null or page >= from_page").drop("from_page")
        corpus = assemble(tail, contract, began=began, taken=old["recipes"])
        new = {n: corpus[n].unionByName(old[n]) for n in old}
    _append({n: materialize(rows, n) for n, rows in new.items()}, out)
    landed.write.mode("append").partitionBy("book").parquet(pages_path)


def start(spark: SparkSession, root: str, pages_path: str, out: str, checkpoint: str, contract: Contract | None = None) -> StreamingQuery:
    """Take what is there now and stop; run it again for what lands later."""
    writer = stream_pages(spark, root).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, _: refresh_books(batch, pages_path, out, contract)).start()


def stream_scan(spark: SparkSession, root: str) -> DataFrame:
    """Private strings in pages as they land; no state is needed."""
    pages = stream_pages(spark, root).withColumn("path", F.concat_ws("/", "book", F.col("page").cast("string")))
    return scan_patterns(pages)
