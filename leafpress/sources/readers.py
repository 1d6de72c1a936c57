"""Readers and writers of the corpus's files.  All go through Spark, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators import scan
from leafpress.storage import materialize

#: Files whose places are sent to all tasks at most.
SENT_FILES = 1_000_000

RECIPE_SCHEMA = "book string, recipe_id string, number int, number_raw string, ordinal int, name string, name_toc string, name_body string, chapter string, chapter_seq int, sub_chapter string, scope_id string, ingredients array<string>, seasonings array<string>, blocks array<string>"
BLOCK_SCHEMA = "bid string, book string, recipe_id string, number int, type string, page_from int, group string, text string"
_BREAK = r"\r\n|[\n\r]"


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """(book, page, text) of every ``<root>/<book>/_pages/pNNNN.md``; an empty file is no page."""
    path = F.col("_metadata.file_path")
    rows = spark.read.text(f"{root}/*/_pages/p*.md", wholetext=True)
    return rows.select(F.regexp_extract(path, r"/([^/]+)/_pages/[^/]+$", 1).alias("book"), F.regexp_extract(path, r"p(\d+)\.md$", 1).try_cast("int").alias("page"), F.col("value").alias("text")).where("page is not null")


def compact_pages(spark: SparkSession, root: str, out: str, part_bytes: int = 128_000_000) -> int:
    """Gather the page files under ``root`` that are new or changed into Parquet under ``out``; returns how many they are.

    A book's pages are dealt by their summed size into parts of about ``part_bytes``, each sorted by page in one file.  ``out/manifest``
    lists what is in: (path, book, page, bytes, modified).  It is written last: a run that failed is done again, and pages that
    are in twice are read once (``read_compacted``).
    """
    path = F.col("_metadata.file_path")
    book, page = F.regexp_extract(path, r"/([^/]+)/_pages/[^/]+$", 1).alias("book"), F.regexp_extract(path, r"p(\d+)\.md$", 1).try_cast("int").alias("page")
    files = spark.read.format("binaryFile").load(f"{root}/*/_pages/p*.md").select(path.alias("path"), book, page, F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).where("page is not null")
    known = _manifest(spark, out)
    fresh = files if known is None else files.join(known.select("path", "bytes", "modified"), ["path", "bytes", "modified"], "left_anti")
    fresh = materialize(fresh, "fresh_files")
    n = fresh.count()
    if n:
        placed = scan.before(fresh, ["page"], {"ahead": F.col("bytes")}).select("path", "book", "page", "modified", F.floor(F.col("ahead") / part_bytes).alias("part"))
        texts = spark.read.text(f"{root}/*/_pages/p*.md", wholetext=True).select(path.alias("path"), F.col("value").alias("text"))
        rows = texts.join(F.broadcast(placed) if n <= SENT_FILES else placed, "path")
        parts = placed.select("book", "part").distinct().count()
        rows.repartition(min(parts, 10_000), "book", "part").sortWithinPartitions("book", "part", "page").select("book", "page", "text", "modified").write.mode("append").parquet(f"{out}/pages")
        fresh.write.mode("append").parquet(f"{out}/manifest")
    return n


def _manifest(spark: SparkSession, out: str) -> DataFrame | None:
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/manifest")
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return None
    return spark.read.parquet(f"{out}/manifest")


def read_compacted(spark: SparkSession, out: str) -> DataFrame:
    """(book, page, text) of what ``compact_pages`` gathered, the newest text of each page."""
    return spark.read.parquet(f"{out}/pages").groupBy("book", "page").agg(F.max_by("text", "modified").alias("text"))


def tsv_rows(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of commented tables in (path, text): blank and ``#`` lines dropped, cells stripped, ``line`` from 1, ``cells`` counted."""
    lines = files.select("path", F.posexplode(F.split("text", _BREAK)).alias("at", "raw")).where(~F.col("raw").rlike(r"(?U)^\s*(#.*)?$"))
    cells = lines.select("path", (F.col("at") + 1).alias("line"), F.split("raw", "\t").alias("c"))
    return cells.select("path", "line", F.size("c").alias("cells"), *(T.strip(F.get("c", i)).alias(n) for i, n in enumerate(columns)))


def header_rows(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of tables whose first non-blank line names the columns; missing cells are empty.  No file, no rows."""
    lines = files.select("path", F.posexplode(F.split("text", _BREAK)).alias("at", "raw")).where(T.strip("raw") != "")
    head = lines.groupBy("path").agg(F.min_by("raw", "at").alias("head"), F.min("at").alias("first"))
    rows = lines.join(head, "path").where("at > first").select("path", (F.col("at") + 1).alias("line"), F.split("raw", "\t").alias("c"), F.split("head", "\t").alias("h"))
    place = lambda n: F.array_position("h", n)
    return rows.select("path", "line", *(F.when(place(n) > 0, F.coalesce(T.strip(F.get("c", (place(n) - 1).cast("int"))), F.lit(""))).otherwise("").alias(n) for n in columns))


def rule_rows(files: DataFrame) -> DataFrame:
    """Literals of rule lists: ``#`` tails cut, blanks and ``[section]`` lines dropped."""
    lines = files.select("path", F.posexplode(F.split("text", _BREAK)).alias("at", "raw"))
    return lines.select("path", (F.col("at") + 1).alias("line"), T.strip(F.regexp_replace("raw", "#.*$", "")).alias("literal")).where("literal <> '' and not literal rlike '^\\\\[.*\\\\]$'")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file; contents are dropped as soon as they are hashed."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_corpus(corpus: dict[str, DataFrame], root: str) -> None:
    """``recipes``, ``blocks`` and ``glossary`` as JSON lines by book, and all block texts of a book in order."""
    for name in ("recipes", "blocks", "glossary"):
        corpus[name].write.mode("overwrite").partitionBy("book").json(f"{root}/{name}")
    ordered = corpus["blocks"].repartition("book").sortWithinPartitions("book", "block")
    ordered.select("book", "text").write.mode("overwrite").partitionBy("book").text(f"{root}/all")


def write_index(terms: DataFrame, families: DataFrame, listing: DataFrame, root: str) -> None:
    for name, df in (("terms", terms), ("aliases", families), ("listing", listing)):
        df.write.mode("overwrite").json(f"{root}/{name}")


def book_listing(recipes: DataFrame) -> DataFrame:
    """What a reader leafs through: number, name, name in the contents (or a dash), blocks."""
    return recipes.select("book", "ordinal", "number", "name", F.coalesce(F.nullif("name_toc", F.lit("")), F.lit("—")).alias("name_toc"), F.size("blocks").alias("blocks"))


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Rows (book, kind, id, vec), by book and kind, in id order within a file: ids stay with their vectors."""
    rows = vectors.select("book", "kind", "id", "vec").repartition("book", "kind").sortWithinPartitions("book", "kind", "id")
    rows.write.mode("overwrite").partitionBy("book", "kind").parquet(path)


def read_vectors(spark: SparkSession, path: str, book: str | None = None, kind: str | None = None) -> DataFrame:
    """(id, vec, book, kind); a book and a kind are found by their folders alone."""
    rows = spark.read.parquet(path).withColumns({c: F.col(c).cast("string") for c in ("book", "kind")})
    for c, v in (("book", book), ("kind", kind)):
        rows = rows if v is None else rows.where(F.col(c) == v)
    return rows
