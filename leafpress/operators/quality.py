"""Checks and counts over corpus tables; every outcome is PASS, FAIL or SKIP (not decidable)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators import literals
from leafpress.operators.scan import matched
from leafpress.storage import materialize

#: Kinds of errata that are accepted; fixed values.
ERRATA_KINDS = ("print_duplicate_number", "print_missing_number")


def contiguous(numbers: DataFrame, by: list[str], number: str = "number") -> DataFrame:
    """(by, n, lowest, highest, distinct_n, contiguous): whether the numbers are 1 to n, each once."""
    rows = numbers.groupBy(*by).agg(F.count(number).alias("n"), F.min(number).alias("lowest"), F.max(number).alias("highest"), F.count_distinct(number).alias("distinct_n"))
    return rows.withColumn("contiguous", F.coalesce(F.expr("lowest = 1 and highest = n and distinct_n = n"), F.lit(False)))


def missing_ranges(numbers: DataFrame, by: list[str], number: str = "number") -> DataFrame:
    """(by, first, last) of each run of numbers from 1 on that a group lacks below its highest: a row a run, however long.

    Nulls and numbers below 1 do not count.  Numbers missing at the end cannot be seen.
    """
    held = numbers.select(*by, F.col(number).cast("long").alias("__n")).where("__n >= 1").distinct()
    rows = held.withColumn("__before", F.lag("__n", 1, 0).over(Window.partitionBy(*by).orderBy("__n")))
    return rows.where("__n - __before > 1").select(*by, (F.col("__before") + 1).alias("first"), (F.col("__n") - 1).alias("last"))


def missing_numbers(numbers: DataFrame, by: list[str], number: str = "number") -> DataFrame:
    """(by, missing): the numbers of ``missing_ranges`` one by one."""
    return missing_ranges(numbers, by, number).select(*by, F.explode(F.sequence("first", "last")).alias("missing")).withColumn("missing", F.col("missing").cast("int"))


def numbers_in_scope(recipes: DataFrame) -> DataFrame:
    """Sorted numbers of each scope, repeats kept, with its printed title."""
    title = F.concat_ws(" / ", F.concat_ws(" ", "scope_id", F.nullif("chapter", F.lit(""))), F.nullif("sub_chapter", F.lit("")))
    return recipes.groupBy("book", "scope_id", title.alias("title")).agg(F.sort_array(F.collect_list("number")).alias("numbers"))


def without_method(recipes: DataFrame, blocks: DataFrame) -> DataFrame:
    return recipes.join(blocks.where("type = 'step'").select("book", "recipe_id"), ["book", "recipe_id"], "left_anti")


def pseudo_steps(blocks: DataFrame) -> DataFrame:
    """Steps that are only a number."""
    return blocks.where("type = 'step'").where(F.col("text").rlike(r"(?U)^\d{1,3}$"))


def starts_balance(lines: DataFrame) -> DataFrame:
    """Per book: start lines, unmarked and promoted ones, records and rejected ones; do they add up, and is none rejected."""
    counts = lines.groupBy("book").agg(
        F.count_if(F.col("accepted") | F.col("rejected")).alias("start_lines"),
        F.count_if(F.col("how") == "unmarked").alias("unmarked"),
        F.count_if(F.col("how") == "promoted").alias("promoted"),
        F.count_if(F.col("how").isNotNull()).alias("records"),
        F.count_if(F.col("rejected")).alias("refused"),
    )
    return counts.withColumn("balanced", F.expr("start_lines + unmarked + promoted = records + refused")).withColumn("none_rejected", F.col("refused") == 0)


def ids_unique(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(key).alias("n"), F.count_distinct(key).alias("distinct_n")).withColumn("unique", F.col("n") == F.col("distinct_n"))


def duplicate_ids(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by, key).agg(F.count("*").alias("n")).where("n > 1")


def corpus_counts(recipes: DataFrame, blocks: DataFrame) -> DataFrame:
    mine = recipes.groupBy("book").agg(F.count("*").alias("recipes"), F.count_distinct("scope_id").alias("scopes"))
    theirs = blocks.groupBy("book").agg(F.count("*").alias("blocks"), F.count_if(F.col("type") == "step").alias("steps"), F.count_if(F.col("type") == "ingredient").alias("ingredient_blocks"), F.sum(T.count_literal("text", "⟦?⟧")).alias("unread"))
    return mine.join(theirs, "book", "left").na.fill(0)


def validate_errata(rows: DataFrame) -> DataFrame:
    """Add ``reason``, null for an accepted row of (cells, book, scope, kind, value, expected, evidence, source)."""
    reason = F.when(F.col("cells") < 7, "too few columns").when(~F.col("kind").isin(*ERRATA_KINDS), "unknown kind").when(F.coalesce("evidence", F.lit("")) == "", "no evidence").when(F.coalesce("source", F.lit("")) == "", "no source")
    return rows.withColumn("reason", reason)


def match_errata(df: DataFrame, errata: DataFrame, kind: str, number: str = "number", how: str = "left_semi") -> DataFrame:
    """Rows of (book, scope_id, number) that an erratum names.  Book-specific and book-wide errata join on equal keys each."""
    named = errata.where(F.col("kind") == kind).select("book", T.scope_code("scope").alias("scope_id"), F.col("value").try_cast("int").alias(number)).distinct()
    key = ["scope_id", number]
    wide = named.where("book in ('', '*')").select(*key).distinct()
    own = named.where("book not in ('', '*')")
    if how == "left_anti":
        return df.join(wide, key, "left_anti").join(own, ["book", *key], "left_anti")
    return df.join(wide, key, "left_semi").unionByName(df.join(wide, key, "left_anti").join(own, ["book", *key], "left_semi"))


def exempt_missing(missing: DataFrame, errata: DataFrame) -> DataFrame:
    """Per book with missing numbers (book, scope_id, missing): found, exempted, and whether errata explain all of them."""
    named = match_errata(missing, errata, "print_missing_number", "missing").groupBy("book").agg(F.count("*").alias("exempted"))
    return missing.groupBy("book").agg(F.count("*").alias("found")).join(named, "book", "left").na.fill(0).withColumn("passes", F.expr("found > 0 and exempted = found"))


def exempt_duplicates(recipes: DataFrame, errata: DataFrame) -> DataFrame:
    """Duplicated ids that no erratum explains."""
    return match_errata(duplicate_ids(recipes, "recipe_id", ["book", "scope_id", "number"]), errata, "print_duplicate_number", how="left_anti")


def collision_attribution(recipes: DataFrame, blocks: DataFrame, lines: DataFrame) -> DataFrame:
    """Per duplicated id: ``assembly`` if a page of its blocks has a heading that is no section, chapter or sub-chapter
    right before a start on that page, else ``transcription``."""
    on_page = Window.partitionBy("book", "page").orderBy("line")
    heads = lines.withColumn("after", F.lead("mark").over(on_page)).where("mark = 'section' and named is null and not chapter_line and not sub_line and after = 'start'").select("book", "page").distinct()
    pages = duplicate_ids(recipes, "recipe_id", ["book"]).join(blocks.select("book", "recipe_id", F.col("page_from").alias("page")).distinct(), ["book", "recipe_id"])
    hit = pages.join(heads.withColumn("hit", F.lit(True)), ["book", "page"], "left")
    return hit.groupBy("book", "recipe_id").agg(F.when(F.max(F.coalesce("hit", F.lit(False))), "assembly").otherwise("transcription").alias("cause"))


def products_equal(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(key, only_a, only_b, equal): rows that one of two tables has more often, over all columns.

    Each group gets a digest that does not depend on the order of rows: sums of two hashes, added up where the rows are.  Rows
    themselves are dealt out only for groups whose digests differ.  Nulls are values; a table without columns but the key compares counts.
    """
    columns = sorted(set(a.columns) - set(key))
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"}) if columns else F.lit("")
    sided = lambda d, side: d.select(*key, text.alias("__row"), F.lit(side).alias("__side"))
    rows = sided(a, 1).unionByName(sided(b, -1))
    weighed = lambda seed: F.sum(F.xxhash64("__row", F.lit(seed)).cast("decimal(38,0)") * F.col("__side"))
    groups = materialize(rows.groupBy(*key).agg(F.sum("__side").alias("__n"), weighed(1).alias("__p"), weighed(2).alias("__q")), "groups")
    same = groups.where("__n = 0 and __p = 0 and __q = 0").select(*key, F.lit(0).cast("long").alias("only_a"), F.lit(0).cast("long").alias("only_b"))
    differ = groups.where("__n <> 0 or __p <> 0 or __q <> 0").select(*key)
    if differ.limit(1).count():
        counted = matched(rows, differ, key).groupBy(*key, F.sha2("__row", 256).alias("__digest")).agg(F.sum("__side").alias("__more"))
        same = same.unionByName(counted.groupBy(*key).agg(F.sum(F.greatest("__more", F.lit(0))).alias("only_a"), F.sum(F.greatest(-F.col("__more"), F.lit(0))).alias("only_b")))
    return same.withColumn("equal", F.expr("only_a = 0 and only_b = 0"))


def portable_scan(files: DataFrame, banned: list[str], marks: list[str], text: str = "text") -> DataFrame:
    """Add ``drive_path``, ``banned`` and ``watermark``: whether a text has a drive path, a banned literal, a literal of a watermark."""
    has = lambda xs: F.coalesce(literals.holds_any(xs, text), F.lit(False))
    return files.withColumn("drive_path", F.col(text).rlike(r"(?<![A-Za-z0-9:/])[A-Za-z]:[\\/]")).withColumn("banned", has(banned)).withColumn("watermark", has(marks))


def gate(name: str, passed: Column, skipped: Column | None = None) -> Column:
    """struct(gate, status); null means not decidable."""
    status = F.when(passed, "PASS").when(passed.isNull(), "SKIP").otherwise("FAIL")
    return F.struct(F.lit(name).alias("gate"), (status if skipped is None else F.when(skipped, "SKIP").otherwise(status)).alias("status"))


def gate_rollup(readings: DataFrame) -> DataFrame:
    """Per book of (book, gate, status): failed and skipped gates, and a verdict: FAIL before SKIP before PASS."""
    names = lambda s: F.sort_array(F.collect_list(F.when(F.col("status") == s, F.col("gate"))))
    rows = readings.groupBy("book").agg(names("FAIL").alias("fails"), names("SKIP").alias("skips"))
    return rows.withColumn("verdict", F.when(F.size("fails") > 0, "FAIL").when(F.size("skips") > 0, "SKIP").otherwise("PASS"))


def registry_check(books: DataFrame, code: str = r"^[A-Z][0-9]{2,}$") -> DataFrame:
    """Per row of (code, source_basename): first fault, or null."""
    n = F.count("*").over(Window.partitionBy("code"))
    return books.withColumn("fault", F.when(~F.col("code").rlike(code), "code").when(n > 1, "repeated").when(F.coalesce("source_basename", F.lit("")) == "", "no source"))


#: Grammar of a series' id; a fixed value.
SERIES_ID = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def series_check(series: DataFrame, required: tuple[str, ...] = ("id", "title", "out_root", "source_root")) -> DataFrame:
    """Add ``missing``, the required columns that are null or empty, and ``id_ok``, whether the id keeps its grammar."""
    lacks = F.array_compact(F.array(*(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", c) for c in required)))
    return series.withColumn("missing", lacks).withColumn("id_ok", F.coalesce(F.col("id").rlike(SERIES_ID), F.lit(False)))


def size_check(recorded: DataFrame, files: DataFrame, key: str = "path") -> DataFrame:
    """(key, recorded, actual, passes) of (key, bytes) on both sides; no file: null, not decidable."""
    return recorded.selectExpr(key, "bytes as recorded").join(files.selectExpr(key, "bytes as actual"), key, "left").withColumn("passes", F.col("recorded") == F.col("actual"))


def modal_shape(pages: DataFrame, shape: list[str]) -> DataFrame:
    """Per book: its most frequent shape, of equally frequent ones the first seen, and pages of it."""
    counted = pages.groupBy("book", *shape).agg(F.count("*").alias("pages"), F.min("page").alias("first"))
    best = F.max_by(F.struct(*shape, "pages"), F.struct(F.col("pages"), -F.col("first")))
    return counted.groupBy("book").agg(best.alias("m")).select("book", "m.*")


def shape_outliers(pages: DataFrame, shape: list[str]) -> DataFrame:
    modal = modal_shape(pages, shape).select("book", *(F.col(c).alias(f"m_{c}") for c in shape))
    same = F.lit(True)
    for c in shape:
        same = same & F.col(c).eqNullSafe(F.col(f"m_{c}"))
    return pages.join(modal, "book").where(~same).drop(*(f"m_{c}" for c in shape))


def book_shape(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Per book of pages (book, page, width, height, text_chars): page count, characters of the text layer, its most frequent page
    size and, of images (book, page, image, px_width, px_height, bits, filter), its most frequent image size and the first image's
    bits and filter.  Of equally frequent sizes the first seen; no images: nulls.
    """
    sums = pages.groupBy("book").agg(F.count("*").alias("pages"), F.coalesce(F.sum("text_chars"), F.lit(0)).alias("text_chars"))
    sizes = modal_shape(pages, ["width", "height"]).select("book", "width", "height")
    seen = images.withColumn("page", F.struct("page", "image"))
    counted = seen.groupBy("book", "px_width", "px_height").agg(F.count("*").alias("n"), F.min("page").alias("first"), F.min_by(F.struct("bits", "filter"), "page").alias("look"))
    # of equally frequent sizes the one seen first: the order by first place is kept by a minimum over (-n, first)
    shapes = counted.groupBy("book").agg(F.min_by(F.struct("px_width", "px_height"), F.struct(-F.col("n"), F.col("first"))).alias("px"), F.min_by("look", "first").alias("look"))
    return sums.join(sizes, "book").join(shapes.select("book", "px.*", "look.*"), "book", "left")


#: Planner's tokens for a page; fixed values.
IMAGE_TOKENS, TEXT_TOKENS = 1262, 250


def todo_pages(books: DataFrame, done: DataFrame) -> DataFrame:
    """(book, page) of (book, pages) not in ``done``; pages counted from 0."""
    wanted = books.where("pages > 0").select("book", F.explode(F.expr("sequence(0, cast(pages as int) - 1)")).alias("page"))
    return wanted.join(done.select("book", F.col("page").cast("int").alias("page")).distinct(), ["book", "page"], "left_anti")


def todo_estimate(todo: DataFrame) -> DataFrame:
    return todo.groupBy("book").agg(F.count("*").alias("todo"), (F.count("*") * (IMAGE_TOKENS + TEXT_TOKENS)).alias("tokens"))


def log_summary(log: DataFrame) -> DataFrame:
    """Per book of (book, page, seq, seconds, tokens, status): entries, pages, totals, failures, and failures that a later entry did not mend."""
    last = log.groupBy("book", "page").agg(F.count("*").alias("entries"), F.sum("seconds").alias("seconds"), F.sum("tokens").alias("tokens"), F.count_if(F.col("status") != "ok").alias("failed"), F.max_by("status", "seq").alias("last"))
    return last.groupBy("book").agg(F.sum("entries").alias("entries"), F.count("*").alias("pages"), F.sum("seconds").alias("seconds"), F.sum("tokens").alias("tokens"), F.sum("failed").alias("failed"), F.count_if(F.col("last") != "ok").alias("open"))


def mixed_versions(log: DataFrame) -> DataFrame:
    return log.groupBy("book").agg(F.count_distinct("version").alias("versions")).where("versions > 1")
