"""Lines of transcript pages: their neighbours, page classes and types before any state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators import scan
from leafpress.operators.contract import Contract
from leafpress.storage import materialize


def to_lines(pages: DataFrame) -> DataFrame:
    """(book, page, line, st): stripped non-blank lines of (book, page, text), numbered from 0 with blank ones counted."""
    rows = pages.select("book", "page", F.posexplode(F.split("text", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]")).alias("line", "raw"))
    return rows.select("book", "page", "line", T.strip("raw").alias("st")).where("st <> ''")


def is_toc_line(c: Column | str, contract: Contract) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(contract.toc_line_pattern)


def page_flags(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add ``toc_hit``, and of the line's page ``toc_page``, ``no_marker`` and ``continued``."""
    hit = is_toc_line("st", contract)
    page = Window.partitionBy("book", "page")
    hits, all_lines = F.sum(F.col("toc_hit").cast("int")).over(page), F.count("*").over(page)
    return lines.withColumn("toc_hit", hit).select(
        "*",
        ((hits >= 3) & (4 * hits >= all_lines)).alias("toc_page"),
        (~F.max(F.col("st").startswith("@@")).over(page)).alias("no_marker"),
        F.max(F.col("st").startswith(contract.recipe_cont)).over(page).alias("continued"),
    )


def toc_pages(lines: DataFrame, contract: Contract) -> DataFrame:
    """(book, page, hits, lines) of the pages that are tables of contents."""
    counted = lines.groupBy("book", "page").agg(F.count_if(is_toc_line("st", contract)).alias("hits"), F.count("*").alias("lines"))
    return counted.where("hits >= 3 and 4 * hits >= lines")


def neighbours(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add ``next_line`` and ``next_content`` (neither footer nor continuation mark), across pages.

    ``lines`` are read twice.  A page's lines look ahead within it; only the first lines of pages look further.
    """
    content = F.when(~F.col("st").startswith(contract.footer) & ~F.col("st").startswith(contract.recipe_cont), F.col("st"))
    first = lambda v: F.min(F.when(v.isNotNull(), F.struct("line", v.alias("v"))))["v"]
    heads = materialize(lines.groupBy("book", "page").agg(first(F.col("st")).alias("head"), first(content).alias("head_content")), "page_heads")
    after = scan.before(heads, ["page"], lasts={"after": F.col("head"), "after_content": F.col("head_content")}, reverse=True).select("book", "page", "after", "after_content")
    behind = Window.partitionBy("book", "page").orderBy(F.desc("line")).rowsBetween(Window.unboundedPreceding, -1)
    local = lines.withColumn("next_line", F.lead("st").over(Window.partitionBy("book", "page").orderBy("line"))).withColumn("next_content", F.last(content, ignorenulls=True).over(behind))
    return scan.matched(local, after, ["book", "page"]).withColumns({"next_line": F.coalesce("next_line", "after"), "next_content": F.coalesce("next_content", "after_content")}).drop("after", "after_content")


def is_section_line(c: Column, contract: Contract) -> Column:
    """A registered section name, marked, bare (6 characters at most) or before text on its line."""
    keys = contract.section_keys()
    said = T.strip(F.when(c.startswith(contract.section), F.substring(c, len(contract.section) + 1, 1_000_000)).otherwise(c))
    named = T.let(said, lambda s: T.inline_section(s, keys)["section"].isNotNull() | (T.lookup(T.norm_key(s), keys).isNotNull() & (F.length(s) <= 6)))
    return F.coalesce(named, F.lit(False))


#: Lines end here; ``_ODD`` are blanks and line ends other than a space and a line feed.
_ENDS, _ODD = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]", r"(?U)[\s\x1c-\x1f&&[^ \n]]"


def page_rows(pages: DataFrame, contract: Contract) -> DataFrame:
    """(book, page, other columns of ``pages`` but text, ``rows``, hinted, toc_page, no_marker, continued): a page's stripped lines as an array, so that no line is moved.

    The places are those of ``to_lines``, blank lines stay as empty strings; the flags are those of ``page_flags``.  Only ``hinted`` pages may hold lines of contents.
    """
    text, pattern = F.col("text"), contract.toc_line_pattern
    plain = ~(text.rlike(_ODD) | text.contains(" \n") | text.contains("\n ") | text.startswith(" ") | text.endswith(" "))
    clean = F.when(plain, text).otherwise(F.array_join(F.transform(F.split("text", _ENDS), lambda x: T.strip(x)), "\n"))
    local = not any(x in pattern for x in (r"\A", r"\Z", r"\z", r"\G", "(?<", "(?=", "(?!"))  # else a line may match that does not match within its page
    held = lambda mark: F.col("clean").startswith(mark) | F.col("clean").contains("\n" + mark)
    rows = pages.withColumn("clean", clean).drop("text").select("*", F.split("clean", "\n").alias("rows"), (F.col("clean").rlike("(?m)" + pattern) if local else F.lit(True)).alias("hinted"), (~held("@@")).alias("no_marker"), held(contract.recipe_cont).alias("continued"))
    hits, n = F.size(F.filter("rows", lambda x: is_toc_line(x, contract))), F.size(F.filter("rows", lambda x: x != ""))
    return rows.withColumn("toc_page", F.when(F.col("hinted"), (hits >= 3) & (4 * hits >= n)).otherwise(F.lit(False))).drop("clean")


def exploded(rows: DataFrame, contract: Contract) -> DataFrame:
    """A row a line (``line``, ``st``) of ``page_rows``; lines of contents are dropped."""
    hit = F.col("hinted") & is_toc_line("st", contract)
    return rows.select("*", F.posexplode("rows").alias("line", "st")).where((F.col("st") != "") & ~hit)


def marked(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add ``mark``: toc, start, section, cont, step, footer, other (another mark) or null (unmarked), and ``tail``, the text behind it."""
    marks = [("toc", contract.toc), ("start", contract.recipe_start), ("section", contract.section), ("cont", contract.recipe_cont), ("step", contract.step), ("footer", contract.footer)]
    st = F.col("st")
    mark = F.when(~st.startswith("@@"), None)
    tail = F.when(~st.startswith("@@"), st)
    for name, text in marks:
        mark = mark.when(st.startswith(text), name)
        tail = tail.when(st.startswith(text), T.strip(F.substring(st, len(text) + 1, 1_000_000)))
    return lines.select("*", mark.otherwise("other").alias("mark"), tail.otherwise(st).alias("tail"))


def named_parts(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add what marked lines hold: a section before text, a group and a section's name; each pattern is tried only where it can match."""
    keys, unmarked = contract.section_keys(), F.col("mark").isNull()
    return lines.select(
        "*",
        F.when(unmarked & F.substring("st", 1, 1).isin("〔", "[", "【"), T.inline_section("st", keys)).alias("inline"),
        F.when(unmarked & (F.contains("st", F.lit("：")) | F.contains("st", F.lit(":"))), T.bare_group("st", contract.group_keys())).alias("grp"),
        F.when(F.col("mark").eqNullSafe("section"), T.lookup(T.norm_key("tail"), keys)).when(unmarked & (F.length("st") <= 6), T.lookup(T.norm_key("st"), keys)).alias("named"),
    )


def start_flags(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add the parsed ``start`` of marked lines that may have one, and whether they are or may be chapters, sub-chapters and openings of records."""
    can_start = F.col("mark").eqNullSafe("start") | ((F.col("mark").isNull() | (F.col("mark") == "section")) & T.may_number("tail"))
    parsed = lines.withColumn("start", F.when(can_start, T.parse_start("tail", contract.number_style, contract.recipe_number_pattern)))
    section = F.col("mark").eqNullSafe("section")
    ok = F.coalesce(F.col("start.reason") == "ok", F.lit(False))
    flags = parsed.withColumn("chapter_line", section & T.norm("tail").rlike(contract.chapter_pattern))
    flags = flags.withColumn("sub_line", section & ~F.col("chapter_line") & T.norm("tail").rlike(contract.subchapter_pattern) & F.coalesce(F.col("next_line").startswith(contract.recipe_start), F.lit(False)))
    return flags.select(
        "*",
        (F.col("mark").eqNullSafe("start") & ~F.col("toc_page") & ok).alias("accepted"),
        (F.col("mark").eqNullSafe("start") & ~F.col("toc_page") & ~ok).alias("rejected"),
        (section & ~F.col("chapter_line") & ~F.col("sub_line") & ok & is_section_line(F.col("next_content"), contract)).alias("candidate"),
        (F.col("mark").isNull() & F.col("inline.section").isNull() & ~F.col("toc_page") & ok).alias("unmarked_start"),
    )


def type_lines(lines: DataFrame, contract: Contract) -> DataFrame:
    """Add each line's ``mark``, ``tail``, parsed start and the types that need no state; lines of contents are dropped."""
    base = marked(neighbours(page_flags(lines, contract), contract).where(~F.col("toc_hit")), contract)
    return start_flags(named_parts(base, contract), contract)


def rejected_starts(typed: DataFrame) -> DataFrame:
    """Start lines of body pages that give no record, with the reason; lines counted from 1."""
    return typed.where("rejected").select("book", "page", (F.col("line") + 1).alias("line"), F.col("tail").alias("rest"), F.col("start.reason").alias("reason"))
