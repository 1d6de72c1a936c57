"""Records and blocks from typed lines, for books of any size.

Where every book lies within one page range (``SPAN`` pages), its lines are never moved: few of them are written to number what they open,
and pages meet what was found by one shuffle (``small_books``).  Longer books are scanned by ranges, as follows.

Chapters, sub-chapters and openings of records are few: they are numbered by scans over page ranges (``scan.before``), and each
page learns the state it begins with.  All other state, the section in force, a step mark that waits for its text, the
count of steps and whether a piece goes on across pages, ends where a record opens, so it is followed within records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators import scan
from leafpress.operators.contract import Contract
from leafpress.operators.lines import exploded, is_toc_line, marked, named_parts, page_rows, start_flags, to_lines, type_lines
from leafpress.operators.quality import match_errata
from leafpress.storage import materialize

#: Marks that end a sentence; fixed values.
SENTENCE_ENDS = "。！？；：…”』"


#: Tolerated ways to give a piece; ``plain`` is none.
VARIANTS = ("inline", "group", "bare_step", "inline_step", "step_body")


def _in_record(*keys: str) -> WindowSpec:
    """A record's lines in order; lines before the first record in the stretches between chapters and sub-chapters, where a section ends too."""
    return Window.partitionBy("book", "record", "stretch", *keys).orderBy(*(c for c in ("page", "line") if c not in keys))


def _two(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), F.greatest(F.lit(2), F.length(F.col(c).cast("string"))), "0")


#: What a book's first line finds, unless its pages go on from earlier ones.
BEGIN = {"chapter_seq": 0, "sub_seq": 0, "chapter": "", "sub_chapter": "", "scope_id": "C00", "record": 0, "blocks": 0}


def _with_begin(rows: DataFrame, began: DataFrame | None) -> DataFrame:
    """Add ``begin``, what the first of a book's pages here finds."""
    kinds = {n: F.lit(v).cast("long") if isinstance(v, int) else F.lit(v) for n, v in BEGIN.items()}
    if began is None:
        return rows.withColumn("begin", F.struct(*(v.alias(n) for n, v in kinds.items())))
    found = scan.matched(rows, began.select("book", F.struct(*(F.col(n).cast("long" if isinstance(v, int) else "string").alias(n) for n, v in BEGIN.items())).alias("begin")), ["book"], "left")
    return found.withColumn("begin", F.coalesce("begin", F.struct(*(v.alias(n) for n, v in kinds.items()))))


def openings(typed: DataFrame, span: int = scan.SPAN, began: DataFrame | None = None, taken: DataFrame | None = None) -> DataFrame:
    """Of the lines that may change the scope or open a record: scope, ``how`` they open one (start, promoted, unmarked or null) and its number in the book.

    The scope is ``Cnn`` or ``Cnn-Snn`` by chapters and the sub-chapters of a chapter.
    """
    at, title = F.struct("page", "line"), T.norm("tail")
    few = typed.where("chapter_line or sub_line or accepted or candidate or unmarked_start").select("book", "page", "line", "chapter_line", "sub_line", "accepted", "candidate", "unmarked_start", F.col("start.number").alias("start_number"), title.alias("title"))
    few = materialize(few, "few")
    count = lambda c: F.col(c).cast("long")
    few = scan.before(few, ["page", "line"], {"chapter_seq": count("chapter_line"), "subs": count("sub_line")}, span=span)
    few = _with_begin(few, began).withColumns({"chapter_seq": F.col("begin.chapter_seq") + F.col("chapter_seq") + count("chapter_line"), "subs": F.col("subs") + count("sub_line")})
    few = materialize(few, "few")
    events = {"chapter": F.when(F.col("chapter_line"), F.col("title")), "sub_chapter": F.when(F.col("chapter_line"), "").when(F.col("sub_line"), F.col("title")), "subs_before": F.when(F.col("chapter_line"), F.col("subs"))}
    few = scan.before(few, ["page", "line"], lasts=events, span=span)
    first = {"chapter": F.col("begin.chapter"), "sub_chapter": F.col("begin.sub_chapter"), "subs_before": -F.col("begin.sub_seq")}
    few = few.withColumns({n: F.coalesce(v, F.col(n), first[n]) for n, v in events.items()}).withColumn("sub_seq", F.col("subs") - F.col("subs_before"))
    few = few.withColumn("scope_id", F.concat(F.lit("C"), _two("chapter_seq"), F.when(F.col("sub_seq") > 0, F.concat(F.lit("-S"), _two("sub_seq"))).otherwise("")))
    few = materialize(few, "scoped")
    # The first opening of a book may lack its mark
    first = lambda c: F.min(F.when(c, at))
    firsts = few.groupBy("book").agg(first(F.col("unmarked_start")).alias("u"), first(F.col("accepted") | F.col("candidate")).alias("o"), F.max("begin.record").alias("r")).where("r = 0 and u is not null and (o is null or u < o)")
    few = scan.matched(few, firsts.selectExpr("book", "u.page as page", "u.line as line", "true as unmarked_open"), ["book", "page", "line"], "left").withColumn("unmarked_open", F.coalesce("unmarked_open", F.lit(False)))
    opens = F.col("accepted") | F.col("candidate") | F.col("unmarked_open")
    nth = F.row_number().over(Window.partitionBy("book", "scope_id", "number").orderBy("page", "line"))
    how = F.when(F.col("accepted"), "start").when(F.col("unmarked_open"), "unmarked").when(F.col("candidate") & (F.col("nth") == 1) & ~F.col("taken"), "promoted")
    numbered = few.where(opens).withColumn("number", F.col("start_number")).withColumn("nth", nth)
    if taken is not None:
        earlier = taken.select("book", "scope_id", "number", F.lit(True).alias("taken")).distinct()
        numbered = scan.matched(numbered, earlier, ["book", "scope_id", "number"], "left")
    numbered = numbered.withColumn("taken", F.coalesce("taken", F.lit(False)) if taken is not None else F.lit(False)).withColumn("how", how).drop("nth", "taken")
    few = materialize(numbered.unionByName(few.where(~opens), allowMissingColumns=True), "numbered")
    few = scan.before(few, ["page", "line"], {"record": F.col("how").isNotNull().cast("long")}, span=span)
    return few.select("book", "page", "line", *STATE, (F.col("begin.record") + F.col("record") + F.col("how").isNotNull().cast("long")).alias("record"), "how", "number")


#: What holds from a line on, until another line changes it.
STATE = ("chapter_seq", "sub_seq", "chapter", "sub_chapter", "scope_id")


def placed(typed: DataFrame, found: DataFrame, span: int = scan.SPAN, began: DataFrame | None = None) -> DataFrame:
    """Add to each line the scope in force, its ``record`` (0 before the first) and, if it opens one, ``how`` and ``number``."""
    state = F.struct("line", *STATE, "record", "how", "number")
    changes = found.groupBy("book", "page").agg(F.sort_array(F.collect_list(state)).alias("changes"))
    pages = materialize(scan.matched(typed.select("book", "page").distinct(), changes, ["book", "page"], "left"), "page_states")
    pages = scan.before(pages, ["page"], lasts={"came": F.element_at("changes", -1)}, span=span)
    lines = scan.matched(typed, pages, ["book", "page"]).withColumn("own", F.expr("get(filter(changes, x -> x.line <= line), size(filter(changes, x -> x.line <= line)) - 1)"))
    lines = lines.withColumn("state", F.coalesce("own", "came")).withColumn("opens", F.coalesce(F.col("own.line") == F.col("line"), F.lit(False)))
    lines = _with_begin(lines, began)
    lines = lines.select("*", *(F.coalesce(f"state.{c}", f"begin.{c}").alias(c) for c in (*STATE, "record")), *(F.when(F.col("opens"), F.col(f"own.{c}")).alias(c) for c in ("how", "number")))
    return lines.withColumn("stretch", F.when(F.col("record") == 0, F.concat_ws("-", "chapter_seq", "sub_seq")).otherwise("")).drop("changes", "came", "own", "state", "opens", "begin")


def stated(lines: DataFrame) -> DataFrame:
    """Add ``takes_step`` (the line is the body of a step mark before it) and ``sec``, the section in force."""
    step_only = F.col("mark").eqNullSafe("step") & ((F.col("tail") == "") | F.col("bare_number"))
    inline = F.coalesce(F.col("inline.section").isNotNull(), F.lit(False))
    consumer = (F.col("record") > 0) & F.col("how").isNull() & ((F.col("mark").isNull() & ~inline) | F.col("mark").eqNullSafe("other"))
    event = F.when(step_only, "set").when(F.col("mark").eqNullSafe("footer") | F.col("how").isNotNull(), "reset").when(consumer, "use")
    taking = lines.withColumn("event", event).withColumn("takes_step", F.coalesce((F.col("event") == "use") & (F.last("event", ignorenulls=True).over(_in_record().rowsBetween(Window.unboundedPreceding, -1)) == "set"), F.lit(False)))
    bare_name = F.col("mark").isNull() & ~F.col("takes_step") & F.col("grp").isNull() & F.col("named").isNotNull()
    none = F.struct(F.lit(None).cast("string").alias("sec"))
    change = (
        F.when(F.col("how").isNotNull() | F.col("chapter_line") | F.col("sub_line"), none)
        .when(inline, F.struct(F.col("inline.section").alias("sec")))
        .when(bare_name, F.struct(F.col("named").alias("sec")))
        .when(F.col("mark").eqNullSafe("section"), F.struct(F.coalesce("named", F.lit("other")).alias("sec")))
    )
    return taking.withColumn("is_name", bare_name).withColumn("is_inline", inline).withColumn("sec", F.last(change, ignorenulls=True).over(_in_record().rowsBetween(Window.unboundedPreceding, 0))["sec"])


def pieces(lines: DataFrame, contract: Contract, also: Column | None = None) -> DataFrame:
    """What each line adds to its record: ``kind`` (ingredient, seasoning, step, note), ``label`` and ``text``.

    ``via`` tells the tolerated variant: inline, step_body, group, bare_step, inline_step or plain.  Lines for which ``also`` is true
    stay too, with neither.
    """
    bare_step = T.bare_step("st", contract.step_number_patterns)
    stay = F.lit(False) if also is None else also
    plain = F.when(F.col("sec").isin("ingredients", "main", "side"), "ingredient").when(F.col("sec") == "seasoning", "seasoning").when(F.col("sec") == "method", "step").when(F.col("sec") == "notes", "note")
    unmarked = F.col("mark").isNull() & F.col("how").isNull()
    via = (
        F.when(F.col("is_inline"), "inline")
        .when(F.col("takes_step"), "step_body")
        .when(unmarked & F.col("grp").isNotNull(), "group")
        .when(F.col("is_name"), None)
        .when(unmarked & (F.col("sec") == "method") & bare_step.isNotNull(), "bare_step")
        .when(unmarked | F.col("mark").eqNullSafe("other"), "plain")
        .when(F.col("mark").eqNullSafe("step") & (F.col("tail") != "") & ~F.col("bare_number"), "inline_step")
    )
    typed = lines.withColumn("via", via).where(F.col("via").isNotNull() | stay).select(
        "*",
        F.when(F.col("via").isNull(), None).when(F.col("via").isin("step_body", "bare_step", "inline_step"), "step").when(F.col("via") == "group", F.when(F.col("grp.group") == "seasoning", "seasoning").otherwise("ingredient")).otherwise(plain).alias("kind"),
        T.strip(F.when(F.col("via") == "inline", F.col("inline.rest")).when(F.col("via") == "group", F.col("grp.value")).when(F.col("via") == "bare_step", bare_step["rest"]).when(F.col("via") == "inline_step", F.col("tail")).otherwise(F.col("st"))).alias("text"),
    )
    step_no = F.sum((F.col("kind") == "step").cast("int")).over(_in_record().rowsBetween(Window.unboundedPreceding, 0))
    label = F.when(F.col("kind") == "step", F.concat(F.lit("step"), step_no.cast("string"))).when(F.col("via") == "group", F.col("grp.group")).when(F.col("kind") == "note", "note").otherwise(F.col("sec"))
    return typed.where(F.expr("kind is not null and not (via = 'inline' and text = '')") | stay).withColumn("label", label)


def _joined(parts: DataFrame) -> DataFrame:
    """Add ``held`` (the piece has text, in a record) and, of such pieces, ``splice``."""
    held = F.coalesce((F.col("record") > 0) & F.col("kind").isNotNull() & (F.col("text") != ""), F.lit(False))
    rows = parts.withColumn("held", held)
    last = F.last(F.when(F.col("held"), F.struct("kind", F.substring("text", -1, 1).isin(*SENTENCE_ENDS).alias("ended"))), ignorenulls=True).over(_in_record().rowsBetween(Window.unboundedPreceding, -1))
    same = (last["kind"] == F.col("kind")) & ~last["ended"] & (F.col("continued") | F.col("no_marker"))
    # Another record on the page before would mean that this one opened there, with a piece that joins none
    rows = rows.withColumn("joins", F.when(F.col("held"), F.coalesce(same, F.lit(False))))
    return rows.withColumn("splice", F.min("joins").over(_in_record("page").rowsBetween(Window.unboundedPreceding, 0)))


def spliced(parts: DataFrame, span: int = scan.SPAN, began: DataFrame | None = None) -> DataFrame:
    """Add ``splice`` (the piece continues the block before it, across pages) and ``block``, counted in the book."""
    joined = _joined(parts).where("held")
    joined = joined.withColumn("own_block", F.sum((~F.col("splice")).cast("long")).over(_in_record().rowsBetween(Window.unboundedPreceding, 0)))
    counted = materialize(joined.groupBy("book", "record").agg(F.max("own_block").alias("n")), "block_counts")
    before = _with_begin(scan.before(counted, ["record"], {"blocks_before": F.col("n")}, span=span), began)
    before = before.select("book", "record", (F.col("begin.blocks") + F.col("blocks_before")).alias("blocks_before"))
    return scan.matched(joined, before, ["book", "record"]).withColumn("block", F.col("own_block") + F.col("blocks_before")).drop("own_block", "blocks_before")


def records(lines: DataFrame, contract: Contract, errata: DataFrame | None = None) -> DataFrame:
    """A row per record, without its lists.  A number that recurs in its scope gets b, c, … only where an erratum names it.

    ``errata``: (book, scope, kind, value) strings; book empty or ``*`` stands for all.
    """
    nth = F.row_number().over(Window.partitionBy("book", "scope_id", "number").orderBy("page", "line"))
    three = F.lpad(F.col("number").cast("string"), F.greatest(F.lit(3), F.length(F.col("number").cast("string"))), "0")
    base = F.concat("book", F.lit("-"), F.when(F.lit(contract.numbering == "per_chapter"), F.concat("scope_id", F.lit("-"))).otherwise(""), F.lit("R"), three)
    rows = lines.where("how is not null").select("book", "record", "page", "line", "how", "number", F.trim("start.raw").alias("number_raw"), T.norm("start.name").alias("name"), "chapter", "chapter_seq", "sub_chapter", "scope_id", base.alias("base_id"), nth.alias("occurrence"))
    if errata is None:
        return rows.withColumn("recipe_id", F.col("base_id"))
    again = match_errata(rows.where("occurrence > 1"), errata, "print_duplicate_number").select("book", "record", F.lit(True).alias("listed"))
    return rows.join(again, ["book", "record"], "left").withColumn("recipe_id", F.when(F.col("listed"), F.concat("base_id", F.char(F.lit(96) + F.col("occurrence")))).otherwise(F.col("base_id"))).drop("listed")


def assemble(pages: DataFrame, contract: Contract | None = None, errata: DataFrame | None = None, cut: Callable[[DataFrame, str], DataFrame] = materialize, span: int = scan.SPAN, began: DataFrame | None = None, taken: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a corpus from (book, page, text): typed lines, recipes, blocks, glossary, rejected and promoted starts.

    Empty pages give nothing; null text is an empty page.  (book, page) should be unique.  ``cut`` writes the lines and
    pieces of books of several ranges, of which all other tables are made, and reads them back.  ``span`` pages or records are scanned in one task.

    Pages that go on from earlier ones have what those left: ``began`` (book and the columns of ``BEGIN``; a first page with a state must
    begin with a line that opens a record) and ``taken`` (book, scope_id, number), the numbers of earlier records.
    """
    contract = contract or Contract()
    if began is None and taken is None:
        pages = materialize(pages.select("book", "page", "text"), "pages")
        if not pages.where((F.col("page") >= span) | (F.col("page") < 0)).limit(1).count():
            return small_books(pages, contract, errata, span)
    raw = materialize(to_lines(pages), "raw_lines")
    typed = materialize(type_lines(raw, contract), "typed_lines")
    bare = F.coalesce(F.col("tail").rlike(contract.step_number_bare) & F.col("mark").eqNullSafe("step"), F.lit(False))
    lines = cut(stated(placed(typed, openings(typed, span, began, taken), span, began).withColumn("bare_number", bare)), "lines")
    contents = raw.groupBy("book", "page").agg(F.count_if(is_toc_line("st", contract)).alias("hits"), F.count("*").alias("lines"), (~F.max(F.col("st").startswith("@@"))).alias("bare"))
    parts = cut(pieces(lines, contract), "pieces")
    heads = records(lines, contract, errata)
    ids = heads.select("book", "record", "recipe_id", "number")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "line", "text"))), lambda x: x["text"]), "")
    names = lines.where("is_name").select("book", "record", "stretch", "page", "line", *(F.lit(None).cast("string").alias(c) for c in ("via", "kind", "text")), "continued", "no_marker", "is_name", "st")
    first = F.min(F.struct("page", "line", "label"))
    merged = spliced(parts, span, began).groupBy("book", "record", "block", "kind").agg(first.alias("first"), text.alias("text"), F.count("*").alias("n"))
    blocks = merged.join(ids, ["book", "record"]).select(
        _bid(F.col("recipe_id"), F.col("block")).alias("bid"),
        "book", "recipe_id", "record", "block", "number", F.col("kind").alias("type"), F.col("first.page").alias("page_from"), F.col("first.label").alias("group"), "text", F.col("n").alias("pieces"),
    )
    item = F.struct("page", "line", "text")
    lists = parts.where("record > 0 and kind in ('ingredient', 'seasoning')").groupBy("book", "record").agg(*(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == k, item))), lambda x: x["text"]).alias(n) for k, n in (("ingredient", "ingredients"), ("seasoning", "seasonings"))))
    owned = blocks.groupBy("book", "record").agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "bid"))), lambda x: x["bid"]).alias("blocks"))
    none = F.array().cast("array<string>")
    recipes = heads.join(lists, ["book", "record"], "left").join(owned, ["book", "record"], "left").select(
        "book", "recipe_id", "number", "number_raw", F.col("record").alias("ordinal"), "name", F.lit("").alias("name_toc"), F.col("name").alias("name_body"), "chapter", "chapter_seq", "sub_chapter", "scope_id", "how", "page", "line", *(F.coalesce(c, none).alias(c) for c in ("ingredients", "seasonings", "blocks")),
    )
    return {"lines": lines, "pieces": parts, "starts": lines, "heads": recipes, "recipes": recipes, "blocks": blocks, "glossary": glossary(lines, contract), "contents": contents, "shown": _shown(parts.select("book", "record", "stretch", "page", "line", "via", "kind", "text", "continued", "no_marker", F.lit(False).alias("is_name"), "st").unionByName(names))}


def glossary(lines: DataFrame, contract: Contract) -> DataFrame:
    """(book, page, line, marker, title, text) of the notes that explain a word."""
    notes = lines.where(F.col("mark").isNull() | F.col("mark").eqNullSafe("other")).where("sec = 'notes' and not takes_step and not is_name and how is null")
    entry = T.glossary_entry(F.when(F.col("is_inline"), F.col("inline.rest")).otherwise(F.col("st")), contract.glossary_pattern)
    return notes.where("grp is null").select("book", "page", "line", entry.alias("g")).where("g is not null").select("book", "page", "line", "g.*")


# Books of one page range


def _bid(recipe_id: Column, block: Column) -> Column:
    return F.concat(recipe_id, F.lit("-¶"), F.lpad(block.cast("string"), F.greatest(F.lit(4), F.length(block.cast("string"))), "0"))


def _few_lines(pages: DataFrame, contract: Contract) -> DataFrame:
    """(book, page, line, st, toc_page, next_line, next_content, full): lines that may change the scope or open a record, and a row a page with line -1.

    A page's own row has its first line and first content; ``full`` says that the page has more than contents.
    """
    content = lambda x: ~x.startswith(contract.footer) & ~x.startswith(contract.recipe_cont)
    st, line = F.col("st"), F.col("line")
    tail = F.substring(st, len(contract.section) + 1, 1_000_000)
    section = st.startswith(contract.section)
    telling = st.startswith(contract.recipe_start) | (section & (T.may_number(tail) | T.norm(tail).rlike(f"(?:{contract.chapter_pattern})|(?:{contract.subchapter_pattern})"))) | (~st.startswith("@@") & T.may_number(st))
    rows = page_rows(pages, contract).select("book", "page", "toc_page", "hinted", "rows")
    some = F.filter("rows", lambda x: x != "")
    own = rows.withColumn("some", some).where("size(some) > 0").select(
        "book", "page", F.lit(-1).alias("line"), F.get("some", 0).alias("st"), "toc_page", F.lit(None).cast("string").alias("next_line"), F.get(F.filter("some", content), 0).alias("next_content"),
        (~F.col("hinted") | F.exists("some", lambda x: ~is_toc_line(x, contract))).alias("full"),
    )
    behind = F.filter(F.slice("rows", line + 2, F.size("rows")), lambda x: x != "")
    told = exploded(rows, contract).where(telling).select("book", "page", "line", "st", "toc_page", F.when(section, F.get(behind, 0)).alias("next_line"), F.when(section, F.get(F.filter(behind, content), 0)).alias("next_content"), F.lit(None).cast("boolean").alias("full"))
    return own.unionByName(told)


def _numbered(few: DataFrame, contract: Contract) -> DataFrame:
    """Of ``_few_lines``: types, the scope in force, how they open a record and its number in the book."""
    book = lambda *keys: Window.partitionBy("book", "range", *keys)
    to_here = lambda w: w.orderBy("page", "line").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    own, opener = F.col("line") < 0, ~F.col("st").startswith(contract.section)
    later = book().orderBy(F.desc("page"), F.desc("line")).rowsBetween(Window.unboundedPreceding, -1)
    heads = {"next_line": F.last(F.when(own, F.col("st")), ignorenulls=True).over(later), "next_content": F.last(F.when(own, F.col("next_content")), ignorenulls=True).over(later)}
    few = few.withColumn("range", F.lit(0)).repartition("book")
    few = few.withColumns({f"far_{n}": v for n, v in heads.items()})
    few = few.withColumns({n: F.when(~own & ~opener, F.coalesce(n, f"far_{n}")) for n in heads}).drop(*(f"far_{n}" for n in heads))
    few = start_flags(named_parts(marked(few, contract), contract), contract)
    few = few.select("book", "range", "page", "line", "st", "toc_page", "full", "tail", "start", *(((F.col("line") >= 0) & F.col(c)).alias(c) for c in ("chapter_line", "sub_line", "accepted", "rejected", "candidate", "unmarked_start")))
    title = T.norm("tail")
    few = few.withColumns({"chapter_seq": F.sum(count("chapter_line")).over(to_here(book())), "subs": F.sum(count("sub_line")).over(to_here(book()))})
    events = {"chapter": F.when(F.col("chapter_line"), title), "sub_chapter": F.when(F.col("chapter_line"), "").when(F.col("sub_line"), title), "subs_before": F.when(F.col("chapter_line"), F.col("subs"))}
    place = F.struct("page", "line")
    first = lambda c: F.min(F.when(c, place)).over(book().orderBy("page", "line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    few = few.withColumns({n: F.coalesce(F.last(v, ignorenulls=True).over(to_here(book())), F.lit(BEGIN.get(n, 0))) for n, v in events.items()} | {"u": first(F.col("unmarked_start")), "o": first(F.col("accepted") | F.col("candidate"))})
    few = few.withColumn("sub_seq", F.col("subs") - F.col("subs_before"))
    few = few.withColumn("scope_id", F.concat(F.lit("C"), _two("chapter_seq"), F.when(F.col("sub_seq") > 0, F.concat(F.lit("-S"), _two("sub_seq"))).otherwise("")))
    # The first opening of a book may lack its mark
    few = few.withColumn("unmarked_open", F.coalesce(F.col("unmarked_start") & (place == F.col("u")) & (F.col("o").isNull() | (F.col("u") < F.col("o"))), F.lit(False)))
    opens = F.col("accepted") | F.col("candidate") | F.col("unmarked_open")
    few = few.withColumn("number", F.when(opens, F.col("start.number"))).withColumn("nth", F.sum(opens.cast("int")).over(to_here(book("scope_id", "number"))))
    how = F.when(F.col("accepted"), "start").when(F.col("unmarked_open"), "unmarked").when(F.col("candidate") & (F.col("nth") == 1), "promoted")
    few = few.withColumn("how", how).withColumn("occurrence", F.count("how").over(to_here(book("scope_id", "number"))))
    few = few.withColumn("record", F.count("how").over(to_here(book())))
    return few.select("book", "page", "line", "full", "tail", "start", "chapter_line", "sub_line", "accepted", "rejected", *STATE, "record", "how", "number", "occurrence")


def small_books(pages: DataFrame, contract: Contract, errata: DataFrame | None = None, span: int = scan.SPAN) -> dict[str, DataFrame]:
    """The corpus of books that lie within one page range each, as DataFrames over the written pages and the few lines that open something.

    Nothing but these two is written, so a table costs only what it needs.  ``starts`` has each page's row and the lines that are or may be
    starts, ``heads`` the records without their lists.
    """
    few = materialize(_few_lines(pages, contract), "few")
    found = materialize(_numbered(few, contract), "found")
    base = F.concat("book", F.lit("-"), F.when(F.lit(contract.numbering == "per_chapter"), F.concat("scope_id", F.lit("-"))).otherwise(""), F.lit("R"), F.lpad(F.col("number").cast("string"), F.greatest(F.lit(3), F.length(F.col("number").cast("string"))), "0"))
    found = found.withColumn("recipe_id", F.when(F.col("how").isNotNull(), base))
    if errata is not None:
        again = match_errata(found.where("how is not null and occurrence > 1").select("book", "scope_id", "number", "record"), errata, "print_duplicate_number")
        again = materialize(again.select("book", "record", F.lit(True).alias("listed")), "listed")
        found = found.join(again, ["book", "record"], "left").withColumn("recipe_id", F.when(F.col("listed") & F.col("how").isNotNull(), F.concat("recipe_id", F.char(F.lit(96) + F.col("occurrence")))).otherwise(F.col("recipe_id"))).drop("listed")
        found = materialize(found, "found")
    name = T.norm("start.name")
    heads = found.where("how is not null").select("book", "recipe_id", "number", F.trim("start.raw").alias("number_raw"), F.col("record").alias("ordinal"), name.alias("name"), F.lit("").alias("name_toc"), name.alias("name_body"), "chapter", "chapter_seq", "sub_chapter", "scope_id", "how", "page", "line")
    lines = _small_lines(pages, found, contract, span)
    parts = pieces(lines, contract)
    contents = page_contents(pages, contract)
    shown = _shown(pieces(lines, contract, F.col("is_name")))
    held = _in_book(parts)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "line", "text"))), lambda x: x["text"]), "")
    merged = held.where("held").groupBy("book", "record", "block", "kind", "opened").agg(F.min(F.struct("page", "line", "label")).alias("first"), text.alias("text"), F.count("*").alias("n"))
    blocks = merged.select(_bid(F.col("opened.recipe_id"), F.col("block")).alias("bid"), "book", "opened.recipe_id", "record", "block", "opened.number", F.col("kind").alias("type"), F.col("first.page").alias("page_from"), F.col("first.label").alias("group"), "text", F.col("n").alias("pieces"))
    return {"lines": lines, "pieces": parts, "starts": found.where("full or line >= 0"), "heads": heads, "recipes": _small_recipes(lines, contract), "blocks": blocks, "glossary": glossary(lines, contract), "contents": contents, "shown": shown}


def page_contents(pages: DataFrame, contract: Contract) -> DataFrame:
    """(book, page, hits, lines, bare): lines of contents and all lines of each page, and whether others bear no mark."""
    size = lambda x: F.size(x).cast("long")
    hits, n = F.when(F.col("hinted"), size(F.filter("rows", lambda x: is_toc_line(x, contract)))).otherwise(F.lit(0)), size(F.filter("rows", lambda x: x != ""))
    rows = page_rows(pages, contract).select("book", "page", hits.alias("hits"), n.alias("lines"), "no_marker")
    return rows.groupBy("book", "page").agg(F.sum("hits").alias("hits"), F.sum("lines").alias("lines"), F.bool_and("no_marker").alias("bare")).where("lines > 0")


def _shown(parts: DataFrame) -> DataFrame:
    """(book, kind): tolerated variants, splices and spellings of unmarked sections, one by one."""
    kinds = F.array(F.when(F.col("via").isin(*VARIANTS), F.col("via")), F.when(F.col("held") & F.col("splice"), "splice"), F.when(F.col("is_name"), F.concat(F.lit("spelling_"), "st")))
    return _joined(parts).select("book", F.explode(F.array_compact(kinds)).alias("kind"))


def _small_lines(pages: DataFrame, found: DataFrame, contract: Contract, span: int) -> DataFrame:
    """Typed lines with the state in force: pages and what was found in them meet by book."""
    state = F.struct("line", *STATE, "record", "recipe_id", "number", "how", "chapter_line", "sub_line", "accepted", "rejected", "start")
    changes = found.where("how is not null or chapter_line or sub_line or rejected").select("book", "page", F.lit(None).cast("string").alias("text"), state.alias("change"))
    rows = pages.withColumn("change", F.lit(None).cast(changes.schema["change"].dataType)).unionByName(changes).repartition("book")
    rows = rows.groupBy("book", "page").agg(F.collect_list("text").alias("texts"), F.sort_array(F.collect_list("change")).alias("changes"))
    earlier = Window.partitionBy("book", "range").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    in_force = ("record", *STATE)
    came = F.last(F.try_element_at("changes", F.lit(-1)), ignorenulls=True).over(earlier)
    rows = rows.withColumn("range", F.floor(F.col("page") / span)).withColumn("came", F.struct(*(came[c].alias(c) for c in in_force)))
    rows = page_rows(rows.select("book", "page", "changes", "came", F.explode("texts").alias("text")), contract)
    lines = exploded(rows, contract)
    lines = lines.select("book", "page", "line", "st", "toc_page", "no_marker", "continued", "came", F.expr("try_element_at(filter(changes, c -> c.line <= line), -1)").alias("own"))
    here = F.col("own.line").eqNullSafe(F.col("line"))
    begin = {n: F.lit(BEGIN[n]).cast("long" if isinstance(BEGIN[n], int) else "string") for n in in_force}
    lines = lines.select(
        "book", "page", "line", "st", "toc_page", "no_marker", "continued", *(F.coalesce(f"own.{c}", f"came.{c}", begin[c]).alias(c) for c in in_force),
        *(F.when(here, F.col(f"own.{c}")).alias(c) for c in ("how", "number", "recipe_id", "start")), *((here & F.col(f"own.{c}")).alias(c) for c in ("chapter_line", "sub_line", "accepted", "rejected")),
    )
    lines = named_parts(marked(lines, contract), contract).withColumn("stretch", F.when(F.col("record") == 0, F.concat_ws("-", "chapter_seq", "sub_seq")).otherwise(""))
    bare = F.coalesce(F.col("tail").rlike(contract.step_number_bare) & F.col("mark").eqNullSafe("step"), F.lit(False))
    opened = F.first(F.when(F.col("how").isNotNull(), F.struct("recipe_id", "number")), ignorenulls=True).over(_in_record().rowsBetween(Window.unboundedPreceding, 0))
    return stated(lines.withColumn("bare_number", bare)).withColumn("opened", opened)


def _in_book(parts: DataFrame) -> DataFrame:
    """Add what ``_joined`` adds and ``block``, counted in the book, null for pieces without text."""
    to_here = Window.partitionBy("book").orderBy("record", "stretch", "page", "line").rowsBetween(Window.unboundedPreceding, 0)
    return _joined(parts).withColumn("block", F.when(F.col("held"), F.sum((F.col("held") & ~F.col("splice")).cast("long")).over(to_here)))


def _small_recipes(lines: DataFrame, contract: Contract) -> DataFrame:
    """Records with their lists, gathered from their opening lines and pieces alike."""
    name = T.norm("start.name")
    head = F.struct("recipe_id", "number", F.trim("start.raw").alias("number_raw"), name.alias("name"), "chapter", "chapter_seq", "sub_chapter", "scope_id", "how", "page", "line")
    rows = _in_book(pieces(lines, contract, F.col("how").isNotNull()).where("record > 0"))
    rows = rows.select("book", "record", "block", "kind", F.when(F.col("how").isNotNull(), head).alias("head"), F.struct("page", "line", "text").alias("item"))
    items = {"ingredients": "ingredient", "seasonings": "seasoning"}
    found = rows.groupBy("book", "record").agg(F.first("head", ignorenulls=True).alias("h"), F.min("block").alias("low"), F.max("block").alias("high"), *(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("item")))), lambda x: x["text"]).alias(n) for n, k in items.items()))
    ids = F.when(F.col("low").isNull(), F.array().cast("array<string>")).otherwise(F.transform(F.sequence("low", "high"), lambda b: _bid(F.col("h.recipe_id"), b)))
    return found.select("book", "h.recipe_id", "h.number", "h.number_raw", F.col("record").alias("ordinal"), "h.name", F.lit("").alias("name_toc"), F.col("h.name").alias("name_body"), "h.chapter", "h.chapter_seq", "h.sub_chapter", "h.scope_id", "h.how", "h.page", "h.line", "ingredients", "seasonings", ids.alias("blocks"))


def promoted_starts(recipes: DataFrame) -> DataFrame:
    return recipes.where("how = 'promoted'").select("book", "page", (F.col("line") + 1).alias("line"), F.col("number_raw").alias("raw"), "number", "name", "scope_id")


def drift_counts(corpus: dict[str, DataFrame]) -> DataFrame:
    """(book, kind, n): how often each tolerated variant, sub-chapter, page without marks, splice, spelling of an unmarked section, line and page of contents occurs."""
    starts = corpus["starts"]
    how = starts.where("how is not null").select("book", F.concat(F.lit("open_"), "how").alias("kind"))
    refused = starts.where("rejected").select("book", F.concat(F.lit("rejected_"), "start.reason").alias("kind"))
    subs = starts.where("sub_line").select("book", F.lit("sub_chapter").alias("kind"))
    rows = corpus["shown"].unionByName(how).unionByName(refused).unionByName(subs).withColumn("n", F.lit(1))
    unmarked = corpus["contents"].where("bare and hits < lines").select("book", F.lit("no_marker_page").alias("kind"), F.lit(1).alias("n"))
    toc = corpus["contents"].where("hits > 0").selectExpr("book", "stack(2, 'toc_line', hits, 'toc_page', if(hits >= 3 and 4 * hits >= lines, 1L, 0L)) as (kind, n)").where("n > 0")
    return rows.unionByName(unmarked).unionByName(toc.select("book", "kind", "n")).groupBy("book", "kind").agg(F.sum("n").alias("n"))


def signature(rows: DataFrame, keys: list[str], order: Column | str, id_col: str, text_col: str, model: str, dtype: str, slug: str) -> DataFrame:
    """(keys, n, sha256, signature): a digest over the model's name and every (id, text) of a group in order."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(F.expr(order) if isinstance(order, str) else order, F.col(id_col).alias("i"), F.col(text_col).alias("t")))), lambda x: F.concat(F.char(F.lit(0)), x["i"], F.char(F.lit(1)), x["t"]))
    digest = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sha2(F.concat(F.lit(model), F.array_join(parts, "")), 256).alias("sha256"))
    return digest.withColumn("signature", F.concat_ws("_", F.substring("sha256", 1, 16), "n", F.lit(dtype), F.lit(slug)))
