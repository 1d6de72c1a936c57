"""Queries that apply the operators to whole tables, each beside SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.jobs.transcript import ITEMS, ORDERS, SQL, transcript_pages
from leafpress.operators import assemble as A
from leafpress.operators import audit, evaluate, gram_index, index, lines, quality, search, vectors
from leafpress.operators.contract import Contract
from leafpress.sources import readers
from leafpress.storage import materialize, new_path, shared_dir

#: White space in RE2, as the library sees it.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_KEY_OUT = r"〔〕【】\[\]（）()〈〉《》"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_as_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("source as book", "doc_id as page", "text")


# Text functions and lines


@query(rf"""
    with l as (select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text is not null),
    s as (select doc_id, i, regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') as st from l)
    select doc_id, count(*) as lines, cast(sum(length(regexp_replace(st, '{WS}+', '', 'g'))) as bigint) as chars,
        md5(regexp_replace(regexp_replace(arg_min(st, i), '{WS}+', '', 'g'), '^[{_KEY_OUT}]+|[{_KEY_OUT}：:]+$', '', 'g')) as first_key,
        cast(sum(cast((length(st) - length(replace(st, 'the', ''))) / 3 as bigint)) as bigint) as literals
    from s where st <> '' group by doc_id""")
def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document: how many, their characters without blanks, the first one's key, a literal's count."""
    rows = lines.to_lines(documents_as_pages(spark, sf_dir))
    found = rows.groupBy(F.col("page").cast("long").alias("doc_id")).agg(F.count("*").alias("lines"), F.sum(F.length(T.norm("st"))).cast("long").alias("chars"), F.min_by("st", "line").alias("first"), F.sum(T.count_literal("st", "the")).cast("long").alias("literals"))
    return found.select("doc_id", "lines", "chars", F.md5(T.norm_key("first")).alias("first_key"), "literals")


@query("""
    select cast(l_quantity as int) as number, count(*) as n, cast(sum(length(concat('P', cast(l_partkey as varchar)))) as bigint) as name_chars, 0 as unread
    from lineitem group by 1""")
def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start lines with Chinese numerals made of quantities, read back by ``parse_start``."""
    digit = lambda c: F.substring(F.lit("〇一二三四五六七八九"), c + 1, F.lit(1))
    q = F.col("l_quantity").cast("int")
    tens, ones = F.floor(q / 10).cast("int"), q % 10
    numeral = F.when(q < 10, digit(q)).otherwise(F.concat(F.when(tens > 1, digit(tens)).otherwise(""), F.lit("十"), F.when(ones > 0, digit(ones)).otherwise("")))
    start = F.concat(F.lit("*（ "), numeral, F.lit(" ） P"), F.col("l_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(T.parse_start(start, "mixed", Contract().recipe_number_pattern).alias("s"))
    return rows.groupBy(F.col("s.number").alias("number")).agg(F.count("*").alias("n"), F.sum(F.length("s.name")).cast("long").alias("name_chars"), F.count_if(F.col("s.reason") != "ok").cast("int").alias("unread"))


@query(rf"""
    with t as (select conv_id, turn, regexp_replace(text, '{WS}+', '', 'g') as t from conversations),
    g as (select conv_id, turn, case when length(t) < 2 then [t] else list_distinct(list_transform(range(1, length(t)), lambda i: substr(t, i, 2))) end as g from t)
    select conv_id, turn, cast(len(g) as int) as grams, md5(array_to_string(list_sort(g), '')) as digest from g""")
def turn_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.bigrams("text").alias("g"))
    return rows.select("conv_id", "turn", F.size("g").alias("grams"), F.md5(F.array_join(F.sort_array("g"), "")).alias("digest"))


@query(rf"""
    with c as (select page_id, html, replace(replace(html, 'example.com', ''), 'class=', '') as t from pages)
    select page_id, sha256(html) as sha256, cast((contains(html, 'example.com'))::int + (contains(html, 'class='))::int as int) as literals,
        md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\(\s*\)|\[\s*\]|（\s*）|【\s*】', '', 'g'), '[\s\x0b]{{2,}}', ' ', 'g'), '[\s\x0b]+([.)\]])', '\1', 'g'), '^{WS}+|{WS}+$', '', 'g')) as digest
    from c""")
def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", T.strip_watermark("html", ["example.com", "class="]).alias("w"))
    return rows.select("page_id", "w.sha256", "w.literals", F.md5("w.text").alias("digest"))


@query("""
    with t as (select conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as st, role from conversations)
    select conv_id, turn, md5(coalesce(lead(st) over w, '-')) as next_line,
        md5(coalesce((select arg_min(b.st, b.turn) from t b where b.conv_id = t.conv_id and b.turn > t.turn and b.role <> 'user'), '-')) as next_content
    from t window w as (partition by conv_id order by turn)""")
def next_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next turn, and the next turn that is not the user's (whose lines are marked as footers here)."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), F.lit(0).alias("page"), F.col("turn").alias("line"), F.concat(F.when(F.col("role") == "user", "@@FOOTER ").otherwise(""), F.regexp_replace("text", r"^[ \t\n\r]+|[ \t\n\r]+$", "")).alias("st"))
    plain = lambda c: F.md5(F.coalesce(F.regexp_replace(c, "^@@FOOTER ", ""), F.lit("-")))
    return lines.neighbours(turns, Contract()).select(F.col("book").alias("conv_id"), F.col("line").alias("turn"), plain("next_line").alias("next_line"), plain("next_content").alias("next_content"))


# The synthetic transcript: what assembly must give follows from the order tables

_OWNED = f"""
    o as ({ORDERS}), i as ({ITEMS}),
    k as (select *, sum(case when refused then 0 else 1 end) over (partition by book order by seq) as rec from o),
    r as (select book, rec, min(okey) filter (not refused) as okey, any_value(num) filter (not refused) as num, any_value(chap) filter (not refused) as chap,
        any_value(yr) filter (not refused) as yr, bool_or(promoted) as promoted from k where rec > 0 group by book, rec),
    rid as (select *, concat(book, '-C', lpad(cast(chap as varchar), 2, '0'), '-R', lpad(cast(num as varchar), 3, '0')) as recipe_id from r),
    p as (select k.book, k.rec, k.seq, 0 as kind, i.item, i.part as text from k join i on i.okey = k.okey where rec > 0
        union all select k.book, k.rec, k.seq, 1, i.item, i.ship from k join i on i.okey = k.okey where rec > 0),
    b as (select *, row_number() over (partition by book order by rec, seq, kind, item) as block from p)"""
_ORDERS_SQL = _OWNED.replace("cast(o_custkey as string)", "cast(o_custkey as varchar)").replace(" as string)", " as varchar)")


def corpus(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The transcript's corpus, assembled by the first query of a session that needs it."""
    return shared(spark, sf_dir, "transcript", ("orders", "lineitem"), lambda: A.assemble(transcript_pages(spark, sf_dir)))


_SHARED: dict[tuple, dict[str, DataFrame]] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, sources: tuple[str, ...], make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The tables that ``make`` gives, for all queries of a session over the same files: what it writes is written once, the rest each query computes as far as it needs it."""
    files = tuple(sorted(f for t in sources for f in table(spark, sf_dir, t).inputFiles()))
    key = (spark.sparkContext.applicationId, shared_dir(spark), files, name)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


@query(f"""with {_ORDERS_SQL}
    select rid.book, rid.recipe_id, cast(rid.num as int) as number, cast(rid.rec as bigint) as ordinal, concat('名', cast(okey as varchar)) as name, concat('一、', cast(yr as varchar)) as chapter,
        case when promoted then 'promoted' else 'start' end as how,
        coalesce((select md5(string_agg(text, '|' order by block)) from b where b.book = rid.book and b.rec = rid.rec and kind = 0), md5('')) as ingredients,
        cast((select count(*) from b where b.book = rid.book and b.rec = rid.rec) as int) as blocks
    from rid""")
def transcript_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = corpus(spark, sf_dir)["recipes"]
    return r.select("book", "recipe_id", "number", "ordinal", "name", "chapter", "how", F.md5(F.array_join("ingredients", "|")).alias("ingredients"), F.size("blocks").alias("blocks"))


@query(f"""with {_ORDERS_SQL}
    select b.book, concat(recipe_id, '-¶', lpad(cast(block as varchar), cast(greatest(4, length(cast(block as varchar))) as int), '0')) as bid, case kind when 0 then 'ingredient' else 'step' end as type,
        case kind when 0 then 'main' else concat('step', cast(row_number() over (partition by b.book, b.rec, kind order by block) as varchar)) end as "group", text
    from b join rid on rid.book = b.book and rid.rec = b.rec""")
def transcript_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir)["blocks"].select("book", "bid", "type", "group", "text")


_TRANSCRIPT_SQL = SQL.replace(" as string)", " as varchar)")


@query(f"""with t as ({_TRANSCRIPT_SQL})
    select book, page, at_line + 1 as line, substr(line, 16) as rest, 'unnumbered' as reason from t where line like '@@RECIPE_START 名%'""")
def transcript_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.rejected_starts(corpus(spark, sf_dir)["starts"])


@query(f"""with t as ({_TRANSCRIPT_SQL})
    select book, page, at_line + 1 as line, regexp_extract(line, '（([0-9]+)）', 1) as raw, cast(regexp_extract(line, '（([0-9]+)）', 1) as int) as number, regexp_extract(line, '名[0-9]+') as name
    from t where line like '@@SECTION （%'""")
def transcript_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.promoted_starts(corpus(spark, sf_dir)["heads"]).drop("scope_id")


@query(f"""with t as ({_TRANSCRIPT_SQL}) select book, page, count(*) as hits, count(*) as lines from t where page = 0 group by book, page having count(*) >= 3""")
def transcript_toc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.page_contents(transcript_pages(spark, sf_dir), Contract()).where("hits >= 3 and 4 * hits >= lines").select("book", "page", "hits", "lines")


@query(f"""with {_ORDERS_SQL}
    select book, case when promoted then 'open_promoted' else 'open_start' end as kind, count(*) as n from rid group by 1, 2
    union all select book, 'rejected_unnumbered', count(*) from o where refused group by 1
    union all select book, 'step_body', count(*) from b where kind = 1 group by 1
    union all select book, 'no_marker_page', count(*) from (select book, page from ({_TRANSCRIPT_SQL}) where page > 0 group by 1, 2 having not bool_or(starts_with(line, '@@'))) group by 1
    union all select book, 'toc_line', count(*) from o group by 1
    union all select book, 'toc_page', 1 from o group by 1 having count(*) >= 3""")
def transcript_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.drift_counts(corpus(spark, sf_dir))


@query(f"""with {_ORDERS_SQL}
    select book, concat('C', lpad(cast(chap as varchar), 2, '0')) as scope_id, concat('C', lpad(cast(chap as varchar), 2, '0'), ' 一、', cast(yr as varchar)) as title, string_agg(cast(num as varchar), ',' order by num) as numbers
    from rid group by book, chap, yr""")
def transcript_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.numbers_in_scope(corpus(spark, sf_dir)["heads"]).withColumn("numbers", F.array_join(F.col("numbers").cast("array<string>"), ","))


_MISSING = "m as (select o.book, concat('C', lpad(cast(chap as varchar), 2, '0')) as scope_id, cast(num as int) as missing from o where refused and exists (select 1 from o x where x.book = o.book and x.chap = o.chap and x.num > o.num and not x.refused))"


@query(f"with {_ORDERS_SQL}, {_MISSING} select * from m")
def transcript_missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_numbers(corpus(spark, sf_dir)["heads"], ["book", "scope_id"])


@query(f"""with {_ORDERS_SQL}, {_MISSING},
    e as (select 'K' || cast(c_custkey as varchar) as book, 'C0' || cast(c_custkey % 7 + 1 as varchar) as scope_id, c_nationkey % 4 + 1 as v from customer where c_custkey % 3 > 0
        union all select '*', 'C0' || cast(c_custkey % 7 + 1 as varchar), c_nationkey % 2 + 1 from customer where c_custkey % 3 = 0),
    x as (select m.*, exists (select 1 from e where e.book in ('*', m.book) and e.scope_id = m.scope_id and e.v = m.missing) as listed from m)
    select book, count(*) as found, count(*) filter (listed) as exempted, bool_and(listed) as passes from x group by book""")
def exempt_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing numbers of the transcripts against errata made from customers, some of them for all books."""
    c = table(spark, sf_dir, "customer")
    errata = c.selectExpr("if(c_custkey % 3 > 0, concat('K', c_custkey), '*') as book", "concat('C0', c_custkey % 7 + 1, ' title') as scope", "'print_missing_number' as kind", "cast(if(c_custkey % 3 > 0, c_nationkey % 4, c_nationkey % 2) + 1 as string) as value")
    missing = quality.missing_numbers(corpus(spark, sf_dir)["heads"], ["book", "scope_id"])
    return quality.exempt_missing(missing, errata)


@query(f"""with {_ORDERS_SQL}
    select o.book, count(*) filter (not promoted) as start_lines, 0::bigint as unmarked, count(*) filter (promoted) as promoted, count(*) filter (not refused) as records, count(*) filter (refused) as refused,
        true as balanced, count(*) filter (refused) = 0 as none_rejected from o group by 1""")
def transcript_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.starts_balance(corpus(spark, sf_dir)["starts"])


@query(f"""with {_ORDERS_SQL},
    s as (select book, chap, min(num) = 1 and max(num) = count(*) as ok from rid group by 1, 2), c as (select book, bool_and(ok) as contiguous from s group by 1),
    m as (select rid.book, bool_and(exists (select 1 from i where i.okey = rid.okey) or exists (select 1 from b where b.book = rid.book and b.rec = rid.rec and kind = 1)) as methods from rid group by 1),
    f as (select c.book, list_sort(list_filter([case when not contiguous then 'contiguous' end, case when not methods then 'methods' end,
        case when exists (select 1 from o where o.book = c.book and refused) then 'starts' end], lambda x: x is not null)) as fails from c join m using (book))
    select book, array_to_string(fails, ',') as fails, 'vectors' as skips, case when len(fails) > 0 then 'FAIL' else 'SKIP' end as verdict from f""")
def transcript_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates of every book with a record; vectors are not there, so that gate cannot be decided."""
    c = corpus(spark, sf_dir)
    recipes = c["heads"]
    scopes = quality.contiguous(recipes, ["book", "scope_id"]).groupBy("book").agg(F.bool_and("contiguous").alias("ok")).select("book", quality.gate("contiguous", F.col("ok")).alias("g"))
    bare = quality.without_method(recipes, c["blocks"]).groupBy("book").agg(F.count("*").alias("n"))
    methods = recipes.select("book").distinct().join(bare, "book", "left").select("book", quality.gate("methods", F.coalesce("n", F.lit(0)) == 0).alias("g"))
    starts = quality.starts_balance(c["starts"]).where("records > 0").select("book", quality.gate("starts", F.col("balanced") & F.col("none_rejected")).alias("g"))
    ids = quality.ids_unique(recipes, "recipe_id", ["book"]).select("book", quality.gate("ids", F.col("unique")).alias("g"))
    vector = recipes.select("book").distinct().select("book", quality.gate("vectors", F.lit(None).cast("boolean")).alias("g"))
    rows = scopes.unionByName(methods).unionByName(starts).unionByName(ids).unionByName(vector).select("book", "g.*")
    return quality.gate_rollup(rows).select("book", F.array_join("fails", ",").alias("fails"), F.array_join("skips", ",").alias("skips"), "verdict")


@query(f"""with {_ORDERS_SQL}
    select book, count(*) as recipes, count(distinct chap) as scopes, coalesce((select count(*) from b where b.book = rid.book), 0) as blocks, coalesce((select count(*) from b where b.book = rid.book and kind = 1), 0) as steps,
        coalesce((select count(*) from b where b.book = rid.book and kind = 0), 0) as ingredient_blocks, 0::bigint as unread from rid group by book""")
def transcript_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = corpus(spark, sf_dir)
    return quality.corpus_counts(c["heads"], c["blocks"])


@query(f"""with {_ORDERS_SQL}, k2 as (select book, rec, recipe_id, unnest([concat('#', cast(num as varchar)), concat('名', cast(okey as varchar))]) as key from rid)
    select book, key, string_agg(recipe_id, ',' order by rec) as recipe_ids from k2 group by 1, 2""")
def transcript_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.terms(corpus(spark, sf_dir)["heads"]).withColumn("recipe_ids", F.array_join("recipe_ids", ","))


@query(f"""with {_ORDERS_SQL},
    c as (select book, 'card' as kind, cast(rec as bigint) as ord, recipe_id as id, concat('名', cast(okey as varchar), '（一、', cast(yr as varchar), '）主料：',
        coalesce((select string_agg(text, '、' order by block) from b where b.book = rid.book and b.rec = rid.rec and kind = 0), '无'), '；调料：无') as text from rid
      union all select b.book, 'text', block, concat(recipe_id, '-¶', lpad(cast(block as varchar), cast(greatest(4, length(cast(block as varchar))) as int), '0')), text from b join rid on rid.book = b.book and rid.rec = b.rec)
    select book, kind, count(*) as n, concat(substr(sha256(concat('model', string_agg(concat(chr(0), id, chr(1), text), '' order by ord))), 1, 16), '_', cast(count(*) as varchar), '_float32_slug') as signature,
        cast(ceil(count(*) / 32.0) as bigint) as calls from c group by 1, 2""")
def transcript_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = corpus(spark, sf_dir)
    inputs = vectors.embedding_inputs(c["recipes"], c["blocks"])
    calls = vectors.batch_calls(inputs).select("book", "kind", "calls")
    return A.signature(inputs, ["book", "kind"], "ord", "id", "text", "model", "float32", "slug").join(calls, ["book", "kind"]).select("book", "kind", "n", "signature", "calls")


@query(f"""with {_ORDERS_SQL}, f as (select * from rid where rec = 1),
    w as (select book, min(rec) as rec from b group by book), s as (select b.book, b.rec, arg_min(text, block) as t from b join w on w.book = b.book and w.rec = b.rec where kind = 1 group by 1, 2)
    select book, concat('名', cast(okey as varchar)) as q, recipe_id as want, 1 as topn from f union all select book, concat('#', cast(num as varchar)), recipe_id, 1 from f
    union all select s.book, substr(replace(t, ' ', ''), 1, 8), recipe_id, 3 from s join rid on rid.book = s.book and rid.rec = s.rec""")
def transcript_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = corpus(spark, sf_dir)
    return evaluate.derived_cases(c["recipes"], c["blocks"])


@query(f"""with {_ORDERS_SQL}
    select book, cast(rec as bigint) as ordinal, cast(num as int) as number, concat('名', cast(okey as varchar)) as name, '—' as name_toc, cast((select count(*) from b where b.book = rid.book and b.rec = rid.rec) as int) as blocks from rid""")
def transcript_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.book_listing(corpus(spark, sf_dir)["recipes"])


# Checks over the order and event tables


@query("""
    select l_orderkey, count(*) as n, min(l_linenumber) as lowest, max(l_linenumber) as highest, count(distinct l_linenumber) as distinct_n,
        min(l_linenumber) = 1 and max(l_linenumber) = count(*) and count(distinct l_linenumber) = count(*) as contiguous from lineitem group by 1""")
def order_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contiguous(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
    with t as (select l_orderkey, max(l_linenumber) as top from lineitem group by 1), w as (select l_orderkey, unnest(range(1, top + 1)) as missing from t)
    select l_orderkey, cast(missing as int) as missing from w where not exists (select 1 from lineitem l where l.l_orderkey = w.l_orderkey and l.l_linenumber = w.missing)""")
def order_missing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_numbers(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
    with w as (select o_orderkey, unnest(range(0, 7)) as page from orders), m as (select * from w where not exists (select 1 from lineitem l where l.l_orderkey = w.o_orderkey and l.l_linenumber - 1 = w.page))
    select o_orderkey as book, count(*) as todo, count(*) * 1512 as tokens from m group by 1""")
def todo_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as books of seven pages, of which line items are done."""
    books = table(spark, sf_dir, "orders").selectExpr("o_orderkey as book", "7 as pages")
    return quality.todo_estimate(quality.todo_pages(books, table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as book", "l_linenumber - 1 as page")))


@query("""
    with l as (select user_id as book, event_id % 11 as page, event_id, cast(round(value * 100) as bigint) as cents, length(props) as tokens, event_type from events),
    p as (select book, page, count(*) as entries, sum(cents) as c, sum(tokens) as t, count(*) filter (event_type = 'error') as failed, arg_max(event_type, event_id) as last from l group by 1, 2)
    select book, cast(sum(entries) as bigint) as entries, count(*) as pages, cast(sum(c) as bigint) as seconds, cast(sum(t) as bigint) as tokens, cast(sum(failed) as bigint) as failed, count(*) filter (last = 'error') as "open" from p group by 1""")
def event_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").selectExpr("user_id as book", "event_id % 11 as page", "event_id as seq", "cast(round(value * 100) as bigint) as seconds", "cast(length(props) as bigint) as tokens", "if(event_type = 'error', 'failed', 'ok') as status")
    return quality.log_summary(log)


@query("select user_id as book, count(distinct event_type) as versions from events group by 1 having count(distinct event_type) > 1")
def mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mixed_versions(table(spark, sf_dir, "events").selectExpr("user_id as book", "event_type as version"))


_MODAL = """
    c as (select p_brand as book, p_type, p_size, count(*) as pages, min(p_partkey) as first from part group by 1, 2, 3),
    m as (select book, p_type, p_size, pages from (select *, row_number() over (partition by book order by pages desc, first) as k from c) where k = 1)"""


@query(f"with {_MODAL} select * from m")
def modal_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part").selectExpr("p_brand as book", "p_partkey as page", "p_type", "p_size")
    return quality.modal_shape(pages, ["p_type", "p_size"])


@query(f"with {_MODAL} select p_brand as book, p_partkey as page, p.p_type, p.p_size from part p join m on m.book = p.p_brand where (p.p_type, p.p_size) is distinct from (m.p_type, m.p_size)")
def shape_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part").selectExpr("p_brand as book", "p_partkey as page", "p_type", "p_size")
    return quality.shape_outliers(pages, ["p_type", "p_size"])


@query("""
    with b as (select case when s_nationkey % 5 = 0 then 's' else 'S' end || lpad(cast(s_suppkey - s_suppkey % 2 * (s_nationkey % 3) as varchar), 8, '0') as code, case when s_suppkey % 9 = 0 then '' else s_name end as source_basename, s_suppkey from supplier)
    select s_suppkey, case when not regexp_matches(code, '^[A-Z][0-9]{2,}$') then 'code' when count(*) over (partition by code) > 1 then 'repeated' when source_basename = '' then 'no source' end as fault from b""")
def registry_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = table(spark, sf_dir, "supplier").selectExpr("concat(if(s_nationkey % 5 = 0, 's', 'S'), lpad(cast(s_suppkey - s_suppkey % 2 * (s_nationkey % 3) as string), 8, '0')) as code", "if(s_suppkey % 9 = 0, '', s_name) as source_basename", "s_suppkey")
    return quality.registry_check(books).select("s_suppkey", "fault")


@query("""
    with c as (select c_custkey, case when c_custkey % 11 = 0 then 6 else 7 end as cells, case c_custkey % 3 when 0 then 'print_duplicate_number' when 1 then 'print_missing_number' else 'typo' end as kind,
        case when c_nationkey = 3 then '' else c_name end as evidence, case when c_nationkey = 4 then null else c_mktsegment end as source from customer)
    select c_custkey, case when cells < 7 then 'too few columns' when kind = 'typo' then 'unknown kind' when evidence = '' then 'no evidence' when source is null then 'no source' end as reason from c""")
def errata_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "if(c_custkey % 11 = 0, 6, 7) as cells", "case c_custkey % 3 when 0 then 'print_duplicate_number' when 1 then 'print_missing_number' else 'typo' end as kind", "if(c_nationkey = 3, '', c_name) as evidence", "if(c_nationkey = 4, null, c_mktsegment) as source")
    return quality.validate_errata(rows).select("c_custkey", "reason")


@query("""
    select o_orderpriority, count(*) filter (o_orderkey % 100 = 0) as only_a, count(*) filter (o_orderkey % 100 = 0 and o_orderkey % 200 <> 0) as only_b, count(*) filter (o_orderkey % 100 = 0) = 0 as equal from orders group by 1""")
def products_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy in which some are changed and some are gone."""
    a = table(spark, sf_dir, "orders")
    b = a.where("o_orderkey % 200 <> 0").withColumn("o_custkey", F.expr("if(o_orderkey % 100 = 0, -1, o_custkey)"))
    return quality.products_equal(a, b, ["o_orderpriority"])


_LEDGER = """
    w as (select '甲' || chr(19968 + cast(c_custkey % 300 as int)) || '丙' as a, '甲' || chr(19968 + cast((c_custkey * 7 + c_nationkey) % 600 as int)) || '丙' as b from customer where c_nationkey % 2 = 0 and c_custkey % 10 <> 0),
    p as (select distinct substr(a, 2, 1) as x, substr(b, 2, 1) as y from w where a <> b)"""


def char(e: str) -> str:
    """SQL for the character of a code point from 2048 to 65535, by its UTF-8."""
    return f"decode(unhex(hex(bigint(14680064 + shiftright(({e}), 12) * 65536 + 32768 + (shiftright(({e}), 6) & 63) * 256 + 128 + (({e}) & 63)))), 'UTF-8')"


def _ledger_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = table(spark, sf_dir, "customer").selectExpr("'name' as kind", "if(c_nationkey % 2 = 0, 'closed', 'OPEN: ask') as status", f"concat('A=甲', {char('19968 + cast(c_custkey % 300 as int)')}, '丙（x）') as witness_a", f"if(c_custkey % 10 = 0, 'n/a', concat('甲 ', {char('19968 + cast((c_custkey * 7 + c_nationkey) % 600 as int)')}, '丙')) as witness_b")
    return index.ledger_pairs(ledger, ["witness_a", "witness_b"])


@query(f"with {_LEDGER} select x, y from p")
def ledger_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger_pairs(spark, sf_dir)


@query(f"""with recursive {_LEDGER}, e as (select x as a, y as b from p union select y, x from p), r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
    c as (select a, least(a, min(b)) as family from r group by a) select family, string_agg(a, '' order by a) as members from c group by family""")
def ledger_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.families(_ledger_pairs(spark, sf_dir)).withColumn("members", F.array_join("members", ""))


# Vectors


@query("select label, count(*) as n, count(distinct vec_id) as ids, round(min(sqrt(list_inner_product(embedding::double[], embedding::double[]))), 4) as shortest, round(max(sqrt(list_inner_product(embedding::double[], embedding::double[]))), 4) as longest, count(*) = count(distinct vec_id) as ids_unique, abs(round(max(sqrt(list_inner_product(embedding::double[], embedding::double[]))), 4) - 1) < 2e-3 as unit_norm from embeddings group by label")
def vector_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = table(spark, sf_dir, "embeddings").withColumn("vec", vectors.l2_normalize(F.transform("embedding", lambda x: x * 3)))
    return vectors.vector_report(scaled, ["label"], "vec_id")


@query("""
    with s as (select q.vec_id as query_id, e.vec_id as id, list_inner_product(q.embedding::double[], e.embedding::double[]) as s from embeddings q join embeddings e on q.vec_id % 100 = 0),
    r as (select *, row_number() over (partition by query_id order by s desc, id) as k from s) select query_id, cast(k as int) as rank, id, round(s, 5) as score from r where k <= 10""")
def dot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 100, among all."""
    e = table(spark, sf_dir, "embeddings")
    hits = vectors.dot_topk(e.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding as qvec"), e.selectExpr("vec_id as id", "embedding as vec"), 10)
    return hits.select("query_id", "rank", "id", F.round("score", 5).alias("score"))


# Retrieval: benchmark passages over conversations and documents


def _norm(c: str) -> str:
    return f"regexp_replace({c}, '{WS}+', '', 'g')"


_GRAMS = "case when length({0}) < 2 then [{0}] else list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) end"
_LEX = f"""
    q as (select item_id as query_id, {_norm("text")} as nq from benchmark),
    bl as (select conv_id as record_id, turn as block_id, {_norm("text")} as nt from conversations),
    qg as (select query_id, nq, {_GRAMS.format("nq")} as g from q), bg as (select record_id, block_id, nt, unnest({_GRAMS.format("nt")}) as gram from bl),
    sh as (select a.query_id, b.record_id, b.block_id, count(*) as c, any_value(contains(b.nt, a.nq)) as whole, any_value(a.n) as n from (select query_id, nq, len(g) as n, unnest(g) as gram from qg) a join bg b using (gram) group by 1, 2, 3),
    lex as (select query_id, record_id, max(c / cast(n as double) + case when whole then 1 else 0 end) as score, min(block_id) as tie from sh group by 1, 2)"""


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), T.norm("text").alias("q"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr("conv_id as record_id", "turn as block_id", "text")


@query(f"with {_LEX} select query_id, record_id, round(score, 9) as score, tie from lex")
def lexical_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.lexical_layer(_queries(spark, sf_dir), _turns(spark, sf_dir)).withColumn("score", F.round("score", 9))


_SEARCH = f"""{_LEX},
    ks as (select conv_id as record_id, conv_id as ord, {_norm("text")} as key from conversations where turn = 0),
    ex as (select query_id, record_id, 1.0 as score, min(ord) as tie from q join ks on ks.key = q.nq group by 1, 2),
    rk as (select query_id, record_id, 0 as layer, row_number() over (partition by query_id order by score desc, tie, record_id) as rank from ex
        union all select query_id, record_id, 1, row_number() over (partition by query_id order by score desc, tie, record_id) from lex),
    fu as (select query_id, record_id, coalesce(max(1.0::double / (60 + rank)) filter (layer = 0), 0) + coalesce(max(1.0::double / (60 + rank)) filter (layer = 1), 0) as score, min(layer * 1000000000 + rank) as first from rk group by 1, 2),
    pi as (select fu.*, ex.tie as pin from fu left join ex using (query_id, record_id)),
    hits as (select query_id, record_id, score, pin is not null as pinned, row_number() over (partition by query_id order by pin is null, pin, score desc, first, record_id) as rank from pi)"""


def _hits(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    keys = table(spark, sf_dir, "conversations").where("turn = 0").select(T.norm("text").alias("key"), F.col("conv_id").alias("record_id"), F.col("conv_id").alias("ord"))
    return search.search(_queries(spark, sf_dir), _turns(spark, sf_dir), keys, k=k)


@query(f"with {_SEARCH} select query_id, record_id, cast(rank as int) as rank, round(score, 9) as score, pinned from hits where rank <= 5")
def search_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword search without vectors: exact first turns and shared bigrams."""
    return _hits(spark, sf_dir, 5).select("query_id", "record_id", "rank", F.round("score", 9).alias("score"), "pinned")


@query(f"""with {_SEARCH}, sc as (select query_id, record_id, (record_id * 7 + query_id) % 101 as s from hits where rank <= 20 and record_id % 3 <> 0),
    re as (select h.query_id, h.record_id, row_number() over (partition by h.query_id order by h.pinned desc, case when h.pinned then h.rank end, sc.s desc nulls last, h.rank) as rank, h.rank as old_rank from hits h left join sc using (query_id, record_id) where h.rank <= 20)
    select query_id, record_id, cast(rank as int) as rank, cast(old_rank as int) as old_rank from re""")
def reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty hits reordered by a table of scores that lacks some of them."""
    return _reranked(_hits(spark, sf_dir, 20))


def _reranked(found: DataFrame) -> DataFrame:
    hits = materialize(found, "hits")
    scores = hits.where("record_id % 3 <> 0").selectExpr("query_id", "record_id", "cast((record_id * 7 + query_id) % 101 as double) as rerank")
    return search.apply_rerank(hits, scores).select("query_id", "record_id", "rank", "old_rank")


_HYBRID = f"""{_SEARCH.split(", rk as" if ", rk as" in _SEARCH else "rk as")[0].rstrip().rstrip(",")},
    vh as (select query_id, record_id, score, row_number() over (partition by query_id order by score desc, record_id) as rank from (
        select q.query_id, v.vec_id as record_id, list_dot_product(cast(e.embedding as double[]), cast(v.embedding as double[])) as score
        from q join embeddings e on e.vec_id = q.query_id cross join (select * from embeddings where vec_id in (select conv_id from conversations)) v)),
    rk as (select query_id, record_id, 0 as layer, row_number() over (partition by query_id order by score desc, tie, record_id) as rank from ex
        union all select query_id, record_id, 1, row_number() over (partition by query_id order by score desc, tie, record_id) from lex
        union all select query_id, record_id, 2, row_number() over (partition by query_id order by score desc, record_id) from vh),
    fu as (select query_id, record_id, coalesce(max(1.0::double / (60 + rank)) filter (layer = 0), 0) + coalesce(max(1.0::double / (60 + rank)) filter (layer = 1), 0) + coalesce(max(1.0::double / (60 + rank)) filter (layer = 2), 0) as score,
        min(layer * 1000000000 + rank) as first, bool_or(layer = 2) as by_vector from rk group by 1, 2),
    pi as (select fu.*, ex.tie as pin from fu left join ex using (query_id, record_id)),
    hits as (select query_id, record_id, score, by_vector, row_number() over (partition by query_id order by pin is null, pin, score desc, first, record_id) as rank from pi)"""


@query(f"with {_HYBRID} select query_id, record_id, cast(rank as int) as rank, round(score, 9) as score, by_vector from hits where rank <= 5")
def search_three_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact first turns, shared bigrams and all cards by their dot products; the vector of a passage or conversation is that of its number."""
    return _three_layers(spark, sf_dir).select("query_id", "record_id", "rank", F.round("score", 9).alias("score"), F.col("layers")["vector"].alias("by_vector"))


def _three_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, turns, e = _queries(spark, sf_dir), _turns(spark, sf_dir), table(spark, sf_dir, "embeddings")
    keys = table(spark, sf_dir, "conversations").where("turn = 0").select(T.norm("text").alias("key"), F.col("conv_id").alias("record_id"), F.col("conv_id").alias("ord"))
    cards = e.selectExpr("vec_id as record_id", "vec_id as ord", "embedding as vec").join(turns.select("record_id"), "record_id", "left_semi")
    near = search.VectorLayer(asked.select("query_id").join(e.selectExpr("vec_id as query_id", "embedding as qvec"), "query_id"), cards)
    return search.search(asked, turns, keys, near, k=5)


# Names that the queries with whole passages had first

@query(f"with {_LEX} select query_id, record_id, round(score, 9) as score, tie from lex")
def lexical_layer_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.lexical_layer(_queries(spark, sf_dir), _turns(spark, sf_dir)).withColumn("score", F.round("score", 9))


@query(f"with {_SEARCH} select query_id, record_id, cast(rank as int) as rank, round(score, 9) as score, pinned from hits where rank <= 5")
def search_conversations_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword search without vectors: first turns equal to the whole passage, and shared bigrams."""
    return _hits(spark, sf_dir, 5).select("query_id", "record_id", "rank", F.round("score", 9).alias("score"), "pinned")


@query(f"""with {_SEARCH}, sc as (select query_id, record_id, (record_id * 7 + query_id) % 101 as s from hits where rank <= 20 and record_id % 3 <> 0),
    re as (select h.query_id, h.record_id, row_number() over (partition by h.query_id order by h.pinned desc, case when h.pinned then h.rank end, sc.s desc nulls last, h.rank) as rank, h.rank as old_rank from hits h left join sc using (query_id, record_id) where h.rank <= 20)
    select query_id, record_id, cast(rank as int) as rank, cast(old_rank as int) as old_rank from re""")
def reranked_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty hits of the whole passages reordered by a table of scores that lacks some of them."""
    return _reranked(_hits(spark, sf_dir, 20))


# The flagship: passages over lines of documents

_FLAG = f"""
    q as (select item_id as query_id, {_norm("text")} as nq from benchmark),
    ln as (select doc_id as record_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as block_id from documents),
    bl as (select record_id, block_id, {_norm("raw")} as nt from ln where {_norm("raw")} <> ''),
    qg as (select query_id, nq, {_GRAMS.format("nq")} as g from q), bg as (select record_id, block_id, nt, unnest({_GRAMS.format("nt")}) as gram from bl),
    sh as (select a.query_id, b.record_id, b.block_id, count(*) as c, any_value(contains(b.nt, a.nq)) as whole, any_value(a.n) as n from (select query_id, nq, len(g) as n, unnest(g) as gram from qg) a join bg b using (gram) group by 1, 2, 3),
    lex as (select query_id, record_id, max(c / cast(n as double) + case when whole then 1 else 0 end) as score, min(block_id) as tie from sh group by 1, 2),
    rk as (select query_id, record_id, score, row_number() over (partition by query_id order by score desc, tie, record_id) as rank from lex)"""


@query(f"with {_FLAG} select query_id, record_id, cast(rank as int) as rank, round(1.0::double / (60 + rank), 9) as score from rk where rank <= 5")
def search_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five documents that share most with each benchmark passage, by their best line."""
    return _flag_hits(spark, sf_dir, T.norm("text"))


@query(f"with {_FLAG} select query_id, record_id, cast(rank as int) as rank, round(1.0::double / (60 + rank), 9) as score from rk where rank <= 5")
def search_benchmark_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a written index of the lines' bigrams: no text is read for a batch of passages, nor a list that cannot matter."""
    path = new_path(spark, "grams")
    gram_index.write_index(_document_lines(spark, sf_dir), path)
    hits = search.fuse({"lex": search.IndexLayer(path, _queries(spark, sf_dir))}, 5)
    return hits.select("query_id", "record_id", "rank", F.round("score", 9).alias("score"))


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.to_lines(table(spark, sf_dir, "documents").selectExpr("0 as book", "doc_id as page", "text")).selectExpr("page as record_id", "line as block_id", "st as text")


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and the documents that hold all of them: with a whole document as one block, these score above 1."""
    whole = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.lit(0).alias("block_id"), "text")
    return search.lexical_layer(_queries(spark, sf_dir), whole).where("score > 1").select("query_id", "record_id")


def _flag_hits(spark: SparkSession, sf_dir: str, q: Column, across: bool = False) -> DataFrame:
    blocks = _document_lines(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), q.alias("q"))
    lex = search.lexical_layer(asked, blocks)
    if across:  # a line that holds the passage has 2 already, any other line 1 at most
        lex = lex.join(_held(spark, sf_dir).withColumn("whole", F.lit(1.0)), ["query_id", "record_id"], "left").withColumn("score", F.least("score", F.lit(1.0)) + F.coalesce("whole", F.lit(0.0))).drop("whole")
    return search.fuse({"lex": search.TableLayer(lex)}, 5).select("query_id", "record_id", "rank", F.round("score", 9).alias("score"))


_WHOLE_FLAG = f"""
    q as (select item_id as query_id, {_norm("text")} as nq from benchmark),
    ln as (select doc_id as record_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as block_id from documents),
    bl as (select record_id, block_id, {_norm("raw")} as nt from ln where {_norm("raw")} <> ''),
    qg as (select query_id, nq, {_GRAMS.format("nq")} as g from q), bg as (select record_id, block_id, unnest({_GRAMS.format("nt")}) as gram from bl),
    sh as (select a.query_id, b.record_id, b.block_id, count(*) as c, any_value(a.n) as n from (select query_id, len(g) as n, unnest(g) as gram from qg) a join bg b using (gram) group by 1, 2, 3),
    wh as (select distinct query_id, doc_id as record_id, true as held from q join (select doc_id, {_norm("text")} as nd from documents) d on contains(d.nd, q.nq)),
    be as (select query_id, record_id, max(c / cast(n as double)) as best, min(block_id) as tie from sh group by 1, 2),
    lex as (select query_id, record_id, best + case when held then 1 else 0 end as score, tie from be left join wh using (query_id, record_id)),
    rk as (select query_id, record_id, row_number() over (partition by query_id order by score desc, tie, record_id) as rank from lex)"""


@query(f"with {_WHOLE_FLAG} select query_id, record_id, cast(rank as int) as rank, round(1.0::double / (60 + rank), 9) as score from rk where rank <= 5")
def search_benchmark_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five documents that share most with each whole benchmark passage, by their best line; those that hold all of it, across lines too, first."""
    return _flag_hits(spark, sf_dir, T.norm("text"), across=True)


# Retrieval judged by what the tables say is right


_WANTED = f"select item_id as query_id, min(doc_id) as want from benchmark join documents on contains({_norm("documents.text")}, {_norm("benchmark.text")}) group by 1"


@query(f"""
    with l as (with {_FLAG} select query_id, record_id, rank from rk where rank <= 5), w as (with {_WHOLE_FLAG} select query_id, record_id, rank from rk where rank <= 5),
    c as (select * from ({_WANTED}) cross join (values ('line'), ('whole')) m(mode)),
    r as (select c.query_id % 5 as book, mode, case mode when 'line' then l.rank else w.rank end as rank from c left join l on l.query_id = c.query_id and l.record_id = want left join w on w.query_id = c.query_id and w.record_id = want)
    select book, mode, cast(count(*) filter (rank <= 1) as bigint) as hits, count(*) as cases, round(count(*) filter (rank <= 1) / count(*), 6) as recall from r group by grouping sets ((book, mode), (mode))""")
def recall_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a passage's first hit is the first document that holds it, by line or by whole text; passages in five groups, and all."""
    wanted = _held(spark, sf_dir).groupBy("query_id").agg(F.min("record_id").alias("want"))
    ranks = [search.rank_of(_flag_hits(spark, sf_dir, T.norm("text"), across), wanted).withColumn("mode", F.lit(mode)) for mode, across in (("line", False), ("whole", True))]
    return evaluate.recall_by_mode(ranks[0].unionByName(ranks[1]).select((F.col("query_id") % 5).alias("book"), "mode", F.col("rank_of_want").alias("rank"), F.lit(1).alias("topn")))


def _first_of_label(spark: SparkSession, sf_dir: str, hits: DataFrame, *ranks: str) -> DataFrame:
    """Per query, the best of each rank among hits whose vector has the label of the query's vector."""
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    rows = hits.join(labels.toDF("query_id", "label"), "query_id").join(labels.toDF("record_id", "label"), ["record_id", "label"])
    return rows.groupBy("query_id").agg(*(F.min(r).alias(r) for r in ranks))


_OF_LABEL = "join embeddings eq on eq.vec_id = h.query_id join embeddings er on er.vec_id = h.record_id and er.label = eq.label group by 1"


@query(f"""
    with v as (with {_HYBRID} select h.query_id, min(rank) as rank from hits h {_OF_LABEL.replace("group", "where rank <= 5 group")}), d as (with {_SEARCH} select h.query_id, min(rank) as rank from hits h {_OF_LABEL.replace("group", "where rank <= 5 group")}),
    known as (select distinct label from embeddings where vec_id in (select conv_id from conversations)),
    c as (select item_id, v.rank as rank_v, d.rank as rank_d, e.vec_id is not null as have, e.vec_id is not null and k.label is null as expect_none, d.rank is null as needs
        from benchmark left join embeddings e on e.vec_id = item_id left join known k on k.label = e.label left join v on v.query_id = item_id left join d on d.query_id = item_id),
    s as (select item_id, case when have then case when (case when expect_none then rank_v is null else coalesce(rank_v <= 3, false) end) then 'PASS' else 'FAIL' end when needs then 'SKIP' else 'untested' end as v_state,
        case when needs then 'not set' when (case when expect_none then rank_d is null else coalesce(rank_d <= 3, false) end) then 'PASS' else 'FAIL' end as d_state from c)
    select item_id, v_state, d_state, case when 'FAIL' in (v_state, d_state) then 'FAIL' when 'SKIP' in (v_state, d_state) then 'SKIP' else 'PASS' end as verdict from s""")
def case_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages are to find a conversation of their own label among three hits, with the vector layer and without.

    A passage that keywords alone do not answer needs vectors; one whose label no conversation has expects none.
    """
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "label")
    known = e.join(_turns(spark, sf_dir).select(F.col("record_id").alias("query_id")), "query_id", "left_semi").select("label", F.lit(True).alias("known")).distinct()
    best = lambda hits, name: _first_of_label(spark, sf_dir, hits, "rank").withColumnRenamed("rank", name)
    cases = _queries(spark, sf_dir).select("query_id").join(e, "query_id", "left").join(known, "label", "left")
    cases = cases.join(best(_three_layers(spark, sf_dir), "rank_v"), "query_id", "left").join(best(_hits(spark, sf_dir, 5), "rank_d"), "query_id", "left")
    cases = cases.selectExpr("query_id as item_id", "rank_v", "rank_d", "3 as topn", "label is not null and known is null as expect_none", "rank_d is null as needs_vectors", "label is not null as have_vectors")
    return evaluate.case_verdict(cases).select("item_id", "v_state", "d_state", "verdict")


@query(f"""
    with re as (with {_SEARCH}, sc as (select query_id, record_id, list_dot_product(cast(a.embedding as double[]), cast(b.embedding as double[])) as s from hits join embeddings a on a.vec_id = query_id join embeddings b on b.vec_id = record_id where rank <= 20)
        select h.query_id, h.record_id, row_number() over (partition by h.query_id order by h.pinned desc, case when h.pinned then h.rank end, sc.s desc nulls last, h.rank) as rank, h.rank as old_rank from hits h left join sc using (query_id, record_id) where h.rank <= 20),
    b as (select h.query_id, min(old_rank) as off, min(rank) as new from re h {_OF_LABEL}),
    r as (select coalesce(off <= 4, false) as a, coalesce(new <= 4, false) as b from benchmark left join b on b.query_id = item_id)
    select count(*) as cases, count(*) filter (a) as ok_off, count(*) filter (b) as ok_on, count(*) filter (a and not b) as regressions, count(*) filter (b and not a) as improvements, count(*) filter (a and not b) = 0 as passes from r""")
def rerank_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword hits before and after reranking by vectors: how often a conversation of the passage's label is among the first four."""
    hits, e = materialize(_hits(spark, sf_dir, 20), "hits"), table(spark, sf_dir, "embeddings")
    pairs = hits.select("query_id", "record_id").join(e.selectExpr("vec_id as query_id", "embedding as qvec"), "query_id").join(e.selectExpr("vec_id as record_id", "embedding as vec"), "record_id")
    scores = pairs.select("query_id", "record_id", F.expr("aggregate(zip_with(qvec, vec, (a, b) -> double(a) * double(b)), 0D, (x, y) -> x + y)").alias("rerank"))
    best = _first_of_label(spark, sf_dir, search.apply_rerank(hits, scores), "old_rank", "rank")
    return evaluate.rerank_ab(_queries(spark, sf_dir).select("query_id").join(best, "query_id", "left").selectExpr("query_id as case_id", "cast(null as int) as topn", "old_rank as rank_off", "rank as rank_on"))


# Scans and manifests


def _audit_sql(label: str, pattern: str, lead: str = "") -> str:
    """The line of a pattern's first match; a ``lead`` before it may be the end of the line before."""
    head, skipped = f"string_split_regex(text, '{lead}{pattern}')[1]", f"regexp_extract(text, '({lead}){pattern}', 1)"
    ends = lambda x: f"length({x}) - length(replace({x}, chr(10), ''))"
    return f"select doc_id as path, '{label}' as label, {ends(head)} + {ends(skipped)} + 1 as line from documents where regexp_matches(text, '{lead}{pattern}')"


_W = r"\p{L}\p{N}_"
_AUDIT = " union all ".join((
    _audit_sql("drive path", r"[A-Za-z]:[\\/]", "(?:^|[^A-Za-z0-9:/])"),
    _audit_sql("temp root", r"(?i)[A-Za-z]:\\[^\x22\x27\n]*system-temp"),
    _audit_sql("e-mail", rf"(?i)[.+\-]*[{_W}][{_W}.+\-]*@[{_W}\-]+\.[a-z]{{2,}}(?:[^{_W}]|$)"),
    _audit_sql("token", rf"(?:sk-[A-Za-z0-9]{{16,}}|gh[pous]_[A-Za-z0-9]{{20,}})(?:[^{_W}]|$)", f"(?:^|[^{_W}])"),
))


@query(f"with h as ({_AUDIT}) select d.doc_id as path, case when count(h.label) > 0 then 'FAIL' else 'PASS' end as verdict, coalesce(string_agg(h.label || '@L' || cast(h.line as varchar), '; ' order by h.label), '') as labels from documents d left join h on h.path = d.doc_id group by 1")
def privacy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id as path", "text")
    exempt = spark.createDataFrame([], "path long, reason string")
    return audit.audit_verdict(docs, audit.apply_exemptions(audit.scan_patterns(docs), exempt))


@query("""
    with l(literal_id, literal) as (values (1, 'Apache'), (2, 'password'), (3, '###'), (4, 'http'))
    select doc_id as path, cast(literal_id as int) as literal_id, length(substr(text, 1, strpos(text, literal) - 1)) - length(replace(substr(text, 1, strpos(text, literal) - 1), chr(10), '')) + 1 as line from documents join l on contains(text, literal)""")
def forbidden_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(1, "Apache"), (2, "password"), (3, "###"), (4, "http")], "literal_id int, literal string")
    return audit.scan_literals(table(spark, sf_dir, "documents").selectExpr("doc_id as path", "text"), rules).withColumn("line", F.col("line").cast("long"))


@query(r"""select page_id, regexp_matches(html, '(^|[^A-Za-z0-9:/])[A-Za-z]:[\\/]') as drive_path, contains(html, 'example.com') or contains(html, 'href') as banned, contains(html, '<footer') as watermark from pages""")
def portable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.portable_scan(table(spark, sf_dir, "pages").selectExpr("page_id", "html as text"), ["example.com", "href"], ["<footer"]).drop("text")


_FILES = """select case page_id % 6 when 0 then 'scripts/' when 1 then 'references/' when 2 then 'examples/a/' when 3 then 'out/' when 4 then 'x/__pycache__/' else 'kb/' end || cast(page_id as varchar)
    || case when page_id % 10 = 7 then '.pyc' else '.html' end as path, cast(octet_length(encode(html)) as bigint) as bytes, sha256(html) as sha256 from pages"""
_CLASS = f"""f as ({_FILES}), c as (select *, case when path like 'x/__pycache__/%' or path like '%.pyc' then 'byte code' when path like 'out/%' then 'run products' end as reason,
    case when starts_with(path, 'scripts/') then '00-engine' when starts_with(path, 'references/') then '10-references' when starts_with(path, 'examples/') then '20-examples' else '90-other' end as layer from f)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = "element_at(array('scripts/', 'references/', 'examples/a/', 'out/', 'x/__pycache__/', 'kb/'), int(page_id % 6) + 1)"
    rows = table(spark, sf_dir, "pages").selectExpr(f"concat({place}, page_id, if(page_id % 10 = 7, '.pyc', '.html')) as path", "cast(octet_length(html) as bigint) as bytes", "sha2(html, 256) as sha256")
    return audit.assign_layer(audit.classify_files(rows))


@query(f"with {_CLASS} select path, layer, bytes, sha256 from c where reason is null")
def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.manifest(_files(spark, sf_dir).where("reason is null"))


@query(f"with {_CLASS} select layer, count(*) as files, cast(sum(bytes) as bigint) as bytes from c where reason is null group by 1")
def layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.layer_summary(_files(spark, sf_dir).where("reason is null"))


@query(f"with {_CLASS} select reason, count(*) as files, array_to_string(list_slice(list(path order by path), 1, 3), ',') as examples from c where reason is not null group by 1")
def excluded_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.excluded_summary(_files(spark, sf_dir)).withColumn("examples", F.array_join("examples", ","))


@query(f"with f as ({_FILES}) select path, case when bytes % 17 = 0 then 'missing' when bytes % 13 = 0 then 'extra' when bytes % 11 = 0 then 'bad' else 'ok' end as state from f")
def verify_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files against a manifest: some are gone, some were never listed, some have changed."""
    rows = _files(spark, sf_dir)
    recorded = rows.where("not (bytes % 13 = 0 and bytes % 17 <> 0)").withColumn("sha256", F.expr("if(bytes % 11 = 0, reverse(sha256), sha256)"))
    return audit.verify_manifest(rows.where("bytes % 17 <> 0"), recorded)
