"""Queries over transcripts that use every tolerated variant, made from the order table, beside SQL for what assembly must give.

A customer is a book, a year a chapter, an order a record on two pages.  Which variants a record shows follows from its
order key: sub-chapters (5), printed duplicates (7), a heading of no kind before the start (9), a page that goes on (2) or
bears no mark, a step mark without text (6), an unmarked section name (8), a first record without a mark (3), an ended
sentence at the page's end (4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.jobs.queries import query, shared, table
from leafpress.operators import assemble as A
from leafpress.operators import audit, lines, quality, vectors
from leafpress.operators.contract import Contract

#: An order a row, with its variants; runs in Spark and, as ``_duck`` writes it, in DuckDB.
_ORDERS = """
    o0 as (select concat('V', cast(o_custkey as string)) as book, o_orderkey as okey, cast(o_orderkey as string) as k, year(o_orderdate) as yr,
        row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey) as num,
        row_number() over (partition by o_custkey order by year(o_orderdate), o_orderkey) as seq,
        dense_rank() over (partition by o_custkey order by year(o_orderdate)) as chap from orders),
    o1 as (select *, seq = 1 and okey % 3 = 0 as unmarked, okey % 5 = 0 and not (seq = 1 and okey % 3 = 0) as sub from o0),
    o as (select *, okey % 9 = 0 and not sub as odd, case when okey % 7 = 0 and num > 1 and not sub then num - 1 else num end as printed from o1)"""
_PAGES = f"""
    with {_ORDERS},
    t as (
        select book, 2 * seq as page, 0 as nth, concat('@@SECTION 一、', cast(yr as string)) as line from o where num = 1
        union all select book, 2 * seq, 1, concat('@@SECTION 甲', cast(okey % 10000 as string), '类') from o where sub
        union all select book, 2 * seq, 2, concat('@@SECTION 杂', k) from o where odd
        union all select book, 2 * seq, 3, concat(case when unmarked then '' else '@@RECIPE_START ' end, '（', cast(printed as string), '）名', k) from o
        union all select book, 2 * seq, 4, concat('〔调料〕盐', k) from o
        union all select book, 2 * seq, 5, concat('主料：米', k) from o
        union all select book, 2 * seq, 6, case when okey % 8 = 1 then '制 法' else '@@SECTION 〔制法〕' end from o
        union all select book, 2 * seq, 7, concat('1. 煮', k) from o
        union all select book, 2 * seq, 8, '@@STEP 3' from o where okey % 6 = 0
        union all select book, 2 * seq, 9, '12' from o where okey % 6 = 0
        union all select book, 2 * seq, 10, concat('@@STEP 炒', k, case when okey % 4 = 1 then '。' else '' end) from o
        union all select book, 2 * seq + 1, 0, '@@RECIPE_CONT' from o where okey % 2 = 0
        union all select book, 2 * seq + 1, 1, concat('续', k, '。') from o
        union all select book, 2 * seq + 1, 2, '@@SECTION 〔注释〕' from o where okey % 2 = 0
        union all select book, 2 * seq + 1, 3, concat('①词', k, '：义') from o where okey % 2 = 0
        union all select book, 0, seq, concat('名', k, '……', cast(seq % 900 + 1 as string)) from o
    )
    select book, cast(page as int) as page, cast(nth as int) as at_line, line from t"""
_MARKED = _ORDERS.replace(" as string)", " as varchar)")
#: What the records and blocks must be, in DuckDB.
_WANTED = f"""{_MARKED},
    sc as (select *, sum(case when sub then 1 else 0 end) over (partition by book, chap order by seq) as snum from o),
    si as (select *, concat('C', lpad(cast(chap as varchar), 2, '0'), case when snum > 0 then concat('-S', lpad(cast(snum as varchar), 2, '0')) else '' end) as scope_id,
        coalesce(last_value(case when sub then concat('甲', cast(okey % 10000 as varchar), '类') end ignore nulls) over (partition by book, chap order by seq), '') as sub_chapter from sc),
    r as (select *, row_number() over (partition by book, scope_id, printed order by seq) as occurrence, concat(book, '-', scope_id, '-R', lpad(cast(printed as varchar), 3, '0')) as base_id from si),
    p as (select book, seq, 1 as n, 'seasoning' as type, 'seasoning' as "group", '盐' || k as text from o
        union all select book, seq, 2, 'ingredient', 'main', '米' || k from o
        union all select book, seq, 3, 'step', 'step1', '煮' || k from o
        union all select book, seq, 4, 'step', 'step2', '12' from o where okey % 6 = 0
        union all select book, seq, 5, 'step', case when okey % 6 = 0 then 'step3' else 'step2' end, '炒' || k || case when okey % 4 = 1 then '。' else '续' || k || '。' end from o
        union all select book, seq, 6, 'step', 'step3', '续' || k || '。' from o where okey % 4 = 1
        union all select book, seq, 7, 'note', 'note', '①词' || k || '：义' from o where okey % 2 = 0),
    b as (select *, row_number() over (partition by book order by seq, n) as block from p)"""
_ERRATA = """
    e as (select case when c_custkey % 3 > 0 then 'V' || cast(c_custkey as varchar) else '*' end as book, 'C0' || cast(c_custkey % 7 + 1 as varchar) || case when c_nationkey % 2 = 0 then '-S01' else '' end as scope_id,
        c_nationkey % 4 + 1 as v from customer),
    d as (select r.*, exists (select 1 from e where e.book in ('*', r.book) and e.scope_id = r.scope_id and e.v = r.printed) as listed from r)"""


def variant_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book, page, text) of all orders: the lines of ``_PAGES``, but made page by page from orders, not moved one by one."""
    orders = table(spark, sf_dir, "orders").selectExpr("concat('V', cast(o_custkey as string)) as book", "o_orderkey as okey", "cast(o_orderkey as string) as k", "year(o_orderdate) as yr")
    o = orders.selectExpr("*", "row_number() over (partition by book, yr order by okey) as num", "row_number() over (partition by book order by yr, okey) as seq")
    o = o.selectExpr("*", "seq = 1 and okey % 3 = 0 as unmarked", "okey % 5 = 0 and not (seq = 1 and okey % 3 = 0) as sub")
    o = o.selectExpr("*", "okey % 9 = 0 and not sub as odd", "case when okey % 7 = 0 and num > 1 and not sub then num - 1 else num end as printed")
    first = """array_join(array(
        if(num = 1, concat('@@SECTION 一、', cast(yr as string)), null), if(sub, concat('@@SECTION 甲', cast(okey % 10000 as string), '类'), null), if(odd, concat('@@SECTION 杂', k), null),
        concat(case when unmarked then '' else '@@RECIPE_START ' end, '（', cast(printed as string), '）名', k), concat('〔调料〕盐', k), concat('主料：米', k),
        case when okey % 8 = 1 then '制 法' else '@@SECTION 〔制法〕' end, concat('1. 煮', k), if(okey % 6 = 0, '@@STEP 3', null), if(okey % 6 = 0, '12', null),
        concat('@@STEP 炒', k, case when okey % 4 = 1 then '。' else '' end)), '\n')"""
    second = "array_join(array(if(okey % 2 = 0, '@@RECIPE_CONT', null), concat('续', k, '。'), if(okey % 2 = 0, '@@SECTION 〔注释〕', null), if(okey % 2 = 0, concat('①词', k, '：义'), null)), '\n')"
    pages = f"array(struct(0 as page, seq as at, concat('名', k, '……', cast(seq % 900 + 1 as string)) as text), struct(cast(2 * seq as int) as page, seq as at, {first} as text), struct(cast(2 * seq + 1 as int) as page, seq as at, {second} as text))"
    stretches = o.select("book", F.expr(f"inline({pages})"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n")
    return stretches.groupBy("book", "page").agg(text.alias("text"))


def errata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errata made from customers: a third of them for all books."""
    return table(spark, sf_dir, "customer").selectExpr("if(c_custkey % 3 > 0, concat('V', c_custkey), '*') as book", "concat('C0', c_custkey % 7 + 1, if(c_nationkey % 2 = 0, '-S01', ''), ' title') as scope", "'print_duplicate_number' as kind", "cast(c_nationkey % 4 + 1 as string) as value")


def corpus(spark: SparkSession, sf_dir: str, named: bool = False) -> dict[str, DataFrame]:
    """The corpus, with ids told apart where errata name them or not."""
    return shared(spark, sf_dir, f"variants_{named}", ("orders", "customer"), lambda: A.assemble(variant_pages(spark, sf_dir), errata=errata(spark, sf_dir) if named else None))


@query(f"""with {_WANTED}, {_ERRATA}
    select book, concat(base_id, case when occurrence > 1 and listed then chr(cast(96 + occurrence as int)) else '' end) as recipe_id, cast(printed as int) as number, concat('名', k) as name, concat('一、', cast(yr as varchar)) as chapter,
        sub_chapter, scope_id, case when unmarked then 'unmarked' else 'start' end as how, concat('米', k) as ingredients, concat('盐', k) as seasonings from d""")
def variant_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with sub-chapters, unmarked starts, and repeated numbers told apart where an erratum names them."""
    r = corpus(spark, sf_dir, named=True)["recipes"]
    return r.select("book", "recipe_id", "number", "name", "chapter", "sub_chapter", "scope_id", "how", F.array_join("ingredients", "|").alias("ingredients"), F.array_join("seasonings", "|").alias("seasonings"))


@query(f"""with {_WANTED}
    select b.book, concat(base_id, '-¶', lpad(cast(block as varchar), cast(greatest(4, length(cast(block as varchar))) as int), '0')) as bid, type, "group", text from b join r using (book, seq)""")
def variant_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks from inline sections, bare groups, bare and inline steps, step bodies, and pieces joined across pages."""
    return corpus(spark, sf_dir)["blocks"].select("book", "bid", "type", "group", "text")


@query(f"with {_MARKED} select book, cast(2 * seq + 1 as int) as page, '①' as marker, '词' || k as title, '义' as text from o where okey % 2 = 0")
def variant_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir)["glossary"].select("book", "page", "marker", "title", "text")


@query(f"""with {_MARKED},
    c as (select book, unnest(['inline', 'group', 'bare_step', 'inline_step', case when okey % 6 = 0 then 'step_body' end, case when unmarked then 'open_unmarked' else 'open_start' end, case when sub then 'sub_chapter' end,
        case when okey % 8 = 1 then 'spelling_制 法' end, case when okey % 2 = 1 then 'no_marker_page' end, case when okey % 4 <> 1 then 'splice' end, 'toc_line']) as kind from o
        union all select book, 'toc_page' from o group by 1 having count(*) >= 3)
    select book, kind, count(*) as n from c where kind is not null group by 1, 2""")
def variant_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.drift_counts(corpus(spark, sf_dir))


@query(f"with {_WANTED} select r.book, base_id as recipe_id, text from b join r using (book, seq) where n = 4")
def variant_pseudo_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps that are only a number."""
    return quality.pseudo_steps(corpus(spark, sf_dir)["blocks"]).select("book", "recipe_id", "text")


@query(f"""with {_WANTED}, {_ERRATA}
    select book, scope_id, cast(printed as int) as number, base_id as recipe_id, count(*) as n from d group by all having count(*) > 1 and not bool_or(listed)""")
def variant_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed duplicates that no erratum names."""
    return quality.exempt_duplicates(corpus(spark, sf_dir)["heads"], errata(spark, sf_dir)).select("book", "scope_id", "number", "recipe_id", "n")


@query(f"with {_WANTED} select book, base_id as recipe_id, case when bool_or(odd and not unmarked) then 'assembly' else 'transcription' end as cause from r group by 1, 2 having count(*) > 1")
def variant_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids, and whether a heading of no kind before a start on one of their pages explains them."""
    c = corpus(spark, sf_dir)
    return quality.collision_attribution(c["heads"], c["blocks"], c["lines"])


@query(f"""with {_MARKED} select book, cast(2 * seq + 1 as int) as page, okey % 2 = 1 as no_marker, okey % 2 = 0 as continued, false as toc_page from o union all select book, cast(2 * seq as int), false, false, false from o
    union all select book, 0, true, false, count(*) >= 3 from o group by 1""")
def variant_pages_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each page: bears no mark, goes on from the page before, is a table of contents."""
    return lines.page_rows(variant_pages(spark, sf_dir), Contract()).where("exists(rows, x -> x <> '')").select("book", "page", "no_marker", "continued", "toc_page").distinct()


# Reports over the other tables


@query("""
    with i as (select *, vec_id % 10 = label as doubled from embeddings),
    s as (select label, string_agg(concat(chr(0), cast(vec_id as varchar), chr(1), 'vector ', cast(vec_id as varchar)), '' order by vec_id) as body, count(*) as n from i group by 1),
    v as (select label, count(*) + count(*) filter (doubled) as n, count(distinct vec_id) as ids from i where not (label % 4 = 1 and vec_id % 3 = 0) group by 1)
    select s.label, coalesce(v.n = s.n, false) as rows_match, coalesce(v.n = v.ids, false) as ids_unique, s.label % 5 <> 4 and v.n is not null as unit_norm,
        sha256(concat('model', body)) <> sha256(concat('model#x', body)) as model_matters, concat(sha256(concat('model', body)), 'float16') <> concat(sha256(concat('model', body)), 'float32') as dtype_matters
    from s left join v on v.label = s.label""")
def vector_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates over vectors of which some are gone, some come twice and some are not of unit length."""
    e = table(spark, sf_dir, "embeddings")
    inputs = e.selectExpr("label", "vec_id as ord", "cast(vec_id as string) as id", "concat('vector ', vec_id) as text")
    made = [A.signature(inputs, ["label"], "ord", "id", "text", m, d, "slug").select("label", F.col("signature").alias(n)) for m, d, n in (("model", "float16", "signature"), ("model#x", "float16", "other_model"), ("model", "float32", "other_dtype"))]
    there = e.where("not (label % 4 = 1 and vec_id % 3 = 0)").selectExpr("label", "cast(vec_id as string) as id", "embedding", "explode(sequence(1, if(vec_id % 10 = label, 2, 1))) as copy")
    held = there.select("label", "id", F.transform(vectors.l2_normalize("embedding"), lambda x: x * F.expr("if(label % 5 = 4, 2, 1)")).alias("vec"))
    return vectors.vector_gates(held, inputs, made[0].join(made[1], "label").join(made[2], "label"), ["label"])


@query("""
    with p as (select p_brand as book, p_partkey as page, p_type as width, p_size as height, length(p_name) as chars from part),
    a as (select book, count(*) as pages, cast(sum(chars) as bigint) as text_chars from p group by 1),
    m as (select book, width, height from (select book, width, height, row_number() over (partition by book order by count(*) desc, min(page)) as k from p group by 1, 2, 3) where k = 1),
    i as (select p_brand as book, p_partkey as page, n as image, p_size % 4 as px_width, p_partkey % 3 as px_height, p_partkey % 7 as bits, p_type as filter from part, range(2) t(n) where p_partkey % 5 > 0 and p_size > n * 25),
    x as (select book, px_width, px_height from (select book, px_width, px_height, row_number() over (partition by book order by count(*) desc, min((page, image))) as k from i group by 1, 2, 3) where k = 1),
    f as (select book, arg_min(bits, (page, image)) as bits, arg_min(filter, (page, image)) as filter from i group by 1)
    select a.book, pages, text_chars, width, height, px_width, px_height, bits, filter from a join m using (book) left join x using (book) left join f using (book)""")
def book_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as books, parts as pages with up to two images."""
    part = table(spark, sf_dir, "part")
    pages = part.selectExpr("p_brand as book", "p_partkey as page", "p_type as width", "p_size as height", "cast(length(p_name) as long) as text_chars")
    images = part.where("p_partkey % 5 > 0").selectExpr("*", "explode(sequence(0, 1)) as image").where("p_size > image * 25")
    return quality.book_shape(pages, images.selectExpr("p_brand as book", "p_partkey as page", "image", "p_size % 4 as px_width", "p_partkey % 3 as px_height", "p_partkey % 7 as bits", "p_type as filter"))


@query("""
    with s as (select c_custkey, case c_nationkey % 4 when 0 then lower(c_mktsegment) when 1 then lower(c_mktsegment) || '-' || cast(c_custkey as varchar) when 2 then c_mktsegment else lower(c_mktsegment) || '-' end as id,
        case when c_custkey % 5 = 0 then '' else c_name end as title, case when c_custkey % 7 = 0 then null else c_mktsegment end as out_root, c_name as source_root from customer)
    select c_custkey, concat_ws(',', case when coalesce(title, '') = '' then 'title' end, case when coalesce(out_root, '') = '' then 'out_root' end) as missing, regexp_matches(id, '^[a-z0-9]+(-[a-z0-9]+)*$') as id_ok from s""")
def series_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as series: required columns, and the grammar of ids."""
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "case c_nationkey % 4 when 0 then lower(c_mktsegment) when 1 then concat(lower(c_mktsegment), '-', c_custkey) when 2 then c_mktsegment else concat(lower(c_mktsegment), '-') end as id", "if(c_custkey % 5 = 0, '', c_name) as title", "if(c_custkey % 7 = 0, null, c_mktsegment) as out_root", "c_name as source_root")
    return quality.series_check(rows).select("c_custkey", F.array_join("missing", ",").alias("missing"), "id_ok")


_LAYERS = """
    f as (select 'L' || cast(page_id % 3 as varchar) as layer, 'kb/' || cast(page_id as varchar) || '.html' as path, cast(octet_length(encode(html)) as bigint) as bytes, sha256(html) as sha256 from pages),
    p as (select layer, substr(sha256(path), 1, 3) as part, sha256(string_agg(path || chr(9) || cast(bytes as varchar) || chr(9) || sha256, chr(10) order by path)) as digest from f group by 1, 2),
    l as (select layer, sha256(string_agg(part || digest, '' order by part)) as sha256 from p group by 1)"""


def _layer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr("concat('L', page_id % 3) as layer", "concat('kb/', page_id, '.html') as path", "cast(octet_length(html) as bigint) as bytes", "sha2(html, 256) as sha256")


@query(f"with {_LAYERS} select * from l")
def layer_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.layer_digests(_layer_files(spark, sf_dir))


@query("select 'L0' as layer, 'ok' as state where exists (select 1 from pages where page_id % 3 = 0) union all select 'L1', case when exists (select 1 from pages where page_id % 3 = 1 and page_id % 100 = 1) then 'bad' else 'ok' end where exists (select 1 from pages where page_id % 3 = 1) union all select 'L2', 'missing' where exists (select 1 from pages where page_id % 3 = 2)")
def verify_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of layers against files of which some have changed and one layer is gone."""
    rows = _layer_files(spark, sf_dir)
    changed = rows.where("layer <> 'L2'").withColumn("bytes", F.expr("if(layer = 'L1' and cast(regexp_extract(path, '[0-9]+', 0) as long) % 100 = 1, bytes + 1, bytes)"))
    return audit.verify_layers(changed, audit.layer_digests(rows))


@query("""
    with f as (select page_id, octet_length(encode(html)) as n from pages)
    select 'kb/' || cast(page_id as varchar) as path, cast(case when page_id % 6 = 0 then n + 1 else n end as bigint) as recorded, cast(case when page_id % 5 > 0 then n end as bigint) as actual, case when page_id % 5 > 0 then page_id % 6 <> 0 end as passes from f""")
def size_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded sizes against files; a file that is gone cannot be decided."""
    rows = table(spark, sf_dir, "pages").selectExpr("concat('kb/', page_id) as path", "cast(octet_length(html) as long) as bytes", "page_id")
    recorded = rows.selectExpr("path", "if(page_id % 6 = 0, bytes + 1, bytes) as bytes")
    return quality.size_check(recorded, rows.where("page_id % 5 > 0").select("path", "bytes"))
