"""Queries for checks that compare a derived table with a stored one, and for totals of evaluations, beside SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.jobs.queries import _AUDIT, _HYBRID, _LEDGER, QUERIES, _ledger_pairs, _three_layers, char, query, table
from leafpress.operators import audit, clustered, evaluate, index, quality, search, vectors

# Families of characters against stored ones

_STORED = "select unnest([chr(19968 + cast(c_custkey % 300 as int)), chr(19968 + cast((c_custkey * 7 + c_nationkey) % 600 as int))]) as c from customer where c_custkey % 3 = 0"


@query(f"with {_LEDGER}, k as ({_STORED}) select x, y from p where x not in (select c from k) or y not in (select c from k)")
def ledger_missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the customers' ledger of which a character stands in no family that a third of the customers store."""
    stored = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").selectExpr(f"array({char('19968 + cast(c_custkey % 300 as int)')}, {char('19968 + cast((c_custkey * 7 + c_nationkey) % 600 as int)')}) as members")
    return index.missing_pairs(_ledger_pairs(spark, sf_dir), stored)


def _families_sql(name: str, pairs: str) -> str:
    return f"""{name}_e as (select x as a, y as b from {pairs} union select y, x from {pairs}), {name}_r as (select a, b from {name}_e union select r.a, e.b from {name}_r r join {name}_e e on r.b = e.a),
    {name}_c as (select a, least(a, min(b)) as family from {name}_r group by a), {name} as (select string_agg(a, '' order by a) as members from {name}_c group by family)"""


@query(f"""with recursive {_LEDGER}, half as (select * from p where unicode(x) % 2 = 0), {_families_sql("derived", "p")}, {_families_sql("stored", "half")}
    select members, 'derived' as side from derived where members not in (select members from stored) union all select members, 'stored' from stored where members not in (select members from derived)""")
def ledger_family_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of the whole ledger against those stored from half of it."""
    pairs = _ledger_pairs(spark, sf_dir)
    stored = index.families(pairs.where("conv(hex(encode(x, 'UTF-16BE')), 16, 10) % 2 = 0"))
    return index.family_drift(index.families(pairs), stored).withColumn("members", F.array_join("members", ""))


@query("select distinct ch as char from (select unnest(string_split(p_name, '')) as ch from part) where ch not in (select unnest(string_split(c_mktsegment, '')) from customer)")
def uncovered_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of part names that no market segment holds."""
    gaps = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", "")).alias("char")).where("char <> ''")
    return index.uncovered_gaps(gaps, table(spark, sf_dir, "customer").selectExpr("c_mktsegment as q"))


# Stored signatures, registered cases, totals


@query("""
    with now as (select label, cast(sum(vec_id) as varchar) as card, cast(count(*) as varchar) as txt from embeddings group by 1),
    r as (select label as book, concat_ws(',', case when label % 4 = 3 or label % 5 = 0 then 'model' end, case when label % 4 = 3 then 'dtype' end, case when label % 4 = 3 or label % 3 = 0 then 'sig_card' end, case when label % 4 = 3 then 'sig_text' end) as reasons, label % 4 <> 3 and label % 2 = 0 as present from now)
    select book, reasons, case when reasons <> '' then 'SKIP' when not present then 'FAIL' else 'PASS' end as status from r""")
def signature_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as books: what differs from the stored report, which lacks some books and some vectors."""
    now = table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("book")).agg(F.sum("vec_id").cast("string").alias("sig_card"), F.count("*").cast("string").alias("sig_text")).selectExpr("book", "'m' as model", "'f' as dtype", "sig_card", "sig_text")
    report = now.where("book % 4 <> 3").selectExpr("book", "if(book % 5 = 0, 'other', model) as model", "dtype", "if(book % 3 = 0, 'x', sig_card) as sig_card", "sig_text", "book % 2 = 0 as present")
    return vectors.signature_status(now, report).withColumn("reasons", F.array_join("reasons", ","))


@query(QUERIES["dot_topk"].sql)
def dot_topk_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector, with clusters of vectors that bound what a query can find in them."""
    e = table(spark, sf_dir, "embeddings")
    held = clustered.cluster(e.selectExpr("vec_id as id", "embedding as vec"))
    hits = clustered.dot_topk(e.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding as qvec"), held, 10)
    return hits.select("query_id", "rank", "id", F.round("score", 5).alias("score"))


@query("select c_nationkey as book, c_name as q, c_custkey as want, cast(case when c_custkey % 3 = 0 then 3 else c_custkey % 5 end as int) as topn, c_custkey % 4 = 1 as expect_none, false as needs_vectors from customer join nation on n_nationkey = c_nationkey where n_regionkey = 1")
def registered_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cases of the books of one region; what they leave out has defaults."""
    cases = table(spark, sf_dir, "customer").selectExpr("c_nationkey as book", "c_name as q", "c_custkey as want", "if(c_custkey % 3 = 0, null, cast(c_custkey % 5 as int)) as topn", "if(c_custkey % 4 = 1, true, null) as expect_none", "cast(null as boolean) as needs_vectors")
    return evaluate.registered_cases(cases, table(spark, sf_dir, "nation").where("n_regionkey = 1").selectExpr("n_nationkey as book"))


@query(f"""with v as ({QUERIES["case_verdicts"].sql}), n as (select count(*) filter (verdict = 'PASS') as passed, count(*) filter (verdict = 'FAIL') as failed, count(*) filter (verdict = 'SKIP') as skipped from v)
    select *, case when failed > 0 then 2 when skipped > 0 then 3 else 0 end as status from n""")
def verdict_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.verdict_counts(QUERIES["case_verdicts"].run(spark, sf_dir))


@query(f"with {_HYBRID} select h.query_id, bool_or(ex.score is not null) as terms, bool_or(lex.score is not null) as lex, bool_or(by_vector) as vector from hits h left join ex using (query_id, record_id) left join lex using (query_id, record_id) where rank <= 5 group by 1")
def layers_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which layers gave each passage's five hits."""
    return search.layers_used(_three_layers(spark, sf_dir)).select("query_id", *(F.col("layers")[n].alias(n) for n in search.LAYERS))


@query(f"""with h as ({_AUDIT}), open as (select * from h join documents d on d.doc_id = h.path where d.doc_id % 10 <> 0)
    select d.doc_id as path, case when count(o.label) > 0 then 'FAIL' else 'PASS' end as verdict, coalesce(string_agg(o.label || '@L' || cast(o.line as varchar), '; ' order by o.label), '') as labels from documents d left join open o on o.path = d.doc_id group by 1""")
def audit_with_exemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The privacy audit with a table of declared documents, a tenth of all."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id as path", "text")
    return audit.audit_verdict(docs, audit.apply_exemptions(audit.scan_patterns(docs), docs.where("path % 10 = 0").selectExpr("path", "'declared' as reason")))


@query("""
    with n as (select l_orderkey, l_linenumber * l_linenumber as v, lag(l_linenumber * l_linenumber, 1, 0) over (partition by l_orderkey order by l_linenumber) as b from (select distinct l_orderkey, l_linenumber from lineitem))
    select l_orderkey, cast(b + 1 as bigint) as first, cast(v - 1 as bigint) as last from n where v - b > 1""")
def order_gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of line numbers leave gaps that grow; a row a gap."""
    return quality.missing_ranges(table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber * l_linenumber as v"), ["l_orderkey"], "v")
