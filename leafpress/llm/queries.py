"""The registered queries of this subpackage, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.llm import ann, langid, lexical, licenses, minhash, mixing, packing, pii, repair, repetition, simhash, token_files, warc
from leafpress.llm.oracles import REPAIR
from leafpress.storage import materialize, new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per confirmed license of a block of any document.  Null or empty text, or no rows: no rows; repeated rows are scanned alike."""
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per token piece with its place in a sequence of 1024.  Null or empty text: its end id alone; repeated rows are packed as rows."""
    pieces = materialize(packing.token_pieces(_table(spark, sf_dir, "documents")), "pieces")
    return packing.pack(packing.with_crc(pieces), written=pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its group: three-word shingles, similarity 0.85.  Without words: linked with nothing and kept."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words_in=3, percent=85)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with counts, a digest of the base spans and all spans.  Null text: no spans."""
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(pii, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("pii", base_only=True), 256).alias("base_sha256"), pii.spans_text("pii").alias("spans"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per page, read back from the archives.  Null html: an empty payload."""
    return warc.archive_and_read(_table(spark, sf_dir, "pages"), least_bytes=0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its readings and verdicts.  Null text: no words, so it fails."""
    return repetition.quality_rules(_table(spark, sf_dir, "documents"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.expr(f"coalesce(crc32(cast(cast({id_col} as string) as binary)) % 4 = 2, false)")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its language.  Null text or text without letters: ``und``, score 0."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = langid.fit(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return langid.identify(rows, models).select("doc_id", "held_out", "lang_pred", "score", "bits_per_char", "rejected")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document, read back from the files.  Null or empty text: its end id alone."""
    path = new_path(spark, "tokens")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path)
    return token_files.token_index(spark, path)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with posteriors, rate and copies.  Null or empty text: no tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = docs.join(_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")
    return mixing.mix(docs, mixing.fit_domains(labelled, mixing.label_domain()))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20.  Unusable vectors take no part."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its fingerprint and group: up to 4 of 64 bits differ.  Without words: fingerprint zero, linked like any other."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item, from an index of all documents.  Null text, or text without terms: no hits."""
    path = new_path(spark, "lexical")
    lexical.write_index(_table(spark, sf_dir, "documents"), path)
    return lexical.search(spark, path, _table(spark, sf_dir, "benchmark"), k=10)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per conversation, damaged and repaired.  No rows left: zeros, no edits and the digest of nothing."""
    rows = _table(spark, sf_dir, "conversations")
    return repair.report(rows, repair.damage(rows))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_best_fit_packing, op3_minhash_near_dedup, op4_pii, op5_warc, op6_quality_rules, op7_language_id, op8_token_files, op9_mixing, op10_nearest_neighbours, op11_simhash_near_dedup, op12_lexical_search, op13_conversation_repair)}


ORACLES = {
    "op12_lexical_search": r"""
        with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents where text is not null),
        q as (select item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) as term from benchmark where text is not null),
        c as (select count(*) as n_docs, sum(len(terms)) as n_terms from d where len(terms) > 0),
        m as (select r, cast(100 - 90 + (90 * len(terms) * n_docs) // n_terms as bigint) as m from d, c where len(terms) > 0),
        t as (select r, term, count(*) as tf from (select r, unnest(terms) as term from d) group by r, term),
        w as (select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) as w from t, c group by term),
        s as (select q.item_id, t.r, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * m.m))) as score from (select distinct item_id, term from q) q join t using (term) join w using (term) join m using (r) group by q.item_id, t.r)
        select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, cast(score as bigint) as score
        from s join d using (r) where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10""",
    "op13_conversation_repair": REPAIR,
    # Every link of the contract over all pairs that share a shingle, then the smallest id that links reach.
    "op3_minhash_near_dedup": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
        ), sets as (
            select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from words
        ), classes as (
            select min(doc_id) as rep, any_value(len(s)) as n, any_value(s) as s from (select doc_id, s, list_sort(s) as k from sets where len(s) > 0) group by k
        ), items as (select rep, n, unnest(s) as x from classes),
        shared as (
            select a.rep as a, b.rep as b, a.n + b.n as total, count(*) as c from items a join items b on a.x = b.x and a.rep < b.rep group by a.rep, b.rep, a.n + b.n
        ), links as (select a, b from shared where 100 * c >= 85 * (total - c) union all select b, a from shared where 100 * c >= 85 * (total - c)),
        reach as (select rep as a, rep as b from classes union select r.a, l.b from reach r join links l on r.b = l.a),
        least as (select a, min(b) as component from reach group by a),
        member as (select s.doc_id, c.rep from (select doc_id, list_sort(s) as k from sets where len(s) > 0) s join (select rep, list_sort(s) as k from classes) c on s.k = c.k)
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(l.component, s.doc_id) as component_id, s.doc_id = coalesce(l.component, s.doc_id) as kept
        from sets s left join member m on m.doc_id = s.doc_id left join least l on l.a = m.rep""",
    "op5_warc": """
        with p as (select page_id, coalesce(html, '') as html from pages),
        d as (select page_id, octet_length(encode(html)) as n, sha1(html) as h, max(page_id) over (partition by html) as top from p)
        select page_id, cast(n as bigint) as payload_bytes,
            array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((cast('0x' || substr(h, 10 * (k // 8) + 1, 10) as bigint) >> cast(35 - 5 * (k % 8) as bigint)) & 31) as bigint), 1)), '') as payload_digest,
            case when page_id < top then 'revisit' else 'response' end as record_type,
            case when page_id < top then top end as refers_to
        from d""",
}
