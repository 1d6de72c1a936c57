"""From raw documents to packed token sequences, in five stages over the whole corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.llm import langid, minhash, mixing, packing, pii
from leafpress.llm.queries import held_out
from leafpress.storage import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of an Arrow batch; with Spark's own bound, a batch of 10,000 texts takes tens of megabytes in the executor and again in its worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in this session, unless it has a bound of its own."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model accepts go."""
    bound_batches(spark)
    models = langid.fit(docs.where(~held_out()))
    return langid.identify(docs, models).where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each near-duplicate group stays (five words, similarity 0.8); a repeated row stays once.

    Rows with one id and different texts are separate documents of that id: each of these texts stays.
    """
    bound_batches(spark)
    kept = minhash.near_duplicates(docs, words_in=5, percent=80).where("kept").select("doc_id").distinct()
    null_ids = docs.where("doc_id is null")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(null_ids).select(*COLUMNS)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; all documents stay."""
    masked = pii.redact(pii.find_pii(docs.select(*COLUMNS), out="__pii"), spans="__pii").drop("__pii")
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its rate says: none of most toxic ones, several where a domain needs more than it has."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    model = mixing.fit_domains(docs.select("doc_id", "text").join(labels, "doc_id"), mixing.label_domain())
    copies = mixing.mix(docs, model).where("copies > 0").groupBy("doc_id").agg(F.max("copies").alias("copies"))
    chosen = docs.alias("d").join(copies.alias("c"), F.expr("d.doc_id <=> c.doc_id")).withColumn("copy", F.explode(F.expr("sequence(1, c.copies)")))
    return chosen.select(*(f"d.{c}" for c in COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences of 1024."""
    bound_batches(spark)
    pieces = materialize(packing.token_pieces(docs), "pieces")
    return packing.pack(packing.with_crc(pieces), written=pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]
#: Trained models and a tokenizer decide; SQL cannot say that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
