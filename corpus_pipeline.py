"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, PII, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the shared
folder and reads again for the next one. All but the last return the columns of docs, whatever they are, in their order.

Rows: documents with null or letterless texts are rejected by the first stage; a null id has no group and stays; rows that repeat an id are told
apart by their texts, and of rows with the same id and text one stays; empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import decontaminate, language_id, ngram_join, packing, pii
from changelake.llm.scratch import Scratch, among

#: A document whose language is less certain than this is rejected; and one whose best language saves fewer bits a byte than this against
#: the letters' frequencies alone, since its contexts are then those of no language. (Clean texts save more than 2, odd short ones -1 to -2,
#: texts in unknown languages and junk -4 and less.)
MIN_LANGUAGE_SCORE = 0.5
MIN_SAVED_BITS = -2.5
#: A document of whose words more than this share is benchmark text is dropped; of others, the passages are cut out.
MAX_COVERAGE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; it learns from the labelled ones."""
    model = language_id.train(docs)
    seen = language_id.identify(docs, model, lang_col="__lang", score_col="__score", saved_col="__saved")
    return seen.where(language_id.told("__lang", "__score", "__saved", MIN_LANGUAGE_SCORE, MIN_SAVED_BITS)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Texts of repeated ids get numbers of their own, behind all ids: of a group with another document, that one stays.
    """
    scratch = Scratch(spark, "near-duplicates")
    twice = scratch.table(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    keyed = docs.withColumn("__key", F.col("doc_id").cast("long"))
    if not twice.isEmpty():
        last = max(0, docs.agg(F.max("doc_id")).first()[0])
        again = among(docs, twice, "doc_id").dropDuplicates(["doc_id", "text"]).select(*docs.columns, (F.monotonically_increasing_id() + last + 1).alias("__key"))
        keyed = keyed.join(twice, "doc_id", "left_anti").select(*keyed.columns).unionByName(scratch.table(again, "again"))  # written: the numbers stay
    groups = ngram_join.near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"))
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("__key"))
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages, and without documents that are mostly such."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=MAX_COVERAGE)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences, as op10 returns them."""
    out = packing.pack(packing.pieces(docs, packing.vocabulary()), Scratch(spark, "packing"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL can't express the language model: the whole pipeline is tested against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        docs = done if i == len(STAGES) - 1 else scratch.table(done, name)
    return docs
