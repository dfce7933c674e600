"""From raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows it is given, and returns documents with their
columns; the last returns pieces of sequences. run() writes each stage's result as Parquet in the
shared folder and reads it for the next, so a lost executor costs one stage's tasks.

Columns of documents may be null and more columns may be there; they are kept as they are. Names that
begin with `__` are used inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm import decontamination, jaccard, language, packing, pii
from courtflow.llm.common import stored, table, with_keys


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or letters go. A missing lang is filled in."""
    model = language.learned(docs, ~language.held_out())
    found = language.with_language(docs, model, "__lang").where(F.col("__lang") != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "__lang")).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id; equal rows once.

    Five-word shingles, similarity 0.8. Rows without an id or without words stay.
    """
    groups = jaccard.jaccard_groups(docs, 5, 4, 5).where("doc_id is not null")
    gone = groups.where("doc_id <> component_id").select("doc_id", F.col("th").alias("__th")).distinct()
    again = groups.groupBy("doc_id", F.col("th").alias("__th")).count().where("count > 1").select("doc_id", "__th")
    kept = with_keys(docs.withColumn("__th", F.xxhash64("text")), gone, ["doc_id", "__th"], "left_anti")
    if again.limit(1).count():
        once = kept.join(again, ["doc_id", "__th"], "left_semi").dropDuplicates(["doc_id", "__th"])
        kept = kept.join(again, ["doc_id", "__th"], "left_anti").unionByName(once)
    return kept.select(docs.columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = decontamination.matches_by_text(docs, table(spark, sf_dir, "benchmark"))
    # the text alone decides, so a missing id may meet the id 0 of the same text
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id")
    found = stored(found.select(key, F.col("th").alias("__th")).distinct(), "leaks")
    keyed = docs.select("*", key, F.xxhash64("text").alias("__th"))
    return with_keys(keyed, found, ["__id", "__th"], "left_anti").select(docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("language_identification", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("personal_data", hide_personal_data),
    ("packing", pack_sequences),
]
#: Learned languages, retrieval and token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
