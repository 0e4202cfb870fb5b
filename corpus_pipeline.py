"""Corpus pipeline: toxic documents go, near copies go, repeated passages go, the rest is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``. ``run`` writes each stage's result to the shared folder and
reads it again as the next one's input, so a lost executor repeats one stage at most.
Tables that a stage needs on its way are deleted when it is done. Every stage gives no rows
for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.llm import mil_toxicity
from diamondlake.llm.hyperminhash import near_duplicates, text_key
from diamondlake.llm.level_packing import pack_documents
from diamondlake.llm.queries import TOXIC_FROM, toxicity_model
from diamondlake.llm.suffix_dedup import remove_repeats
from diamondlake.operators.materialize import settled


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the labels' own fold rule holds."""
    return mil_toxicity.keep_below(docs, toxicity_model(spark, docs, sf_dir), TOXIC_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Rows are told apart by id and text. Rows without id stay. Of equal rows a single one stays.
    """
    judged = settled(spark, lambda: near_duplicates(docs, threshold=0.75).where("kept AND doc_id IS NOT NULL").select("doc_id", "text_key"))
    kept = judged.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    named = docs.join(kept, (F.col("doc_id") == F.col("__id")) & text_key(F.col("text")).eqNullSafe(F.col("__key")), "left_semi")
    if not judged.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        named = named.dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 400-byte strings, and without the runs of 51 words, that start anywhere else as well."""
    cut = remove_repeats(docs, length=400, words=51)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised texts in windows of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: No SQL can learn the scores of the first stage; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
