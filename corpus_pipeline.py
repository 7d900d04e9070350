"""Corpus pipeline: language ID, line dedup, near-duplicate join, secret masking, packing.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and returns a
DataFrame that is written and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import jaccard, langid, lines, packing, secrets
from feedlake.llm.common import tokenizer_path, written

MIN_SCORE = 0.5
ORACLE_SQL = None  # language ID and packing cannot be told in SQL; tests hold the stages to brute force


def _with_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language is uncertain; fills a missing lang."""
    model = langid.train(docs, F.lit(True))
    said = langid.predict(docs, model, keep=docs.columns)
    good = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return said.where(good).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes later occurrences of repeated three-line windows out; what loses all its words goes."""
    cut = lines.dedup_lines(docs)
    empty = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _with_size(cut.where(~empty)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group linked by five-word shingles at 0.8."""
    rows = docs.withColumn("__np_key", F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_components(rows, words=5, percent=80, id_col="__np_key", count_links=False)
    pairs = groups.select(F.col("doc_id").alias("__np_row"), F.col("component_id").alias("__np_group")).distinct()
    kept = rows.select("doc_id", "__np_key").join(pairs, F.col("__np_key") == F.col("__np_row")) \
        .groupBy("__np_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__np_key")).alias("__np_first")) \
        .select(F.col("__np_first.__np_key").alias("__np_kept"))
    return rows.join(kept, F.col("__np_key") == F.col("__np_kept")).dropDuplicates(["__np_key"]).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the text."""
    return _with_size(secrets.mask_secrets(docs, secrets.train(docs))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens at the sources' proportions."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the cluster's shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
