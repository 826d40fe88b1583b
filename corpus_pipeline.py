"""Corpus pipeline: five stages, each on all that the one before it kept.

    run(spark, sf_dir)   the stages over ``documents`` of sf_dir

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; between stages the rows are written
as Parquet in the shared folder and read again, so a lost executor re-reads files. All
stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnpress.llm import bpe, mixing, quality, queries, simhash, substrings
from turnpress.llm.common import fold, read, stored
from turnpress.operators.permutation import unused


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among ``docs``."""
    features = stored(quality.feature_table(docs.where(fold(F.col("doc_id"), 4) != 2)), "features")
    model = quality.fit(features, read(spark, sf_dir, "labels"))
    (score,) = unused(docs, "score")
    return quality.with_score(docs, model, out=score).where(quality.good(F.col(score))).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (then text hash) of every group of linked SimHash fingerprints.

    Equal ids and texts are one document and stay once; rows with one id and different texts are
    different documents. Rows without an id are in no group and stay.
    """
    found = simhash.groups(docs)
    (digest,) = unused(docs, "digest")
    least = F.min(F.struct("doc_id", F.col("text_hash").alias(digest))).alias("least")
    kept = found.where("doc_id IS NOT NULL").groupBy("group").agg(least).select("least.*")
    named = docs.where("doc_id IS NOT NULL").withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest])
    chosen = named.join(kept, ["doc_id", digest], "left_semi").select(docs.columns)
    return chosen.unionByName(docs.where("doc_id IS NULL"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; what is empty then goes."""
    shorter = substrings.without_repeats(docs, substrings.repeats(docs))
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return shorter.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every text; ids that do not decode to it end the job."""
    codec = queries.vocabulary()
    done = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), codec, ids="_ids", out="_bytes")
    same = F.col("_bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    ids = F.when(same, F.col("_ids")).otherwise(F.raise_error(F.lit("ids do not decode to the text")).cast("array<int>"))
    return done.select("doc_id", "source", F.size("_ids").cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("classify_quality", classify_quality),
    ("drop_near_duplicates", drop_near_duplicates),
    ("cut_repeated_passages", cut_repeated_passages),
    ("mix_sources", mix_sources),
    ("encode_tokens", encode_tokens),
]

ORACLE_SQL = None
"""SQL has neither the fingerprints' hash nor the merges; tests hold each stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
