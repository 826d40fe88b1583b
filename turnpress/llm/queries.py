"""The registered queries of this folder: thin digests of what the operators return."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnpress.llm import (
    bpe,
    chat,
    contexts,
    licenses,
    manifest,
    mixing,
    neighbours,
    quality,
    rules,
    search,
    simhash,
    substrings,
    toxicity,
)
from turnpress.llm.common import fold, read, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> bpe.Codec:
    return bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = vocabulary()
    done = bpe.encode_and_decode(read(spark, sf_dir, "documents", "doc_id", "text"), codec)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = stored(quality.feature_table(read(spark, sf_dir, "documents")), "features")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = quality.fit(features.where(~held_out), read(spark, sf_dir, "labels"))
    scored = quality.score_features(features, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", quality.good(F.col("score")).cast("int").alias("predicted")
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "times", "taken")


@query
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    records = chat.canonical(chat.layouts(rows.union(control)))
    back = chat.read_back(chat.formatted(records).select("conv_id", "formatted", "mask"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(each, "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        digest(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op1_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id")


@query
def op6_toxicity_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.scored(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", toxicity.toxic(F.col("score")).cast("int").alias("predicted")
    )


@query
def op3_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    held_out = fold(F.col("doc_id"), 10) == 0
    block = F.xxhash64("file_path", F.floor(F.col("row_index") / 8192))
    scored = contexts.score(docs, ~held_out, block)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"
    )


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    claims = F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) == 0)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    proved = manifest.manifest(docs, claimed={"text": lowered}, claims=claims)
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return search.search(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    result = F.col("licenses")
    words = result["base"]["word"]
    return scanned.select(
        "doc_id", result["n_words"].alias("n_words"), F.size(words).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        licenses.labels(result["base"]["label"]).alias("base_labels"),
        licenses.labels(F.concat(result["base"]["label"], result["found"]["label"])).alias("labels"),
        licenses.score(result).alias("score"),
    )
