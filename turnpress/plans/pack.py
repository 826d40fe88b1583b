"""Cleaned examples to packed training records and evaluation records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnpress.functions.tokens import ByteTokenizer, ChatTemplate, resolve_pad
from turnpress.operators.order import holdout_split, with_shuffle_key
from turnpress.operators.packing import build_eval, build_packed, place
from turnpress.operators.report import drop_reasons, packing_density, token_length_profile
from turnpress.operators.tokenize import fits, tokenize
from turnpress.sources.io import inputs_of, is_complete, publish, read_packed, stored_in_buckets, write_packed


def pack(
    spark: SparkSession,
    examples: DataFrame,
    output: str,
    seq_len: int = 2048,
    eval_size: int = 500,
    seed: int = 42,
    tokenizer=None,
    template: ChatTemplate = ChatTemplate(),
) -> dict[str, DataFrame]:
    """Split, tokenise, pack and write ``train/`` and ``eval/``.

    A folder of an earlier run with other parameters or inputs is an error. Tokens are stored once, under ``tokens/``, and found again by a run that goes on after a
    failure; ``train/`` and ``eval/`` are put in place when whole. Reports and the length histogram read one narrow column of
    that table. Conversations are dealt out by key before they become tokens; bins are found on
    keys and lengths alone and come to the buckets, and token arrays move once, to meet in them.
    """
    tokenizer = tokenizer or ByteTokenizer()
    pad = resolve_pad(tokenizer)
    coded_from = {"eval_size": eval_size, "seed": seed, "tokenizer": tokenizer, "template": template, "inputs": inputs_of(examples)}
    made_from = {**coded_from, "seq_len": seq_len}
    for part in ("train", "eval"):  # before any work: a folder of another run is an error
        if is_complete(spark, f"{output}/{part}"):
            publish(spark, f"{output}/{part}", lambda at: None, made_from)
    keyed = holdout_split(with_shuffle_key(examples, seed, "source", "ord"), eval_size)
    tokens = stored_in_buckets(
        spark, f"{output}/tokens", "shuffle_key",
        lambda n: tokenize(keyed.repartition(n, "shuffle_key"), tokenizer, template), coded_from,
    )
    usable = tokens.where(fits(F.col("n_tokens"), seq_len))
    train = usable.where(F.col("split") == "train")
    bins, placed = place(train, seq_len)
    held = usable.where(F.col("split") == "eval").select("input_ids", "labels")
    write_packed(build_packed(placed, seq_len, pad), build_eval(held, seq_len, pad), output, seq_len, made_from)
    packed, records = read_packed(spark, output)
    return {
        "train": packed, "eval": records,
        "drops": drop_reasons(tokens, seq_len), "lengths": token_length_profile(train),
        "density": packing_density(bins, seq_len),
    }
