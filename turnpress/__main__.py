"""Command line: ``spark-submit`` or ``python -m turnpress {prepare,pack,plan} ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from turnpress.functions.tokens import ChatTemplate, FileTokenizer
from turnpress.functions.vocabulary import VocabularyTokenizer
from turnpress.plans.feed import training_plan, training_schedule, write_plan
from turnpress.plans.pack import pack
from turnpress.plans.prepare import prepare
from turnpress.schemas import MULTI_TURN, SINGLE_TURN
from turnpress.sources.io import is_complete, read_jsonl, read_packed, scan_multi_turn, scan_single_turn


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="turnpress")
    commands = parser.add_subparsers(dest="command", required=True)

    p = commands.add_parser("prepare", help="clean, merge and deduplicate raw corpora")
    p.add_argument("--single-turn", help="Parquet or JSON lines with query, tools, answers")
    p.add_argument("--multi-turn", help="Parquet or JSON lines with system, chat")
    p.add_argument("--format", default="parquet", choices=["parquet", "json"])
    p.add_argument("--file-order", action="store_true", help="rows without an ord column: order by file and row or line")
    p.add_argument("--output-dir", required=True)
    only = p.add_mutually_exclusive_group()
    only.add_argument("--single-turn-only", action="store_true")
    only.add_argument("--multi-turn-only", action="store_true")
    p.add_argument("--max-single-turn", type=int, help="read only the first rows, for a trial run")
    p.add_argument("--max-multi-turn", type=int)

    p = commands.add_parser("pack", help="split, tokenise and pack prepared examples")
    p.add_argument("--examples", required=True)
    p.add_argument("--format", default="json", choices=["parquet", "json"], help="parquet for table/, json for examples/")
    p.add_argument("--file-order", action="store_true", help="JSON lines without ord: order by file and line")
    p.add_argument("--quoted-arguments", action="store_true", help="render call arguments as a JSON string")
    p.add_argument("--out-dir", required=True)
    p.add_argument("--tokenizer", help="rank file (.tiktoken) or tokenizer.json; byte ids if left out")
    p.add_argument("--pad-id", type=int)
    p.add_argument("--eos-id", type=int)
    p.add_argument("--seq-len", type=int, default=2048)
    p.add_argument("--eval-size", type=int, default=500)
    p.add_argument("--seed", type=int, default=42)

    p = commands.add_parser("plan", help="assign packed records to epochs, ranks and steps")
    p.add_argument("--data-dir", required=True)
    p.add_argument("--out-dir", required=True)
    p.add_argument("--epochs", type=int, default=2)
    p.add_argument("--world-size", type=int, default=16)
    p.add_argument("--global-batch-size", type=int, default=128)
    p.add_argument("--micro-batch-size", type=int, default=1)
    p.add_argument("--warmup-ratio", type=float, default=0.03)
    p.add_argument("--seed", type=int, default=42)
    return parser.parse_args(argv)


def tokenizer_of(args: argparse.Namespace):
    """Byte-level vocabularies are read here; a ``tokenizer.json`` of another kind needs its library on the executors."""
    if not args.tokenizer:
        return None
    try:
        return VocabularyTokenizer(args.tokenizer, pad_id=args.pad_id, eos_id=args.eos_id)
    except ValueError:
        if not args.tokenizer.endswith(".json"):
            raise
        return FileTokenizer(args.tokenizer, args.pad_id, args.eos_id)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"turnpress {args.command}").getOrCreate()
    if args.command == "prepare":
        scans = {SINGLE_TURN: (scan_single_turn, args.single_turn), MULTI_TURN: (scan_multi_turn, args.multi_turn)}
        sources = {
            name: scan(spark, path, args.format, not args.file_order) for name, (scan, path) in scans.items() if path
        }
        caps = {SINGLE_TURN: args.max_single_turn, MULTI_TURN: args.max_multi_turn}
        there = is_complete(spark, f"{args.output_dir}/stats")
        out = prepare(spark, sources, args.output_dir, caps, args.single_turn_only, args.multi_turn_only)
        if there:
            print(f"{args.output_dir} is complete, nothing to do")
            return
        out["rates"].show()
    elif args.command == "pack":
        tokenizer = tokenizer_of(args)
        examples = (
            spark.read.parquet(args.examples) if args.format == "parquet"
            else read_jsonl(spark, args.examples, not args.file_order)
        )
        there = is_complete(spark, f"{args.out_dir}/eval")
        out = pack(
            spark, examples, args.out_dir, args.seq_len, args.eval_size, args.seed, tokenizer,
            ChatTemplate(quoted_arguments=args.quoted_arguments),
        )
        if there:
            print(f"{args.out_dir} is complete, nothing to do")
            return
        for name in ("drops", "lengths", "density"):
            out[name].show()
    else:
        packed, _ = read_packed(spark, args.data_dir)
        training_schedule(
            packed, args.epochs, args.world_size, args.global_batch_size, args.micro_batch_size, args.warmup_ratio
        ).show()
        write_plan(
            training_plan(packed, args.epochs, args.world_size, args.global_batch_size, args.micro_batch_size, args.seed),
            args.out_dir,
        )


if __name__ == "__main__":
    main()
