"""Time the headline queries and print one line of JSON.

Every query runs once to warm up the session and once on the clock; the result goes to
the ``noop`` sink, so all rows and columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "normalize_single_turn", "normalize_multi_turn", "extract_json_objects", "source_counts",
    "dedup_first", "dedup_report", "holdout_split", "render_chat", "tokenize", "mask_labels",
    "token_length_profile", "drop_reasons", "pack_ffd", "packing_density", "build_packed",
    "build_eval", "epoch_shard_plan", "batch_plan", "loss_by_window", "write_packed",
]


def end_to_end(spark, sf_dir: str) -> tuple[float, float]:
    """Both raw corpora to packed records on disk, once: seconds, and raw rows per second."""
    from turnpress.catalog import inputs
    from turnpress.plans.pack import pack
    from turnpress.plans.prepare import prepare
    from turnpress.schemas import MULTI_TURN, SINGLE_TURN
    from turnpress.session import new_path

    folder = new_path(spark, "bench")
    sources = {SINGLE_TURN: inputs.raw_single_turn(spark, sf_dir), MULTI_TURN: inputs.raw_multi_turn(spark, sf_dir)}
    rows = sum(df.count() for df in sources.values())
    start = time.perf_counter()
    pack(spark, prepare(spark, sources, f"{folder}/prepared")["examples"], f"{folder}/packed")
    took = time.perf_counter() - start
    return round(took, 3), round(rows / took, 1)


def main() -> None:
    from turnpress.catalog import QUERIES
    from turnpress.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = run(name)
    if not sys.argv[1:]:
        seconds["prepare_and_pack"], rate = end_to_end(spark, sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        **({} if sys.argv[1:] else {"prepare_and_pack_raw_rows_per_sec": rate}),
    }))


if __name__ == "__main__":
    main()
