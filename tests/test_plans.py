"""Whole stages: prepare, pack, plan, sinks and the registered queries."""

import json
import pathlib
import sys

import pytest
from pyspark.sql import functions as F

from turnpress.catalog import CHECKS, QUERIES, inputs
from turnpress.operators.mapping import apply_row_processor
from turnpress.plans.feed import training_plan, training_schedule, write_plan
from turnpress.plans.pack import pack
from turnpress.plans.prepare import prepare
from turnpress.schemas import EXAMPLE, MULTI_TURN, SINGLE_TURN
from turnpress.sources import io

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("prepared"))
    sources = {SINGLE_TURN: inputs.raw_single_turn(spark, SMALL), MULTI_TURN: inputs.raw_multi_turn(spark, SMALL)}
    return out, prepare(spark, sources, out)


def test_prepare(spark, prepared):
    out, tables = prepared
    stats = {r["metric"]: r["value"] for r in io.read_stats(spark, f"{out}/stats").collect()}
    n = tables["examples"].count()
    assert stats["final_examples"] == n == stats["by_source_single_turn"] + stats["by_source_multi_turn"]
    assert stats["single_turn_total"] == 1000 and stats["multi_turn_total"] == 20
    kept = stats["single_turn_kept"] + stats["multi_turn_kept"]
    assert kept - stats["duplicates_dropped"] == n and n > 0
    assert stats["single_turn_kept"] + stats["single_turn_dropped"] == stats["single_turn_total"]
    assert not pathlib.Path(out, "_flagged").exists()
    lines = [json.loads(line) for p in pathlib.Path(out, "examples").glob("part-*") for line in p.read_text().splitlines()]
    assert len(lines) == n
    assert all(set(x) == set(EXAMPLE.fieldNames()) for x in lines)
    assert any("tool_calls" not in m for x in lines for m in x["messages"])
    assert all(isinstance(t["function"]["parameters"], dict) for x in lines for t in x["tools"])
    metrics = [json.loads(line)["metric"] for p in sorted(pathlib.Path(out, "stats").glob("*.json")) for line in p.read_text().splitlines()]
    assert metrics == sorted(metrics)


def test_pack_and_plan(spark, prepared, tmp_path):
    _, tables = prepared
    out = pack(spark, tables["examples"], str(tmp_path / "packed"), seq_len=4096, eval_size=50)
    density = out["density"].first()
    assert density["n_bins"] == out["train"].count() and density["density_pct"] <= 100
    drops = {r["split"]: r for r in out["drops"].collect()}
    assert drops["eval"]["n_rows"] == 50
    usable = {s: r["n_rows"] - r["render_failures"] - r["over_length"] for s, r in drops.items()}
    assert usable["eval"] == out["eval"].count() and usable["train"] == density["n_docs"]
    assert out["train"].where("size(input_ids) <> 4096 OR aggregate(seq_lens, 0, (a, b) -> a + b) <> 4096").count() == 0
    assert out["lengths"].first()["n_tokens"] == density["used_tokens"]

    plan = training_plan(out["train"], epochs=2, world=2, global_batch=4)
    write_plan(plan, str(tmp_path / "plan"))
    back = spark.read.parquet(str(tmp_path / "plan"))
    steps = training_schedule(out["train"], 2, 2, 4).first()["total_steps"]
    assert back.count() == steps * 4 and back.agg(F.max("step")).first()[0] == steps


def test_write_checks_lengths(spark, tmp_path):
    bad = spark.createDataFrame([([1], [1], [1])], "input_ids array<int>, labels array<int>, attention_mask array<int>")
    train = bad.select("input_ids", "labels", F.col("attention_mask").alias("position_ids"))
    with pytest.raises(Exception, match="is not 2 long"):
        io.write_packed(train, bad, str(tmp_path / "x"), 2)


def test_outputs_are_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "metric string, value bigint")
    io.write_stats(df, str(tmp_path / "s"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        io.write_stats(df, str(tmp_path / "s"))


def test_materialize_once_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "once")
    assert io.materialize_once(spark, path, build).count() == io.materialize_once(spark, path, build).count() == 3
    assert calls == [1]


def test_a_run_goes_on_from_what_is_whole(spark, tmp_path):
    parsed = []

    def build():
        parsed.append(1)
        return spark.range(5)

    stage, out = str(tmp_path / "stage"), str(tmp_path / "out")

    def run(fail):
        table = io.materialize_once(spark, stage, build)
        if fail:
            table = table.select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
        io.publish(spark, out, lambda at: table.write.parquet(at))

    with pytest.raises(Exception, match="lost"):
        run(True)
    assert not io.is_complete(spark, out) and not pathlib.Path(out).exists()
    run(False)
    run(True)  # all is there: nothing is built
    assert parsed == [1] and spark.read.parquet(out).count() == 5
    pathlib.Path(tmp_path / "foreign").mkdir()
    with pytest.raises(FileExistsError):
        io.materialize_once(spark, str(tmp_path / "foreign"), build)


def test_lines_without_order_are_numbered_as_stored(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    lines = [json.dumps({"source": "single_turn", "tools": [], "messages": [{"role": "user", "content": f"text {i}"}, {"role": "assistant", "content": "ok"}]}) for i in range(50)]
    (path / "a.json").write_text("\n".join(lines[:30]) + "\n")
    (path / "b.json").write_text("\n".join(lines[30:]) + "\n")
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = io.read_jsonl(spark, str(path), has_ord=False).repartition(3).collect()
        assert {r["ord"]: r["messages"][0]["content"] for r in rows} == {i: f"text {i}" for i in range(50)}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    examples = io.read_jsonl(spark, str(path), has_ord=False)
    out = pack(spark, examples, str(tmp_path / "packed"), seq_len=256, eval_size=5)
    assert out["eval"].count() == 5 and out["density"].first()["n_docs"] == 45
    (path / "c.json").write_text("no json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_jsonl(spark, str(path)).collect()


def test_file_order(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(f"query {i}", "[]", "[]") for i in range(20)], "query string, tools string, answers string").repartition(3).write.parquet(path)
    first = {r["query"]: r["ord"] for r in io.scan_single_turn(spark, path, has_ord=False).collect()}
    again = {r["query"]: r["ord"] for r in io.scan_single_turn(spark, path, has_ord=False).repartition(5).collect()}
    assert first == again and len(set(first.values())) == 20


def test_scan_multi_turn_fills_missing_texts(spark, tmp_path):
    path = str(tmp_path / "multi")
    spark.createDataFrame([(1, None, "x"), (2, "s", None)], "ord bigint, system string, chat string").write.parquet(path)
    rows = io.scan_multi_turn(spark, path).orderBy("ord").collect()
    assert [(r["system"], r["chat"]) for r in rows] == [("", "x"), ("s", "")]


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "m")
    io.append_metrics(spark.createDataFrame([(5, 1.0, 0.1, 2.0)], "step bigint, loss double, lr double, elapsed_s double"), path)
    io.append_metrics(spark.createDataFrame([(5, 0.5)], "step bigint, eval_loss double"), path)
    rows = {r["kind"]: r for r in io.read_metrics(spark, path).collect()}
    assert rows["train"]["loss"] == 1.0 and rows["train"]["eval_loss"] is None
    assert rows["eval"]["eval_loss"] == 0.5 and rows["eval"]["loss"] is None


def test_row_processor(spark):
    kept, counts = apply_row_processor(spark.range(10), F.when(F.col("id") > 6, F.col("id")))
    assert kept.count() == 3 and tuple(counts.first()) == (10, 3, 7)


sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
from check import compare, database  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, con, name):
    problem, n = compare(spark, con, SMALL, QUERIES[name], CHECKS.get(name))
    assert problem is None and n > 0


def test_a_folder_of_other_parameters_or_inputs_is_an_error(spark, prepared, tmp_path):
    out, tables = prepared
    target = str(tmp_path / "packed")
    first = pack(spark, tables["examples"], target, seq_len=4096, eval_size=50)
    again = pack(spark, spark.read.parquet(f"{out}/table"), target, seq_len=4096, eval_size=50)
    assert again["train"].count() == first["train"].count() and again["eval"].count() == first["eval"].count()
    for changed in ({"seq_len": 8192, "eval_size": 50}, {"seq_len": 4096, "eval_size": 4}, {"seq_len": 4096, "eval_size": 50, "seed": 1}):
        with pytest.raises(ValueError, match="other parameters or inputs"):
            pack(spark, tables["examples"], target, **changed)
    tables["examples"].limit(100).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="other parameters or inputs"):
        pack(spark, spark.read.parquet(str(tmp_path / "other")), target, seq_len=4096, eval_size=50)
    sources = {SINGLE_TURN: inputs.raw_single_turn(spark, SMALL), MULTI_TURN: inputs.raw_multi_turn(spark, SMALL)}
    with pytest.raises(ValueError, match="other parameters or inputs"):
        prepare(spark, sources, out, caps={SINGLE_TURN: 10})


def test_materialize_once_knows_what_it_was_made_from(spark, tmp_path):
    path = str(tmp_path / "once")
    data = str(tmp_path / "data")
    spark.range(3).write.parquet(data)
    made = lambda n: {"n": n, "inputs": io.inputs_of(spark.read.parquet(data))}
    build = lambda: spark.read.parquet(data)
    assert io.materialize_once(spark, path, build, made(1)).count() == io.materialize_once(spark, path, build, made(1)).count() == 3
    with pytest.raises(ValueError, match="other parameters"):
        io.materialize_once(spark, path, build, made(2))
    spark.range(4).write.mode("append").parquet(data)
    with pytest.raises(ValueError, match="other parameters"):
        io.materialize_once(spark, path, build, made(1))


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(5, 1.0, 0.1, 2.0)], "step bigint, loss double, lr double, elapsed_s double")
    assert io.read_metrics(spark, path).count() == 0
    for _ in range(2):
        io.append_metrics(rows, path, "train/step 5")
    assert io.read_metrics(spark, path).count() == 1
    io.append_metrics(rows, path, "train/step 10")
    with pytest.raises(Exception, match="lost"):  # dies before the manifest names its rows
        io.append_metrics(rows.withColumn("loss", F.raise_error(F.lit("lost")).cast("double")), path, "train/step 15")
    rows.write.json(f"{path}/rows/left-behind")
    assert io.read_metrics(spark, path).count() == 2
    io.append_metrics(rows, path)
    io.append_metrics(rows, path)
    assert io.read_metrics(spark, path).count() == 4


def test_packed_row_groups_are_bounded(spark, tmp_path):
    """A reader decodes up to a row group at once: it holds a bounded number of tokens, whatever a task writes."""
    import pyarrow.parquet as pq

    seq_len, n = io.GROUP_TOKENS // 4, 10
    ints = lambda fill: F.array_repeat(F.lit(fill).cast("int"), seq_len)
    rows = spark.range(n).coalesce(1)
    train = rows.select(F.col("id").alias("bin"), ints(1).alias("input_ids"), ints(1).alias("labels"), ints(0).alias("position_ids"), F.array(F.lit(seq_len)).alias("seq_lens"))
    held = rows.select(ints(1).alias("input_ids"), ints(1).alias("labels"), ints(1).alias("attention_mask"))
    io.write_packed(train, held, str(tmp_path / "packed"), seq_len)
    for part in ("train", "eval"):
        for file in (tmp_path / "packed" / part).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) * seq_len <= io.GROUP_TOKENS
    assert [df.count() for df in io.read_packed(spark, str(tmp_path / "packed"))] == [n, n]

    keyed = spark.range(io.GROUP_ROWS * 8).select(F.col("id").alias("k"), ints(1)[0].alias("v"))
    table = io.stored_in_buckets(spark, str(tmp_path / "tokens"), "k", lambda b: keyed.repartition(b, "k"))
    groups = [pq.ParquetFile(f).metadata.row_group(0).num_rows for f in (tmp_path / "tokens").glob("*.parquet")]
    assert max(groups) <= io.GROUP_ROWS and table.count() == io.GROUP_ROWS * 8
