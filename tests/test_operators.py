"""Edge rows and properties of the table operators."""

import random

import pytest
from pyspark.sql import functions as F

from turnpress.functions.tokens import (
    ByteTokenizer, ChatTemplate, FileTokenizer, mask_labels, render_chat, rendered_text, resolve_pad, trainable,
)
from turnpress.operators import clean, dedup, order, packing, report
from turnpress.operators.tokenize import fits, token_lengths, tokenize
from turnpress.schemas import EXAMPLE, RAW_MULTI_TURN, RAW_SINGLE_TURN

TOOLS = '[{"name": "f", "parameters": {"q": 1}}]'
CALL = '[{"name": "f", "arguments": {"q": 1}}]'


def reasons(spark, rows):
    raw = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RAW_SINGLE_TURN)
    return [r["reject_reason"] for r in clean.flag_single_turn(raw).orderBy("ord").collect()]


def test_single_turn_reasons(spark):
    many = "[" + ", ".join(['{"name": "a"}'] * 33) + "]"
    cases = [
        (("x" * 4, TOOLS, CALL), "user_chars"),
        (("x" * 5, TOOLS, CALL), None),
        (("x" * 8000, TOOLS, CALL), None),
        (("x" * 8001, TOOLS, CALL), "user_chars"),
        (("", TOOLS, CALL), "user_chars"),
        ((None, TOOLS, CALL), "user_chars"),
        (("hello", "{}", CALL), "json_lists"),
        (("hello", TOOLS, "[]"), "json_lists"),
        (("hello", "[", CALL), "json_lists"),
        (("hello", TOOLS + " junk", CALL), "json_lists"),
        (("hello", None, CALL), "json_lists"),
        (("hello", "[]", CALL), "tool_count"),
        (("hello", many, CALL), "tool_count"),
        (("hello", '[{"name": "f"}, {"x": 1}]', CALL), "not_normalized"),
        (("hello", "[1]", CALL), "not_normalized"),
        (("hello", '["{\\"name\\": \\"f\\"}"]', CALL), "not_normalized"),
        (("hello", TOOLS, '[{"name": "f", "arguments": "x"}]'), "not_normalized"),
        (("hello", TOOLS, '[{"name": "undeclared"}]'), None),
        (("ééééé", TOOLS, CALL), None),
    ]
    assert reasons(spark, [c for c, _ in cases]) == [want for _, want in cases]


def test_multi_turn_reasons(spark):
    system = 'Use - {"name": "f"} {"bad": 1}'
    long = "USER: hello\nASSISTANT: hi\n" * 20
    cases = [
        ((system, "USER: hello\nASSISTANT: no"), None),
        ((system, "USER: hello\nASSISTANT: <functioncall> {\"name\": \"f\", \"arguments\": '{}'}"), None),
        ((system, 'USER: hello\nASSISTANT: <functioncall> {"name": "g"}'), "undeclared_tool"),
        ((system, "USER: hello"), "role_presence"),
        ((system, "ASSISTANT: hello"), "role_presence"),
        ((system, "USER: hey\nASSISTANT: no"), "chat"),
        ((system, None), "chat"),
        (("no tools", "USER: hello\nASSISTANT: no"), "tool_count"),
        ((None, "USER: hello\nASSISTANT: no"), "tool_count"),
        ((system, long), None),
        ((system, long + "ASSISTANT: more"), "message_count"),
    ]
    raw = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], RAW_MULTI_TURN)
    got = [r["reject_reason"] for r in clean.flag_multi_turn(raw).orderBy("ord").collect()]
    assert got == [want for _, want in cases]


def test_reports_of_flagged_rows(spark):
    raw = spark.createDataFrame([(0, "hello", TOOLS, CALL), (1, "hey", TOOLS, CALL)], RAW_SINGLE_TURN)
    counts = report.keep_rate(report.source_counts(clean.flag_single_turn(raw))).first()
    assert (counts["total"], counts["kept"], counts["dropped"], counts["keep_pct"]) == (2, 1, 1, 50.0)


def example(ord_, messages, tools=(), source="single_turn"):
    spec = [("function", (n, d, p)) for n, d, p in tools]
    return (ord_, source, spec, [(r, c, [("function", x) for x in calls] if calls else None) for r, c, calls in messages])


def examples(spark, *rows):
    return spark.createDataFrame(list(rows), EXAMPLE)


def kept(df):
    return sorted((r["source"], r["ord"]) for r in dedup.dedup_first(df).collect())


def test_dedup_rules(spark):
    base = [("user", "Hello there", None), ("assistant", "", [("f", "{}")])]
    folded = [("user", "  hello THERE\n", None), ("assistant", "", [("f", "{}")])]
    other = [("user", "Hello there", None), ("assistant", "", [("f", '{"x": 1}')])]
    first = examples(spark, example(9, base, [("f", "a", "{}"), ("g", "", "{}")]), example(3, other, [("f", "", "{}"), ("g", "", "{}")]))
    second = examples(spark, example(1, folded, [("g", "b", "{}"), ("f", "c", "{1}")], "multi_turn"))
    assert kept(dedup.union_sources(first, second)) == [("single_turn", 3), ("single_turn", 9)]
    assert kept(dedup.union_sources(second, first)) == [("multi_turn", 1), ("single_turn", 3)]


def test_dedup_does_not_depend_on_partitions(spark):
    rows = [example(i, [("user", f"text {i % 7}", None)]) for i in range(300)]
    df = dedup.union_sources(examples(spark, *rows))
    assert kept(df.repartition(1)) == kept(df.repartition(13, F.rand(3))) == [("single_turn", i) for i in range(7)]


def test_dedup_sums_up_before_the_shuffle(spark):
    df = dedup.union_sources(examples(spark, example(1, [("user", "a", None)])))
    plan = dedup.first_rows(dedup.with_row_id(dedup.with_dedup_key(df)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.index("Exchange") < plan.index("partial_min")


def test_select_sources():
    both = {"single_turn": 1, "multi_turn": 2}
    assert dedup.select_sources(both) == both
    assert dedup.select_sources(both, single_only=True) == {"single_turn": 1}
    assert dedup.select_sources(both, multi_only=True) == {"multi_turn": 2}
    with pytest.raises(ValueError):
        dedup.select_sources(both, True, True)


def test_conversations_keep_all_their_turns(spark):
    turns = spark.createDataFrame(
        [(c, i, "user", f"hello {i}") for c, n in ((1, 500), (2, 61), (3, 40), (4, 2)) for i in reversed(range(n))],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = {r["ord"]: [m["content"] for m in r["messages"]] for r in clean.conversation_examples(turns).collect()}
    assert rows == {c: [f"hello {i}" for i in range(n)] for c, n in ((1, 500), (2, 61), (3, 40), (4, 2))}


def test_long_chats_are_counted_as_too_long(spark, tmp_path):
    from turnpress.catalog import inputs

    rows = [
        (c, i, "system" if i == 0 and c % 2 else ("user", "assistant")[i % 2], f"number {i} in the row")
        for c, n in ((101, 61), (102, 61), (103, 500), (104, 500), (105, 4), (106, 4)) for i in range(n)
    ]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id != 106").withColumn("props", F.lit('{"k": 90}')).write.parquet(
        str(tmp_path / "events.parquet")
    )
    flagged = {r["ord"]: r for r in inputs.flagged_multi_turn(spark, str(tmp_path)).collect()}
    assert sorted(flagged) == [101, 102, 103, 104, 105, 106]
    assert {c for c, r in flagged.items() if r["reject_reason"] == "message_count"} == {101, 102, 103, 104}
    assert len(flagged[104]["messages"] or range(500)) == 500 and flagged[105]["reject_reason"] is None


# ---- order ----------------------------------------------------------------------

def ids(spark, n, parts=5):
    return order.with_shuffle_key(spark.range(n).repartition(parts), 42, "id")


def test_positions_are_a_permutation(spark):
    rows = order.with_position(ids(spark, 3000), "shuffle_key", prefix=1).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(3000))
    assert [r["shuffle_key"] for r in rows] == sorted(r["shuffle_key"] for r in rows)
    assert rows[0]["total"] == 3000


@pytest.mark.parametrize("n,size", [(50, 0), (50, 7), (50, 50), (50, 99), (3000, 1234)])
def test_holdout_is_exact_and_stable(spark, n, size):
    def held(parts):
        out = order.holdout_split(ids(spark, n, parts), size)
        return sorted(r["id"] for r in out.where("split = 'eval'").collect())

    got = held(3)
    assert len(got) == min(n, size) and got == held(11)
    expected = sorted(ids(spark, n).collect(), key=lambda r: r["shuffle_key"])[:size]
    assert got == sorted(r["id"] for r in expected)


def test_shards_are_even_and_differ_by_epoch(spark):
    plan = order.epoch_shard_plan(spark.range(103), "id", 2, 4, 42).collect()
    for epoch in (0, 1):
        rows = [r for r in plan if r["epoch"] == epoch]
        assert len(rows) == 100 and len({r["id"] for r in rows}) == 100
        assert {(r["rank"], r["index"]) for r in rows} == {(k, i) for k in range(4) for i in range(25)}
    first = {e: sorted((r["position"], r["id"]) for r in plan if r["epoch"] == e) for e in (0, 1)}
    assert first[0] != first[1]


def test_eval_shards_keep_every_row(spark):
    rows = order.eval_shard_plan(ids(spark, 103), "id", 4).collect()
    assert len({r["id"] for r in rows}) == 103


def test_batches(spark):
    shards = order.epoch_shard_plan(spark.range(103), "id", 2, 2, 42)
    rows = order.batch_plan(shards, global_batch=12, micro_batch=2, world=2).collect()
    per_step = {}
    for r in rows:
        per_step.setdefault(r["step"], []).append(r)
    assert sorted(per_step) == list(range(1, 17)) and {len(v) for v in per_step.values()} == {12}
    assert {r["slot"] for r in rows} == {0, 1, 2}
    with pytest.raises(ValueError):
        order.accumulation(10, 4, 3)


def test_schedule(spark):
    counted = spark.range(1).select(F.lit(26300).alias("n_rows"))
    row = order.schedule(counted, 128, 1, 16, 2).first()
    assert (row["steps_per_epoch"], row["total_steps"], row["warmup_steps"], row["accumulation"]) == (205, 410, 12, 8)


# ---- tokens ----------------------------------------------------------------------

def test_rendering_with_tools(spark):
    df = examples(spark, example(
        1, [("user", "hi", None), ("assistant", "ok", [("f", '{"a": 1}')]), ("tool", "r1", None), ("tool", "r2", None),
            ("assistant", "done", None)], [("f", 'say "x"', '{"q": 1}')],
    ))
    segments = render_chat(F.col("messages"), F.col("tools"), ChatTemplate("Be kind."))
    text = df.select(rendered_text(segments).alias("t")).first()["t"]
    assert text.startswith("<|im_start|>system\nBe kind.\n\n# Tools\n\n")
    assert '<tools>\n{"type": "function", "function": {"name": "f", "description": "say \\"x\\"", "parameters": {"q": 1}}}\n</tools>' in text
    assert text.endswith(
        "<|im_start|>user\nhi<|im_end|>\n"
        '<|im_start|>assistant\nok\n<tool_call>\n{"name": "f", "arguments": {"a": 1}}\n</tool_call><|im_end|>\n'
        "<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response><|im_end|>\n"
        "<|im_start|>assistant\ndone<|im_end|>\n"
    )
    quoted = df.select(rendered_text(render_chat(F.col("messages"), F.col("tools"), ChatTemplate(quoted_arguments=True))).alias("t"))
    assert '"arguments": "{\\"a\\": 1}"}' in quoted.first()["t"]


def test_own_system_prompt_replaces_the_default(spark):
    df = examples(spark, example(1, [("system", "S", None), ("user", "u", None), ("assistant", "a", None)]))
    rows = df.select(F.explode(render_chat(F.col("messages"), F.col("tools"))).alias("s")).select("s.*").collect()
    assert [(r["role"], r["trained"]) for r in rows] == [("system", False), ("user", False), ("assistant", True)]
    assert rows[0]["text"] == "<|im_start|>system\nS<|im_end|>\n"


def test_byte_ids_and_masks(spark):
    df = examples(spark, example(1, [("user", "é€😀\n", None), ("assistant", "b<|im_end|>", None)]))
    row = tokenize(df).first()
    markers = {"<|im_start|>": 257, "<|im_end|>": 258}

    def ids_of(text):
        out, i = [], 0
        while i < len(text):
            marker = next((m for m in markers if text.startswith(m, i)), None)
            out += [markers[marker]] if marker else list(text[i].encode())
            i += len(marker) if marker else 1
        return out

    masked = ids_of("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\né€😀\n<|im_end|>\n")
    trained = ids_of("<|im_start|>assistant\nb<|im_end|><|im_end|>\n")
    assert row["input_ids"] == masked + trained
    assert row["labels"] == [-100] * len(masked) + trained
    assert row["n_tokens"] == len(masked + trained) == token_lengths(df).first()["n_tokens"]


def test_untrainable_conversations_have_no_tokens(spark):
    df = examples(spark, example(1, [("user", "only", None)]), example(2, []))
    assert [(r["input_ids"], r["labels"], r["n_tokens"]) for r in tokenize(df).collect()] == [(None, None, None)] * 2
    assert [r["n_tokens"] for r in token_lengths(df).collect()] == [None, None]


def test_trainable_and_fits(spark):
    df = spark.createDataFrame([([-100, -100], 8), ([-100, 3], 9), (None, None)], "labels array<int>, n int")
    assert [tuple(r) for r in df.select(trainable(F.col("labels")), fits(F.col("n"), 8)).collect()] == [
        (False, True), (True, False), (False, False)]


def test_file_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tok = Tokenizer(models.WordLevel({"[UNK]": 0, "hi": 1, "there": 2}, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    df = examples(spark, example(1, [("user", "hi", None), ("assistant", "there", None)]))
    row = tokenize(df, FileTokenizer(path, eos_id=0)).first()
    assert len(row["input_ids"]) == len(row["labels"]) == row["n_tokens"]
    assert 2 in row["labels"] and 1 in row["input_ids"] and 1 not in row["labels"]
    assert resolve_pad(FileTokenizer(path, eos_id=7)) == 7
    assert resolve_pad(FileTokenizer(path, pad_id=3, eos_id=7)) == 3
    with pytest.raises(ValueError):
        resolve_pad(FileTokenizer(path))


# ---- packing ---------------------------------------------------------------------

def naive(lengths, capacity):
    """Item-by-item first fit over lengths that are already in order."""
    room, bins = [], []
    for n in lengths:
        b = next((i for i, r in enumerate(room) if r >= n), len(room))
        if b == len(room):
            room.append(capacity)
        room[b] -= n
        bins.append(b)
    return bins


def expand(plan, counts):
    out = {n: [None] * c for n, c in counts.items()}
    for length, lo, hi, first, per in plan:
        for r in range(lo, hi):
            out[length][r] = first + (r - lo) // per
    return [b for n in sorted(counts, reverse=True) for b in out[n]]


def test_runs_equal_item_by_item_first_fit():
    rng = random.Random(5)
    for _ in range(500):
        capacity = rng.choice([5, 10, 37, 128])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randrange(1, 120))), reverse=True)
        counts = {n: items.count(n) for n in set(items)}
        assert expand(packing.length_runs(counts.items(), capacity), counts) == naive(items, capacity)


def test_runs_edge_cases():
    assert packing.length_runs([], 10) == []
    assert expand(packing.length_runs([(5, 2), (3, 2), (2, 2)], 10), {5: 2, 3: 2, 2: 2}) == [0, 0, 1, 1, 1, 1]
    assert packing.length_runs([(10, 3)], 10) == [(10, 0, 3, 0, 1)]
    with pytest.raises(ValueError):
        packing.length_runs([(11, 1)], 10)
    # A billion items of one length are one plan row.
    assert packing.length_runs([(3, 10**9 - 1)], 10) == [(3, 0, 10**9 - 1, 0, 3)]


def lengths_frame(spark, n, capacity, hot=None, seed=1):
    rng = random.Random(seed)
    rows = [(i, hot if hot and i % 3 else rng.randint(1, capacity)) for i in range(n)]
    return order.with_shuffle_key(spark.createDataFrame(rows, "ord bigint, n_tokens int"), 42, "ord")


@pytest.mark.parametrize("hot", [None, 4])
def test_pack_matches_naive(spark, hot):
    df = lengths_frame(spark, 900, 32, hot)
    placed = packing.pack_ffd(df.repartition(7), 32).collect()
    rows = sorted(df.collect(), key=lambda r: (-r["n_tokens"], r["shuffle_key"]))
    want = dict(zip((r["ord"] for r in rows), naive([r["n_tokens"] for r in rows], 32)))
    assert {r["ord"]: r["bin"] for r in placed} == want


@pytest.mark.parametrize("rows", [0, 10**6])
def test_pack_does_not_depend_on_the_join(spark, monkeypatch, rows):
    df = lengths_frame(spark, 900, 32, 4)
    want = sorted((r["ord"], r["bin"]) for r in packing.pack_ffd(df, 32).collect())
    monkeypatch.setattr(packing, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(packing, "RANKS_PER_BUCKET", 50)
    assert sorted((r["ord"], r["bin"]) for r in packing.pack_ffd(df, 32).collect()) == want


def token_frame(spark, sizes):
    rows = [(i, n, list(range(1, n + 1)), [-100] + list(range(2, n + 1))) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "ord bigint, n_tokens int, input_ids array<int>, labels array<int>")
    return order.with_shuffle_key(df, 42, "ord")


def test_packed_record(spark):
    placed = packing.pack_ffd(token_frame(spark, [2, 3]), 8)
    row = packing.build_packed(placed, 8, 99).first()
    assert row["position_ids"] == [0, 1, 2, 0, 1, 0, 0, 0]
    assert row["seq_lens"] == [3, 2, 3]
    assert row["input_ids"] == [1, 2, 3, 1, 2, 99, 99, 99]
    assert row["labels"] == [-100, 2, 3, -100, 2, -100, -100, -100]


def test_full_bin_has_no_padding_entry(spark):
    row = packing.build_packed(packing.pack_ffd(token_frame(spark, [8]), 8), 8, 99).first()
    assert row["seq_lens"] == [8]


def test_pack_round_trip(spark):
    rng = random.Random(2)
    sizes = [rng.randint(1, 16) for _ in range(200)]
    packed = packing.build_packed(packing.pack_ffd(token_frame(spark, sizes), 16), 16, 0)
    found = packing.doc_boundaries(packed, 0).collect()
    assert all(r["consistent"] and sum(r["seq_lens"]) == 16 for r in found)
    assert sorted(n for r in found for n in r["lengths"]) == sorted(sizes)
    for r in found:
        for start, n in zip(r["starts"], r["lengths"]):
            assert r["input_ids"][start : start + n] == list(range(1, n + 1))


def test_eval_record(spark):
    row = packing.build_eval(token_frame(spark, [3]).select("input_ids", "labels"), 5, 99).first()
    assert row["attention_mask"] == [1, 1, 1, 0, 0]
    assert row["labels"] == [-100, 2, 3, -100, -100] and row["input_ids"] == [1, 2, 3, 99, 99]


# ---- reports ---------------------------------------------------------------------

def test_weighted_loss_without_tokens_is_zero(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "step bigint, loss double, n_tokens bigint")
    assert report.weighted_loss(df).first()["loss"] == 0


def test_only_complete_windows_are_logged(spark):
    df = spark.createDataFrame([(s, float(s), 1) for s in range(1, 13)], "step bigint, loss double, n_tokens bigint")
    assert [(r["step"], r["loss"]) for r in report.loss_by_window(df, 5).orderBy("step").collect()] == [(5, 3.0), (10, 8.0)]


def test_length_profile(spark):
    import numpy as np

    values = [3, 9, 27, 81, 100]
    row = report.token_length_profile(spark.createDataFrame([(v,) for v in values], "n_tokens int")).first()
    assert (row["n_tokens"], row["p50"], row["p95"], row["max"]) == (
        sum(values), int(np.percentile(values, 50)), int(np.percentile(values, 95)), max(values))


def test_a_null_key_part_ends_the_job(spark):
    df = spark.createDataFrame([("s", None), ("s", 1)], "source string, ord bigint")
    with pytest.raises(Exception, match="NULL in a key part"):
        order.with_shuffle_key(df, 1, "source", "ord").collect()


def test_key_parts_cannot_run_into_each_other(spark):
    df = spark.createDataFrame([("a|1", "b"), ("a", "1|b"), ("a", "1:b")], "x string, y string")
    assert order.with_shuffle_key(df, 1, "x", "y").select("shuffle_key").distinct().count() == 3


def test_cap_is_exact_and_only_a_filter(spark):
    from turnpress.sources.io import cap_rows

    df = spark.createDataFrame([(i * i * 977 - 10**6,) for i in range(3000)], "ord bigint").repartition(7)
    want = sorted(r["ord"] for r in df.collect())
    for n in (0, 1, 2999, 3000, 5000, 1234):
        assert sorted(r["ord"] for r in cap_rows(df, n).collect()) == want[:n]
    assert "TakeOrdered" not in cap_rows(df, 1234)._jdf.queryExecution().toString()


def test_every_length_is_planned_quickly():
    import time

    start = time.perf_counter()
    plan = packing.length_runs([(n, n % 200 + 1) for n in range(1, 32769)], 32768)
    assert time.perf_counter() - start < 20
    assert sum(hi - lo for _, lo, hi, _, _ in plan) == sum(n % 200 + 1 for n in range(1, 32769))


def test_repeated_keys_are_not_packed(spark):
    tokens = spark.createDataFrame([("k", 3, [1, 2, 3], [1, 2, 3])] * 2, "shuffle_key string, n_tokens int, input_ids array<int>, labels array<int>")
    with pytest.raises(ValueError, match="not unique"):
        packing.place(tokens, 8)


def test_token_arrays_move_once(spark, tmp_path):
    """Rows in buckets of their key: bins come to them, and only the groups by bin shuffle arrays."""
    import re

    from turnpress.sources.io import stored_in_buckets

    rows = [(f"{i * 7919 % 1000:03d}", i % 5 + 1, [i] * (i % 5 + 1), [i] * (i % 5 + 1)) for i in range(300)]
    columns = "shuffle_key string, n_tokens int, input_ids array<int>, labels array<int>"
    df = spark.createDataFrame(rows, columns)
    path = str(tmp_path / "it's 100% here" / "tokens")
    df.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not written in buckets"):
        stored_in_buckets(spark, str(tmp_path / "plain"), "shuffle_key", lambda n: df)
    tables = {t.name for t in spark.catalog.listTables()}
    stored_in_buckets(spark, path, "shuffle_key", lambda n: df.repartition(n, "shuffle_key"))
    tokens = stored_in_buckets(spark, path, "shuffle_key", lambda n: pytest.fail("built again"))
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert sorted(map(tuple, tokens.collect())) == sorted(rows)
    odd = df.selectExpr("shuffle_key", "named_struct('a b', n_tokens, 'c:d', labels) AS `e ``f`")
    there = stored_in_buckets(spark, str(tmp_path / "odd"), "shuffle_key", lambda n: odd.repartition(n, "shuffle_key"))
    assert sorted(map(str, there.collect())) == sorted(map(str, odd.collect()))

    def exchanges(frame):
        return re.findall(r"Exchange hashpartitioning\((\w+?)#", frame._jdf.queryExecution().executedPlan().toString())

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(tokens.groupBy("shuffle_key").count()) == []
        bins, placed = packing.place(tokens, 8)
        packed = packing.build_packed(placed, 8, 99)
        assert sorted(exchanges(packed)) == ["bin", "shuffle_key"]
        plain = packing.build_packed(packing.place(df, 8)[1], 8, 99)
        assert sorted(map(str, packed.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_spread_bounds_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    from turnpress import session

    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    rows = session.spread(spark.read.parquet(str(tmp_path / "rows")))
    sizes = rows.rdd.glom().map(len).collect()
    assert max(sizes) <= 110 and sum(sizes) == 2000 and rows.distinct().count() == 2000


def test_nested_to_json_parses_once(spark):
    from turnpress.catalog import QUERIES

    found = QUERIES["nested_to_json"](spark, "/root/testdata/sf0.001")
    assert all("/nested-" in f for f in found.inputFiles()) and found.where("NOT same_key").count() == 0 < found.count()
