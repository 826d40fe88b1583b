"""Permutations of epochs, plans of one rank, exact cuts with ties, first rows by narrow keys."""

import pytest
from pyspark.sql import functions as F

from turnpress.operators import dedup, order
from turnpress.operators.permutation import Permutation, unused
from turnpress.sources.io import cap_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 50, 97, 1009, 1371, 4096, 10007])
@pytest.mark.parametrize("seed", [0, 42, 2**40 + 1])
def test_every_epoch_is_a_permutation(n, seed):
    p = Permutation(n, seed, 3)
    a, b = p.sides
    assert n <= a * b
    places = [[p.place(i, e) for i in range(n)] for e in range(3)]
    assert all(sorted(x) == list(range(n)) for x in places)
    assert all(p.number(x[i], e) == i for e, x in enumerate(places) for i in range(0, n, 7))
    if n > 50:
        assert places[0] != places[1] != places[2] and places[0] != list(range(n))


def test_places_are_spread():
    """Neighbours part, and every tenth of the places holds about a tenth of any run of numbers."""
    p = Permutation(10007, 7, 1)
    places = [p.place(i, 0) for i in range(10007)]
    assert sum(abs(x - y) for x, y in zip(places, places[1:])) / 10006 == pytest.approx(10007 / 3, rel=0.05)
    for start in range(0, 10000, 1000):
        cells = [0] * 10
        for x in places[start : start + 1000]:
            cells[x * 10 // 10007] += 1
        assert all(60 < c < 140 for c in cells)


@pytest.mark.parametrize("n", [1, 7, 4013])
def test_columns_equal_numbers_and_run_backwards(spark, n):
    p = Permutation(n, 42, 2)
    rows = spark.range(n).withColumn("left", F.lit(1)).withColumn("epoch", F.lit(1))
    placed = p.with_number(p.with_place(rows, "id", "epoch"), "position", "epoch")
    got = placed.collect()
    assert len(got) == n and all(r["position"] == p.place(r["id"], 1) and r["number"] == r["id"] and r["left"] == 1 for r in got)


def test_walks_are_as_long_as_they_must_be():
    long = [p for n in range(2, 400) if (p := Permutation(n, 1, 4)).walk > 2]
    assert long
    for p in long:
        seen = 0
        for e in range(4):
            for i in range(p.n):
                v, steps = p._once(i, e), 1
                while v >= p.n:
                    v, steps = p._once(v, e), steps + 1
                seen = max(seen, steps)
        assert seen <= p.walk


def test_numbers_of_a_huge_table_come_without_it():
    p = Permutation(10**12 + 39, 42, 5)
    assert p.walk < 10
    for i in (0, 1, 10**11, 10**12):
        assert p.number(p.place(i, 4), 4) == i


def test_no_ids_no_plan(spark):
    assert order.epoch_shard_plan(spark.range(0), "id", 2, 4, 1).collect() == []


def test_a_null_id_and_ids_with_gaps_end_the_job(spark):
    with pytest.raises(Exception, match="NULL id"):
        order.epoch_shard_plan(spark.createDataFrame([(1,), (None,)], "id bigint"), "id", 1, 1, 1).collect()
    with pytest.raises(Exception, match="not 0..n-1"):
        order.epoch_shard_plan(spark.createDataFrame([(0,), (2,)], "id bigint"), "id", 1, 1, 1, is_dense=True).collect()


def test_epochs_cost_one_scan(spark):
    plan = plan_of(order.epoch_shard_plan(spark.range(1000), "id", 50, 4, 42))
    assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan and "Window" not in plan


@pytest.mark.parametrize("parts", [1, 5])
def test_a_plan_does_not_depend_on_partitions(spark, parts):
    ids = spark.range(0, 3000, 3)
    one = order.epoch_shard_plan(ids, "id", 2, 4, 42).orderBy("epoch", "position").collect()
    assert one == order.epoch_shard_plan(ids.repartition(parts), "id", 2, 4, 42).orderBy("epoch", "position").collect()


@pytest.mark.parametrize("asked", [(4, 20), (1, 10**6)])
def test_one_rank_plans_its_own_steps_without_a_table(spark, tmp_path, asked):
    ids = spark.range(1000, 5013).select((F.col("id") * 10).alias("doc"))
    path = str(tmp_path / "numbers")
    n = order.write_numbering(ids, "doc", path, chunk=100)
    p = Permutation(n, 7, 3)
    plan = order.rank_plan(spark, p, 2, 4, 24, 3, *asked)
    assert "Range" in plan_of(plan) and "Scan" not in plan_of(plan) and "Exchange" not in plan_of(plan)
    numbers = order.asked_numbers(p, 2, 4, 24, *asked)
    assert sorted(numbers) == sorted(r["number"] for r in plan.collect())
    found = order.ids_of(spark.read.parquet(path), plan, numbers, chunk=100)
    whole = order.batch_plan(order.epoch_shard_plan(ids, "doc", 3, 4, 7), 24, 3, 4)
    columns = ["doc", "epoch", "position", "rank", "index", "step", "slot"]
    want = whole.where(F.col("step").between(*asked) & (F.col("rank") == 2)).select(*columns)
    assert sorted(found.select(*columns).collect()) == sorted(want.collect())
    assert sorted(order.ids_of(spark.read.parquet(path), plan).select(*columns).collect()) == sorted(want.collect())


def test_few_numbers_read_few_folders(spark, tmp_path):
    path = str(tmp_path / "numbers")
    n = order.write_numbering(spark.range(5000), "id", path, chunk=100)
    p = Permutation(n, 7, 1)
    plan = order.rank_plan(spark, p, 0, 2, 8, 4, 3, 3)
    found = order.ids_of(spark.read.parquet(path), plan, order.asked_numbers(p, 0, 2, 8, 3, 3), chunk=100)
    assert found.count() == 4
    listed = plan_of(found).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "chunk" in listed and "IN (" in listed and listed.count(",") <= 4


# --- exact cuts with ties ---

def repeated(spark, parts, orders=(1, 2, None)):
    rows = [(o, f"text {i // 4}", {"a": i // 4}) for o in orders for i in range(40)]
    return spark.createDataFrame(rows, "ord bigint, body string, more map<string,int>").repartition(parts)


@pytest.mark.parametrize("n", [3, 40, 57])
def test_cap_rows_is_exact_where_ord_repeats(spark, n):
    def capped(parts):
        return sorted(str(r) for r in cap_rows(repeated(spark, parts, (1, 2)), n).collect())

    got = capped(3)
    assert len(got) == n and got == capped(7)
    assert sum("ord=1" in r for r in got) == min(n, 40)


def test_cap_rows_takes_as_many_equal_rows_as_are_missing(spark):
    df = spark.createDataFrame([(1, "x")] * 10 + [(0, "y")], "ord bigint, body string").withColumn("place", F.lit(5)).repartition(4)
    rows = cap_rows(df, 4).collect()
    assert sorted((r["ord"], r["body"], r["place"]) for r in rows) == [(0, "y", 5)] + [(1, "x", 5)] * 3


@pytest.mark.parametrize("size", [3, 25, 99])
def test_holdout_is_exact_where_keys_repeat(spark, size):
    def held(parts):
        df = repeated(spark, parts, (1, 2)).select("ord", "body")
        out = order.holdout_split(order.with_shuffle_key(df, 42, "ord"), size)
        assert out.count() == 80
        return sorted(map(str, out.where("split = 'eval'").collect()))

    assert len(held(3)) == min(size, 80) and held(3) == held(8)


def test_order_statistics_over_all_of_64_bits(spark):
    values = [-(2**62), 2**62, 0, 5, 5, 5, -7]
    df = spark.createDataFrame([(v,) for v in values], "ord bigint")
    for n, v in enumerate(sorted(values), 1):
        value, taken, count = order.order_cutoff(df, n)
        assert (value, count) == (v, values.count(v)) and sorted(values)[:n].count(v) == taken
    assert order.order_cutoff(df, 8) is None


# --- first rows by narrow keys ---

def wide(spark):
    rows = [(f"k{i % 50}", i % 3, None if i % 17 == 0 else i % 11, f"text {i}" * 20) for i in range(600)]
    rows += [("k1", 0, 0, "same")] * 40 + [("hot", 1, i, "h") for i in range(300)]
    return spark.createDataFrame(rows, "key string, source_rank int, ord bigint, messages string")


@pytest.mark.parametrize("limit", [10**6, 200, 0])
def test_first_rows_whatever_is_broadcast(spark, limit):
    df = wide(spark)
    got = sorted(map(str, dedup.dedup_first(df.repartition(5), limit).collect()))
    best = {}
    for r in df.collect():
        order_ = (r["source_rank"], r["ord"] is not None, r["ord"] or 0)
        best.setdefault(r["key"], []).append((order_, r))
    assert len(got) == len(best) == 51
    for rows in best.values():
        least = min(o for o, _ in rows)
        assert any(str(r) in got for o, r in rows if o == least)
    assert got == sorted(map(str, dedup.dedup_first(df.repartition(2), limit).collect()))


def test_no_message_is_shuffled_by_key(spark):
    df = wide(spark)
    keyed = dedup.with_row_id(df.withColumn("row_id", F.lit("taken")), *unused(df.withColumn("row_id", F.lit(0)), "row_id", "row_tie"))
    narrow = plan_of(dedup.first_rows(dedup.with_row_id(df)))
    assert "Exchange hashpartitioning(key" in narrow
    below = narrow[narrow.index("Exchange hashpartitioning(key"):]
    assert "messages" not in below.split("Project", 1)[0]
    plan = plan_of(dedup.dedup_first(df))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert set(dedup.dedup_first(keyed).columns) == set(keyed.columns)
