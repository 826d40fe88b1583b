"""Orders, splits and training plans over whole tables."""

from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.registry import query
from turnpress.catalog.reports import EVAL_SIZE, SEED
from turnpress.operators import order
from turnpress.operators.permutation import FACTOR, FACTOR_2, PRIME, PRIME_2, ROUNDS, TRIED, Permutation
from turnpress.operators.tokenize import token_lengths
from turnpress.session import new_path

EPOCHS, WORLD, MICRO, GLOBAL = 2, 4, 2, 16


@query("seeded_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {sqltext.key("'42'", "doc_id")}) - 1 AS position FROM documents
""")
def seeded_shuffle(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return order.seeded_shuffle(docs, SEED, "doc_id").select("doc_id", "position")


@query("holdout_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {sqltext.key("'42'", "doc_id")}) <= {EVAL_SIZE} THEN 'eval' ELSE 'train' END AS split
FROM documents
""")
def holdout_split(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return order.holdout_split(order.with_shuffle_key(docs, SEED, "doc_id"), EVAL_SIZE).select("doc_id", "split")


@query("sort_length_desc", f"WITH {sqltext.RENDERED_DOC} SELECT ord, n_tokens FROM toks ORDER BY n_tokens DESC, ord")
def sort_length_desc(spark, sf_dir):
    lengths = token_lengths(inputs.documents(spark, sf_dir))
    return order.sort_length_desc(lengths.select("ord", F.col("n_tokens").cast("bigint").alias("n_tokens")))


def _permuted(rows: str, passes: int = 4) -> str:
    """CTEs from ``rows(event_id, epoch, number)`` to ``placed``, with the place in the epoch's permutation.

    Rounds of ``permutation.py`` spelled out; a place beyond the table is sent through again.
    """
    low = "CAST(floor(sqrt(greatest(n - 1, 0))) AS BIGINT) + 1"
    out = f"""
side AS (
  SELECT n, arg_min(a, CAST((a - n % a) % a AS HUGEINT) * 10000000000 + a) AS a
  FROM (SELECT n, unnest(range({low}, {low} + least({TRIED}, greatest(1, ({low}) // 4)))) AS a FROM (SELECT count(*) AS n FROM {rows} WHERE epoch = 0) c) t GROUP BY n),
p0 AS (SELECT event_id, epoch, n, a, (n + a - 1) // a AS b, number AS v FROM {rows}, side)"""
    for p in range(passes):
        now = f"SELECT *, v % a AS l, v // a AS r FROM p{p}"
        for i in range(ROUNDS):
            to, other, size = (("l", "r", "a"), ("r", "l", "b"))[i % 2]
            key = f"(epoch * {FACTOR} + {(SEED * 16807 + (i + 1) * FACTOR_2) % PRIME}) % {PRIME}"
            shifted = f"(({other} + {key}) % {PRIME})"
            moved = f"(({shifted} * {shifted} % {PRIME} + {key}) * {FACTOR_2} % {PRIME_2})"
            now = f"SELECT * REPLACE (({to} + {moved} % {size}) % {size} AS {to}) FROM ({now}) x"
        again = "l + a * r" if p == 0 else "CASE WHEN v < n THEN v ELSE l + a * r END"
        out += f",\np{p + 1} AS (SELECT event_id, epoch, n, a, b, {again} AS v FROM ({now}) x)"
    return f"{out},\nplaced AS (SELECT event_id, epoch, n AS total, v AS position FROM p{passes})"


_SHARDS = f"""
WITH numbers AS (
  SELECT event_id, CAST(epoch AS INTEGER) AS epoch, row_number() OVER (PARTITION BY epoch ORDER BY event_id) - 1 AS number
  FROM events, range({EPOCHS}) e(epoch)), {_permuted("numbers")},
shards AS (
  SELECT event_id, epoch, position, CAST(position % {WORLD} AS INTEGER) AS rank, position // {WORLD} AS index, total
  FROM placed WHERE position < total - total % {WORLD})"""


def shards(spark, sf_dir):
    """Two epochs of all event ids on four ranks."""
    return order.epoch_shard_plan(inputs.table(spark, sf_dir, "events"), "event_id", EPOCHS, WORLD, SEED)


@query("epoch_shard_plan", f"{_SHARDS} SELECT event_id, epoch, position, rank, index FROM shards")
def epoch_shard_plan(spark, sf_dir):
    return shards(spark, sf_dir).select("event_id", "epoch", "position", "rank", "index")


@query("eval_shard_plan", f"""
WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY {sqltext.key("'42'", "doc_id")}) - 1 AS position FROM documents)
SELECT doc_id, position, CAST(position % {WORLD} AS INTEGER) AS rank, position // {WORLD} AS index FROM placed
""")
def eval_shard_plan(spark, sf_dir):
    docs = order.with_shuffle_key(inputs.table(spark, sf_dir, "documents"), SEED, "doc_id")
    return order.eval_shard_plan(docs, "doc_id", WORLD).select("doc_id", "position", "rank", "index")


_BATCHES = f"""
{_SHARDS},
batches AS (
  SELECT event_id, epoch, rank, position, epoch * (total // {GLOBAL}) + index // {MICRO * (GLOBAL // MICRO // WORLD)} + 1 AS step,
    CAST((index // {MICRO}) % {GLOBAL // MICRO // WORLD} AS INTEGER) AS slot
  FROM shards WHERE index // {MICRO * (GLOBAL // MICRO // WORLD)} < total // {GLOBAL})"""


@query("batch_plan", f"{_BATCHES} SELECT event_id, epoch, rank, step, slot FROM batches")
def batch_plan(spark, sf_dir):
    plan = order.batch_plan(shards(spark, sf_dir), GLOBAL, MICRO, WORLD)
    return plan.select("event_id", "epoch", "rank", "step", "slot")


@query("rank_plan", f"{_BATCHES} SELECT event_id, epoch, position, step, slot FROM batches WHERE rank = 1")
def rank_plan(spark, sf_dir):
    """All steps of one rank: places by arithmetic, ids from a stored numbering."""
    path = new_path(spark, "numbering")
    n = order.write_numbering(inputs.table(spark, sf_dir, "events"), "event_id", path)
    permutation = Permutation(n, SEED, EPOCHS)
    ask = (1, WORLD, GLOBAL)
    steps = (1, n // GLOBAL * EPOCHS)
    plan = order.rank_plan(spark, permutation, *ask, MICRO, *steps)
    asked = order.asked_numbers(permutation, *ask, *steps)
    found = order.ids_of(spark.read.parquet(path), plan, asked)
    return found.select("event_id", "epoch", "position", "step", "slot")


@query("schedule_summary", f"""
SELECT count(*) // {GLOBAL} AS steps_per_epoch, count(*) // {GLOBAL} * {EPOCHS} AS total_steps,
  greatest(1, CAST(floor(0.03 * (count(*) // {GLOBAL} * {EPOCHS})) AS BIGINT)) AS warmup_steps,
  CAST({GLOBAL // MICRO // WORLD} AS BIGINT) AS accumulation
FROM events
""")
def schedule_summary(spark, sf_dir):
    """Steps per epoch, total and warm-up of the plan above."""
    rows = inputs.table(spark, sf_dir, "events").agg(F.count("*").alias("n_rows"))
    return order.schedule(rows, GLOBAL, MICRO, WORLD, EPOCHS)


