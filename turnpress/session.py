"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("turnpress")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach: the session's checkpoint folder, or one in its warehouse."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_stages")


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Lost executors re-read files instead of re-running the stages above.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 100_000
"""Most rows of a task in costly row-wise work, on average."""


def spread(scan: DataFrame) -> DataFrame:
    """A scan with at least one partition per core and per ``TASK_ROWS`` rows, for row-wise work that is CPU-bound.

    A few small files would otherwise keep most cores idle, and splits by bytes hold millions of
    rows where these are short; splits also end with row groups, so that some hold none. Rows
    are counted in the files' footers. A scan that already has the partitions is left alone and
    not shuffled.
    """
    wanted = max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // TASK_ROWS))
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted)


def sealed(df: DataFrame) -> DataFrame:
    """A boundary for costly columns: what stands above uses their values as they are.

    Without it the optimiser moves a later filter below the projection that computes
    its columns, or merges projections, and the same parse runs several times per row.
    A partition id that is both computed and tested here keeps the two sides apart; it
    costs no shuffle and no copy.
    """
    return df.selectExpr("*", "spark_partition_id() AS _part").where("_part >= 0").drop("_part")
