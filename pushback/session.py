"""Spark session settings shared by tests, the bench and the jobs.

On a cluster the session is created by the platform; ``tune`` only adds the
SQL settings this library relies on (UTC, AQE).  ``local_session`` is for
tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet pushdown of timestamp_ntz predicates and nested pruning.
    "spark.sql.parquet.filterPushdown": "true",
}


#: Wide rows (about 1 KB in a sort) that a shuffle's partition should hold at most on average.
ROWS_PER_PART = 250_000
FIRST_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    for k, v in SQL_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pushback", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PUSHBACK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, as named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and Spark already uses it.  Only
    when nothing is set and the master is local (tests) a fresh scratch folder
    is created and registered; on a cluster a missing setting is an error,
    because each executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    if named:
        if sc is not None:
            sc.setCheckpointDir(named)
        return named
    if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="pushback-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:
        pass
    return path


def deal_by_size(df: DataFrame) -> int:
    """Let the session's shuffles begin with a partition for every ``ROWS_PER_PART`` rows of ``df``.

    With a fixed number of partitions the rows that a task sorts grow with the
    input; adaptive execution joins small partitions but never adds any.  The
    session's number is only raised, never lowered, and stays as it is for small
    inputs and where adaptive execution does not join partitions.  Costs a count
    of ``df``; returns the number that shuffles begin with.
    """
    conf = df.sparkSession.conf
    have = int(conf.get(FIRST_PARTS, None) or conf.get("spark.sql.shuffle.partitions"))
    if "false" in (conf.get("spark.sql.adaptive.enabled"), conf.get("spark.sql.adaptive.coalescePartitions.enabled")):
        return int(conf.get("spark.sql.shuffle.partitions"))
    parts = -(-df.count() // ROWS_PER_PART)
    if parts > have:
        conf.set(FIRST_PARTS, str(parts))
    return max(parts, have)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage at a stage boundary: write Parquet to the checkpoint folder, read it back.

    The folder is the shared one named by ``spark.checkpoint.dir``, so a lost
    executor does not force a recomputation of the upstream plan, and later
    statistics steps do not re-run it either.  Unlike an RDD checkpoint the
    read-back is columnar: later steps get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
