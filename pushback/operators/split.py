"""Reproducible train/test labels and cross-validation resamples.

All labels come from a hash of ``gufi`` and a salt (see
:mod:`pushback.functions.hashing`): a flight keeps its label whatever the
partitioning, the executor count or a task retry, and no row ever moves
through the driver.
"""

from __future__ import annotations

import logging
import random
from typing import Any, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushback.functions.hashing import uniform01

log = logging.getLogger(__name__)


def resolve_seed(seed) -> int:
    """``'RANDOM'`` draws a seed once on the driver; anything else is used as is."""
    if seed == "RANDOM":
        return random.randint(0, 99999)
    return int(seed)


def _label(u) -> "F.Column":
    return F.when(u, F.lit("test")).otherwise(F.lit("train"))


def simple_split(df: DataFrame, test_size: float, seed: int, key: str = "gufi") -> DataFrame:
    """``group`` = 'test' with probability ``test_size``, else 'train'."""
    return df.withColumn("group", _label(uniform01(key, seed, "group") < F.lit(float(test_size))))


def montecarlo_split(df: DataFrame, test_size: float, seed: int, n_cv: int, key: str = "gufi") -> DataFrame:
    """Simple split plus ``test_0 … test_{n_cv-2}``, each an independent draw."""
    out = simple_split(df, test_size, seed, key)
    return out.select("*", *[(uniform01(key, seed, f"cv{k}") < F.lit(float(test_size))).alias(f"test_{k}")
                             for k in range(n_cv - 1)])


def rank_by_uniform(df: DataFrame, u: str, key: str, buckets: int | None = None) -> DataFrame:
    """Add ``_rank``: 0-based position of each row in the global order ``(u, key)``.

    ``u`` is uniform on [0, 1), so ``floor(u * buckets)`` is a range
    partitioning that needs no sampling and gives every bucket about the same
    number of rows.  Two levels: a tiny table of per-bucket counts gives each
    bucket its offset (one row per bucket, broadcast), and a row number inside
    each bucket completes the rank.  No one-partition window over the rows.
    """
    n = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = df.withColumn("_b", F.floor(F.col(u) * F.lit(n)).cast("int"))
    counts = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_b").orderBy(u, key)
    return (b.join(F.broadcast(offsets), "_b")
            .withColumn("_rank", F.col("_off") + F.row_number().over(within) - 1).drop("_b", "_off"))


def kfold_split(df: DataFrame, seed: int, n_cv: int, key: str = "gufi", exact: bool = False) -> DataFrame:
    """Shuffled k-fold: fold 0 is the main test group, fold k+1 is ``test_k``.

    By default folds come from ``floor(u * n_cv)`` of the key hash, so their
    sizes are equal in expectation.  ``exact=True`` ranks rows by ``(u, key)``
    and deals them round-robin (``rank % n_cv``): fold sizes then differ by at
    most one row, like a shuffled k-fold.
    """
    if exact:
        ranked = rank_by_uniform(df.withColumn("_u", uniform01(key, seed, "fold")), "_u", key)
        out = ranked.withColumn("_fold", (F.col("_rank") % F.lit(n_cv)).cast("int")).drop("_u", "_rank")
    else:
        fold = F.floor(uniform01(key, seed, "fold") * F.lit(n_cv)).cast("int")
        out = df.withColumn("_fold", fold)
    out = out.withColumn("group", _label(F.col("_fold") == 0))
    out = out.select("*", *[(F.col("_fold") == k + 1).alias(f"test_{k}") for k in range(n_cv - 1)])
    return out.drop("_fold")


def add_train_test_group(df: DataFrame, test_size: float, random_seed, params: Mapping[str, Any] | None = None,
                         key: str = "gufi") -> DataFrame:
    """Dispatch on ``params['cross_val']``: ``kfold``, ``montecarlo`` or a single split.

    ``kfold`` uses ``n_cv`` and warns when ``n_cv * test_size`` is not 1.
    An unknown algorithm or a missing ``n_cv`` falls back to the single split
    with a warning.
    """
    seed = resolve_seed(random_seed)
    cv = (params or {}).get("cross_val")
    if cv and "algo" in cv:
        algo = cv["algo"]
        n_cv = cv.get("n_cv")
        if algo == "kfold":
            if n_cv:
                if abs(n_cv * test_size - 1) > 0.01:
                    log.warning("test_size %s inconsistent with %s folds, using n_cv", test_size, n_cv)
                return kfold_split(df, seed, n_cv, key, exact=bool(cv.get("exact", False)))
            log.warning("kfold without n_cv: single split")
        elif algo == "montecarlo":
            if n_cv:
                return montecarlo_split(df, test_size, seed, n_cv, key)
            log.warning("montecarlo without n_cv: single split")
        else:
            log.warning("unknown cross_val algo %s: single split", algo)
    elif cv is not None:
        log.warning("cross_val without algo: single split")
    return simple_split(df, test_size, seed, key)


def group_sizes(df: DataFrame) -> DataFrame:
    """Rows per split group plus a ``total`` row."""
    per = df.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    tot = df.agg(F.lit("total").alias("group"), F.count(F.lit(1)).alias("n"))
    return per.unionByName(tot)
