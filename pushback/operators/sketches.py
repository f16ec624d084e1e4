"""Mergeable quantile states (KLL sketches), opt-in beside the exact quantiles.

A state has a bounded size whatever the number of rows, so a job can keep one
per airport and day and a later run over a month merges states instead of
reading rows.  The rank of an answer is off by a share of the rows that ``k``
bounds (about 0.5 % at 800); smallest and largest value are exact.  Built-in
functions only; states are aggregated before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: larger is more exact.
K = 800


def quantile_states(df: DataFrame, value: Column, by: Sequence[str], k: int = K) -> DataFrame:
    """``by``, n (values counted) and state per group; NULL and NaN are ignored, a group without values has no row."""
    rows = df.select(*by, value.cast("double").alias("q_value")).where("q_value IS NOT NULL AND NOT isnan(q_value)")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("q_value", k).alias("state"))


def merge_states(states: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """States of coarser groups; merging again later is allowed."""
    return states.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("state", k).alias("state"))


def quantiles_of(states: DataFrame, probabilities: Sequence[float], name: str = "quantiles") -> DataFrame:
    """Replace the state by an array of quantiles, in the order of ``probabilities``."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return states.withColumn(name, F.kll_sketch_get_quantile_double("state", asked)).drop("state")
