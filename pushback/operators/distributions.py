"""Training-set feature distributions per terminal, as long tables.

The reference draws a pair-plot image per terminal.  Here the numbers behind
it are tables: 1-D value counts, 2-D contingency counts for every feature
pair, the colour-scale break points, and the per-terminal low-count filter.
Each table is one ``groupBy`` over rows stacked by feature (or feature pair)
with a single explode, so adding features adds rows, not jobs.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushback.functions.codes import terminal_of_stand, zero_pad_gate
from pushback.functions.timecols import hour_bin
from pushback.operators import filters


def training_rows_per_terminal(df: DataFrame, min_flights: int = 50,
                               stand: str = "departure_stand_actual",
                               binned: Sequence[str] = (), training_only: bool = True) -> DataFrame:
    """Terminal from the stand, one-digit gates zero-padded, busy terminals only,
    then the training rows (unimpeded ones when the flag exists).

    ``binned`` time columns are replaced by their hour of day.  Without
    ``training_only`` the rows of all split groups stay.
    """
    out = df.withColumn("terminal", terminal_of_stand(stand)).withColumn(stand, zero_pad_gate(stand))
    for c in binned:
        out = out.withColumn(c, hour_bin(c))
    out = filters.busy_values(out, "terminal", min_flights)
    if not training_only:
        return out
    sel = F.col("group") == "train"
    if "unimpeded_AMA" in out.columns:
        sel = sel & F.coalesce(F.col("unimpeded_AMA"), F.lit(False))
    return out.where(sel)


def supported_rows(df: DataFrame, features: Sequence[str], divisor: float = 100.0) -> DataFrame:
    """Rows whose every feature value is common enough within its terminal."""
    return filters.common_categories(df, features, divisor, by=["terminal"])


def low_count_values(df: DataFrame, features: Sequence[str], divisor: float = 100.0) -> DataFrame:
    """Values dropped by :func:`supported_rows`: ``(terminal, feature, value, n)``."""
    c = feature_counts(df, features)
    top = c.groupBy("terminal", "feature").agg(F.max("n").alias("_top"))
    return c.join(top, ["terminal", "feature"]).where(F.col("n") < F.col("_top") / F.lit(divisor)).drop("_top")


def feature_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """1-D counts ``(terminal, feature, value, n)``; NULL values are not counted."""
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    st = df.select("terminal", F.explode(arr).alias("s")).select("terminal", "s.feature", "s.value")
    return st.where(F.col("value").isNotNull()).groupBy("terminal", "feature", "value").agg(
        F.count(F.lit(1)).alias("n"))


def feature_pair_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """2-D counts for each feature pair (i < j): ``(terminal, feature_x, value_x, feature_y, value_y, n)``."""
    pairs = list(combinations(features, 2))
    arr = F.array(*[F.struct(F.lit(a).alias("feature_x"), F.col(a).cast("string").alias("value_x"),
                             F.lit(b).alias("feature_y"), F.col(b).cast("string").alias("value_y"))
                    for a, b in pairs])
    st = df.select("terminal", F.explode(arr).alias("s")).select("terminal", "s.*")
    st = st.where(F.col("value_x").isNotNull() & F.col("value_y").isNotNull())
    return st.groupBy("terminal", "feature_x", "value_x", "feature_y", "value_y").agg(F.count(F.lit(1)).alias("n"))


def count_scale(pair_counts: DataFrame) -> DataFrame:
    """Colour-scale break points per (terminal, feature pair).

    ``min, min+r/50, min+r/20, min+r/5, min+r/2, max`` with ``r = max-min``,
    truncated to integers.
    """
    g = pair_counts.groupBy("terminal", "feature_x", "feature_y").agg(
        F.min("n").cast("double").alias("vmin"), F.max("n").cast("double").alias("vmax"))
    r = F.col("vmax") - F.col("vmin")
    pts = [F.col("vmin"), r / 50 + F.col("vmin"), r / 20 + F.col("vmin"), r / 5 + F.col("vmin"),
           r / 2 + F.col("vmin"), F.col("vmax")]
    return g.select("terminal", "feature_x", "feature_y",
                    *[F.floor(x).cast("long").alias(f"b{i}") for i, x in enumerate(pts)])


def missing_values(all_rows: DataFrame, train_rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Values present in a terminal's rows but absent from its training rows."""
    a = feature_counts(all_rows, features).select("terminal", "feature", "value")
    t = feature_counts(train_rows, features).select("terminal", "feature", "value")
    return a.join(t, ["terminal", "feature", "value"], "left_anti")
