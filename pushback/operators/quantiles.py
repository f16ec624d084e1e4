"""Exact quantiles by distributed rank selection.

``F.percentile`` keeps one counter per distinct value of a group in one task.
Here a value's rank is found in steps instead: values are counted, and an
order-preserving bucket (a fixed share of an octave, so it does not depend on
the data) groups them.  Running counts over the buckets of a group, of which
there are a bounded number, tell which buckets hold the wanted ranks.  Those
buckets are cut again, evenly between their own smallest and largest value, so
that values with a large offset (times, ids), which all fall into one bucket,
are spread as well; only the values of the cells that hold a wanted rank are
ordered.  No task ever holds a group's values.  Infinite values have buckets of
their own at either end.

Results interpolate linearly between neighbours, like ``F.percentile``.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per octave; a bucket spans 0.02 % of its values.
PER_OCTAVE = 4096
#: Above the largest exponent times ``PER_OCTAVE``, so that buckets of one sign keep their sign.
_SHIFT = 5_000_000
#: Cells into which a bucket's own range is cut.
CELLS = 65_536


def _bucket(x: Column) -> Column:
    infinite = F.abs(x) == float("inf")
    finite = F.when(infinite, 1.0).otherwise(F.abs(x))  # evaluated for every row
    size = F.when(infinite, F.lit(3 * _SHIFT)).otherwise(F.floor(F.log2(finite) * PER_OCTAVE) + _SHIFT)
    return F.when(x == 0, F.lit(0).cast("long")).otherwise(F.signum(x).cast("long") * size)


def _cell(x: Column, low: Column, high: Column) -> Column:
    """Place of a value between its bucket's ends; a bucket of one value (infinite ones too) is one cell."""
    width = F.when(high > low, high - low)
    return F.coalesce(F.floor((x - low) / width * (CELLS - 1)), F.lit(0)).cast("long")


def _holds(places: Column, first: Column, end: Column) -> Column:
    """Whether one of the places, or its neighbour, lies in the ranks from ``first`` to ``end``."""
    return F.exists(places, lambda x: ((F.floor(x) >= first) & (F.floor(x) < end)) | ((F.ceil(x) >= first) & (F.ceil(x) < end)))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, (left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys))


def exact_quantiles(df: DataFrame, values: Mapping[str, tuple[Column, Sequence[float]]],
                    by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of several expressions per group.

    ``values``: name -> (expression, probabilities).  Returns ``by`` and, per
    name, an array of doubles in the order of its probabilities.  NULL and NaN
    are ignored; a group without any value has no row (one all-NULL row when
    ``by`` is empty), a name without any value in its group is NULL.
    """
    by = list(by)
    group = [*by, "q_name"]
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("q_name"), c.cast("double").alias("q_value"))
                                  for n, (c, _) in values.items()]))
    rows = df.select(*by, stacked.alias("q")).select(*by, "q.q_name", "q.q_value")
    counts = (rows.where(F.col("q_value").isNotNull() & ~F.isnan("q_value")).groupBy(*group, "q_value")
              .agg(F.count(F.lit(1)).alias("q_n")).withColumn("q_bucket", _bucket(F.col("q_value"))))
    in_group = Window.partitionBy(*group)
    buckets = counts.groupBy(*group, "q_bucket").agg(
        F.sum("q_n").alias("q_in"), F.min("q_value").alias("q_low"), F.max("q_value").alias("q_high")).select(
        *group, "q_bucket", "q_in", "q_low", "q_high",
        (F.sum("q_in").over(in_group.orderBy("q_bucket")) - F.col("q_in")).alias("q_before"),
        F.sum("q_in").over(in_group).alias("q_total"))
    probabilities = reduce(lambda e, n: e.when(F.col("q_name") == n, F.array(*[F.lit(float(p)) for p in values[n][1]])),
                           values, F).otherwise(F.lit(None).cast("array<double>"))
    places = F.transform(probabilities, lambda p: p * (F.col("q_total") - 1))
    wanted = buckets.withColumn("q_places", places).where(_holds(F.col("q_places"), F.col("q_before"), F.col("q_before") + F.col("q_in")))
    wanted = wanted.select(*[F.col(k).alias(f"w_{k}") for k in (*group, "q_bucket")], "q_low", "q_high", "q_before", "q_places")
    near = counts.join(wanted, _same(counts, wanted, [*group, "q_bucket"], "w_"))
    near = near.select(*group, "q_bucket", "q_value", "q_n", "q_before", "q_places",
                       _cell(F.col("q_value"), F.col("q_low"), F.col("q_high")).alias("q_cell"))
    # the same once more among the cells of a bucket
    cell = [*group, "q_bucket", "q_cell"]
    cells = near.groupBy(*cell).agg(F.sum("q_n").alias("q_in"), F.first("q_before").alias("q_before"), F.first("q_places").alias("q_places"))
    along = F.sum("q_in").over(Window.partitionBy(*group, "q_bucket").orderBy("q_cell"))
    cells = cells.withColumn("q_from", F.col("q_before") + along - F.col("q_in"))
    cells = cells.where(_holds(F.col("q_places"), F.col("q_from"), F.col("q_from") + F.col("q_in")))
    cells = cells.select(*[F.col(k).alias(f"c_{k}") for k in cell], F.col("q_from").alias("q_start"))
    near = near.join(cells, _same(near, cells, cell, "c_")).select(*cell, "q_value", "q_n", "q_start", "q_places")
    running = F.sum("q_n").over(Window.partitionBy(*cell).orderBy("q_value"))
    near = near.withColumn("q_end", F.col("q_start") + running).select(
        *group, "q_value", (F.col("q_end") - F.col("q_n")).alias("q_from"), "q_end",
        F.posexplode("q_places").alias("q_i", "q_place"))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("q_from")) & (rank < F.col("q_end")), F.col("q_value")))

    lo, hi = F.floor("q_place"), F.ceil("q_place")
    ends = near.groupBy(*group, "q_i", "q_place").agg(at(lo).alias("q_lo"), at(hi).alias("q_hi"))
    value = F.when(F.col("q_lo") == F.col("q_hi"), F.col("q_lo")).otherwise(
        (hi - F.col("q_place")) * F.col("q_lo") + (F.col("q_place") - lo) * F.col("q_hi"))
    found = ends.withColumn("q_result", value)

    def one(name: str, i: int) -> Column:
        return F.max(F.when((F.col("q_name") == name) & (F.col("q_i") == i), F.col("q_result")))

    arrays = []
    for name, (_, ps) in values.items():
        whole = F.array(*[one(name, i) for i in range(len(ps))])
        arrays.append(F.when(one(name, 0).isNotNull(), whole).alias(name))
    return found.groupBy(*by).agg(*arrays)


def exact_medians(df: DataFrame, values: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Median of several expressions per group, as plain columns."""
    out = exact_quantiles(df, {n: (c, [0.5]) for n, c in values.items()}, by)
    return out.select(*by, *[F.get(n, F.lit(0)).alias(n) for n in values])
