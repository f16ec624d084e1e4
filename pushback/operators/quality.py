"""Step-quality table: rows in / out of each pipeline step, and match rates of its joins.

The reference logs a kept-percentage after every filter and a match rate after
every join.  ``StepWatch`` gets them for free: every step's rows are counted by
metrics that ride along in the job that writes the table (``df.observe``), so no
row is read twice.  ``step_counts`` counts the same by a job of its own, for
steps that nothing writes.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

WATCHED = "step_no int, step string, rows_in long, rows_out long, pct_kept double, pct_matched double"


class StepWatch:
    """Counts the rows of named steps while a job runs over them.

    Call it on each step's result, in order, and use what it returns; after the
    job that writes the last one, ``table`` has the counts.  A step whose plan a
    job left out, because another input had no rows, has NULL counts.  The
    counts are Spark's observed metrics: a stage that is run again after an
    executor was lost adds its repeated tasks, so they are a log, not an audit.
    """

    def __init__(self):
        self.steps: list[tuple[str, Observation, bool]] = []

    def __call__(self, name: str, df: DataFrame, matched: Column | None = None, times: Column | None = None) -> DataFrame:
        """Watch a step; ``matched`` tells the rows that found a partner in the step's join.

        ``times``: the rows of the step that a row stands for (NULL: one).
        """
        seen = Observation()
        self.steps.append((name, seen, matched is not None))
        weight = F.lit(1) if times is None else F.coalesce(times, F.lit(1))

        def rows(of: Column) -> Column:
            return F.coalesce(F.sum(F.when(of, weight)), F.lit(0))

        hits = [] if matched is None else [rows(matched).alias("matched")]
        return df.observe(seen, rows(F.lit(True)).alias("rows"), *hits)

    def table(self, spark: SparkSession) -> DataFrame:
        rows, before = [], None
        for i, (name, seen, joined) in enumerate(self.steps):
            try:
                got = seen.get
            except Py4JJavaError:  # no metrics arrived: the step was not run
                got = {}
            n = got.get("rows")
            kept = 100.0 * n / before if n is not None and before else None
            hit = 100.0 * got["matched"] / n if joined and n else None
            rows.append((i, name, before, n, kept, hit))
            before = n
        return spark.createDataFrame(rows, WATCHED)


def step_counts(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(step_no, step, rows_in, rows_out, pct_kept)`` for an ordered list of stages.

    The first entry is the input; ``rows_in`` of a step is ``rows_out`` of the
    one before.  The window runs over one row per step.
    """
    parts = [df.agg(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.count(F.lit(1)).alias("rows_out"))
             for i, (name, df) in enumerate(steps)]
    t = reduce(DataFrame.unionByName, parts)
    w = Window.orderBy("step_no")
    t = t.withColumn("rows_in", F.lag("rows_out").over(w))
    return t.select("step_no", "step", "rows_in", "rows_out",
                    F.try_divide(F.col("rows_out") * F.lit(100.0), F.col("rows_in")).alias("pct_kept"))


def ramp_step_quality(core: DataFrame, p) -> DataFrame:
    """Quality table of the unimpeded ramp pipeline."""
    from pushback.plans.jobs import variant_steps
    steps = variant_steps(core, p, "unimp_ramp")
    names = ["input", "require_stand_runway", "taxi_time_band", "surface_count_limits", "non_null_times"]
    return step_counts([(n, df) for n, (_, df) in zip(names, steps)])
