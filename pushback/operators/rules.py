"""Row quality rules: which rows a model may answer, and why not.

For each core feature:

* ``Unknown <f>`` – a one-hot core feature whose value was not seen in the
  training rows, or is listed in ``category_exclusions`` (compared as text);
* ``Missing <f>`` – NULL, NaN or blank.

After prediction, ``Negative prediction`` flags values below zero.  Rows
failing any rule get the default answer (train median of the target).

The training vocabulary is a DataFrame (``feature, value``, and the airport
where the rows have one) joined back with a left join, not a Python list: it
never goes through the driver.  It holds one row per category; it is learnt
from all training rows of an airport, whatever flag restricts the rows that a
model is fitted on.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.operators.filters import airports_of


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, NaN (of a number) or blank text; the text ``nan`` is a category like any other."""
    c = F.col(name)
    missing = c.isNull() | (F.trim(c.cast("string")) == "")
    return missing | F.isnan(c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else missing


def vocabulary(train: DataFrame, features: Sequence[str],
               exclusions: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Distinct non-missing training values per feature (and airport) minus the exclusions.

    Returns a long table ``(airport_icao, feature, value)`` with values as
    text; without the airport where ``train`` has none.
    """
    exclusions = exclusions or {}
    by = airports_of(train)
    parts = []
    for f in features:
        v = train.where(~is_missing(train, f)).select(*by, F.lit(f).alias("feature"),
                                                      F.col(f).cast("string").alias("value")).distinct()
        ex = [str(x) for x in exclusions.get(f, [])]
        if ex:
            v = v.where(~F.col("value").isin(ex))
        parts.append(v)
    return reduce(DataFrame.unionByName, parts)


def add_rule_columns(df: DataFrame, features_core: Sequence[str], known_features: Sequence[str],
                     vocab: DataFrame | None, prefix: str = "") -> DataFrame:
    """Add ``<prefix>error_msg`` (array of reasons) and ``<prefix>missing_core_features``.

    ``known_features`` are the core features that must take a training value.
    """
    out = df
    by = airports_of(vocab) if vocab is not None else []
    reasons = []
    for f in features_core:
        miss = is_missing(df, f)
        if f in known_features and vocab is not None:
            flag = f"__known_{f}"
            voc = vocab.where(F.col("feature") == f).select(
                *[F.col(c).alias(f"__by_{c}") for c in by], F.col("value").alias(f"__v_{f}"), F.lit(True).alias(flag))
            same = reduce(Column.__and__, (F.col(c) == F.col(f"__by_{c}") for c in by), F.col(f).cast("string") == F.col(f"__v_{f}"))
            out = out.join(voc, same, "left").drop(f"__v_{f}", *[f"__by_{c}" for c in by])
            reasons.append(F.when(~miss & F.col(flag).isNull(), F.lit(f"Unknown {f}")))
        reasons.append(F.when(miss, F.lit(f"Missing {f}")))
    msg = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    out = out.withColumn(f"{prefix}error_msg", msg)
    out = out.withColumn(f"{prefix}missing_core_features", F.size(F.col(f"{prefix}error_msg")) > 0)
    return out.drop(*[c for c in out.columns if c.startswith("__known_")])


def apply_default(df: DataFrame, pred_col: str, default: Column, prefix: str = "") -> DataFrame:
    """Replace predictions of failing rows (or negative ones) by the default answer.

    Negative predictions append ``Negative prediction`` to the reasons.
    """
    neg = F.coalesce(F.col(pred_col) < 0, F.lit(False))
    msg_col = f"{prefix}error_msg"
    out = df.withColumn(msg_col, F.when(neg, F.array_append(F.col(msg_col), F.lit("Negative prediction")))
                        .otherwise(F.col(msg_col)))
    bad = F.col(f"{prefix}missing_core_features") | neg | F.col(pred_col).isNull() | F.isnan(F.col(pred_col))
    return out.withColumn(pred_col, F.when(bad, default).otherwise(F.col(pred_col)))
