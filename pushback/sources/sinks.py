"""Sinks: feature tables, predictions, models, tuning results.

All tables are Parquet with the airport in their path, so a job for one
airport never touches another's: tables with an ``airport_icao`` column are
partitioned by it and only the partitions written are replaced; others go to
an ``airport_icao=…`` folder of their own.  Paths include the model variant,
so unimpeded and impeded predictions never overwrite each other.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

AIRPORT = "airport_icao"


def table_path(root: str, kind: str, variant: str) -> str:
    return f"{root.rstrip('/')}/{kind}/{variant}"


def airport_folder(path: str, airports: Sequence[str]) -> str:
    """Folder of a table that has no airport column (several airports make one folder name)."""
    return f"{path}/{AIRPORT}={'+'.join(sorted(airports))}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (AIRPORT,),
                mode: str = "overwrite", airports: Sequence[str] = ()) -> str:
    """Write ``df``; returns ``path``.

    ``overwrite`` replaces only what the table's own airports had before:
    partitions present in ``df``, or the folder of ``airports``.
    """
    cols = [c for c in partition_by if c in df.columns]
    writer = df.write.mode(mode)
    if cols:
        writer.partitionBy(*cols).option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.parquet(airport_folder(path, airports) if airports else path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> str:
    """Write a catalog table bucketed and sorted by ``key``; returns its name.

    Tables with equal ``key`` and ``buckets`` join, and group by ``key``, without
    a shuffle.  Rows go to their bucket's task first: one file per bucket (and
    partition), not one per task.  Choose ``buckets`` so that one fits in a task.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    return table


def write_feature_table(df: DataFrame, root: str, variant: str) -> str:
    """Intermediate table ``data_engred_<variant>`` (e.g. ``unimp_ramp``)."""
    return write_table(df, table_path(root, "data_engred", variant))


def write_predictions(df: DataFrame, root: str, variant: str) -> str:
    return write_table(df, table_path(root, "predictions", variant))


def save_model(model, root: str, variant: str, airports: Sequence[str] = ()) -> str:
    """Save anything with ``save(path)`` (a fitted model with its clones, rules, encoders and answers)."""
    path = table_path(root, "models", variant)
    return model.save(airport_folder(path, airports) if airports else path)


def write_tuning_results(df: DataFrame, root: str, variant: str, airports: Sequence[str] = ()) -> str:
    return write_table(df.coalesce(1), table_path(root, "tuning", variant), (), airports=airports)
