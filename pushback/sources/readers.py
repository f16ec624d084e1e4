"""Readers: time-chunked reads, typed CSV, empty-tolerant reads.

The reference reads its database in N-day chunks to bound memory.  On Spark a
chunk becomes a *partition* of one read: JDBC gets one predicate per
half-open chunk (read in parallel by the executors), Parquet gets a plain
range filter that prunes files / row groups.  Chunks are half-open so a flight
on a boundary is read exactly once.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.session import materialize

TS = T.TimestampNTZType()
S = T.StringType()
D = T.DoubleType()
B = T.BooleanType()


def _fields(names: list[str], typ) -> list[T.StructField]:
    return [T.StructField(n, typ, True) for n in names]


# Schema of the flight summary as saved by the ingest step (forced types).
FLIGHT_SUMMARY_SCHEMA = T.StructType(
    _fields(["actual_arrival_ramp_taxi_time", "actual_arrival_ama_taxi_time",
             "actual_departure_ramp_taxi_time", "actual_departure_ama_taxi_time",
             "actual_departure_full_taxi_time"], D)
    + _fields(["gufi", "carrier", "acid"], S)
    + _fields(["departure_stand_initial_time"], TS)
    + _fields(["aircraft_type", "arrival_aerodrome_icao_name", "departure_aerodrome_icao_name"], S)
    + _fields(["isarrival", "isdeparture"], B)
    + _fields(["arrival_stand_actual"], S)
    + _fields(["arrival_stand_actual_time", "arrival_stand_airline_time"], TS)
    + _fields(["arrival_spot_actual"], S)
    + _fields(["arrival_movement_area_actual_time"], TS)
    + _fields(["arrival_runway_actual"], S)
    + _fields(["arrival_runway_actual_time"], TS)
    + _fields(["departure_stand_actual"], S)
    + _fields(["departure_stand_actual_time", "departure_stand_airline_time"], TS)
    + _fields(["departure_spot_actual"], S)
    + _fields(["departure_movement_area_actual_time"], TS)
    + _fields(["departure_runway_actual"], S)
    + _fields(["departure_runway_actual_time"], TS)
    + _fields(["airport_icao"], S)
)

RUNWAY_ACTUALS_SCHEMA = T.StructType(
    _fields(["gufi"], S) + _fields(["departure_runway_actual_time"], TS) + _fields(["departure_runway_actual"], S)
    + _fields(["arrival_runway_actual_time"], TS) + _fields(["arrival_runway_actual"], S)
    + _fields(["airport_icao"], S))

ESTIMATES_SCHEMA = T.StructType(
    _fields(["gufi"], S) + _fields(["isarrival", "isdeparture"], B) + _fields(["acid"], S)
    + _fields(["departure_stand_initial_time"], TS)
    + _fields(["departure_aerodrome_icao_name", "arrival_aerodrome_icao_name"], S)
    + _fields(["undelayed_departure_ramp_transit_time", "undelayed_departure_ama_transit_time",
               "undelayed_departure_total_transit_time"], D))

# Schema of the raw runway-use source.
RAW_RUNWAYS_SCHEMA = T.StructType(
    _fields(["gufi", "departure_aerodrome_iata_name", "arrival_aerodrome_iata_name", "departure_runway_actual"], S)
    + _fields(["departure_runway_actual_time"], TS) + _fields(["arrival_runway_actual"], S)
    + _fields(["arrival_runway_actual_time"], TS) + _fields(["points_on_runway"], B))

SPEED_FRACTION_SCHEMA = T.StructType(_fields(["gufi"], S) + _fields(["fraction_speed_gte_threshold"], D))


def time_chunks(start: str, end: str, days: int) -> list[tuple[str, str]]:
    """Half-open ``[lo, hi)`` chunks of ``days`` covering ``[start, end]``.

    The last chunk ends one microsecond after ``end`` so the inclusive end of
    the query window is kept.
    """
    fmt = "%Y-%m-%d %H:%M:%S"
    lo = dt.datetime.strptime(start, fmt)
    stop = dt.datetime.strptime(end, fmt) + dt.timedelta(microseconds=1)
    out = []
    while lo < stop:
        hi = min(lo + dt.timedelta(days=days), stop)
        out.append((lo.strftime("%Y-%m-%d %H:%M:%S.%f"), hi.strftime("%Y-%m-%d %H:%M:%S.%f")))
        lo = hi
    return out


def chunk_predicates(time_cols: str | Sequence[str], start: str, end: str, days: int) -> list[str]:
    """One SQL predicate per chunk, for ``spark.read.jdbc(predicates=…)``.

    A row qualifies by any of ``time_cols`` inside the window, and is read by
    the chunk of the first of them that is inside, so it is read exactly once.
    """
    cols = [time_cols] if isinstance(time_cols, str) else list(time_cols)

    def inside(col: str) -> str:
        return f"({col} >= TIMESTAMP '{start}' AND {col} <= TIMESTAMP '{end}')"

    def taken(k: int, lo: str, hi: str) -> str:
        own = f"{cols[k]} >= TIMESTAMP '{lo}' AND {cols[k]} < TIMESTAMP '{hi}'"
        earlier = [f"({c} IS NULL OR NOT {inside(c)})" for c in cols[:k]]
        return " AND ".join([*earlier, own])

    return [" OR ".join(f"({taken(k, lo, hi)})" for k in range(len(cols))) for lo, hi in time_chunks(start, end, days)]


def read_jdbc_chunked(spark: SparkSession, url: str, table: str, time_cols: str | Sequence[str],
                      start: str, end: str, chunk_days: int, properties: dict) -> DataFrame:
    """Parallel JDBC read, one partition per time chunk (30 days, 5 for positions)."""
    preds = chunk_predicates(time_cols, start, end, chunk_days)
    return spark.read.jdbc(url=url, table=table, predicates=preds, properties=properties)


def in_window(time_cols: str | Sequence[str], start: str, end: str) -> Column:
    """Any of ``time_cols`` inside ``[start, end]`` (NULL times are outside)."""
    cols = [time_cols] if isinstance(time_cols, str) else list(time_cols)
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return reduce(Column.__or__, (F.col(c).between(lo, hi) for c in cols))


def read_parquet_window(spark: SparkSession, path: str, time_cols: str | Sequence[str], start: str, end: str) -> DataFrame:
    """Parquet read limited to ``[start, end]``; pruned by partition / row-group stats."""
    return spark.read.parquet(path).where(in_window(time_cols, start, end))


def read_parquet_chunked(spark: SparkSession, path: str, time_cols: str | Sequence[str], start: str, end: str,
                         chunk_days: int) -> list[DataFrame]:
    """The window as one frame per chunk, for jobs that load a long history step by step.

    The union of the frames is :func:`read_parquet_window`.
    """
    df = spark.read.parquet(path)
    as_ntz = (p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '") for p in chunk_predicates(time_cols, start, end, chunk_days))
    return [df.where(p) for p in as_ntz]


#: Column that holds the text of a record that does not fit its schema.
BAD_RECORD = "__record"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


class BadRecords(ValueError):
    """More records than allowed do not fit the schema."""


def _csv(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str, mode: str) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: the header has no column {', '.join(missing)}")
    known = {f.name: f for f in schema.fields}
    in_file = [known.get(name, T.StructField(name, S, True)) for name in header]
    kept = [T.StructField(BAD_RECORD, S, True)] if mode == "PERMISSIVE" else []
    return (spark.read.schema(T.StructType(in_file + kept)).option("header", True).option("enforceSchema", False)
            .option("mode", mode).option("columnNameOfCorruptRecord", BAD_RECORD)
            .option("timestampNTZFormat", timestamp_format).csv(path))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """CSV with header and explicit types: no inference, stands and runways stay text.

    Columns are bound by the header's names, in any order; columns that the
    schema does not know are left out, and a missing one is an error.  Every
    file's header is checked against the first one's.  A value that does not
    fit its type is an error when the row is read, never a NULL;
    :func:`read_checked_csv` sets such records aside instead.
    """
    return _csv(spark, path, schema, timestamp_format, "FAILFAST").select(*schema.fieldNames())


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, quarantine: str, most_bad: int | float = 0,
                     timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """The records of a CSV that fit ``schema``; all others are set aside, whole.

    Records with a malformed value, or with too few or too many values, go to
    the Parquet folder ``quarantine`` as ``(file, record)``, replacing those of an
    earlier read of the same path.  ``most_bad`` is how many are allowed: a count,
    or (a float) a share of all records; beyond it ``BadRecords`` names the worst
    files, after the records were written.  The text is parsed once: the parsed
    rows are written at this stage boundary.
    """
    parsed = _csv(spark, path, schema, timestamp_format, "PERMISSIVE")
    parsed = materialize(parsed.select(*schema.fieldNames(), BAD_RECORD, F.col("_metadata.file_path").alias("__file")))
    bad = parsed.where(F.col(BAD_RECORD).isNotNull()).select(F.col("__file").alias("file"), F.col(BAD_RECORD).alias("record"))
    bad.write.mode("overwrite").parquet(quarantine)
    total, wrong = parsed.agg(F.count(F.lit(1)), F.count(BAD_RECORD)).first()
    if wrong > (most_bad * total if isinstance(most_bad, float) else most_bad):
        worst = spark.read.parquet(quarantine).groupBy("file").count().orderBy(F.desc("count"), "file").limit(5).collect()
        raise BadRecords(f"{wrong} of {total} records of {path} do not fit, see {quarantine}: "
                         + ", ".join(f"{r['file']} ({r['count']})" for r in worst))
    return parsed.where(F.col(BAD_RECORD).isNull()).select(*schema.fieldNames())


def read_or_empty(spark: SparkSession, path: str | None, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read ``path``; a source that does not exist gives an empty frame of ``schema``.

    Spark itself opens the path, so any file system it knows works; every
    other failure stays an error.
    """
    if path is None:
        return spark.createDataFrame([], schema)
    try:
        if fmt == "csv":
            return read_typed_csv(spark, path, schema)
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
