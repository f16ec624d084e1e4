"""Sharding by jump consistent hashing.

A document's key (its id) alone decides its shard for any number of shards:
the jump hash needs no ring table, spreads keys evenly, and when shards are
appended it moves only the keys that the new shards get (a share of
``1 / (n + 1)`` for one more), never between old shards.

Places inside a shard (``slot``) follow the order of a 64-bit mix of id, size
and checksum.  Equal rows are counted before the shuffle and get consecutive
places; a shard is cut into buckets of that order, so neither a hot id, nor
copies of one row, nor a whole shard meets in one task: only the buckets'
counts are summed along the shard.

Only narrow columns are shuffled.  ``write_shards`` writes the documents
themselves, ``append_shards`` writes only the documents that new shards get,
and ``read_shard`` reads one shard of such a folder.

Edge cases: a null text has no bytes (size 1, the checksum of nothing); an
empty text likewise; a text of any length is only measured, by built-in
functions; a null id is one key like any other; rows that repeat an id share
its shard, equal rows get places of their own; an empty table gives no rows;
other columns are kept by ``write_shards`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mixed, table, written

SHARDS = 16
#: Rows that a task puts in order at a time, and copies of one row that it writes out at a time.
BUCKET_ROWS, COPIES = 100_000, 10_000
#: The key that stands for a null id.
_NO_ID = 0x6E756C6C

_KEYED = "doc_id long, size long, text_crc32 long, shard int, grown_shard int, place long"


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (0 to ``shards - 1``) of each 64-bit key: a key jumps ahead until it would land beyond the last shard."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = mixed(keys.astype(np.uint64))
    shard = np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead = (shard[moving] + 1) * (2147483648.0 / draw)
        go = ahead < shards
        moving = moving[go]
        shard[moving] = ahead[go].astype(np.int64)
    return shard


def _keys(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.fill_null(_NO_ID)).astype(np.int64).view(np.uint64)


def shard_of(doc_id: Column, shards: int) -> Column:
    """The shard of an id, as a column."""

    @F.pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        return pd.Series(jump(ids.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return of(F.coalesce(doc_id.cast("long"), F.lit(_NO_ID)))


def _assign(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, size, crc = _keys(batch.column("doc_id")), np.asarray(batch.column("size")), np.asarray(batch.column("text_crc32"))
        place = mixed(mixed(keys) ^ mixed(size.view(np.uint64) << np.uint64(32) ^ crc.view(np.uint64)))
        out = [*batch.columns, pa.array(jump(keys, shards), pa.int32()), pa.array(jump(keys, shards + 1), pa.int32()),
               pa.array((place >> np.uint64(1)).view(np.int64))]
        yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in _KEYED.split(", ")])


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, size, text_crc32, shard, grown_shard (with one shard more), place (order of slots)."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"))
    return narrow.mapInArrow(lambda it: _assign(it, shards), _KEYED)


def with_slots(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, copies: int = COPIES) -> DataFrame:
    """Rows of ``assign`` with ``slot``: their gapless place in their shard, from 0, by ``place``."""
    columns = [c for c in rows.columns if c != "place"]
    distinct = written(rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("n")), "shard-rows")
    total = distinct.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    buckets = total // bucket_rows + 1
    bucketed = distinct.withColumn("bucket", F.expr(f"cast(place / 9223372036854775808D * {buckets} as long)"))
    sums = bucketed.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    along = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("shard", "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("place", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    first = bucketed.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, ["shard", "bucket"])
    first = first.select(*columns, "n", (F.col("before") + F.col("inside")).alias("first"))
    # rows with many copies are dealt out in pieces
    many = first.where(F.col("n") > copies).withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {copies})")))
    many = many.repartition("doc_id", "size", "text_crc32", "piece").select(
        *columns, (F.col("first") + F.col("piece") * copies).alias("first"), F.expr(f"least(n - piece * {copies}, {copies}L)").alias("n"))
    few = first.where(F.col("n") <= copies).select(*columns, "first", "n").unionByName(many.select(*columns, "first", "n"))
    return few.select(*columns, F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all columns of ``docs`` to ``path``, one folder per shard; an existing folder is an error."""
    docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).write.partitionBy("shard").parquet(path)


def append_shards(spark: SparkSession, path: str, old: int, new: int) -> None:
    """Grow a folder of ``write_shards`` from ``old`` to ``new`` shards: only documents of the added shards are written.

    The documents that move stay in the old shards' files as well until these
    are rewritten; ``read_shard`` leaves them out.
    """
    stored = spark.read.parquet(path).where(F.col("shard") < old)
    moved = stored.withColumn("shard", shard_of(F.col("doc_id"), new)).where(F.col("shard") >= old)
    # a shard of its own folder each, so that a run that is repeated replaces what a lost one left
    moved.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shards: int, shard: int) -> DataFrame:
    """One shard's documents while ``shards`` shards are in use."""
    stored = spark.read.parquet(path).where(F.col("shard") == shard)
    return stored.where(shard_of(F.col("doc_id"), shards) == shard).drop("shard")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slots(assign(table(spark, sf_dir, "documents"), SHARDS))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _mix(x: str) -> str:
    """The 64-bit mix of ``common.mixed``, in DuckDB."""
    step = "((xor(a, a >> 33)::UHUGEINT * c::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"
    steps = f"list_reduce([{x}, 18397679294719823053::UBIGINT, 14181476777654086739::UBIGINT], lambda a, c: {step})"
    return f"list_reduce([{steps}, 33::UBIGINT], lambda a, c: xor(a, a >> 33))"


ORACLE = fr"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY b) AS tab FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
             lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS t(b))),
t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 1853189228)::UBIGINT AS k, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT r, doc_id, k, length(x) // 2 + 1 AS size, list_transform(range(length(x) // 2), lambda i:
             16 * position(x[2 * i + 1] IN '0123456789ABCDEF') + position(x[2 * i + 2] IN '0123456789ABCDEF') - 17) AS bytes FROM t),
d AS (SELECT r, doc_id, k, size, xor(list_reduce(list_concat([4294967295], bytes),
             lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM b, crc),
j AS (SELECT k, {_mix('k')} AS state, 0::BIGINT AS shard FROM (SELECT DISTINCT k FROM d)
      UNION ALL
      SELECT k, state, floor(ahead)::BIGINT FROM
        (SELECT k, state, (shard + 1) * (2147483648.0::DOUBLE / ((state >> 33) + 1)::DOUBLE) AS ahead FROM
          (SELECT k, shard, ((state::UHUGEINT * 2862933555777941757 + 1) % 18446744073709551616::UHUGEINT)::UBIGINT AS state FROM j))
      WHERE ahead < {SHARDS + 1}),
s AS (SELECT k, max(shard) FILTER (shard < {SHARDS}) AS shard, max(shard) AS grown FROM j GROUP BY k),
m AS (SELECT d.*, shard, grown, xor({_mix('k')}, {_mix('xor((size::UBIGINT * 4294967296::UBIGINT), crc::UBIGINT)')}) AS seed FROM d JOIN s USING (k))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard, grown::INT AS grown_shard,
       (row_number() OVER (PARTITION BY shard ORDER BY {_mix('seed')} >> 1, doc_id NULLS FIRST, size, crc) - 1)::BIGINT AS slot
FROM m
"""
