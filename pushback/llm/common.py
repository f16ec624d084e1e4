"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task handles at a time; longer documents are handled alone.
SLICE_BYTES = 4 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


#: Rows and bytes of an Arrow batch: bounds what a Python worker holds, whatever the length of the rows.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(spark: SparkSession, share: int = 1) -> None:
    """Set the bounds; a ``share`` of 2 halves them, and so on."""
    for key, value in BATCHES.items():
        spark.conf.set(key, str(int(value) // share))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """A key of a row's content: rows that repeat an id with another text get another key."""
    return F.xxhash64(*columns)


def fold(column: str, crc_of: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; null for a null id."""
    return (F.crc32(F.col(crc_of).cast("string").cast("binary")) % modulus).alias(column)


#: What a worker remembers from task to task, by operator.
_REMEMBERED: dict[str, dict] = {}


def remembered(owner: str) -> dict:
    """Things that an operator keeps between the tasks of a worker; other operators' tasks drop them."""
    return _REMEMBERED.setdefault(owner, {})


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES, owner: str = "") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (binary) holds about ``max_bytes`` a piece.

    A worker serves one operator after another: what others remembered goes.
    """
    for name in [n for n in _REMEMBERED if n != owner]:
        del _REMEMBERED[name]
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(values), 0).cast(pa.int64()))
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space bytes; none for null."""
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (order counts)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= _MULTIPLIER
        out += hashes[k : k + count]
    return mixed(out)


#: A filter of keys has so many bits, in words of 64: at most 524,288 rows of two numbers, whatever the number of keys.
FILTER_BITS = 1 << 25


def _filter_place(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes of ``key`` (long), of bounded size: (filter_word, filter_bits).  Written."""
    placed = keys.select(_filter_place(key).alias("p"))
    return written(placed.groupBy(F.expr("p div 64").alias("filter_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("filter_bits")), "filter")


def may_hold(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """``df`` with ``__may``: whether ``key`` can be one of the filter's keys; never false for one that is.

    Rows without it need no exact look-up, so a join with many keys moves only
    the rows concerned (and a few others), not the whole texts of all rows.
    """
    at = df.withColumn("__filter_place", _filter_place(key))
    word = F.expr("__filter_place div 64")
    held = at.join(F.broadcast(bits), word == F.col("filter_word"), "left")  # bounded by FILTER_BITS
    bit = F.expr("shiftright(filter_bits, cast(__filter_place % 64 as int)) & 1L")
    return held.withColumn("__may", F.coalesce(bit == 1, F.lit(False))).drop("__filter_place", "filter_word", "filter_bits")


#: Folders that this application wrote and has not removed.
_WRITTEN: list[str] = []


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    import uuid

    from pushback.session import ensure_checkpoint_dir

    _WRITTEN.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def release(spark: SparkSession, needed: DataFrame) -> None:
    """Remove the scratch folders that ``needed`` does not read, and let Spark drop shuffle files that nothing refers to.

    For a pipeline between two stages: what the earlier stages wrote for
    themselves has no use once the next stage's input is safely written.
    """
    if not _WRITTEN:
        return
    read = needed.inputFiles()
    used = {p for p in _WRITTEN if any(f"{p.split(':', 1)[-1].rstrip('/')}/" in f for f in read)}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in [p for p in _WRITTEN if p not in used]:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _WRITTEN.remove(p)
    gc.collect()
    jvm.System.gc()


def written(df: DataFrame, kind: str = "llm") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage for good."""
    spark = df.sparkSession
    path = scratch(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
