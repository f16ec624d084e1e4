"""Packing into fixed windows by non-negative least squares on the length histogram.

Documents become token ids plus an end id and are cut into pieces: whole
windows and one remainder.  Piece lengths are rounded up to bins of
``granularity`` tokens.  All combinations of up to ``depth`` bins that fill a
window exactly are enumerated; non-negative least squares finds how often to
use each so that the histogram of pieces is met; the counts are rounded, and
what the histogram has left is packed greedily (largest bin first, then the
largest that still fits).  Only the histogram (a count per bin, at most
``window / granularity`` of them) reaches the driver.

Pieces take their places by rank within their bin.  The rank is two-level: a
hashed bucket's offset plus the row number within the bucket, so no bin is ever
sorted by one task.

Edge cases: a null text is empty and becomes one piece that holds the end id;
very long texts give as many windows as they need; repeated rows and ties are
packed one by one (ranks among identical rows are interchangeable); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import remembered, slices, table, written

WINDOW, GRANULARITY, DEPTH, END_ID = 2048, 8, 3, 1
#: Rows of a bin in one bucket of the two-level rank, about.
BUCKET_ROWS = 50_000
#: Words whose ids a worker remembers; beyond it the memory starts anew.
CACHE_WORDS = 500_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordTokenizer:
    """Ids of whole texts for a tokenizer that never merges across ASCII white space; words are remembered."""

    def __init__(self, path: str, most: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.most = Tokenizer.from_file(path), {}, most

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        # case is dropped by the tokenizer, but its special tokens are matched before that
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        new = {w for words in split for w in words}.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = {w for words in split for w in words}
        # a comma or full stop after a letter or digit is a token of its own
        cores = {w: core for w in new if (core := w.rstrip(b".,")) != w and core[-1:].isalnum()}
        ends = {w[len(core):] for w, core in cores.items()}
        alone = list((new.difference(cores) | ends | set(cores.values())).difference(self.known))
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in alone], add_special_tokens=False)
        self.known.update((w, array("I", e.ids).tobytes()) for w, e in zip(alone, encoded))
        known = self.known
        known.update((w, known[core] + known[w[len(core):]]) for w, core in cores.items())
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _cut(batches: Iterator[pa.RecordBatch], path: str, window: int, words: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    known = remembered("pack")
    if (path, words) not in known:
        known[path, words] = WordTokenizer(path, words)
    tokenizer = known[path, words]
    end = np.array([END_ID], "<u4").tobytes()
    for batch in slices(batches, "text", 2 << 20, "pack"):
        rows = []
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts)):
            ids += end
            n = len(ids) // 4
            rows += [(doc_id, k, min(window, n - k), zlib.crc32(ids[4 * k:4 * (k + window)]), n) for k in range(0, n, window)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                         names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-8) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    limit = tolerance * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(4 * a.shape[0]):
        candidates = np.where(passive, -np.inf, gradient)
        j = int(candidates.argmax())
        if candidates[j] <= limit:
            break
        passive[j] = True
        while True:
            own = a[:, passive]
            normal = own.T @ own
            normal[np.diag_indices_from(normal)] += 1e-9  # columns may depend on one another
            s = np.zeros(n)
            s[passive] = np.linalg.solve(normal, own.T @ b)
            low = passive & (s <= 0)
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = np.where(passive, x + step * (s - x), 0.0)
            passive &= x > 1e-9
            x[~passive] = 0
        x = s
        gradient = a.T @ (b - a @ x)
    return x


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing runs of at most ``depth`` bins (1 to ``bins``) that sum to ``bins``."""
    def rest(left: int, most: int, depth: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif depth:
            for first in range(min(left, most), -(-left // depth) - 1, -1):
                yield from ((first, *more) for more in rest(left - first, first, depth - 1))
    return list(rest(bins, bins, depth))


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, repeats) that use up ``histogram`` (index: bin, from 1); a window holds ``len - 1`` bins."""
    bins, left = len(histogram) - 1, histogram.astype(np.int64).copy()
    out = []

    def take(combination: tuple[int, ...], most: int | None = None) -> None:
        parts, times = np.unique(combination, return_counts=True)
        repeats = int((left[parts] // times).min())
        repeats = repeats if most is None else min(repeats, most)
        if repeats > 0:
            left[parts] -= repeats * times
            out.append((combination, repeats))

    if left[1:].sum():
        choices = [c for c in combinations(bins, depth) if all(left[p] for p in c)]
        if choices:
            a = np.zeros((bins, len(choices)))
            for k, c in enumerate(choices):
                np.add.at(a[:, k], np.array(c) - 1, 1)
            x = nnls(a, left[1:].astype(float))
            for k in np.argsort(-x, kind="stable"):
                if (times := int(np.floor(x[k] + 0.5))) > 0:
                    take(choices[k], times)
    while (large := np.flatnonzero(left[1:])).size:
        combination, free = [], bins
        spare = left.copy()
        for b in (large + 1)[::-1].tolist():
            use = int(min(spare[b], free // b))
            combination += [b] * use
            free -= b * use
        take(tuple(combination))
    return out


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, words: int = CACHE_WORDS) -> DataFrame:
    """Cut ``docs`` (doc_id, text) into pieces of at most ``window`` ids."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda it: _cut(it, tokenizer, window, words), _PIECES)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, granularity: int = GRANULARITY, depth: int = DEPTH,
         words: int = CACHE_WORDS) -> DataFrame:
    """Place every piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A worker remembers the ids of at most ``words`` words.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, window, words), "pieces")
    bin_of = F.ceil(F.col("length") / granularity).cast("int")
    histogram = np.zeros(window // granularity + 1, np.int64)
    for r in cut.groupBy(bin_of.alias("bin")).count().collect():  # at most window / granularity rows
        histogram[r["bin"]] = r["count"]
    slots, used, sequence = [], np.zeros_like(histogram), 0
    for combination, repeats in plan(histogram, depth):
        for b, times in zip(*(v.tolist() for v in np.unique(combination, return_counts=True))):
            slots.append((b, int(used[b]), int(used[b]) + repeats * times, times, sequence))
            used[b] += repeats * times
        sequence += repeats
    buckets = int(histogram.max(initial=0)) // BUCKET_ROWS + 1
    dealt = cut.withColumns({"bin": bin_of, "bucket": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))})
    before = F.sum("n").over(Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = dealt.groupBy("bin", "bucket").agg(F.count("*").alias("n")).select(
        "bin", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("bin", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("rank", within).join(offsets, ["bin", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    # a bin takes part in a combination once, and combinations are bounded by the bins
    places = spark.createDataFrame(slots, "bin int, first long, last long, times long, sequence long")
    placed = ranked.join(F.broadcast(places), "bin").where("rank >= first AND rank < last").withColumn(
        "sequence_id", F.expr("sequence + (rank - first) div times"))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("bin"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
