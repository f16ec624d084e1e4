"""Exact substring deduplication by super-k-mers.

A window is ``k`` consecutive words of one text.  Its minimiser is the smallest
hash among its runs of ``m`` words (leftmost on ties).  Consecutive windows
with the same minimiser travel together as one packed string (a super-k-mer,
about three times shorter than a window each) to the bucket of their
minimiser.  Equal windows have equal minimisers at equal places, so a bucket
sees all copies of its windows; there strings with one minimiser are sorted
and windows counted exactly, by their words.  Every word covered by a window
that also starts elsewhere is removed.

Skew: a task first joins equal strings of its own; such copies are certain, one
of them travels as a representative and the others' places go on to a bucket of
their document.  A first pass counts the strings of each minimiser over all
texts; the windows of minimisers with more than ``heavy`` strings travel one by
one under a hash of all ``k`` words, so a passage in a third of all texts is
spread over many buckets.  The set of heavy minimisers is broadcast; its size
is bounded, as its limit rises so that no more than ``MOST_HEAVY`` can reach it.
A bucket gets about ``bucket_bytes`` of text.

The texts themselves travel once, packed, to buckets of their rows, and meet
the runs of repeated words there.

Edge cases: null and empty texts have no words; texts of fewer than ``k`` words
keep all; two rows with one id and one text are copies of one another, so they
lose all windows, and each stays a row; rows with a null id take part like any
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, mixed, row_key, slices, table, word_hashes, words_of, written

K, M = 35, 5
HEAVY, MOST_HEAVY, BUCKET_BYTES = 20_000, 1_000_000, 16 << 20
SLICE = 4 << 20

#: A super-k-mer that travels: its place, its windows, where its minimiser lies, and whether copies are known.
_ENTRY = np.dtype([("key", "<u8"), ("doc_row", "<i8"), ("doc_id", "<i8"), ("no_id", "?"), ("sure", "?"),
                   ("start", "<i8"), ("windows", "<i4"), ("at", "<i4")])
#: Words of a text known to be repeated.
_PLACE = np.dtype([("doc_row", "<i8"), ("doc_id", "<i8"), ("no_id", "?"), ("first", "<i8"), ("end", "<i8")])


def _span_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words, by doubling."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out, done, power, size = np.zeros(count, np.uint64), 0, hashes, 1
    while n:
        if n & 1:
            out = mixed(out ^ power[done:done + count])
            done += size
        n >>= 1
        if n:
            power = mixed(power[:-size] * np.uint64(3) + power[size:])
            size *= 2
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each run of ``width`` values."""
    at, size = np.arange(len(values)), 1

    def join(shift: int) -> None:
        nonlocal values, at
        right = values[shift:] < values[:-shift]
        values = np.where(right, values[shift:], values[:-shift])
        at = np.where(right, at[shift:], at[:-shift])

    while size * 2 <= width:
        join(size)
        size *= 2
    if size < width:
        join(width - size)
    return at


class _Cut:
    """The super-k-mers of a slice of texts: word index of the first, number of windows, minimiser's place and hash."""

    def __init__(self, texts: list[bytes | None], k: int, m: int):
        split = [words_of(t) for t in texts]
        self.words = [w for own in split for w in own]
        self.ends = np.cumsum([0, *map(len, split)])
        hashes = word_hashes(self.words)
        self.windows = _span_hashes(hashes, k)
        n = len(self.windows)
        if not n:
            self.first = self.count = self.at = self.key = self.doc = np.empty(0, np.int64)
            return
        grams = gram_hashes(hashes, m)
        least = _least(grams, k - m + 1)
        doc = np.searchsorted(self.ends, np.arange(n), side="right") - 1
        valid = np.flatnonzero(np.arange(n) + k <= self.ends[doc + 1])
        new = np.ones(len(valid), bool)
        new[1:] = (valid[1:] != valid[:-1] + 1) | (least[valid[1:]] != least[valid[:-1]])
        begin = np.flatnonzero(new)
        self.first, self.count = valid[begin], np.diff(np.append(begin, len(valid)))
        self.at, self.key, self.doc = least[self.first] - self.first, grams[least[self.first]], doc[self.first]

    def single(self, heavy: np.ndarray) -> None:
        """Split the super-k-mers of heavy minimisers into windows of their own."""
        if not len(heavy) or not len(self.first):
            return
        slot = np.minimum(np.searchsorted(heavy, self.key), len(heavy) - 1)
        is_heavy = heavy[slot] == self.key
        if not is_heavy.any():
            return
        each = self.count[is_heavy]
        first = np.repeat(self.first[is_heavy], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        rest = ~is_heavy
        self.key = np.concatenate([self.key[rest], self.windows[first]])
        self.at = np.concatenate([self.at[rest], np.zeros(len(first), np.int64)])
        self.doc = np.concatenate([self.doc[rest], np.repeat(self.doc[is_heavy], each)])
        self.count = np.concatenate([self.count[rest], np.ones(len(first), np.int64)])
        self.first = np.concatenate([self.first[rest], first])


def _minimisers(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    """How many different super-k-mers each minimiser has in a slice."""
    for batch in slices(batches, "text", SLICE):
        cut = _Cut(batch.column("text").to_pylist(), k, m)
        if len(cut.first):
            span = mixed(cut.windows[cut.first] ^ mixed(cut.windows[cut.first + cut.count - 1] ^ cut.count.astype(np.uint64)))
            order = np.lexsort((span, cut.key))
            key, span = cut.key[order], span[order]
            different = np.append(True, (key[1:] != key[:-1]) | (span[1:] != span[:-1]))
            keys, n = np.unique(key[different], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


_PACKED = "bucket long, strings binary, entries binary, places binary"


def _pack(batches: Iterator[pa.RecordBatch], k: int, m: int, heavy: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in slices(batches, "text", SLICE):
        cut = _Cut(batch.column("text").to_pylist(), k, m)
        cut.single(heavy)
        words = cut.words
        strings = [b" ".join(words[a:a + n + k - 1]) for a, n in zip(cut.first.tolist(), cut.count.tolist())]
        ids = batch.column("doc_id")
        no_id = np.asarray(ids.is_null())
        doc_id, doc_row = np.asarray(ids.fill_null(0)), np.asarray(batch.column("doc_row"))
        one: dict[bytes, int] = {}
        of = np.fromiter((one.setdefault(s, i) for i, s in enumerate(strings)), np.int64, len(strings))
        copies = np.bincount(of, minlength=len(strings)) if len(strings) else np.empty(0, np.int64)
        travels = np.flatnonzero(of == np.arange(len(strings)))
        entries = np.zeros(len(travels), _ENTRY)
        doc = cut.doc[travels]
        start = cut.first - cut.ends[cut.doc] if len(cut.first) else cut.first
        for name, values in (("key", cut.key[travels]), ("doc_row", doc_row[doc]), ("doc_id", doc_id[doc]), ("no_id", no_id[doc]),
                             ("sure", copies[travels] > 1), ("start", start[travels]), ("windows", cut.count[travels]), ("at", cut.at[travels])):
            entries[name] = values
        known = np.flatnonzero(copies[of] > 1)
        places = np.zeros(len(known), _PLACE)
        doc = cut.doc[known]
        for name, values in (("doc_row", doc_row[doc]), ("doc_id", doc_id[doc]), ("no_id", no_id[doc]),
                             ("first", start[known]), ("end", start[known] + cut.count[known] + k - 1)):
            places[name] = values
        bucket = (mixed(entries["key"]) % np.uint64(buckets)).astype(np.int64)
        home = _home(np.ascontiguousarray(places["doc_row"]), buckets)
        by_bucket, by_home = np.argsort(bucket, kind="stable"), np.argsort(home, kind="stable")
        bucket, home = bucket[by_bucket], home[by_home]
        out = []
        for b in np.unique(np.concatenate([bucket, home])).tolist():
            own = by_bucket[np.searchsorted(bucket, b):np.searchsorted(bucket, b, side="right")]
            place = by_home[np.searchsorted(home, b):np.searchsorted(home, b, side="right")]
            out.append((b, squeeze(b"\n".join([strings[i] for i in travels[own].tolist()])), squeeze(entries[own].tobytes()),
                        squeeze(places[place].tobytes())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.binary()] * 3))],
                                             names=["bucket", "strings", "entries", "places"])


def _repeated(strings: list[bytes], sure: list[bool], at: list[int], k: int) -> list[np.ndarray | None]:
    """Which windows of each super-k-mer of one minimiser occur more than once; None: none, all of the others."""
    weight: dict[bytes, int] = {}
    for s, known in zip(strings, sure):
        weight[s] = weight.get(s, 0) + (2 if known else 1)
    place = dict(zip(strings, at))
    marks: dict[bytes, np.ndarray | None] = {}
    if len(weight) == 1:
        marks = {s: np.ones(s.count(b" ") + 2 - k, bool) if n > 1 else None for s, n in weight.items()}
    else:
        windows = []
        for s, p in place.items():
            cuts = np.flatnonzero(np.frombuffer(s, np.uint8) == 32) + 1
            begins, stops = [0, *cuts.tolist()], [*(cuts - 1).tolist(), len(s)]
            n = len(begins) - k + 1
            marks[s] = np.full(n, weight[s] > 1)
            windows += [(p - i, s[begins[i]:stops[i + k - 1]], s, i) for i in range(n)]
        windows.sort(key=lambda w: w[:2])
        for a, b in zip(windows, windows[1:]):
            if a[:2] == b[:2]:
                marks[a[2]][a[3]] = marks[b[2]][b[3]] = True
    return [marks[s] for s in strings]


_FOUND = "home long, doc_id long, doc_row long, first long, end long"


def _home(doc_row: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a row."""
    return (mixed(doc_row.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _count(group: pa.Table, k: int, buckets: int) -> pa.Table:
    """The repeated words of a bucket: runs of windows that occur more than once."""
    expand = zstandard.ZstdDecompressor().decompress
    strings, entries, places = [], [np.empty(0, _ENTRY)], [np.empty(0, _PLACE)]
    for name, out, kind in (("entries", entries, _ENTRY), ("places", places, _PLACE)):
        out += [np.frombuffer(expand(x.as_py()), kind) for x in group.column(name)]
    for x in group.column("strings"):
        if len(whole := expand(x.as_py())):
            strings += whole.split(b"\n")
    entry, place = np.concatenate(entries), np.concatenate(places)
    order = np.argsort(entry["key"], kind="stable")
    keys = entry["key"][order]
    bounds = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    found = []
    for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(keys)]):
        if b - a < 2:
            continue
        own = order[a:b]
        sure = entry["sure"][own].tolist()
        marks = _repeated([strings[i] for i in own.tolist()], sure, entry["at"][own].tolist(), k)
        for i, known, mark in zip(own.tolist(), sure, marks):
            if known or mark is None or not mark.any():
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
            base = int(entry["start"][i])
            found += [(i, base + int(x), base + int(y) + k - 1) for x, y in zip(edge[::2], edge[1::2])]
    i = np.array([f[0] for f in found], np.int64)
    ids = pa.array(np.concatenate([entry["doc_id"][i], place["doc_id"]]), mask=np.concatenate([entry["no_id"][i], place["no_id"]]))
    doc_row = np.concatenate([entry["doc_row"][i], place["doc_row"]])
    return pa.table([pa.array(_home(doc_row, buckets)), ids, pa.array(doc_row),
                     pa.array(np.concatenate([np.array([f[1] for f in found], np.int64), place["first"]])),
                     pa.array(np.concatenate([np.array([f[2] for f in found], np.int64), place["end"]]))],
                    names=["home", "doc_id", "doc_row", "first", "end"])


def repeated_words(docs: DataFrame, buckets: int, k: int = K, m: int = M, heavy: int = HEAVY) -> DataFrame:
    """``docs`` (doc_id, doc_row, text as binary) -> home, doc_id, doc_row, first, end: runs of repeated words (word indexes)."""
    counts = docs.select("text").mapInArrow(lambda it: _minimisers(it, k, m), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = written(counts.where(F.col("n") > heavy), "heavy")
    # fewer than MOST_HEAVY minimisers can have so many of the strings
    strings = counts.agg(F.sum("n")).first()[0] or 0
    often = [r["key"] for r in counts.where(F.col("n") > strings // MOST_HEAVY).select("key").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(often, np.int64).view(np.uint64)))
    packed = docs.mapInArrow(lambda it: _pack(it, k, m, shared.value, buckets), _PACKED)
    return packed.groupBy("bucket").applyInArrow(lambda t: _count(t, k, buckets), _FOUND)


_TEXTS = "home long, doc_ids array<long>, doc_rows array<long>, lengths array<long>, texts binary"


def _send(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Whole texts, packed by the bucket of their row; the length of a null text is -1."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    types = (pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary())
    for batch in slices(batches, "text", SLICE):
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
        rows = np.asarray(batch.column("doc_row"))
        home, out = _home(rows, buckets), []
        for b in np.unique(home).tolist():
            own = np.flatnonzero(home == b).tolist()
            out.append((b, [ids[i] for i in own], rows[own].tolist(), [-1 if texts[i] is None else len(texts[i]) for i in own],
                        squeeze(b"".join(texts[i] or b"" for i in own))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                         names=["home", "doc_ids", "doc_rows", "lengths", "texts"])


_KEPT = "doc_id long, n_words long, n_removed long, kept binary"


def _remove(texts: pa.Table, runs: pa.Table, digest: bool) -> pa.Table:
    """A bucket's texts without their repeated words."""
    expand = zstandard.ZstdDecompressor().decompress
    gone: dict[tuple, list[tuple[int, int]]] = {}
    for doc, row, first, end in zip(*(runs.column(c).to_pylist() for c in ("doc_id", "doc_row", "first", "end"))):
        gone.setdefault((doc, row), []).append((first, end))
    ids, total, removed, kept = [], [], [], []
    for blob in texts.to_batches(max_chunksize=1):
        part = blob.to_pylist()[0]
        whole, start = expand(part["texts"]), 0
        for doc, row, length in zip(part["doc_ids"], part["doc_rows"], part["lengths"]):
            words = words_of(whole[start:start + max(length, 0)])
            start += max(length, 0)
            keep = np.ones(len(words), bool)
            for first, end in gone.get((doc, row), ()):
                keep[first:end] = False
            ids.append(doc)
            total.append(len(words))
            removed.append(int(len(words) - keep.sum()))
            left = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()] if removed[-1] else words)
            kept.append(hashlib.sha256(left).hexdigest().encode() if digest else left)
    return pa.table([pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, digest: bool = False, bucket_bytes: int = BUCKET_BYTES, **options) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, n_removed, kept: the kept words joined by one space, or their SHA-256."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("doc_row"),
                        F.col("text").cast("binary").alias("text"))
    buckets = (keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes + 1
    runs = repeated_words(keyed, buckets, **options)
    texts = keyed.mapInArrow(lambda it: _send(it, buckets), _TEXTS)
    kept = texts.groupBy("home").cogroup(runs.groupBy("home")).applyInArrow(lambda t, r: _remove(t, r, digest), _KEPT)
    return kept.withColumn("kept", F.col("kept").cast("string"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
w AS (SELECT r, unnest(range(1, len(ws) - 33)) AS i, unnest([array_to_string(ws[i:i + 34], ' ') FOR i IN range(1, len(ws) - 33)]) AS s
      FROM d WHERE len(ws) >= 35),
h AS (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM w),
x AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM h WHERE n > 1),
e AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (SELECT e.r, count(x.i) AS removed, string_agg(word, ' ' ORDER BY e.i) FILTER (x.i IS NULL) AS kept
      FROM e LEFT JOIN x ON x.r = e.r AND x.i = e.i GROUP BY e.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
