"""Periodic runs of words by the dictionary of basic factors.

A run is a stretch of consecutive words of one text with smallest period ``q``
and at least ``2 * q`` words that no neighbouring word extends.

Every factor of 2, 4, 8, ... words gets a name from the names of its two
halves, so that equal names mean equal factors of one text.  A factor that
occurs once in its text cannot begin or continue a repeat; it is dropped, so
ordinary prose leaves the dictionary after a few levels.

At length ``L`` the occurrences of a factor are read in order.  Occurrences at
most ``L / 2`` apart form an arithmetic progression (their distance is the
factor's smallest period).  A run of period ``q``, ``L <= q < 2 * L``, holds a
factor and its copy ``q`` words on; the two lie in different progressions
(otherwise the run had a smaller period) that are at most three apart (steps
between progressions are longer than ``L / 2``).  So all differences between
such progressions, within twice the length, propose every period: as many as
there are occurrences, not as there are pairs.  Each proposal is extended to
both sides by common factors from the longest level down; runs found more than
once are joined and keep their smallest period.

The work is one pass over the texts without a shuffle.  A slice of texts is
handled at a time; a text longer than a slice is handled alone, in memory that
is proportional to its words times the levels that still hold a repeat.

Edge cases: null and empty texts have no words and no runs; their collapsed
text is empty; rows that repeat an id or a text, and rows with a null id, are
judged one by one; runs of the same words with several periods count once, with
the smallest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, words_of

MIN_LENGTH = 12

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])
_RUNS = ("doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")


class _Level:
    """The factors of one length that occur again in their text: a name by place (-1: none), places by (name, place)."""

    def __init__(self, at: np.ndarray, key: np.ndarray, n: int):
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
        again = ~(first & np.append(first[1:], True)) if len(key) else first
        self.name = np.full(n + 1, -1, np.int64)
        self.at, rank = at[order[again]], np.cumsum(first)[again]
        self.name[self.at] = rank
        self.rank = rank


def _levels(words: np.ndarray, doc: np.ndarray) -> list[_Level]:
    """The dictionary of basic factors; ``words`` are numbers, ``doc`` the text of each."""
    n = len(words)
    levels = [_Level(np.arange(n), doc * (words.max(initial=0) + 1) + words, n)]
    while len(levels[-1].at):
        half, size = levels[-1], 1 << (len(levels) - 1)
        at = np.sort(half.at)
        at = at[at + size <= n]
        at = at[half.name[at + size] >= 0]  # a factor over the end of a text occurs once, so it gets no name
        levels.append(_Level(at, half.name[at] * (n + 1) + half.name[at + size], n))
    return levels[:-1]


def _proposals(level: _Level, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods (``size`` to ``2 * size - 1``) that the progressions of this level propose."""
    at, rank = level.at, level.rank
    begin = np.flatnonzero(np.append(True, (rank[1:] != rank[:-1]) | (2 * (at[1:] - at[:-1]) > size)))
    count = np.diff(np.append(begin, len(at)))
    first, last, name = at[begin], at[begin + count - 1], rank[begin]
    step = np.where(count > 1, at[np.minimum(begin + 1, len(at) - 1)] - first, 0)
    places, periods = [], []
    for apart in (1, 2, 3):
        a, b = np.arange(max(len(begin) - apart, 0)), np.arange(apart, max(len(begin), apart))
        near = (name[a] == name[b]) & (first[b] - last[a] < 2 * size) & (last[b] - first[a] >= size)
        a, b = a[near], b[near]
        least, by = first[b] - last[a], np.maximum(step[a], step[b])
        each = np.maximum(by, 1)
        low = np.maximum(-((least - size) // each), 0)
        high = np.minimum((2 * size - 1 - least) // each, np.where(by > 0, count[a] + count[b] - 2, 0))
        total = np.maximum(high - low + 1, 0)
        own = np.repeat(np.arange(len(a)), total)
        turn = low[own] + np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        back = np.maximum(turn - (count[b][own] - 1), 0)  # beyond the second progression: earlier in the first
        places.append(last[a][own] - back * by[own])
        periods.append(least[own] + turn * by[own])
    place, period = np.concatenate(places), np.concatenate(periods)
    fits = (period >= size) & (period < 2 * size)
    place, period = place[fits], period[fits]
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    # neighbours with one period lie in one stretch
    lone = np.append(True, (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 1)) if len(place) else np.empty(0, bool)
    return place[lone], period[lone]


def _common(levels: list[_Level], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``i`` on equal those from ``j`` on (or those before them)."""
    n, got = len(levels[0].name) - 1, np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        name, size = levels[k].name, 1 << k
        x, y = (i + got, j + got) if forward else (i - got - size, j - got - size)
        own = np.where((x >= 0) & (x < n), name[np.clip(x, 0, n)], -1)
        other = np.where((y >= 0) & (y < n), name[np.clip(y, 0, n)], -2)
        got += np.where((own >= 0) & (own == other), size, 0)
    return got


def find_runs(words: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and period of all runs, by start, then period; ``words`` and ``doc`` as numbers."""
    levels = _levels(words, doc)
    found = [np.empty((0, 3), np.int64)]
    for k, level in enumerate(levels):
        place, period = _proposals(level, 1 << k)
        start = place - _common(levels, place, place + period, False)
        end = place + period + _common(levels, place, place + period, True)
        run = end - start >= np.maximum(2 * period, min_length)
        found.append(np.stack([start[run], end[run], period[run]], axis=1))
    start, end, period = np.concatenate(found).T
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    one = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else np.empty(0, bool)
    start, end, period = start[one], end[one], period[one]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _runs(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        split = [words_of(t) for t in batch.column("text").to_pylist()]
        flat = [w for own in split for w in own]
        lengths = np.array([len(own) for own in split], np.int64)
        ends = np.cumsum(lengths)
        numbers: dict[bytes, int] = {}
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for w in flat), np.int64, len(flat))
        start, end, period = find_runs(words, np.repeat(np.arange(len(split)), lengths), min_length)
        edge = np.zeros(len(flat) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, end, -1)
        keep = np.cumsum(edge)[:-1] == 0
        doc = np.searchsorted(ends, start, side="right")
        kept = []
        for a, own in zip((ends - lengths).tolist(), split):
            whole = keep[a:a + len(own)]
            kept.append(b" ".join(own if whole.all() else [own[i] for i in np.flatnonzero(whole).tolist()]))
        runs = pa.StructArray.from_arrays([pa.array(start - (ends - lengths)[doc]), pa.array(end - start), pa.array(period)], fields=list(_RUN))
        offsets = np.append(0, np.cumsum(np.bincount(doc, minlength=len(split))))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                                          pa.array(kept, pa.binary())], schema=_SCHEMA)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, runs, collapsed.

    ``runs`` holds start (word number), length and period of every run, by
    start, then period; ``collapsed`` is the text without the words that a run
    holds after its first period, joined by one space.
    """
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = inputs.mapInArrow(lambda it: _runs(it, min_length), _RUNS)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where, by the rule that the query's contract states, some ids' texts end in a repeated piece.

    With h = crc32(decimal id) and g = h div 10, of the n words of a text with
    h % 10 = 0 every word i from a = g % n on becomes word a + (i - a) % p,
    p = 1 + (n - a) div (3 + g % 8).  Texts of other ids, and of null ids, stay.
    """
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("__h", h).withColumn("__words", F.when(F.col("__h") % 10 == 0, words))
            .withColumn("__n", F.size("__words").cast("long")).withColumn("__g", F.expr("__h div 10")))
    a = F.expr("__g % __n")
    p = F.expr("1 + (__n - __g % __n) div (3 + __g % 8)")
    tail = F.transform(F.sequence(a, F.col("__n") - 1), lambda i: F.get("__words", (a + (i - a) % p).cast("int")))
    whole = F.concat(F.slice("__words", F.lit(1), a.cast("int")), tail)
    return part.select("doc_id", F.when(F.col("__n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("early"), (-r.period).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.early")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        _digest(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"),
        _digest(F.col("collapsed")).alias("collapsed_sha256"))


#: Equal runs of six words give the pairs of equal words: a run of 12 words or more repeats at least 6 of them.
ORACLE = r"""
WITH crc AS (SELECT list(c ORDER BY b) AS tab FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
             lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS t(b))),
h AS (SELECT s, xor(list_reduce(list_concat([4294967295], list_transform(string_split(s, ''), lambda x: ascii(x)::BIGINT)),
                    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h
      FROM (SELECT DISTINCT doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL), crc),
o AS (SELECT row_number() OVER () AS r, doc_id, h, h // 10 AS g, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws
      FROM documents LEFT JOIN h ON s = doc_id::VARCHAR),
a AS (SELECT *, len(ws) AS n, g % len(ws) AS a FROM o),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
             THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM p),
s AS (SELECT r, unnest(range(n - 5)) AS i, unnest(list_transform(range(n - 5), lambda i: array_to_string(ws[i + 1:i + 6], ' '))) AS w
      FROM d WHERE n >= 12),
e AS (SELECT x.r, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.r = y.r AND x.w = y.w AND x.i < y.i),
f AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
m AS (SELECT r, q, min(i) AS start, count(*) + 5 + q AS length FROM f GROUP BY r, q, island HAVING count(*) + 5 >= q),
u AS (SELECT r, start, length, min(q) AS period FROM m WHERE length >= 12 GROUP BY r, start, length),
v AS (SELECT r, count(*) AS n_runs, first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
             first(period ORDER BY length DESC, start, period) AS period,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM u GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
k AS (SELECT b.r, string_agg(word, ' ' ORDER BY b.i) AS kept
      FROM (SELECT r, unnest(ws) AS word, unnest(range(n)) AS i FROM d) b ANTI JOIN gone ON gone.r = b.r AND gone.i = b.i GROUP BY b.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(v.text, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN v USING (r) LEFT JOIN k USING (r)
"""
