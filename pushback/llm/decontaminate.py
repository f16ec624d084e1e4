"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Texts are read as words: ASCII letters are lower-cased, ASCII punctuation
counts as white space.  A seed is a pair of neighbouring words of a test item.
An alignment that reaches ``min_score`` of the item's perfect score keeps a
number of such pairs that follows from the item's length (``least_seeds``), so
each item can do without its most frequent ones: one pass counts the pairs in
the corpus, and only the rare ones are sought.  A second pass over whole
documents finds them; where enough seeds of one item lie within reach of one
alignment there is a candidate passage.  A passage whose words and pairs cannot
reach ``min_score`` however they stand is dropped; how frequent a passage is
does not matter.  Every other passage is aligned with its item by
Smith-Waterman over words, which scores edited and paraphrased copies too; a
pair is reported from ``min_score``.  A task aligns equal passages once.

For ``min_score`` above 0.5 no pair at or above it is lost, however the edits
are spaced, but that a copy of an item of 4 or 5 words has to keep two of its
words side by side.

The test items are the stated query set: they go to the tasks in blocks of at
most ``block_bytes`` of text, so the broadcast has a fixed bound and a larger
benchmark makes more blocks.

Edge cases: null texts have no words; items of fewer than 4 words are too
short to prove anything and match nothing; very long texts are read whole, their
hits in pieces of bounded size; of passages with equal scores the first counts;
repeated items keep their own rows;
repeated documents are judged row by row and give one result row per (doc_id,
item) and distinct text; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, row_key, slices, table, word_hashes, written

#: Words of a seed: with pairs of words nothing at a score above 0.5 can be missed.
N = 2
#: Shorter items are too short to prove anything.
MIN_WORDS = 4
MIN_SCORE, BLOCK_BYTES = 0.6, 8 << 20
#: Pairs of a hit and an item that a task looks at together.
EXPANDED = 2_000_000
#: Words of an item that are looked up before its passage is read whole.
PROBES = 16
#: Alignments that a task remembers at a time, for passages that many documents share.
MEMORY = 50_000
MATCH, MISMATCH, GAP = 2, -1, -1

_PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_PUNCTUATION + bytes(range(65, 91)), b" " * len(_PUNCTUATION) + bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_HITS = "doc_id long, doc_row long, item long, passage binary, passage_start long"
_FOUND = "doc_id long, doc_row long, item long, score double, start long, end long"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def least_seeds(length: int, min_score: float) -> int:
    """How many seeds an alignment of ``min_score`` holds at least.

    With M matched words and E other steps, 2 M - E >= S = 2 min_score length.
    Other steps part the matches into at most E + 1 stretches, so at least
    M - E - 1 >= S - M - 1 >= S - length - 1 pairs of matched words stand side by side.
    """
    return math.ceil(MATCH * min_score * length - 1e-9) - length - 1


class Seeds:
    """Word pairs of a block of items: sorted hashes, the items that use each as a seed, and bounds of their alignments."""

    def __init__(self, items: list[list[bytes]], min_score: float):
        self.lengths = np.array([len(w) for w in items], np.int64)
        self.least_score = np.ceil(MATCH * min_score * self.lengths - 1e-9).astype(np.int64)
        # an alignment takes all words of its item at most, and as many other steps as its score leaves room for
        self.reach = (MATCH + 1) * self.lengths - self.least_score
        self.needed = np.maximum(1, [least_seeds(int(m), min_score) for m in self.lengths])
        hashes = [word_hashes(w) for w in items]
        self.words = [np.unique(h, return_counts=True) for h in hashes]
        self.pairs = [np.unique(gram_hashes(h, N), return_counts=True) for h in hashes]
        self.vocabulary, used = np.unique(np.concatenate([*(w for w, _ in self.words), np.empty(0, np.uint64)]), return_counts=True)
        # the item's words that fewest items hold; the last one fills short lists
        self.probes = np.empty((len(items), PROBES), np.int64)
        self.n_probes = np.array([min(PROBES, len(w)) for w, _ in self.words], np.int64)
        for k, (own, _) in enumerate(self.words):
            at = np.searchsorted(self.vocabulary, own)
            at = at[np.lexsort((at, used[at]))][:PROBES]
            self.probes[k] = np.append(at, np.full(PROBES - len(at), at[-1]))
        self.use([np.ones(len(own), bool) for own, _ in self.pairs])

    def use(self, chosen: list[np.ndarray]) -> None:
        """Make the chosen pairs of each item its seeds."""
        grams = [own[c] for (own, _), c in zip(self.pairs, chosen)]
        keys = np.concatenate([*grams, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        order = np.lexsort((owner, keys))
        self.keys, first = np.unique(keys[order], return_index=True)
        self.owner, self.first = owner[order], np.append(first, len(keys))
        self.present = np.zeros(1 << 22, bool)
        self.present[self._slot(self.keys)] = True

    def rare(self, counts: np.ndarray) -> None:
        """Keep the rare seeds, given how often each occurs in the corpus.

        An item may do without as many pairs as leaves ``hits`` of those that
        every alignment holds: half of them, the most frequent ones go.
        """
        cost = counts * np.diff(self.first)  # candidates that a seed raises
        spare = self.needed // 2
        self.hits = self.needed - spare
        chosen = []
        for k, (own, times) in enumerate(self.pairs):
            frequent = np.lexsort((own, -cost[np.searchsorted(self.keys, own)]))
            left = np.ones(len(own), bool)
            left[frequent[np.cumsum(times[frequent]) <= spare[k]]] = False
            chosen.append(left)
        self.spare = spare
        self.use(chosen)

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams & np.uint64((1 << 22) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions of seeds, and which seeds."""
        grams = gram_hashes(hashes, N)
        at = np.flatnonzero(self.present[self._slot(grams)])
        return _lookup(self.keys, grams[at], at)

    def most(self, item: int, hashes: np.ndarray) -> int:
        """No alignment of the item with these words scores more.

        Words match as often as both have them, and so do pairs; with P pairs
        the M matches stand in M - P stretches, parted by M - P - 1 steps.
        """
        matches = _common(self.words[item], hashes)
        pairs = _common(self.pairs[item], gram_hashes(hashes, N))
        return min(MATCH * matches, matches + pairs + 1)


def _lookup(keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``values`` (and ``at``, beside them) those among the sorted ``keys``: their ``at``, and their place there."""
    if not len(keys):
        return at[:0], at[:0]
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    same = keys[place] == values
    return at[same], place[same]


def _common(own: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> int:
    keys, counts = own
    if not len(keys):
        return 0
    _, place = _lookup(keys, hashes, np.arange(len(hashes)))
    return int(np.minimum(np.bincount(place, minlength=len(keys)), counts).sum())


class _Slice:
    """The words of a slice of documents: split, hashed, and where each document's begin."""

    def __init__(self, batch: pa.RecordBatch):
        self.texts = batch.column("text").to_pylist()
        split = [words(t) for t in self.texts]
        self.hashes = word_hashes([w for own in split for w in own])
        self.ends = np.cumsum([len(own) for own in split])
        self.first = self.ends - [len(own) for own in split]

    def seeds(self, seeds: Seeds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position, seed and document of each hit; no seed reaches over the end of its document."""
        at, seed = seeds.find(self.hashes)
        doc = np.searchsorted(self.ends, at, side="right")
        whole = at + N <= self.ends[doc] if len(at) else np.zeros(0, bool)
        return at[whole], seed[whole], doc[whole]


def _count(batches: Iterator[pa.RecordBatch], seeds: Seeds) -> Iterator[pa.RecordBatch]:
    """How often each seed occurs in the documents of a task."""
    counts = np.zeros(len(seeds.keys), np.int64)
    for batch in slices(batches, "text"):
        _, seed, _ = _Slice(batch).seeds(seeds)
        counts += np.bincount(seed, minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"seed": pa.array(at, pa.int64()), "n": pa.array(counts[at], pa.int64())})


def _candidates(seeds: Seeds, own: _Slice, at: np.ndarray, seed: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, end word) wherever an item's seeds are as dense as an alignment has them.

    Some million pairs of hit and item at a time, and with them the hits that
    an alignment beginning with one of these can reach.
    """
    times = seeds.first[seed + 1] - seeds.first[seed]
    ends = np.cumsum(times)
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + EXPANDED, side="right")))
        seen = slice(start, int(np.searchsorted(at, at[stop - 1] + seeds.reach.max(), side="right")))
        n = times[seen]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        item = seeds.owner[np.repeat(seeds.first[seed[seen]], n) + nth]
        d, p = np.repeat(doc[seen], n), np.repeat(at[seen], n)
        last_begin, start = at[stop - 1], stop
        order = np.lexsort((p, item, d))
        d, p, item = d[order], p[order], item[order]
        pair = np.cumsum(np.append(False, (d[1:] != d[:-1]) | (item[1:] != item[:-1])))
        # the k-th hit and the one that completes the number needed lie within reach of one alignment
        k = np.flatnonzero(p <= last_begin)
        last = k + seeds.hits[item[k]] - 1
        k, last = k[last < len(p)], last[last < len(p)]
        dense = (pair[last] == pair[k]) & (p[last] - p[k] + N <= seeds.reach[item[k]])
        k, last = k[dense], last[dense]
        if not len(k):
            continue
        # of the words an item may lack, given its pairs, none more are absent from the document
        pairs = np.bincount(pair)[pair[k]] + seeds.spare[item[k]]
        lacking = seeds.lengths[item[k]] - (seeds.least_score[item[k]] - 1 - pairs)
        which, back = np.unique(pair[k], return_index=True)
        enough = np.zeros(int(pair[-1]) + 1, bool)
        enough[which] = _absent(seeds, own, d[k[back]], item[k[back]]) <= lacking[back]
        k, last = k[enough[pair[k]]], last[enough[pair[k]]]
        if not len(k):
            continue
        a = np.maximum(own.first[d[k]], p[last] + N - seeds.reach[item[k]])
        b = np.minimum(own.ends[d[k]], p[k] + seeds.reach[item[k]])
        # windows that overlap become one passage
        begin = np.flatnonzero(np.append(True, (pair[k][1:] != pair[k][:-1]) | (a[1:] >= b[:-1])))
        end = np.append(begin[1:], len(k)) - 1
        yield from zip(d[k[begin]].tolist(), item[k[begin]].tolist(), a[begin].tolist(), b[end].tolist())


def _absent(seeds: Seeds, own: _Slice, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
    """For each pair: how many of the item's probe words the document does not hold."""
    wanted = np.unique(doc)
    held = []
    for d in wanted.tolist():
        _, place = _lookup(seeds.vocabulary, own.hashes[own.first[d]:own.ends[d]], np.arange(own.ends[d] - own.first[d]))
        held.append(np.unique(place) + d * len(seeds.vocabulary))
    keys = np.concatenate(held)
    absent = np.zeros(len(doc), np.int64)
    for j in range(PROBES):
        asked = doc * len(seeds.vocabulary) + seeds.probes[item, j]
        there = keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked if len(keys) else np.zeros(len(asked), bool)
        absent += ~there & (j < seeds.n_probes[item])
    return absent


def _find(batches: Iterator[pa.RecordBatch], seeds: Seeds) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("doc_row", pa.int64()), ("item", pa.int64()),
                        ("passage", pa.binary()), ("passage_start", pa.int64())])
    for batch in slices(batches, "text"):
        rows = []
        own = _Slice(batch)
        at, seed, doc = own.seeds(seeds)
        ids, keys = batch.column("doc_id"), batch.column("doc_row")
        spots_of, spots = -1, []
        for d, item, a, b in _candidates(seeds, own, at, seed, doc):
            if seeds.most(item, own.hashes[a:b]) < seeds.least_score[item]:
                continue
            text = own.texts[d]
            if spots_of != d:
                spots_of, spots = d, [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
            lo, hi = spots[a - own.first[d]][0], spots[b - 1 - own.first[d]][1]
            rows.append((ids[d].as_py(), keys[d].as_py(), item, text[lo:hi], len(text[:lo].decode("utf-8", "replace"))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _best(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: best score and where it ends in a and in b (exclusive).

    A row of the matrix at a time: what a gap along ``b`` adds is a running maximum.
    """
    slope = -GAP * np.arange(len(b) + 1)
    row, best = np.zeros(len(b) + 1, np.int64), (0, 0, 0)
    for i, w in enumerate(a):
        new = np.zeros(len(b) + 1, np.int64)
        np.maximum(row[:-1] + np.where(b == w, MATCH, MISMATCH), row[1:] + GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + slope) - slope
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i + 1, j)
    return best


def align(item: list[bytes], passage: list[bytes]) -> tuple[float, int, int]:
    """Best local alignment: score as a share of the item's perfect score, and its words in the passage."""
    ids: dict[bytes, int] = {}
    a, b = (np.array([ids.setdefault(w, len(ids)) for w in x], np.int64) for x in (item, passage))
    score, i, j = _best(a, b)
    if not score:
        return 0.0, 0, 0
    _, _, back = _best(a[:i][::-1], b[:j][::-1])
    return score / (MATCH * len(item)), j - back, j


def _align(batches: Iterator[pa.RecordBatch], items: list[list[bytes]], min_score: float) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("doc_row", pa.int64()), ("item", pa.int64()),
                        ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    known: dict[tuple[int, int], tuple[float, int, int]] = {}
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            passage = r["passage"].translate(_TABLE)
            spots = [m.span() for m in _WORD.finditer(passage)]
            key = r["item"], xxhash.xxh3_128_intdigest(passage)
            if key not in known:
                if len(known) >= MEMORY:
                    known.clear()
                known[key] = align(items[r["item"]], [passage[x:y] for x, y in spots])
            score, a, b = known[key]
            if score >= min_score:
                chars = [r["passage_start"] + len(r["passage"][:x].decode("utf-8", "replace")) for x in (spots[a][0], spots[b - 1][1])]
                rows.append((r["doc_id"], r["doc_row"], r["item"], score, *chars))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) against ``benchmark`` (item_id, text).

    One row per document text and item that align: doc_id, doc_row (key of the
    row's content), item_id, score, start, end (code points of the aligned
    passage, end exclusive).
    """
    spark = docs.sparkSession
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("doc_row"),
                         F.col("text").cast("binary").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    out = spark.createDataFrame([], _FOUND.replace("item long", "item_id long"))
    for block in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        kept = [(r["item_id"], w) for r in own if len(w := words(bytes(r["text"]))) >= MIN_WORDS]
        if not kept:
            continue
        names, texts = [i for i, _ in kept], [w for _, w in kept]
        seeds = Seeds(texts, min_score)
        seeds.rare(_occurrences(inputs, seeds))
        shared = spark.sparkContext.broadcast(seeds)
        hits = written(inputs.mapInArrow(lambda it, s=shared: _find(it, s.value), _HITS), "hits")
        found = hits.mapInArrow(lambda it, t=texts: _align(it, t, min_score), _FOUND)
        by_pair = found.groupBy("doc_id", "doc_row", "item").agg(
            F.max_by(F.struct("score", "start", "end"), F.struct("score", -F.col("start"))).alias("best"))
        ids = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")
        out = out.unionByName(by_pair.join(F.broadcast(ids), "item").select(
            "doc_id", "doc_row", "item_id", "best.score", "best.start", "best.end"))  # ids: at most a block's items
    return out


def _occurrences(inputs: DataFrame, seeds: Seeds) -> np.ndarray:
    """How often each seed of the block (a bounded number) occurs in all documents."""
    shared = inputs.sparkSession.sparkContext.broadcast(seeds)
    counted = inputs.select("text").mapInArrow(lambda it, s=shared: _count(it, s.value), "seed long, n long")
    totals = counted.groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    counts = np.zeros(len(seeds.keys), np.int64)
    counts[totals.column("seed").to_numpy()] = totals.column("n").to_numpy()
    return counts


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "start", "end")
