"""Language-model scores by a weighted backoff automaton of n-grams.

Tokens are words with A-Z lower-cased, and one end token per text.  Every
training document is counted.  The smoothed model (Jelinek-Mercer), for
histories h of up to ``order`` - 1 tokens, the start of the text being one:

    P(w)   = c(w) / (N + V) for known w, V / (N + V) for the one unknown word,
    P(w|h) = l(h) * c(hw) / c(h) + (1 - l(h)) * P(w|h'),  h' = h without its first,
    l(h)   = most * c(h) / (c(h) + half),

which sums to one in every state.  Its automaton has a state for every seen
history and a root for the empty one.  A seen n-gram hw is an arc from h with
log10 P(w|h), to hw or, where that is too long for a state, to its suffix.  Any
other word takes the failure arc of h, log10 (1 - l(h)), to h' and tries again
there, down to the root, which has an arc for every word.  One pass from left to
right carries the state and adds the weights.

Counts grow with the corpus and are never gathered in one place.  Texts are
read once, into chunks of a few megabytes (word ids of the chunk, and the
chunk's sorted 64-bit word hashes), which are written.  Each chunk sends its
distinct n-grams with its own training counts to buckets by hash range; a
bucket adds them up and answers every chunk with the totals, in the order of
its request.  A chunk thus gets the part of the automaton that its own texts
can reach, and walks its texts.  An n-gram in every text is one entry per
chunk; a bucket gets the n-grams of about ``bucket_bytes`` of text.

Edge cases: a null or empty text is its end token alone; a row with a null id
is scored but not learned from and has a null ``held_out``; repeated rows count
as often as they stand; without training rows all words are unknown (N = V = 0:
the model's unknown word then has probability 1, and so the score is 0); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, mixed, slices, table, word_hashes, words_of, written

MOST, HALF = 0.75, 1.0
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Of the query; trigrams take more than the disk and memory that the cluster allows (see README).
ORDER = 2

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Hashes of the end token and the start state; words have no white space, so these names are free.
END, START = (word_hashes([name])[0] for name in (b" end", b" start"))

_CHUNK = "doc_ids array<long>, folds array<long>, lengths array<long>, keys binary, tokens binary"


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed with all lowest bytes first, all highest last: those are zero for small numbers."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expanded(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).reshape(-1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("folds", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                        ("keys", pa.binary()), ("tokens", pa.binary())])
    for batch in slices(batches, "text", CHUNK_BYTES):
        split = [words_of(t.translate(_LOWER)) if t else [] for t in batch.column("text").to_pylist()]
        lengths = np.array([len(w) + 1 for w in split])
        hashes = np.empty(int(lengths.sum()), np.uint64)
        own = np.ones(len(hashes), bool)
        own[np.cumsum(lengths) - 1] = False
        hashes[own] = word_hashes([w for words in split for w in words])
        hashes[~own] = END
        keys, tokens = np.unique(hashes, return_inverse=True)
        yield pa.RecordBatch.from_arrays([
            pa.array([c], f.type) for c, f in zip(
                (batch.column("doc_id").to_pylist(), batch.column("fold").to_pylist(), lengths.tolist(),
                 _squeezed(np.diff(keys, prepend=np.uint64(0))), _squeezed(tokens.astype(np.uint32))), schema)], schema=schema)


class Grams:
    """A chunk's distinct n-grams in the order of their keys, and where its texts use them.

    Word ids are those of the chunk; the id after the last is the start of a text.
    ``levels[k]`` holds the n-grams of k + 2 tokens: (the n-gram without its last
    token, that token, the n-gram without its first), by their ids one level below.
    """

    def __init__(self, row: dict, held_out: int, order: int):
        words = np.cumsum(_expanded(row["keys"], np.uint64), dtype=np.uint64)
        self.tokens = _expanded(row["tokens"], np.uint32).astype(np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.n_words = len(words)
        learned = np.repeat(np.array([f is not None and f != held_out for f in row["folds"]], bool), self.lengths)
        place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        names = np.append(words, START)
        # the last bit tells words (0) from longer n-grams and the start (1)
        keys = [mixed(words) & ~np.uint64(1), mixed(names[-1:]) | np.uint64(1)]
        counts = [np.bincount(self.tokens[learned], minlength=self.n_words), [int(learned[self.starts].sum())]]
        self.levels = []
        shorter = self.tokens  # id of the n-gram one token shorter that ends at each token
        before = np.empty_like(self.tokens)
        before[1:], before[self.starts] = self.tokens[:-1], self.n_words
        single = names
        for k in range(2, order + 1):
            at = np.flatnonzero(place >= k - 2)  # the start of a text is the first token of its longest n-gram there
            grams, first, inverse = np.unique(before[at] * self.n_words + self.tokens[at], return_index=True, return_inverse=True)
            prefix, token = grams // self.n_words, grams % self.n_words
            self.levels.append((prefix, token, shorter[at][first]))
            names = mixed(mixed(names[prefix]) * np.uint64(3) + single[token])
            keys.append(names | np.uint64(1))
            counts.append(np.bincount(inverse[learned[at]], minlength=len(grams)))
            shorter = np.full(len(self.tokens), -1)
            shorter[at] = inverse
            before = np.roll(shorter, 1)
        self.ends = np.cumsum([self.n_words + 1, *(len(x[0]) for x in self.levels)])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[self.order], counts[self.order].astype(np.uint32)

    def placed(self, totals: np.ndarray) -> list[np.ndarray]:
        """Totals in the order of the keys -> those of the words and the start, then of each level."""
        out = np.empty(len(self.keys), np.int64)
        out[self.order] = totals
        return np.split(out, self.ends[:-1])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Hash ranges: a sorted run of keys falls into runs of buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _ask(batches: Iterator[pa.RecordBatch], buckets: int, held_out: int, order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            grams = Grams(row, held_out, order)
            bucket = _bucket(grams.keys, buckets)
            own, first = np.unique(bucket, return_index=True)
            out = [(int(b), row["chunk"], _squeezed(np.diff(grams.keys[i:j], prepend=np.uint64(0))), _squeezed(grams.counts[i:j]))
                   for b, i, j in zip(own, first, [*first[1:], len(bucket)])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                             names=["bucket", "chunk", "keys", "counts"])


_ANSWER = "chunk long, bucket long, totals binary, n long, v long"


def _answer(group: pa.Table) -> pa.Table:
    """Add up a bucket's counts; answer each chunk, and tell the bucket's tokens (n) and distinct words (v)."""
    asked = [np.cumsum(_expanded(x.as_py(), np.uint64), dtype=np.uint64) for x in group.column("keys")]
    counts = np.concatenate([_expanded(x.as_py(), np.uint32) for x in group.column("counts")])
    keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, counts, len(keys)).astype(np.int64)
    word = (keys & np.uint64(1)) == 0
    replies, start = [], 0
    for own in asked:
        replies.append(_squeezed(totals[inverse[start:start + len(own)]]))
        start += len(own)
    n = len(replies)
    return pa.table([pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
                     pa.array([group.column("bucket")[0].as_py()] * (n + 1), pa.int64()), pa.array([*replies, None], pa.binary()),
                     pa.array([None] * n + [int(totals[word].sum())], pa.int64()),
                     pa.array([None] * n + [int((totals[word] > 0).sum())], pa.int64())],
                    names=["chunk", "bucket", "totals", "n", "v"])


class Automaton:
    """The reachable part of the backoff automaton: arcs, failure arcs, root weights.

    States are numbered: words, the start, the longer histories level by level, the root.
    """

    def __init__(self, grams: Grams, totals: np.ndarray, n: int, v: int, most: float = MOST, half: float = HALF):
        singles, *longer = grams.placed(totals)
        self.size, self.start = grams.n_words, grams.n_words
        self.known = singles[:-1]
        words = self.known.astype(np.float64)
        chance = np.where(words > 0, words, max(v, 1)) / max(n + v, 1)
        self.root_weight = np.log10(chance).tolist()
        history, first = singles, 0  # counts of the states of one level, and the number of its first state
        fail, back, arcs, weights, targets = [], [], [], [], []
        for k, ((prefix, token, suffix), count) in enumerate(zip(grams.levels, longer)):
            trust = most * history / (history + half)
            fail.append(np.log10(1 - trust))
            chance = trust[prefix] * count / np.maximum(history[prefix], 1) + (1 - trust[prefix]) * chance[suffix]
            seen = np.flatnonzero(count > 0)
            arcs.append((first + prefix[seen]) * self.size + token[seen])
            weights.append(np.log10(chance[seen]))
            following = first + len(history)
            if k + 1 < len(longer):  # the n-gram is a state itself; its failure arc leads to its suffix
                targets.append(following + seen)
                back.append(first + suffix)
            else:
                targets.append(first + suffix[seen])
            history, first = count, following
        self.root = first
        self.fail = np.concatenate(fail).tolist()
        self.back = np.concatenate([np.full(len(singles), self.root), *back]).tolist()
        self.arcs = dict(zip(np.concatenate(arcs).tolist(), range(sum(map(len, arcs)))))
        self.weights, self.targets = np.concatenate(weights).tolist(), np.concatenate(targets).tolist()
        # an unknown word leads to the root
        self.next = np.where(self.known > 0, np.arange(self.size), self.root).tolist()

    def walk(self, tokens: list[int]) -> float:
        """log10 probability of a text, in one pass."""
        arc, weights, targets, fail, back, root, size = self.arcs.get, self.weights, self.targets, self.fail, self.back, self.root, self.size
        state, total = self.start, 0.0
        for token in tokens:
            while state != root:
                found = arc(state * size + token)
                if found is not None:
                    total += weights[found]
                    state = targets[found]
                    break
                total += fail[state]
                state = back[state]
            else:
                total += self.root_weight[token]
                state = self.next[token]
        return total


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], n: int, v: int, held_out: int, order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            grams = Grams(row, held_out, order)
            totals = np.concatenate([_expanded(r["totals"], np.int64) for r in row["replies"]])
            automaton = Automaton(grams, totals, n, v)
            base = np.log10((automaton.known + 0.5) / (n + 0.5 * (v + 1)))
            known = automaton.known > 0
            scores = [automaton.walk(grams.tokens[a:a + m].tolist()) for a, m in zip(grams.starts.tolist(), grams.lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array([None if f is None else f == held_out for f in row["folds"]], pa.bool_()),
                 pa.array(grams.lengths), pa.array(np.add.reduceat(known[grams.tokens].astype(np.int64), grams.starts)),
                 pa.array([n] * len(scores), pa.int64()), pa.array(np.add.reduceat(base[grams.tokens], grams.starts)),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, fold_column: str = "fold", held_out: int = 1, bucket_bytes: int = BUCKET_BYTES, order: int = 2) -> DataFrame:
    """``docs`` (doc_id, text, fold): learn n-grams of up to ``order`` tokens from rows whose fold is not ``held_out``, score every row."""
    if order < 2:
        raise ValueError("a backoff automaton needs n-grams of two tokens or more")
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fold_column).cast("long").alias("fold"),
                         F.col("text").cast("binary").alias("text"))
    buckets = (inputs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0) // bucket_bytes + 1
    chunks = written(inputs.mapInArrow(_chunks, _CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    asked = chunks.mapInArrow(lambda it: _ask(it, buckets, held_out, order), "bucket long, chunk long, keys binary, counts binary")
    answers = written(asked.groupBy("bucket").applyInArrow(_answer, _ANSWER), "answers")
    sums = answers.where("chunk IS NULL").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    replies = answers.where("chunk IS NOT NULL").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "totals"))).alias("replies"))  # the totals of one chunk
    return chunks.join(replies, "chunk").mapInArrow(lambda it: _score(it, n, v, held_out, order), _SCORED)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text", fold("fold", "doc_id", 5)), order=ORDER)
