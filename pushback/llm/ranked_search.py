"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to owners, one stage each: the rarest terms to the first, with
about equally many postings per owner.  Documents are read in blocks.  Of every
block a bundle with the items' sparse document accumulators travels through the
owners: at each stage a cogroup brings it together with the postings that the
owner has of the block, and the owner adds its terms' integer contributions.
The last stage selects each item's best documents of a block, and a window the
best of all.

No accumulator is cut by number.  What later owners can still add to a document
of the block is bounded by their terms' largest contributions there, and after
every stage the score that an item's ``top`` best documents already have, over
all blocks, is a lower limit of what a result needs.  A document that cannot
reach the limit any more is dropped, and no new one is admitted once a document
without any score could not: exact, and few accumulators outlive the rare terms.

A common term's postings are split by block, so no task meets a whole list.
The items are the stated query set: they are handled in bundles of at most
``bundle_bytes`` of text, whose terms are broadcast; a larger set makes more
bundles.  Postings and bundles are written to the shared folder per stage.

Edge cases: null texts, and texts without a term, hold no terms and are in no
result; items without a term give no rows; rows that repeat an item are items
of their own; rows that repeat a document's id or text are documents of their
own; equal scores go by ascending id, null ids last; a text longer than a block
is a block of its own; a term that no document holds adds nothing; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, slices, table, written

TOP, OWNERS, BUNDLE_BYTES, BLOCK_BYTES = 20, 4, 4 << 20, 8 << 20

#: ASCII letters and digits and every byte of a longer character make terms; only A-Z are lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))

_SCORE = np.dtype([("item", "<i4"), ("doc", "<i4"), ("score", "<i8")])
_POSTING = np.dtype([("term", "<i4"), ("doc", "<i4"), ("impact", "<i4")])


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _squeeze(values: np.ndarray) -> bytes:
    """Columns of a record array one after the other, compressed."""
    parts = [np.ascontiguousarray(values[name]).tobytes() for name in values.dtype.names]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _expand(blob: bytes | None, kind: np.dtype) -> np.ndarray:
    if not blob:
        return np.empty(0, kind)
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = np.empty(len(raw) // kind.itemsize, kind), 0
    for name in kind.names:
        size = len(out) * kind[name].itemsize
        out[name] = np.frombuffer(raw[at:at + size], kind[name])
        at += size
    return out


class Query:
    """A bundle of items: their terms by number, and after ``weigh`` the weights and owners of the terms."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]):
        self.names = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        self.terms = []
        for _, words in items:
            counts = Counter(self.number.setdefault(w, len(self.number)) for w in words)
            self.terms.append((np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))))

    def weigh(self, df: dict[int, int], n_docs: int, n_terms: int, owners: int) -> None:
        self.n_docs, self.n_terms, self.owners = n_docs, n_terms, owners
        counts = np.array([df.get(t, 0) for t in range(len(self.number))], np.int64)
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in counts], np.int64)
        rare_first = np.argsort(counts, kind="stable")
        before = np.cumsum(counts[rare_first]) - counts[rare_first]
        self.owner = np.empty(len(counts), np.int64)
        self.owner[rare_first] = before * owners // max(int(counts.sum()), 1)

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term adds per unit of weight to a document of ``n`` terms that holds it ``tf`` times."""
        m = 75 + (25 * n * self.n_docs) // max(self.n_terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _postings(texts: list[bytes | None], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text; and of the query's terms: which, in which text, how often (by text)."""
    length, found, doc, tf = [], [], [], []
    for d, text in enumerate(texts):
        own = terms(text)
        length.append(len(own))
        counts = Counter(own)
        hits = counts.keys() & number.keys()
        found += [number[w] for w in hits]
        tf += [counts[w] for w in hits]
        doc += [d] * len(hits)
    return tuple(np.array(x, np.int64) for x in (length, found, doc, tf))


#: Term numbers under which the number of documents with a term, and of all their terms, are counted.
_DOCS, _TERMS = -1, -2


def _count(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    total: Counter[int] = Counter()
    for batch in slices(batches, "text"):
        length, found, _, _ = _postings(batch.column("text").to_pylist(), number)
        total[_DOCS] += int((length > 0).sum())
        total[_TERMS] += int(length.sum())
        term, n = np.unique(found, return_counts=True)
        for t, c in zip(term.tolist(), n.tolist()):
            total[t] += c
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])


#: ``stage`` -1: the empty bundle of the block; ``owners``: the ids of its documents; between: an owner's postings.
_PIECES = "block long, stage int, payload binary, ids array<long>"
_LIMIT = np.dtype([("term", "<i4"), ("most", "<i4")])


def _pack(batches: Iterator[pa.RecordBatch], query: Query, block_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", block_bytes):
        length, found, doc, tf = _postings(batch.column("text").to_pylist(), query.number)
        if not len(found):
            continue
        held = np.unique(doc)
        post = np.zeros(len(found), _POSTING)
        post["term"], post["doc"], post["impact"] = found, np.searchsorted(held, doc), query.impact(tf, length[doc])
        post = post[np.lexsort((post["doc"], post["term"]))]
        term, first = np.unique(post["term"], return_index=True)
        limits = np.zeros(len(term), _LIMIT)
        limits["term"], limits["most"] = term, np.maximum.reduceat(post["impact"], first)
        block = uuid.uuid4().int >> 65  # the pieces are written once before anything reads them
        owner = query.owner[post["term"]]
        rows = [(block, -1, _squeeze(limits), None)]
        rows += [(block, s, _squeeze(post[owner == s]), None) for s in range(query.owners)]
        rows.append((block, query.owners, None, batch.column("doc_id").take(pa.array(held)).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())))],
                                         names=["block", "stage", "payload", "ids"])


_BUNDLE = "block long, limits binary, scores binary, items array<int>, best array<long>"


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    return np.partition(values, len(values) - k)[len(values) - k:] if len(values) > k else values


def _add(bundle: dict, postings: bytes | None, query: Query, stage: int, floor: np.ndarray, top: int) -> dict:
    """An owner's stage: add its terms' contributions to a bundle, drop what cannot reach an item's limit.

    ``floor`` is the score that a document needs at least, per item.
    """
    post, limit = _expand(postings, _POSTING), _expand(bundle["limits"], _LIMIT)
    scores = _expand(bundle["scores"], _SCORE)
    most = np.zeros(len(query.number), np.int64)
    most[limit["term"]] = limit["most"]
    begin = np.searchsorted(post["term"], np.arange(len(query.number) + 1))
    n_docs = int(max(post["doc"].max(initial=-1), scores["doc"].max(initial=-1))) + 1
    row, out, kept_items, best = np.zeros(n_docs, np.int64), [np.empty(0, _SCORE)], [], []
    first = np.searchsorted(scores["item"], np.arange(len(query.terms) + 1))
    for item, (own, times) in enumerate(query.terms):
        had = scores[first[item]:first[item + 1]]
        need = max(int(floor[item]), int(_largest(had["score"], top).min()) if len(had) >= top else 0, 1)
        owner = query.owner[own]
        ahead = query.weight[own] * times * most[own]
        here = own[owner == stage]
        here_times = times[owner == stage]
        row[had["doc"]] = had["score"]
        touched = [had["doc"]]
        for t, by in zip(here.tolist(), (query.weight[here] * here_times).tolist()):
            part = post[begin[t]:begin[t + 1]]
            row[part["doc"]] += by * part["impact"].astype(np.int64)
            touched.append(part["doc"])
        if int(ahead[owner >= stage].sum()) < need:  # a document without a score cannot be a result any more
            docs = had["doc"]
        else:
            docs = np.unique(np.concatenate(touched))
        score = row[docs]
        for t in touched:
            row[t] = 0
        need = max(need, int(_largest(score, top).min()) if len(score) >= top else 0)
        stays = score + int(ahead[owner > stage].sum()) >= need
        docs, score = docs[stays], score[stays]
        entry = np.zeros(len(docs), _SCORE)
        entry["item"], entry["doc"], entry["score"] = item, docs, score
        out.append(entry)
        score = _largest(score, top)
        kept_items += [item] * len(score)
        best += score.tolist()
    return {"block": bundle["block"], "limits": bundle["limits"], "scores": _squeeze(np.concatenate(out)), "items": kept_items, "best": best}


def _owner(shared: Broadcast, stage: int, floor: np.ndarray, top: int):
    """What the owner of a stage does with a block's bundle and its postings."""
    schema = pa.schema([("block", pa.int64()), ("limits", pa.binary()), ("scores", pa.binary()), ("items", pa.list_(pa.int32())), ("best", pa.list_(pa.int64()))])

    def meet(bundle: pa.Table, owned: pa.Table) -> pa.Table:
        postings = owned.column("payload").to_pylist()
        rows = [_add(b, postings[0] if postings else None, shared.value, stage, floor, top) for b in bundle.to_pylist()]
        return pa.Table.from_pylist(rows, schema=schema)

    return meet


_RESULT = "item int, doc_id long, score long"


def _select(left: pa.Table, right: pa.Table, top: int) -> pa.Table:
    """The best documents of a block, by score and id."""
    out = [pd.DataFrame({"item": pd.Series(dtype="int32"), "doc_id": pd.Series(dtype="Int64"), "score": pd.Series(dtype="int64")})]
    ids = pd.array(right.column("ids").to_pylist()[0] if right.num_rows else [], dtype="Int64")
    for blob in left.column("scores").to_pylist():
        s = _expand(blob, _SCORE)
        all_ = pd.DataFrame({"item": s["item"], "doc_id": ids.take(s["doc"].astype(np.int64)), "score": s["score"]})
        out.append(all_.sort_values(["item", "score", "doc_id"], ascending=[True, False, True], na_position="last").groupby("item").head(top))
    return pa.Table.from_pandas(pd.concat(out), schema=pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]), preserve_index=False)


def _floors(bundles: DataFrame, n_items: int, top: int) -> np.ndarray:
    """Per item of the bundle the score that its ``top`` best documents of all blocks already have (0: fewer documents)."""
    pairs = bundles.select(F.explode(F.arrays_zip("items", "best")).alias("x")).select(F.col("x.items").alias("item"), F.col("x.best").alias("score"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    last = pairs.withColumn("rank", rank).where(F.col("rank") <= top).where(F.col("rank") == top).collect()  # at most one row per item of a bundle
    out = np.zeros(n_items, np.int64)
    for r in last:
        out[r["item"]] = r["score"]
    return out


def _search_bundle(inputs: DataFrame, query: Query, top: int, owners: int, block_bytes: int) -> DataFrame:
    spark = inputs.sparkSession
    number = spark.sparkContext.broadcast(query.number)
    counted = inputs.select("text").mapInArrow(lambda it: _count(it, number.value), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in counted.collect()}  # no more terms than the bundle's items hold
    query.weigh(df, df.pop(_DOCS, 0), df.pop(_TERMS, 0), owners)
    shared = spark.sparkContext.broadcast(query)
    path = scratch(spark, "search-pieces")
    inputs.mapInArrow(lambda it: _pack(it, shared.value, block_bytes), _PIECES).write.partitionBy("stage").parquet(path)
    pieces = spark.read.schema(_PIECES).parquet(path)
    bundles = pieces.where("stage = -1").select("block", F.col("payload").alias("limits"), F.lit(None).cast("binary").alias("scores"))
    floor = np.zeros(len(query.terms), np.int64)
    for stage in range(owners):
        owned = pieces.where(F.col("stage") == stage).select("block", "payload")
        meet = bundles.groupBy("block").cogroup(owned.groupBy("block"))
        bundles = written(meet.applyInArrow(_owner(shared, stage, floor, top), _BUNDLE), "search-bundles")
        if stage + 1 < owners:
            floor = _floors(bundles, len(query.terms), top)
            bundles = bundles.select("block", "limits", "scores")
    ids = pieces.where(F.col("stage") == owners).select("block", "ids")
    return bundles.select("block", "scores").groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(lambda b, i: _select(b, i, top), _RESULT)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, bundle_bytes: int = BUNDLE_BYTES,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    bundles = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bundle_bytes + 1
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for bundle in range(bundles):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(bundles)) == bundle).orderBy("item_id", "text").collect()
        kept = [(r["item_id"], w) for r in own if (w := terms(bytes(r["text"])))]
        if not kept:
            continue
        query = Query(kept)
        found = _search_bundle(inputs, query, top, owners, block_bytes)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(query.names)), "item int, item_id long")
        out = out.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # a bundle's items
    return out


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS ts FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, {_TERMS_SQL} AS ts FROM benchmark),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
c AS (SELECT p.r, p.t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * n_docs) // n_terms))) AS add
      FROM p JOIN w USING (t) JOIN d USING (r), s),
x AS (SELECT i, r, sum(add)::BIGINT AS score FROM (SELECT i, unnest(ts) AS t FROM b) JOIN c USING (t) GROUP BY i, r),
k AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k JOIN b USING (i) WHERE rank <= 20
"""
