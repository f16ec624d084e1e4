"""MinHash near-duplicates: banded minima, signature verification, links on full sets, components.

A document's set is its distinct ``k``-word shingles, as 64-bit hashes.  Per
document, ``bands * rows`` universal hashes ``(a*x + b) mod 2**64`` (upper half)
give the minima of its signature.  Documents with equal sets are one class.

Two classes whose signatures agree on all rows of a band share a bucket.  At a
similarity of 0.8, 32 bands of 4 rows miss a pair with a chance of 5e-8.
Buckets never make all pairs:

1. Each bucket links its members to its smallest class only (a star); the pairs
   are verified, and components are formed of the links that hold.
2. Members of a bucket that are still in different components are compared
   inside tasks, in blocks of bounded size: by signature (with ``slack`` below
   the threshold), then by their sets.  Only links that join two components
   leave the task, and these are verified too.  Pairs already connected need no
   further link.

Every link is confirmed on the full shingle sets: intersection against union.
The sets are read again from the documents for candidate classes only: a bitmap
of bounded size tells the rows that can be candidates, and only those move.
Components are formed by alternating large-star and small-star.

A class stands for all rows with its set, however many repeat it, and is named
by the row key of its first document; an id with several texts has a class for
each, and joins them at the end.

Edge cases: null and empty texts (or only white space) have an empty set and
link with nothing; with fewer than ``k`` words the whole sequence is the one
shingle; repeated rows of an id are one document (all its texts link to it);
rows with a null id link with nothing and stay, with a null component and
``kept`` true; equal similarities need no order, links at the threshold count;
very long texts are handled alone, their set has to fit in a task; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, key_filter, may_hold, row_key, slices, table, word_hashes, words_of, written
from .components import components

BANDS, ROWS, SEED = 32, 4, 7
#: Signature estimates this far below the threshold are still verified: five standard deviations of 128 minima.
SLACK = 0.18
#: Signatures and sets of a bucket's members that one group compares with as many others.
BLOCK_BYTES = 8 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, count, np.uint64)


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    split = [words_of(t.translate(_LOWER)) if t else [] for t in texts]
    hashes = word_hashes([w for words in split for w in words])
    out, start = [], 0
    for words in split:
        own = hashes[start:start + len(words)]
        start += len(words)
        out.append(np.unique(gram_hashes(own, min(k, len(words)))) if words else np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Minima of ``count`` universal hashes over each non-empty set."""
    a, b = _parameters(count)
    data = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), count), np.uint32)
    for h in range(count):
        out[:, h] = np.minimum.reduceat(((data * a[h] + b[h]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


_SIGNED = "doc_id long, doc_row long, n_shingles long, set_id binary, bands array<long>, signature binary"


def _sign(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2 << 20):
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        full = [i for i, s in enumerate(sets) if len(s)]
        set_id, keys, signature = ([None] * len(sets) for _ in range(3))
        if full:
            signed = signatures([sets[i] for i in full], bands * rows)
            for i, own in zip(full, signed):
                set_id[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                signature[i] = own.tobytes()
                keys[i] = [xxhash.xxh3_64_intdigest(own[rows * j:rows * (j + 1)].tobytes(), j) - (1 << 63) for j in range(bands)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc_row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_id, pa.binary()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
            names=["doc_id", "doc_row", "n_shingles", "set_id", "bands", "signature"])


_SETS = "cls long, hashes binary, short binary"


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Full sets, and the upper halves of their hashes (sorted, distinct) for comparisons inside buckets."""
    for batch in slices(batches, "text", 2 << 20):
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        short = [np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column("doc_row"), pa.array([s.tobytes() for s in sets], pa.binary()),
                                          pa.array(short, pa.binary())], names=["cls", "hashes", "short"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keep pairs with 100 * intersection >= percent * union."""
    for batch in batches:
        good = []
        for i, (a, b) in enumerate(zip(batch.column("a_hashes"), batch.column("b_hashes"))):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
            both = len(x) + len(y) - len(np.union1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both):
                good.append(i)
        taken = batch.take(pa.array(good, pa.int64()))
        yield pa.RecordBatch.from_arrays([taken.column("u"), taken.column("v")], names=["u", "v"])


_CROSS = "u long, v long"


def _cross(group: pd.DataFrame, bands: int, threshold: float, slack: float) -> pd.DataFrame:
    """Pairs of a bucket's two blocks (or of its one block) that may link different components.

    A pair is looked at in the first band that it shares.  Pairs whose
    signatures agree enough are compared by their shortened sets.  A pair that
    certainly links joins its components at once, so only a forest of such
    pairs leaves the task; pairs too close to the threshold for 32 bits leave
    it as well, and full sets decide.
    """
    left = group[group["side"] == 0]
    right = group[group["side"] == 1]
    alone = right.empty
    right = left if alone else right
    if left.empty:
        return pd.DataFrame({"u": [], "v": []}).astype("int64")
    band = int(group["band"].iloc[0])
    x, y = (np.stack([np.frombuffer(s, np.uint32) for s in part["signature"]]) for part in (left, right))
    a, b = ([np.frombuffer(s, np.uint32) for s in part["short"]] for part in (left, right))
    n, m = np.array(list(map(len, a))), np.array(list(map(len, b)))
    u, v = left["cls"].to_numpy(), right["cls"].to_numpy()
    # components joined so far inside this task
    name, label = np.unique(np.concatenate([left["component"], right["component"]]), return_inverse=True)
    p, q = label[:len(u)].copy(), label[len(u):].copy()
    close = 0.01
    out = []
    for i in range(len(x)):
        maybe = np.flatnonzero((p[i] != q) & (np.minimum(n[i], m) >= (threshold - close) * np.maximum(n[i], m)))
        if alone:
            maybe = maybe[maybe > i]
        if not len(maybe):
            continue
        agree = x[i] == y[maybe]
        shared = agree.reshape(len(maybe), bands, -1).all(2)
        maybe = maybe[(agree.mean(1) >= threshold - slack) & (shared.argmax(1) == band)]
        for j in maybe.tolist():
            if p[i] == q[j]:
                continue
            both = len(np.intersect1d(a[i], b[j], assume_unique=True))
            similarity = both / (n[i] + m[j] - both)
            if similarity < threshold - close:
                continue
            out.append((min(u[i], v[j]), max(u[i], v[j])))
            if similarity >= threshold + close:
                old, new = q[j], p[i]
                p[p == old] = new
                q[q == old] = new
    return pd.DataFrame(out, columns=["u", "v"]).astype("int64")


def _sets_of(classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Full sets of ``classes`` (cls), one row each, read again from the texts and written.

    Rows that repeat an id and a text have one key; tasks join them before they move.
    """
    classes = written(classes.distinct(), "candidates")
    may = may_hold(docs, "doc_row", key_filter(classes, "cls")).where("__may")
    rows = may.groupBy("doc_row").agg(F.first("text").alias("text"))
    # merged whatever its size: the candidates grow with the documents
    chosen = rows.join(classes.hint("merge"), F.col("doc_row") == F.col("cls"), "left_semi")
    return written(chosen.mapInArrow(lambda it: _sets(it, k), _SETS), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v: classes) whose full sets link.  Written, so computed once."""
    a = sets.select(F.col("cls").alias("u"), F.col("hashes").alias("a_hashes"))
    b = sets.select(F.col("cls").alias("v"), F.col("hashes").alias("b_hashes"))
    return written(pairs.join(a, "u").join(b, "v").select("u", "v", "a_hashes", "b_hashes")
                   .mapInArrow(lambda it: _confirm(it, percent), "u long, v long").distinct(), "edges")


def _of_documents(links: DataFrame, members: DataFrame) -> DataFrame:
    """Links of classes as links of their first documents."""
    u = members.select(F.col("cls").alias("u"), F.col("node").alias("u_node"))
    v = members.select(F.col("cls").alias("v"), F.col("node").alias("v_node"))
    return links.join(u, "u").join(v, "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    slack: float = SLACK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept; one row per input row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("doc_row"),
                       F.col("text").cast("binary").alias("text"))
    signed = written(docs.mapInArrow(lambda it: _sign(it, k, bands, rows), _SIGNED), "signed")
    usable = signed.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    # classes of equal sets, each as its smallest document sees it: copies are joined before they move
    first_row = F.struct("doc_id", "doc_row")
    members = written(usable.groupBy("set_id").agg(
        F.min(first_row).alias("first"), F.min_by(F.struct("bands", "signature"), first_row).alias("own")).select(
        "set_id", F.col("first.doc_row").alias("cls"), F.col("first.doc_id").alias("node"), "own.bands", "own.signature"), "classes")
    names = members.select("set_id", "cls", "node")
    same = usable.select("doc_id", "set_id").distinct().join(names, "set_id").where("doc_id <> node").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v"))
    banded = members.select("cls", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("cls").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    buckets = written(buckets, "buckets")
    inside = written(banded.join(buckets, ["band", "key"]), "members")
    stars = written(inside.where("cls <> pivot").select(F.col("pivot").alias("u"), F.col("cls").alias("v")).distinct(), "stars")
    first = _linked(stars, _sets_of(stars.select(F.explode(F.array("u", "v")).alias("cls")), docs, k), percent)
    now = written(components(_of_documents(first, names).unionByName(same)), "components")
    # buckets that still hold several components
    parts = names.select("cls", "node").join(now, "node", "left").select("cls", F.coalesce("component", "node").alias("component"))
    placed = inside.select("band", "key", "cls").join(parts, "cls")
    split = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = written(placed.join(split.select("band", "key"), ["band", "key"]), "open")
    sets = _sets_of(open_.select("cls"), docs, k)
    sizes = sets.select("cls", (F.octet_length("short") + F.lit(1000)).alias("bytes"))
    blocks = open_.join(sizes, "cls").groupBy("band", "key").agg(
        F.ceil(F.sum("bytes") / block_bytes).cast("int").alias("blocks"))
    rows_ = (open_.join(blocks, ["band", "key"]).join(members.select("cls", "signature"), "cls")
             .join(sets.select("cls", "short"), "cls")
             .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = rows_.withColumns({"i": F.col("own"), "j": F.explode(every), "side": F.lit(0)}).where("i <= j")
    right = rows_.where("blocks > 1").withColumns({"j": F.col("own"), "i": F.explode(every), "side": F.lit(1)}).where("i < j")
    columns = ["band", "key", "i", "j", "side", "cls", "component", "signature", "short"]
    pairs = left.select(columns).unionByName(right.select(columns)).groupBy("band", "key", "i", "j").applyInPandas(
        lambda g: _cross(g, bands, percent / 100, slack), _CROSS).distinct()
    second = _of_documents(_linked(pairs, sets, percent), names)
    final = components(now.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(second))
    out = signed.select("doc_id", "n_shingles").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN coalesce(len(ws), 0) = 0 THEN []
                             WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                             ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.m AS component_id, c.m = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT u, min(v) AS m FROM reach GROUP BY u) c ON c.u = w.doc_id
"""
