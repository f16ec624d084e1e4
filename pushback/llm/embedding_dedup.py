"""Embedding near-duplicates by spherical-cap filters from random product codes.

Unit vectors are turned by a random rotation and cut into two blocks; each
block has a codebook of random directions, and a filter direction is a pair of
codes, so the inner product with any of the ``codes**2`` filters is the sum of
two block products.  A vector is a member of every filter whose cap it is in:
those list-decoded within ``margin`` of its best filter.  It searches in its
best filter alone.  The products of two vectors at cosine c with one direction
differ by less than ``sqrt(2 - 2c)`` and typically by an eighth of that (64
dimensions), so with the default margin a link is missed about once in ten
million.  Candidates are all members of the searched filter with the same
label; each is verified by the cosine in double precision.

Equal vectors are one node with a weight; links between vectors are counted
where they are verified, and only the edges of a spanning forest leave a task,
so the output never grows with the square of a group.  A filter with many
vectors is split into blocks of searchers and blocks of members, each pair of
blocks its own group, which bounds the memory of a task exactly and loses
nothing.  The number of codes grows with the root of the largest label, so a
best filter has about ``PER_FILTER`` searchers at every size.

Edge cases: a null label, a null or empty vector, zeros and vectors with null
or non-finite parts link with nothing (their component is their own id); only
vectors of one length are compared; repeated rows with one id count as further
vectors; null ids stay in the result with a null component and no links; an
empty table gives an empty result; other columns are ignored; doubles stay
doubles; links at a cosine equal to the threshold count (ties); a vector has to
fit in a row, and long ones are decoded a few at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import table, written
from .components import components

THRESHOLD, MARGIN, SEED = 0.98, 0.15, 11
#: Vectors of a filter that one group compares with as many others.
BLOCK = 2000
#: Vectors of one label and length, about, for one filter of the best-filter partition.
PER_FILTER = 50


class Caps:
    """Filter directions for one vector length."""

    def __init__(self, dim: int, codes: int):
        rng = np.random.default_rng([SEED, dim])
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cut = (dim + 1) // 2
        self.codes = codes
        self.books = [self._book(rng, n, codes) for n in (self.cut, dim - self.cut)]

    @staticmethod
    def _book(rng: np.random.Generator, dim: int, codes: int) -> np.ndarray:
        book = rng.normal(size=(codes, dim)) if dim else np.zeros((codes, 0))
        norm = np.linalg.norm(book, axis=1, keepdims=True)
        return book / np.where(norm > 0, norm, 1) / math.sqrt(2)

    def decode(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best filter of each unit vector; and (row, filter) of all filters within ``margin`` of the best.

        The best pair is the pair of block maxima; a code is only expanded if
        it reaches the threshold with the other block's best.
        """
        y = x @ self.rotation
        a, b = y[:, :self.cut] @ self.books[0].T, y[:, self.cut:] @ self.books[1].T
        top_a, top_b = a.max(1), b.max(1)
        best = a.argmax(1) * self.codes + b.argmax(1)
        row, i = np.nonzero(a + top_b[:, None] >= (top_a + top_b - margin)[:, None])
        rows, filters = [], []
        for part in range(0, len(row), 4096):
            r, c = row[part:part + 4096], i[part:part + 4096]
            k, j = np.nonzero(a[r, c][:, None] + b[r] >= (top_a + top_b - margin)[r][:, None])
            rows.append(r[k])
            filters.append(c[k] * self.codes + j)
        return best, np.concatenate(rows or [np.empty(0, int)]), np.concatenate(filters or [np.empty(0, int)])


def _unit(vectors: list[list[float]]) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


_CAPS = "label long, dim int, filter long, node long, weight long, searches boolean, vector "
#: Block products (vectors times codes) that a task holds at a time.
PRODUCTS = 2000 * 256


def _caps(batches: Iterator[pa.RecordBatch], codes: int, margin: float) -> Iterator[pa.RecordBatch]:
    rows, caps = max(1, min(2000, PRODUCTS // codes)), {}
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            batch = whole.slice(start, rows)
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                own = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names).filter(pa.array(dims == dim))
                x = _unit(own.column("vector").to_pylist())
                if dim not in caps:
                    caps = {dim: Caps(dim, codes)}  # one length at a time
                best, row, filters = caps[dim].decode(x, margin)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [own.column("label").take(take), own.column("dim").take(take), pa.array(filters, pa.int64()),
                     own.column("node").take(take), own.column("weight").take(take), pa.array(best[row] == filters),
                     own.column("vector").take(take)],
                    names=["label", "dim", "filter", "node", "weight", "searches", "vector"])


_LINKS = "u long, v long, n long"


def _verify(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of a group's searchers: (u, null, weight of all linked) and edges (u, v, 0) of a spanning forest."""
    searchers, members = group[group["searches"] & group["asks"]], group[group["answers"]]
    if searchers.empty or members.empty:
        return pd.DataFrame({"u": [], "v": [], "n": []})
    x, y = _unit(searchers["vector"].tolist()), _unit(members["vector"].tolist())
    ids, other, weight = searchers["node"].to_numpy(), members["node"].to_numpy(), members["weight"].to_numpy()
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while (up := root.get(a, a)) != a:
            root[a] = root.get(up, up)
            a = up
        return a

    out = []
    for start in range(0, len(x), 256):
        linked = x[start:start + 256] @ y.T >= threshold
        linked &= ids[start:start + 256, None] != other[None, :]
        for k in np.flatnonzero(linked.any(1)).tolist():
            u = int(ids[start + k])
            own = linked[k]
            out.append((u, None, int(weight[own].sum())))
            for v in other[own].tolist():
                a, b = find(u), find(v)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((u, v, 0))
    # as nullable integers from the start: a float column would round the 64-bit names
    return pd.DataFrame({name: pd.array([r[i] for r in out], "Int64") for i, name in enumerate(("u", "v", "n"))})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN, block: int = BLOCK) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    given = vectors.schema["embedding"].dataType
    kind = "array<float>" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast(kind).alias("vector"))
    usable = F.expr("label IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) "
                    "AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)")
    rows = written(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    # equal vectors are one node, named by a key of its own (ids may repeat)
    nodes = rows.where("usable").groupBy("label", "vector").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least")).withColumn("dim", F.size("vector"))
    nodes = written(nodes.withColumn("node", F.xxhash64("label", "vector")), "nodes")
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    codes = max(16, math.ceil(math.sqrt(largest / PER_FILTER)))
    caps = nodes.select("label", "dim", "node", "weight", "vector").mapInArrow(lambda it: _caps(it, codes, margin), _CAPS + kind)
    caps = written(caps, "caps")
    key = ["label", "dim", "filter"]
    # a filter's vectors fall into blocks; each pair of blocks (searchers, members) is a group
    sizes = caps.groupBy(*key).agg(F.count("*").alias("size"), F.max("searches").alias("any")).where("any")
    sizes = sizes.select(*key, F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    dealt = caps.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    asks = dealt.where("searches").withColumns({"s": F.col("own"), "m": F.explode(every)}).withColumns(
        {"asks": F.lit(True), "answers": F.lit(False)})
    answers = dealt.withColumns({"m": F.col("own"), "s": F.explode(every)}).withColumns(
        {"asks": F.lit(False), "answers": F.lit(True)})
    pairs = asks.unionByName(answers).select(*key, "s", "m", "node", "weight", "searches", "asks", "answers", "vector")
    found = written(pairs.groupBy(*key, "s", "m").applyInPandas(lambda g: _verify(g, threshold), _LINKS), "links")
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("linked"))
    groups = components(found.where("v IS NOT NULL").select("u", "v"))
    # components of nodes become components of ids: the least id of a component's vectors
    of = nodes.select("node", "label", "vector", "weight", "least").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(least, "component").join(counts, "node", "left").select(
        "label", "vector", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("usable").join(of, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM e
      WHERE label IS NOT NULL AND len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0),
link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE a.norm > 0 AND b.norm > 0 AND len(a.v) = len(b.v)
           AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS v FROM e UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.u = e.vec_id)::BIGINT AS n_links,
       c.m AS component_id, c.m = e.vec_id AS kept
FROM e JOIN (SELECT u, min(v) AS m FROM reach GROUP BY u) c ON c.u = e.vec_id
"""
