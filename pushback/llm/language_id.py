"""Language identification by prediction by partial matching (PPM) over bytes.

Per language a context tree of up to ``order`` preceding bytes holds symbol
counts.  Escape method C without exclusion gives each byte a probability: at
the longest context known, a symbol seen there gets c / (n + d), any other pays
the escape d / (n + d) and is coded one context shorter, down to a uniform code
over 256 bytes.  The statistics are frozen after training, so the exact code
length of a whole text is a sum over its bytes.  The language with the shortest
code is predicted; ``score`` is its posterior under equal priors.

Every language with a labelled row is learned, from a bounded sample: about
``docs_per_language`` rows and at most about ``bytes_per_language`` bytes of
each, drawn by a hash of the row's id and text; rows longer than that are not
drawn.  The byte statistics are counted by Spark.  Contexts seen fewer than
``min_count`` times are left out, and only seen (context, byte) entries are
stored, ``max_entries`` a language, most frequent contexts first.  The
broadcast has at most 16 bytes an entry: 2 MB a language; what one language
keeps does not depend on the number of languages.

Edge cases: a null text or one without a letter gets ``und`` with score 0, so
does every text when there are no labelled rows; each row is judged by its own
whole text, however long (a megabyte at a time), so repeated rows agree; equal
code lengths go to the alphabetically first language; empty tables give empty
results; ``predict`` keeps all input columns (an input column named like one of
its own is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fold, row_key, slices, table

ORDER = 3
DOCS_PER_LANGUAGE, BYTES_PER_LANGUAGE, MAX_ENTRIES, MIN_COUNT = 500, 4 << 20, 1 << 17, 8
#: Bytes of text that are looked up at a time.
STEP = 1 << 20
UNDETERMINED = "und"


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text after ORDER zero bytes; and a mask of the texts' own bytes."""
    pad = bytes(ORDER)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    own = np.ones(len(data), bool)
    starts = np.cumsum([0, *(len(t) + ORDER for t in texts)])[:-1]
    for k in range(ORDER):
        own[starts + k] = False
    return data, own


def _contexts(data: np.ndarray) -> np.ndarray:
    """The three bytes before each byte from the fourth on, as one number."""
    x = data.astype(np.uint32)
    return (x[:-3] << 16) | (x[1:-2] << 8) | x[2:-1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs):
            data, own = _padded([t for t, x in zip(texts, langs) if x == lang])
            grams = (_contexts(data).astype(np.uint64) << np.uint64(8)) | data[3:]
            grams, n = np.unique(grams[own[3:]], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.int32()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"])


def _shortened(contexts: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` bytes of contexts."""
    return contexts & ((1 << 8 * k) - 1)


def _found(own: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in the sorted ``own``, and whether they are there."""
    at = np.minimum(np.searchsorted(own, asked), max(0, len(own) - 1))
    return at, own[at] == asked if len(own) else np.zeros(len(asked), bool)


class Tree:
    """One language's contexts with their escapes, and seen (context, byte) pairs with their code lengths, by depth."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, frequent: list[np.ndarray], max_entries: int):
        levels = []
        for k in range(ORDER + 1):
            pairs, inverse = np.unique((_shortened(grams >> 8, k) << 8) | (grams & 255), return_inverse=True)
            count = np.bincount(inverse, n, len(pairs))
            contexts, inverse = np.unique(pairs >> 8, return_inverse=True)
            total, distinct = np.bincount(inverse, count, len(contexts)), np.bincount(inverse, minlength=len(contexts))
            known = _found(frequent[k], contexts)[1] if k else np.ones(len(contexts), bool)
            levels.append((pairs, count, contexts, inverse, total, distinct, known))
        # a context is at least as frequent as any longer one that ends with it, so parents come first
        depth = np.concatenate([np.full(len(x[2]), k) for k, x in enumerate(levels)])
        total, distinct, known = (np.concatenate([x[i] for x in levels]) for i in (4, 5, 6))
        ranked = np.lexsort((depth, -total))
        ranked = ranked[known[ranked]]
        kept = np.zeros(len(depth), bool)
        kept[ranked[np.cumsum(distinct[ranked]) <= max_entries]] = True
        self.levels = []
        for k, (pairs, count, contexts, inverse, total, distinct, _) in enumerate(levels):
            keep = kept[depth == k]
            escape, code = -np.log2(distinct / (total + distinct)), -np.log2(count / (total + distinct)[inverse])
            seen = keep[inverse]
            self.levels.append((contexts[keep].astype(np.uint32), escape[keep].astype(np.float32),
                                pairs[seen].astype(np.uint32), code[seen].astype(np.float32)))

    def codes(self, grams: np.ndarray) -> np.ndarray:
        """Code length in bits of the last byte of each gram after the bytes before it."""
        out = np.full(len(grams), 8.0)
        for k, (contexts, escape, pairs, code) in enumerate(self.levels):
            if not len(contexts):
                continue
            context = _shortened(grams >> np.uint32(8), k)
            at, known = _found(contexts, context)
            out += np.where(known, escape[at], 0.0)
            at, seen = _found(pairs, (context << np.uint32(8)) | (grams & np.uint32(255)))
            out = np.where(seen, code[at], out)
        return out


class Model:
    """Frozen statistics: one tree per language."""

    def __init__(self, languages: list[str], grams: np.ndarray, lang: np.ndarray, n: np.ndarray,
                 max_entries: int = MAX_ENTRIES, min_count: int = MIN_COUNT):
        self.languages = languages
        frequent = []
        for k in range(ORDER + 1):
            own, inverse = np.unique(_shortened(grams >> 8, k), return_inverse=True)
            frequent.append(own[np.bincount(inverse, n, len(own)) >= min_count])
        by_language = np.argsort(lang, kind="stable")
        cuts = np.searchsorted(lang[by_language], np.arange(len(languages) + 1))
        self.trees = [Tree(grams[own], n[own], frequent, max_entries)
                      for own in (by_language[i:j] for i, j in zip(cuts, cuts[1:]))]

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each non-empty text under each language."""
        data, own = _padded(texts)
        grams = ((_contexts(data) << np.uint32(8)) | data[3:])[own[3:]]
        ends = np.cumsum([len(t) for t in texts])
        starts = np.append(0, ends[:-1])
        out = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(grams), STEP):
            b = min(len(grams), a + STEP)
            # the texts with bytes in this step
            first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
            distinct, inverse = np.unique(grams[a:b], return_inverse=True)
            for i, tree in enumerate(self.trees):
                out[first:last, i] += np.add.reduceat(tree.codes(distinct)[inverse], np.maximum(starts[first:last], a) - a)
        return out


def train(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, bytes_per_language: int = BYTES_PER_LANGUAGE) -> Model:
    """Fit on ``labelled`` (doc_id, lang, text)."""
    size = F.octet_length("text")
    rows = labelled.where(F.col("lang").isNotNull() & (size <= bytes_per_language))
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).orderBy("lang").collect()  # one row a language
    if not found:
        return Model([], *(np.empty(0, np.int64) for _ in range(3)))
    # a row is drawn when its hash lies in its language's share of the hash range
    shares = labelled.sparkSession.createDataFrame(
        [(r["lang"], i, min(1.0, docs_per_language / r["n"], bytes_per_language / max(1, r["bytes"]))) for i, r in enumerate(found)],
        "lang string, number int, share double")
    draw = F.pmod(row_key("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    counted = (drawn.select(F.col("number").alias("lang"), F.col("text").cast("binary").alias("text"))
               .mapInArrow(_count, "lang int, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    return Model([r["lang"] for r in found], *(counted.column(c).to_numpy().astype(np.int64) for c in ("gram", "lang", "n")))


_OWN = "lang_pred string, score double, bits_per_byte double"


def _predict(batches: Iterator[pa.RecordBatch], model: Model, text: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, 1 << 20):
        texts, letters = batch.column(text).cast(pa.binary()).to_pylist(), batch.column("__ppm_letters").to_pylist()
        judged = [i for i, ok in enumerate(letters) if ok and model.languages]
        pred, score, rate = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
        if judged:
            bits = model.lengths([texts[i] for i in judged])
            best = bits.argmin(1)
            least = bits.min(1)
            posterior = 1 / np.exp2(least[:, None] - bits).sum(1)
            for i, b, p, x in zip(judged, best.tolist(), posterior.tolist(), least.tolist()):
                pred[i], score[i], rate[i] = model.languages[b], p, x / len(texts[i])
        kept = [c for c in batch.schema.names if c != "__ppm_letters"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(pred), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
            names=[*kept, "lang_pred", "score", "bits_per_byte"])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score and bits_per_byte to ``docs``."""
    own = StructType.fromDDL(_OWN)
    base = docs.drop(*own.names)
    schema = StructType([*base.schema.fields, *own.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inputs = base.withColumn("__ppm_letters", F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))
    return inputs.mapInArrow(lambda it: _predict(it, shared.value, text), schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = train(docs.where(fold("f", "doc_id", 4) != 2))
    held = docs.select("doc_id", (fold("f", "doc_id", 4) == 2).alias("held_out"), "text")
    # only the text reaches the prediction; the id and the fold ride along
    return predict(held, model).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
