"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) with the columns of ``documents`` and
returns the documents that it keeps, with all their columns; the last returns
the pieces of the packed sequences.  ``run`` writes each stage's result to the
shared folder and reads it back for the next.

Stages decide on narrow rows (id and a key of the text).  To apply a decision,
a bitmap of bounded size goes to all tasks; the few rows that it cannot rule out
are joined, all others stay where they are.  A stage begins by removing what
earlier stages wrote for themselves and its input does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.llm import decontaminate, language_id, minhash_dedup, pack, pii
from pushback.llm.common import bounded_batches, key_filter, may_hold, release, row_key, table, written

#: A text that even the best language model codes with more bits than it has is no text of a known language.
MAX_BITS_PER_BYTE = 8.0


_KEY = ["doc_id", "__stage_row"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__stage_row", row_key("doc_id", "text"))


def _split(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` that are certainly not among ``keys`` (doc_id, __stage_row), and the others, to be looked up.

    The first need no join, so their texts do not move.
    """
    held = may_hold(_keyed(docs), "__stage_row", key_filter(keys, "__stage_row"))
    return held.where("NOT __may").select(*docs.columns), held.where("__may").drop("__may")


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``found`` (doc_id, doc_row)."""
    bad = written(found.select("doc_id", F.col("doc_row").alias("__stage_row")).distinct(), "found")
    sure, asked = _split(docs, bad)
    bad = bad.select(F.col("doc_id").alias("__stage_id"), F.col("__stage_row").alias("__stage_bad"))
    same = asked["doc_id"].eqNullSafe(bad["__stage_id"]) & (asked["__stage_row"] == bad["__stage_bad"])
    return sure.unionByName(asked.join(bad, same, "left_anti").select(*docs.columns))


#: Stages run one after the other in the same workers, so each holds a quarter of what an operator alone may.
SHARE = 4
#: Words whose ids a packing worker remembers: fewer than the operator alone may, as the stages share their executors.
PACK_WORDS = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a language, or that no language's model can code, go.

    Without any labelled row there is no model, and nothing is rejected.
    """
    bounded_batches(spark, SHARE)
    model = language_id.train(docs.select("doc_id", "lang", "text"))
    if not model.languages:
        return docs
    judged = language_id.predict(docs, model)
    keep = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("bits_per_byte") <= MAX_BITS_PER_BYTE)
    return judged.where(keep).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash: of each group of near-duplicates (five-word shingles, 0.8), the row with the smallest id stays.

    Rows are judged by id and text (of one id, the smallest ``row_key`` goes
    first): an id's other texts are documents of their own.  Rows that repeat a
    kept id and text are copies too: the one with the smallest other columns
    stays.  Rows without an id stay.
    """
    release(spark, docs)
    bounded_batches(spark, SHARE)
    node = F.when(F.col("doc_id").isNotNull(), F.col("__stage_row"))
    groups = minhash_dedup.near_duplicates(_keyed(docs).select(node.alias("doc_id"), "text"), k=5)
    # decided on narrow rows, each id and text once
    links = written(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__stage_row"), "component_id").distinct(), "links")
    ends = links.unionByName(links.select(F.col("component_id").alias("__stage_row"), "component_id").distinct())
    rows = written(_keyed(docs).where("doc_id IS NOT NULL").groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")), "rows")
    named = written(rows.select(*_KEY).join(ends, "__stage_row"), "named")
    first = named.groupBy("component_id").agg(F.min(F.struct(*_KEY)).alias("first")).select("first.*")
    gone = written(named.select(*_KEY).join(first, _KEY, "left_anti"), "gone")
    repeated = rows.where("n > 1").select(*_KEY)
    # applied in one pass; of the rows looked up, copies of one id and text become one before they move
    sure, asked = _split(docs, gone.unionByName(repeated))
    bare = asked.where("doc_id IS NULL").select(*docs.columns)
    one = asked.where("doc_id IS NOT NULL").groupBy(*_KEY).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return sure.unionByName(bare).unionByName(one.join(gone, _KEY, "left_anti").select("row.*"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a copy of a benchmark item go."""
    release(spark, docs)
    items = table(spark, sf_dir, "benchmark")
    bounded_batches(spark, SHARE)
    found = decontaminate.contaminated(docs.select("doc_id", "text"), items)
    return _without(docs, found)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: personal data is replaced by its kind; ``n_chars`` follows the new text."""
    release(spark, docs)
    bounded_batches(spark, SHARE)
    clean = pii.sanitise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: all kept documents as pieces of training sequences."""
    release(spark, docs)
    bounded_batches(spark, SHARE)
    return pack.pack(docs.select("doc_id", "text"), pack.default_tokenizer(), words=PACK_WORDS)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("pii", personal_data),
    ("packing", packing),
]
#: Trained models, alignments and a tokenizer: no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
