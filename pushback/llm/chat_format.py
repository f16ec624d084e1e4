"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is trainable.  Turns after the last reply (or a
conversation without a reply) become one context-only example, so that no turn
is lost.

Template: ``<s>`` opens an example; a turn is ``[INST]role[/INST]text</s>``.
Inside roles and texts the characters ``\\``, ``[`` and ``<`` are written as
``\\b``, ``\\o`` and ``\\l``, so no control string can appear in them, and
``unescape`` restores them exactly.

Edge cases: a null role or text counts as empty; turns are ordered by (turn,
role, text) with nulls first, so ties have a fixed order and repeated rows
stay repeated turns; rows with a null conversation id form one conversation;
an empty table gives no examples; other columns are ignored.  A conversation
is one row by nature (its last example holds all its turns), so it has to fit
in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BOS, OPEN, CLOSE, EOS = "<s>", "[INST]", "[/INST]", "</s>"
#: The conversation that the registered query adds (fixed values).
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def _replaced(column: Column, old: str, new: str) -> Column:
    return F.replace(column, F.lit(old), F.lit(new))


def escape(column: Column) -> Column:
    return _replaced(_replaced(_replaced(column, "\\", "\\b"), "[", "\\o"), "<", "\\l")


def unescape(column: Column) -> Column:
    return _replaced(_replaced(_replaced(column, "\\l", "<"), "\\o", "["), "\\b", "\\")


def format_examples(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id, turn, role, text -> one row per example.

    Columns: conv_id; example (index of its last turn in the conversation);
    formatted; loss_start, loss_end (code points of the trainable span, end
    exclusive; null for a context-only example).
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    by_conversation = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn"), role.alias("role"), text.alias("text")))).alias("turns"))
    replies = F.filter(F.sequence(F.lit(0), F.size("turns") - 1),
                       lambda i: (F.get("turns", i)["role"] == "assistant") | (i == F.size("turns") - 1))
    rendered = F.transform("turns", lambda t: F.concat(
        F.lit(OPEN), escape(t["role"]), F.lit(CLOSE), escape(t["text"]), F.lit(EOS)))
    target = F.get("turns", F.col("example"))
    loss_end = F.length("formatted") - len(EOS)
    trainable = target["role"] == "assistant"
    return (
        by_conversation.select("conv_id", "turns", rendered.alias("rendered"), F.explode(replies).alias("example"))
        .select("conv_id", "example", "turns",
                F.concat(F.lit(BOS), F.array_join(F.slice("rendered", F.lit(1), F.col("example") + 1), "")).alias("formatted"))
        .select("conv_id", "example", "formatted",
                F.when(trainable, loss_end - F.length(escape(target["text"]))).alias("loss_start"),
                F.when(trainable, loss_end).alias("loss_end"))
    )


def parsed(formatted: Column) -> Column:
    """Read a formatted example back: array of (role, text)."""
    body = F.split(F.substr(formatted, F.lit(len(BOS) + 1)), EOS, -1)
    turns = F.slice(body, F.lit(1), F.size(body) - 1)

    def turn(segment: Column) -> Column:
        role = F.substring_index(F.substr(segment, F.lit(len(OPEN) + 1)), CLOSE, 1)
        text = F.substr(segment, F.length(role) + (len(OPEN) + len(CLOSE) + 1))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples hold, read back from the formatted text."""
    reply = F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    grouped = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("loss_start").isNotNull(),
                                           F.struct("example", unescape(reply).alias("text"))))).alias("replies"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"))
    all_turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("replies", lambda r: r["text"]), "")
    return grouped.withColumn("read", parsed(F.col("longest"))).select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(*columns)
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return digest(format_examples(turns.unionByName(extra)))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         17 + length(role) + length(text)
         + length(regexp_replace(role || text, '[^\\\\<\\[]', '', 'g')) AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, 3 + sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(prefix) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
