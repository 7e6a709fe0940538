"""Chat formatting by prefix-target expansion.

Each assistant turn becomes one example: every earlier turn is context, only that reply is trainable. The
template writes a turn as ``### role: text</turn>\\n``; in texts and roles a backslash is put before ``\\`` and
``#`` (in roles before ``:`` too) and into ``</turn>`` (``<\\/turn>``), so control strings never occur inside a text
and reading back is exact.

Defined results: null role or text counts as empty; turns are ordered by turn, role, text, so ties and repeated
rows have one order; turns after the last reply, or of a conversation without one, are one row without a loss span
(``target`` null), so that the output holds every turn; a null conv_id is a conversation; an empty table gives no
rows; other columns of the input are ignored. The text of the examples of one conversation grows with the square of
its turns, as the method has it; a conversation is read by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

END = "</turn>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\#"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_prefix(role: Column) -> Column:
    return F.concat(F.lit("### "), F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit(": "))


def prefix_target_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, target, text, loss_start, loss_length): one row per assistant turn; spans in code points from 0.

    ``target`` is the reply's place in its conversation, from 0; the row of trailing turns has none and no span.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumns({"prefix": turn_prefix(F.col("role")), "body": escape(F.col("text"))})
    t = t.select("conv_id", F.struct("turn", "role", "text", F.concat("prefix", "body", F.lit(END)).alias("piece"), F.length("prefix").alias("head"), F.length("body").alias("body")).alias("t"))
    c = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    c = c.withColumn("replies", F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda k: F.get("ts", k)["role"] == "assistant"))
    last = F.coalesce(F.get("replies", F.size("replies") - 1), F.lit(-1))
    c = c.withColumn("target", F.explode(F.when(last < F.size("ts") - 1, F.concat("replies", F.array(F.lit(None).cast("int")))).otherwise(F.col("replies"))))
    first = F.when(F.col("target").isNull(), last + 2).otherwise(F.lit(1))
    count = F.when(F.col("target").isNull(), F.size("ts") - 1 - last).otherwise(F.col("target") + 1)
    reply = F.get("ts", F.col("target"))
    text = F.array_join(F.transform(F.slice("ts", first, count), lambda x: x["piece"]), "")
    return c.select("conv_id", F.col("target").cast("long").alias("target"), text.alias("text"), reply["head"].alias("head"), reply["body"].cast("long").alias("loss_length")).select(
        "conv_id", "target", "text", (F.length("text") - F.col("loss_length") - len(END)).cast("long").alias("loss_start"), "loss_length"
    )


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> from formatted text."""
    parts = F.filter(F.split(text, END), lambda x: x != "")
    head = r"(?s)^### ((?:[^\\:]|\\.)*+): "
    return F.transform(parts, lambda x: F.struct(unescape(F.regexp_extract(x, head, 1)).alias("role"), unescape(F.regexp_replace(x, head, "")).alias("text")))


def digests(examples: DataFrame) -> DataFrame:
    """Turns and trainable texts of each conversation, read back from the formatted examples."""
    loss = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_length")))
    per = examples.groupBy("conv_id").agg(
        F.max_by("text", "target").alias("longest"),
        F.max(F.when(F.col("target").isNull(), F.col("text"))).alias("tail"),
        F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", loss.alias("loss"))))).alias("losses"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    per = per.withColumn("turns", F.concat(read_turns(F.coalesce("longest", F.lit(""))), read_turns(F.coalesce("tail", F.lit("")))))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return per.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text")
    )
    return digests(prefix_target_examples(c.unionByName(planted)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
l AS (
  SELECT *, length(role) + length(text) + 14
    + (length(role) - length(replace(replace(replace(role, '\', ''), '#', ''), ':', '')))
    + (length(text) - length(replace(replace(text, '\', ''), '#', '')))
    + (length(role) - length(replace(role, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS n
  FROM t),
w AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
    max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS more
  FROM l)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN upto END), 0) + coalesce(sum(CASE WHEN more = 0 THEN n END), 0) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""
