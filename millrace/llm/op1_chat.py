"""Chat formatting: every conversation is rendered once for each of its participants.

From a participant's perspective its own turns are the assistant's and carry the training mask, the others' turns are those of
named users, and system turns stay system turns. The result is one segment for each turn and perspective, with the segment's
place in the rendered dialogue; a dialogue is the concatenation of its segments by `start`. A dialogue is never gathered into
one row, so that one conversation may hold a large share of the table.

Defined results: a null text is an empty one; a null speaker is the participant named by `unnamed`; rows with a null
conversation id form one conversation; turns that are null come first; turns with equal numbers are ordered by speaker and
text; repeated rows are repeated turns. A conversation with only system turns has no participant and gives no segment.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table, text_of

#: Turns of one block share a window; the blocks' totals are summed by a second, much shorter one.
BLOCK = 1024


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", system: tuple[str, ...] = ("system",), unnamed: str = "unknown") -> DataFrame:
    """Columns: the conversation, perspective, the turn, speaker, kind (assistant, user, system), mask (1: learn from it), content, start, n_chars, mask_start, mask_end (in characters of the dialogue; an empty span without mask)."""
    said = turns.select(F.col(conversation).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(speaker).cast("string"), F.lit(unnamed)).alias("speaker"), text_of(text).alias("said"))
    said = said.withColumn("block", F.floor(F.col("t") / BLOCK))
    participants = said.where(~F.col("speaker").isin(*system)).select("c", F.col("speaker").alias("perspective")).distinct().withColumnRenamed("c", "pc")
    seen = said.join(participants, F.col("c").eqNullSafe(F.col("pc"))).drop("pc")
    kind = F.when(F.col("speaker").isin(*system), "system").when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    seen = seen.withColumn("kind", kind)
    head = F.concat(F.lit("<|"), F.col("kind"), F.when(F.col("kind") == "user", F.concat(F.lit(" name="), F.col("speaker"))).otherwise(F.lit("")), F.lit("|>\n"))
    seen = seen.withColumn("head", head).withColumn("content", F.concat("head", "said", F.lit("<|end|>\n")))
    seen = seen.withColumn("n_chars", F.length("content").cast("long"))

    totals = seen.groupBy("c", "perspective", "block").agg(F.sum("n_chars").alias("n"))
    before = Window.partitionBy("c", "perspective").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("c").alias("c2"), F.col("perspective").alias("p2"), F.col("block").alias("b2"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    seen = seen.join(totals, F.col("c").eqNullSafe(F.col("c2")) & (F.col("perspective") == F.col("p2")) & F.col("block").eqNullSafe(F.col("b2")))
    inside = Window.partitionBy("c", "perspective", "block").orderBy(F.col("t").asc_nulls_first(), "speaker", "said").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("start", F.col("base") + F.coalesce(F.sum("n_chars").over(inside), F.lit(0)))
    own = F.col("kind") == "assistant"
    return seen.select(
        F.col("c").alias(conversation), "perspective", F.col("t").alias(turn), "speaker", "kind", own.cast("int").alias("mask"), "content", "start", "n_chars",
        F.when(own, F.col("start") + F.length("head")).otherwise(F.col("start")).alias("mask_start"), F.when(own, F.col("start") + F.col("n_chars")).otherwise(F.col("start")).alias("mask_end"),
    )


def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


OP1_SQL = """
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said FROM conversations),
participants AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT s.conv_id, p.perspective, s.turn, s.speaker, s.said,
         CASE WHEN s.speaker = 'system' THEN 'system' WHEN s.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS kind
  FROM said s JOIN participants p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (SELECT *, '<|' || kind || CASE WHEN kind = 'user' THEN ' name=' || speaker ELSE '' END || '|>' || chr(10) AS head FROM seen),
whole AS (SELECT *, head || said || '<|end|>' || chr(10) AS content FROM headed),
placed AS (
  SELECT *, CAST(length(content) AS BIGINT) AS n_chars,
         CAST(coalesce(sum(length(content)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM whole)
SELECT conv_id, perspective, turn, speaker, kind, CAST(kind = 'assistant' AS INTEGER) AS mask, content, start, n_chars,
       CASE WHEN kind = 'assistant' THEN start + length(head) ELSE start END AS mask_start,
       CASE WHEN kind = 'assistant' THEN start + n_chars ELSE start END AS mask_end
FROM placed
"""
