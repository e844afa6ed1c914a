"""Chat formatting by rotation of perspective.

For every participant of a conversation the dialogue is rendered once with that speaker as
`assistant`, the others as named users and system turns as they are. The result has one row per
message and perspective: the rendered text, its place in the rendered dialogue and the span on
which that perspective trains (its own turns, end mark included). A dialogue is its rows'
text in order of seq, so that no conversation, however long, has to fit in one row or one task.
Places are prefix sums in two levels: over blocks of BLOCK turn numbers, then within a block, which one
task sorts.

Defined results: messages are ordered by turn (null first), role and text; a null role is the
participant `unknown`; a null text is empty; a null conv_id is a conversation of its own; a
conversation of system turns alone has no participant and no rows; equal rows are rendered as
often as they occur; `<|` in a text or a role is broken up as `< |`, and line breaks in a rendered role are spaces, so that
neither can end its own turn or begin another; an empty table gives no rows; texts of any length are rendered whole; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.llm.common import table

#: Turn numbers that share a block.
BLOCK = 64
SYSTEM = "system"


def rotate(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, speaker, seq, turn, role, rendered, start, end, mask_start, mask_end by perspective."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    own = F.col("role") == F.col("speaker")
    name = F.translate(F.regexp_replace("role", r"<\|", "< |"), "\r\n", "  ")
    as_role = F.when(own, F.lit("assistant")).when(F.col("role") == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), name))
    head = F.concat(F.lit("<|im_start|>"), as_role, F.lit("\n"))
    body = F.concat(F.regexp_replace("text", r"<\|", "< |"), F.lit("<|im_end|>\n"))
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "speaker", "turn", "role", "text", F.expr(f"coalesce(turn div {block}, {-(1 << 62)})").alias("block"), F.concat(head, body).alias("rendered"), F.length(head).cast("long").alias("head"), own.alias("trained")
    )
    one = Window.partitionBy("conv_id", "speaker").orderBy("block")
    before = one.rowsBetween(Window.unboundedPreceding, -1)
    blocks = seen.groupBy("conv_id", "speaker", "block").agg(F.sum(F.length("rendered")).alias("chars"), F.count(F.lit(1)).alias("n"))
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"), F.col("speaker").alias("b_speaker"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
    )
    within = Window.partitionBy("conv_id", "speaker", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = seen.withColumn("sofar", F.sum(F.length("rendered")).over(running)).withColumn("nth", F.row_number().over(within))
    placed = placed.join(blocks, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("speaker") == F.col("b_speaker")) & (F.col("block") == F.col("b_block")))
    end = (F.col("chars_before") + F.col("sofar")).cast("long")
    start = (end - F.length("rendered")).cast("long")
    return placed.select(
        "conv_id", "speaker", (F.col("n_before") + F.col("nth")).cast("long").alias("seq"), "turn", "role", "rendered", start.alias("start"), end.alias("end"),
        F.when(F.col("trained"), start + F.col("head")).alias("mask_start"), F.when(F.col("trained"), end).alias("mask_end"),
    )


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id AS c, role AS speaker FROM r WHERE role <> 'system'),
h AS (SELECT conv_id, speaker, turn, role, text,
    '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || translate(replace(role, '<|', '< |'), chr(13) || chr(10), '  ') END || chr(10) AS head,
    replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM r JOIN s ON conv_id IS NOT DISTINCT FROM c),
p AS (SELECT *, sum(length(head || body)) OVER w AS e, row_number() OVER w AS seq FROM h
  WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, seq::BIGINT AS seq, turn, role, head || body AS rendered, (e - length(head || body))::BIGINT AS start, e::BIGINT AS "end",
  CASE WHEN role = speaker THEN (e - length(body))::BIGINT END AS mask_start, CASE WHEN role = speaker THEN e::BIGINT END AS mask_end
FROM p
"""
