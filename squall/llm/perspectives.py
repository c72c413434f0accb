"""Chat formatting by perspective rotation, with built-in functions only.

A conversation is rendered once for each participant: that speaker's turns are the
assistant's, everybody else's are turns of named users, and the loss mask covers exactly
the speaker's own words and end mark. ``system`` turns are context, never a
participant. Rendering uses the ChatML marks; ``<|`` inside a role or text is written ``< |``, so
content cannot forge a mark.

Conversations of any length: turns are numbered by one distributed sort, and every
``PART_TURNS`` turns of a conversation make one rendered part, so no task ever holds more
than a part. Every part is rendered for every participant of the conversation, with an empty mask
where the participant is silent, so a participant's parts join in order to the whole dialogue.
Participants are dealt to the parts by (conversation, part), so a hot conversation is split.

Defined results: turns are ordered by turn, role, text (nulls first); fully equal turns stay
repeated; a null role speaks as ``unknown``; a null text is empty; rows without conv_id form
one conversation; a conversation with system turns only gives no row. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm import common

PART_TURNS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rows (conv_id, part, speaker, n_turns, n_spoken, rendered, mask) from (conv_id, turn, role, text).

    ``mask``: comma-joined start:end offsets in code points of what the loss covers.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("who"), common.text_or_empty().alias("said"),
                        F.col("role").alias("role_"), F.col("text").alias("text_"))
    order = [F.col("conv_id"), F.col("turn"), F.col("role_"), F.col("text_")]
    rows, _ = common.numbered(rows, order, "turns", "at")
    rows = common.stored(rows.select("conv_id", "who", "said", "at"), "turns-numbered")
    first = rows.groupBy("conv_id").agg(F.min("at").alias("first"), F.max("at").alias("last")).withColumnRenamed("conv_id", "conv")
    rank = F.col("at") - F.col("first")
    parts = (rows.join(first, F.col("conv_id").eqNullSafe(F.col("conv")))
             .withColumn("part", ((rank - rank % part_turns) / part_turns).cast("long"))
             .groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("at", "who", "said"))).alias("turns")))
    length = F.col("last") - F.col("first")
    pairs = rows.where("who <> 'system'").select(F.col("conv_id").alias("of"), F.col("who").alias("speaker")).distinct()
    pairs = (pairs.join(first, F.col("of").eqNullSafe(F.col("conv")))
             .select("of", "speaker", F.explode(F.sequence(F.lit(0).cast("long"), ((length - length % part_turns) / part_turns).cast("long"))).alias("of_part")))
    one = (parts.join(pairs, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
           .select("conv_id", "part", "turns", "speaker"))

    def opening(t: Column) -> Column:
        return (F.when(t["who"] == F.col("speaker"), F.lit(f"{OPEN}assistant\n"))
                .when(t["who"] == "system", F.lit(f"{OPEN}system\n"))
                .otherwise(F.concat(F.lit(f"{OPEN}user name="), _plain(t["who"]), F.lit("\n"))))

    def body(t: Column) -> Column:
        return F.concat(_plain(t["said"]), F.lit(CLOSE))

    pieces = F.transform("turns", lambda t: F.struct((t["who"] == F.col("speaker")).alias("own"), opening(t).alias("open"), body(t).alias("body")))
    one = one.withColumn("pieces", pieces)
    # Start of each turn's body: lengths before it, one line feed after each turn.
    walked = F.aggregate("pieces", F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("spans")),
                         lambda s, p: F.struct((s["end"] + F.length(p["open"]) + F.length(p["body"]) + 1).alias("end"),
                                               F.when(p["own"], F.array_append(s["spans"], F.concat_ws(":", (s["end"] + F.length(p["open"])).cast("string"),
                                                                                                       (s["end"] + F.length(p["open"]) + F.length(p["body"])).cast("string"))))
                                               .otherwise(s["spans"]).alias("spans")))
    return one.select("conv_id", "part", "speaker", F.size("pieces").cast("long").alias("n_turns"),
                      F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_spoken"),
                      F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["open"], p["body"])), "\n"), F.lit("\n")).alias("rendered"),
                      F.array_join(walked["spans"], ",").alias("mask"))


SQL = f"""
WITH ranked AS (
  SELECT conv_id, coalesce(role, 'unknown') AS who, replace(coalesce(text, ''), '<|', '< |') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS rk FROM conversations),
speakers AS (SELECT DISTINCT p.conv_id, part, speaker FROM (SELECT DISTINCT conv_id, rk // {PART_TURNS} AS part FROM ranked) p
             JOIN (SELECT DISTINCT conv_id, who AS speaker FROM ranked WHERE who <> 'system') s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
pieces AS (
  SELECT s.conv_id, part, speaker, rk, who = speaker AS own,
         CASE WHEN who = speaker THEN '{OPEN}assistant' || chr(10) WHEN who = 'system' THEN '{OPEN}system' || chr(10)
              ELSE '{OPEN}user name=' || replace(who, '<|', '< |') || chr(10) END AS open_, said || '{CLOSE}' AS body
  FROM ranked r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.rk // {PART_TURNS} = s.part),
placed AS (
  SELECT *, sum(length(open_) + length(body) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY rk) - length(body) - 1 AS pos FROM pieces)
SELECT conv_id, part, speaker, count(*) AS n_turns, count(*) FILTER (own) AS n_spoken,
       string_agg(open_ || body, chr(10) ORDER BY rk) || chr(10) AS rendered,
       coalesce(string_agg(pos::BIGINT || ':' || (pos + length(body))::BIGINT, ',' ORDER BY rk) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, part, speaker
"""
