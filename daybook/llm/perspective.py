"""Multi-party chat formatting by perspective rotation, with DataFrame functions only.

Every participant of a dialogue gets the dialogue rendered from its side: its
own turns as the assistant's, everyone else's as those of a named user, turns
of context speakers (the system prompt) as they are; the mask lists the
character spans that a trainer learns from, the participant's own texts with
their end marker.

    <|system|>            <|user name=ann|>       <|assistant|>
    text<|end|>           text<|end|>             text<|end|>

A dialogue can hold any number of turns, so it is rendered in chunks of
``CHUNK`` turn numbers, one row each, in order of ``chunk`` and ``part``;
positions count from the start of a chunk. Where rows share turn numbers, a
chunk can hold more than ``CHUNK`` rows; it is then cut into parts of neighbouring
turns: a turn with ``before`` rows ahead of it in the chunk goes to part
before div CHUNK, so n rows make at most ceil(n / CHUNK) parts, each with its
context. Only a single turn number with more than ``CHUNK`` rows of its own is
dealt over several parts, by the hash that also orders equal turns. The rule is
the same at every size. So no group grows with a dialogue, and the joins that
give a turn its place and its participants are equi-joins whose hot keys Spark
splits.

Defined cases: a null speaker is a user named ``unknown`` and no participant;
a null text is empty; null turns come last; equal turns are ordered by the
hash of speaker and text, repeated rows are all rendered; rows without conv_id
form one dialogue; a dialogue without participants, or an empty table, gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import cut

CHUNK = 256
CONTEXT = ("system",)
END = "<|end|>\n"

_SPANS = """
transform(
  filter(
    zip_with(turns,
      aggregate(turns, array(0L), (ends, t) -> concat(ends, array(element_at(ends, -1) + length(t.head) + length(t.body)))),
      (t, at) -> struct(t.mine as mine, at + length(t.head) as start, at + length(t.head) + length(t.body) as stop)),
    x -> x.mine),
  x -> struct(x.start as start, x.stop as stop))
"""


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", context: tuple[str, ...] = CONTEXT, chunk: int = CHUNK) -> DataFrame:
    """conv_id, perspective, chunk, part, n_turns, rendered and mask (array of start, stop) for each chunk."""
    turns = df.select(
        F.struct(F.col(conv_col).alias("id")).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.col(speaker_col).cast("string").alias("speaker"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumns({
        "chunk": F.floor(F.col("turn") / chunk).cast("bigint"),
        "tie": F.md5(F.concat_ws("\x1f", F.coalesce("speaker", F.lit("")), "text")),
    })
    where = F.struct("conv", "chunk", "turn").alias("place")  # never null, so null keys join too
    # both sides are cut off, so that the joins can split a dialogue that holds very many turns
    ahead = Window.partitionBy("conv", "chunk").orderBy("turn")  # a row for each turn number, CHUNK at most
    sizes = turns.groupBy("conv", "chunk", "turn").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("total", F.sum("n").over(Window.partitionBy("conv", "chunk"))).withColumn("before", F.sum("n").over(ahead) - F.col("n"))
    full = cut(sizes.where(F.col("total") > chunk).select(where, F.floor(F.col("before") / chunk).alias("first"), F.ceil(F.col("n") / chunk).alias("parts")))
    hashed = F.conv(F.substring("tie", 1, 8), 16, 10).cast("bigint")
    placed = turns.withColumn("place", where).join(full, "place", "left")
    placed = placed.withColumn("part", F.coalesce(F.col("first") + F.pmod(hashed, F.col("parts")), F.lit(0).cast("bigint"))).drop("place", "first", "parts")
    people = turns.where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*context)).select("conv", "speaker").distinct()
    people = cut(people.groupBy("conv").agg(F.collect_list("speaker").alias("people")))
    seen = placed.join(people, "conv").withColumn("perspective", F.explode("people"))
    mine = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    head = (
        F.when(mine, F.lit("<|assistant|>\n"))
        .when(F.col("speaker").isin(*context), F.concat(F.lit("<|"), "speaker", F.lit("|>\n")))
        .otherwise(F.concat(F.lit("<|user name="), F.coalesce("speaker", F.lit("unknown")), F.lit("|>\n")))
    )
    one = F.struct(F.col("turn").isNull().alias("last"), "turn", "tie", "speaker", mine.alias("mine"), head.alias("head"), F.concat("text", F.lit(END)).alias("body"))
    grouped = seen.groupBy("conv", "perspective", "chunk", "part").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return grouped.select(
        F.col("conv.id").alias("conv_id"), "perspective", "chunk", "part", F.size("turns").cast("bigint").alias("n_turns"),
        F.expr("array_join(transform(turns, t -> concat(t.head, t.body)), '')").alias("rendered"), F.expr(_SPANS).alias("mask"),
    )


def mask_text(mask: str = "mask") -> F.Column:
    """The spans as ``start-stop`` words."""
    return F.expr(f"array_join(transform({mask}, x -> concat(x.start, '-', x.stop)), ' ')")


#: The same rows by window functions.
SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, CAST(floor(turn / 256) AS BIGINT) AS chunk,
         md5(coalesce(role, '') || chr(31) || coalesce(text, '')) AS tie
  FROM conversations),
c AS (SELECT conv_id, chunk, turn, count(*) AS c FROM t GROUP BY ALL),
b AS (
  SELECT *, coalesce(sum(c) OVER (PARTITION BY conv_id, chunk ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM c),
p AS (
  SELECT t.*, CAST(before AS BIGINT) // 256 + CAST('0x' || substr(tie, 1, 8) AS BIGINT) % CAST(ceil(c / 256) AS BIGINT) AS part
  FROM t JOIN b ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.chunk IS NOT DISTINCT FROM b.chunk AND t.turn IS NOT DISTINCT FROM b.turn),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role IS NOT NULL AND role <> 'system'),
r AS (
  SELECT p.conv_id, perspective, chunk, part, turn, tie, role, coalesce(role = perspective, false) AS mine,
         CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
              ELSE '<|user name=' || coalesce(role, 'unknown') || '|>' END || chr(10) AS head,
         text || '<|end|>' || chr(10) AS body
  FROM p JOIN who ON p.conv_id IS NOT DISTINCT FROM who.conv_id),
s AS (
  SELECT *, row_number() OVER w AS k,
         coalesce(sum(length(head) + length(body)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM r WINDOW w AS (PARTITION BY conv_id, perspective, chunk, part ORDER BY turn NULLS LAST, tie, role NULLS FIRST))
SELECT conv_id, perspective, chunk, CAST(part AS BIGINT) AS part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS rendered,
       coalesce(string_agg(CAST(CAST(base + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(base + length(head) + length(body) AS BIGINT) AS VARCHAR), ' ' ORDER BY k) FILTER (WHERE mine), '') AS mask
FROM s GROUP BY conv_id, perspective, chunk, part
"""
