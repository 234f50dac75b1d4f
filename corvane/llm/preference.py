"""Preference formatting: one shared prompt, two masked completions.

For a chosen and a rejected conversation the turns are compared side by side. Those before the
first turn in which they differ, or that only one has, are the longest common prefix; it
is rendered once, as the prompt. The rest of either becomes its completion, in which only the
assistant's turns are trained on. Turns stay rows all the way, so no conversation is gathered
into one row and one of any length does no harm.

Defined results: a pair needs turns on both sides, else nothing is emitted for it; equal
conversations are all prompt; of several rows of one turn the smallest (role, text) stands, so repeated
rows count once; null roles and texts render as empty and equal each other; rows without a
conversation id or turn take no part; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def format_pairs(turns: DataFrame, pair: Column, chosen: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(pair_id, part, turn, content, trained), part being prompt, chosen or rejected.

    ``pair`` names a turn's pair, ``chosen`` tells whether it belongs to its chosen side.
    """
    said = F.struct(F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.select(pair.alias("pair_id"), chosen.alias("chosen"), F.col(turn_col).cast("long").alias("turn"), said.alias("said")).filter("pair_id is not null and turn is not null and chosen is not null")
    cells = rows.groupBy("pair_id", "turn").agg(F.min(F.when(F.col("chosen"), F.col("said"))).alias("c"), F.min(F.when(~F.col("chosen"), F.col("said"))).alias("r"))
    cuts = cells.groupBy("pair_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("cut"), F.count("c").alias("n_c"), F.count("r").alias("n_r")).filter("n_c > 0 and n_r > 0")
    placed = cells.join(cuts.select("pair_id", "cut"), "pair_id")
    shared = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    part = lambda name, cell: F.struct(F.lit(name).alias("part"), F.col(cell).alias("said"))
    parts = F.when(shared, F.array(part("prompt", "c"))).otherwise(F.array(part("chosen", "c"), part("rejected", "r")))
    each = placed.select("pair_id", "turn", F.explode(parts).alias("p")).filter("p.said is not null")
    return each.select("pair_id", F.col("p.part").alias("part"), "turn", render(F.col("p.said.role"), F.col("p.said.text")).alias("content"), ((F.col("p.part") != "prompt") & (F.col("p.said.role") == trained_role)).alias("trained"))


def assemble(segments: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected, and each completion's turns with their masks, for conversations that fit a row."""
    def turns(part: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("turn", "content", "trained"))))

    by = segments.groupBy("pair_id").agg(turns("prompt").alias("p"), turns("chosen").alias("chosen_turns"), turns("rejected").alias("rejected_turns"))
    text = lambda c: F.array_join(F.transform(c, lambda t: t["content"]), "")
    return by.select("pair_id", text("p").alias("prompt"), text("chosen_turns").alias("chosen"), text("rejected_turns").alias("rejected"), "chosen_turns", "rejected_turns")


def digest(conversations: DataFrame) -> DataFrame:
    """Conversations 2i and 2i + 1 are the chosen and rejected one of pair i."""
    c = F.col("conv_id").cast("long")
    return format_pairs(conversations, F.shiftright(c, 1), F.pmod(c, F.lit(2)) == 0)


def with_other_answers(conversations: DataFrame, ring: int = 1000) -> DataFrame:
    """(conv_id, turn, role, text, chosen): each conversation, and as its rejected side the same turns with another conversation's last answer in place of its own.

    Conversations with an answer stand in rings of about ``ring``, by md5 hashes of their ids, and each takes the next
    one's; one without an answer, or with the only one, is its own rejected side.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").filter("conv_id is not null and turn is not null")
    # Of several rows of the last answer's turn the smallest text stands.
    last = rows.filter("role = 'assistant'").groupBy("conv_id").agg(F.min(F.struct((-F.col("turn")).alias("back"), F.coalesce("text", F.lit("")).alias("text"))).alias("a"))
    last = last.select("conv_id", (-F.col("a.back")).alias("turn"), F.col("a.text").alias("text"), F.md5(F.col("conv_id").cast("string")).alias("h"))
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % F.lit(1 + last.count() // ring)
    order = Window.partitionBy(place).orderBy("h", "conv_id")
    other = last.select("conv_id", "turn", F.lit("assistant").alias("role"), F.coalesce(F.lead("text").over(order), F.first("text").over(order)).alias("text"))
    rejected = rows.join(last.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti").unionByName(other)
    return rows.withColumn("chosen", F.lit(True)).unionByName(rejected.withColumn("chosen", F.lit(False)))


def digest_shared(conversations: DataFrame) -> DataFrame:
    """Every conversation against itself with another last answer: the turns before that answer are the prompt."""
    return format_pairs(with_other_answers(conversations), F.col("conv_id"), F.col("chosen"))


def digest_pairs(conversations: DataFrame) -> DataFrame:
    """One row per pair of ``digest_shared``: the prompt, rendered once, both completions, and for each of their turns its number of characters and whether it is trained on."""
    mask = lambda c: F.array_join(F.transform(c, lambda t: F.concat(F.when(t["trained"], "+").otherwise("-"), F.char_length(t["content"]).cast("string"))), ",")
    return assemble(digest_shared(conversations)).select("pair_id", "prompt", "chosen", "rejected", mask(F.col("chosen_turns")).alias("chosen_mask"), mask(F.col("rejected_turns")).alias("rejected_mask"))


_PARTS = """cells AS (
  SELECT pair_id, turn, min(said) FILTER (chosen) AS c, min(said) FILTER (NOT chosen) AS r FROM t GROUP BY ALL
), cuts AS (
  SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM r) AS cut FROM cells GROUP BY pair_id HAVING count(c) > 0 AND count(r) > 0
), parts AS (
  SELECT pair_id, 'prompt' AS part, turn, c AS said FROM cells JOIN cuts USING (pair_id) WHERE cut IS NULL OR turn < cut
  UNION ALL SELECT pair_id, 'chosen', turn, c FROM cells JOIN cuts USING (pair_id) WHERE turn >= cut AND c IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, r FROM cells JOIN cuts USING (pair_id) WHERE turn >= cut AND r IS NOT NULL
), segments AS (
  SELECT pair_id, part, turn, '<|' || said.role || '|>' || chr(10) || said.text || chr(10) AS content, part <> 'prompt' AND said.role = 'assistant' AS trained FROM parts
)
"""
ORACLE_SQL = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS chosen, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), """ + _PARTS + "SELECT pair_id, part, turn, content, trained FROM segments"
_SHARED = """
WITH rows AS (
  SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), last AS (
  SELECT conv_id, turn, min(said.text) AS text, md5(conv_id::VARCHAR) AS h FROM rows
  WHERE said.role = 'assistant' AND (conv_id, turn) IN (SELECT (conv_id, max(turn)) FROM rows WHERE said.role = 'assistant' GROUP BY conv_id) GROUP BY conv_id, turn
), placed AS (
  SELECT *, ('0x' || left(h, 8))::BIGINT % (1 + (SELECT count(*) FROM last) // 1000) AS ring FROM last
), other AS (
  SELECT conv_id, turn, {'role': 'assistant', 'text': coalesce(lead(text) OVER w, first_value(text) OVER w)} AS said FROM placed WINDOW w AS (PARTITION BY ring ORDER BY h, conv_id)
), t AS (
  SELECT conv_id AS pair_id, true AS chosen, turn, said FROM rows
  UNION ALL SELECT conv_id, false, turn, said FROM rows WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM last)
  UNION ALL SELECT conv_id, false, turn, said FROM other
), """ + _PARTS
SHARED_SQL = _SHARED + "SELECT pair_id, part, turn, content, trained FROM segments"
PAIRS_SQL = _SHARED + """SELECT pair_id, coalesce(string_agg(content, '' ORDER BY turn) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(content, '' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen, coalesce(string_agg(content, '' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg(CASE WHEN trained THEN '+' ELSE '-' END || length(content), ',' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen_mask,
  coalesce(string_agg(CASE WHEN trained THEN '+' ELSE '-' END || length(content), ',' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected_mask
FROM segments GROUP BY pair_id
"""
