"""Chat formatting: every dialogue once for every participant, who then speaks as the assistant.

A dialogue is rendered turn by turn: the chosen speaker's turns as ``<|assistant|>``, all others' as ``<|user|>`` with
their name, each closed by ``<|end|>``. The mask lists, as character spans of the rendered text, what the model
should learn: the chosen speaker's words and the closing mark.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, so that one that holds a third of all rows is not one
row: a part is the range of turn numbers ``part * PART_TURNS`` up to the next. Should one part have more than
``PART_ROWS`` rows all the same (many texts under one number), it is cut into sections of that many rows, one behind the
other in the order of the dialogue; its rows get their numbers from a sort that deals a crowded part over many tasks. So
parts and their sections, joined in order, are the dialogue. ``part_chars`` and ``n_turns`` let parts be put together. Rows that repeat whole are one turn; turns of the same number follow by role and text. Null text is
empty, a null role is named ``unknown``, a null turn comes first (in the part of turn 0), and a null conversation is a
conversation of its own. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import table
from sluicebox.llm.sharding import numbered
from sluicebox.session import broadcast_if_small

PART_TURNS, PART_ROWS = 64, 4096
END = "<|end|>\n"


def _head(role: Column, speaker: Column) -> Column:
    return F.when(role == speaker, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))


def _sections(once: DataFrame, crowded: DataFrame) -> DataFrame:
    """``once`` with the number of each row's section, 0 but in the ``crowded`` parts."""
    names = crowded.select(F.col("conv_id").alias("crowded_conv"), F.col("part").alias("crowded_part"))
    if names.isEmpty():
        return once.withColumn("section", F.lit(0).cast("long"))
    same = once.conv_id.eqNullSafe(names.crowded_conv) & (once.part == names.crowded_part)
    ranked, _ = numbered(once.join(names, same, "left_semi"), ["conv_id", "part", "turn", "role", "text"])
    ranked = ranked.select("row.*", "number")
    first = ranked.groupBy(F.col("conv_id").alias("crowded_conv"), F.col("part").alias("crowded_part")).agg(F.min("number").alias("first"))
    first = broadcast_if_small(first)
    placed = ranked.join(first, ranked.conv_id.eqNullSafe(first.crowded_conv) & (ranked.part == first.crowded_part))
    section = F.expr(f"(number - first) div {PART_ROWS}").alias("section")
    rest = once.join(names, same, "left_anti").select("*", F.lit(0).cast("long").alias("section"))
    return rest.unionByName(placed.select(*once.columns, section))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, participant and part: ``rendered``, ``mask_starts`` and ``mask_ends``."""
    role = F.coalesce(F.col("role").cast("string"), F.lit("unknown"))
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    part = F.floor(F.coalesce(F.col("turn"), F.lit(0)) / F.lit(part_turns)).cast("long")
    once = clean.distinct().withColumn("part", part)
    sizes = once.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > PART_ROWS)
    cut = _sections(once, broadcast_if_small(sizes.select("conv_id", "part")))
    dialogues = cut.groupBy("conv_id", "part", "section").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    # Participants of the whole conversation, not of the part alone: few rows, combined on the map side.
    speakers = clean.select("conv_id", F.col("role").alias("speaker")).distinct()
    both = dialogues.join(speakers, dialogues.conv_id.eqNullSafe(speakers.conv_id)).drop(speakers.conv_id)
    pieces = F.transform(
        "said",
        lambda t: F.struct(
            F.concat(_head(t["role"], F.col("speaker")), t["text"], F.lit(END)).alias("text"),
            F.char_length(_head(t["role"], F.col("speaker"))).alias("head"),
            (t["role"] == F.col("speaker")).alias("own"),
        ),
    )
    # Each piece with the place where it starts: a running sum over the part's turns.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a: int, b: int>>").alias("spans"))
    spans = F.aggregate(
        "pieces",
        start,
        lambda done, p: F.struct(
            (done["at"] + F.char_length(p["text"])).alias("at"),
            F.when(
                p["own"],
                F.concat(done["spans"], F.array(F.struct((done["at"] + p["head"]).alias("a"), (done["at"] + F.char_length(p["text"])).alias("b")))),
            ).otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    shown = both.select("conv_id", "speaker", "part", "section", F.size("said").cast("long").alias("n_turns"), pieces.alias("pieces"))
    shown = shown.select("*", spans.alias("spans"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return shown.select(
        "conv_id",
        "speaker",
        "part",
        "section",
        "n_turns",
        text.alias("rendered"),
        F.char_length(text).cast("long").alias("part_chars"),
        F.array_join(F.transform("spans", lambda s: s["a"].cast("string")), ",").alias("mask_starts"),
        F.array_join(F.transform("spans", lambda s: s["b"].cast("string")), ",").alias("mask_ends"),
    )


def rotated_chats(spark, sf_dir) -> DataFrame:
    """Every conversation from every participant's view."""
    return perspectives(table(spark, sf_dir, "conversations"))


SQL = f"""
WITH once AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
        CAST(floor(coalesce(turn, 0) / {PART_TURNS}) AS BIGINT) AS part
    FROM conversations
), clean AS (
    SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, text) - 1) // {PART_ROWS} AS section FROM once
), speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM clean
), shown AS (
    SELECT c.*, s.speaker, c.role = s.speaker AS own,
        CASE WHEN c.role = s.speaker THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || c.role || '|>' || chr(10) END AS head
    FROM clean c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
    SELECT *, length(head) AS n_head, length(head || text) + 8 AS n,
        sum(length(head || text) + 8) OVER (
            PARTITION BY conv_id, speaker, part, section ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING
        ) AS until
    FROM shown
)
SELECT conv_id, speaker, part, CAST(section AS BIGINT) AS section, count(*) AS n_turns,
    string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
    CAST(sum(n) AS BIGINT) AS part_chars,
    coalesce(string_agg(CAST(CAST(until - n + n_head AS BIGINT) AS VARCHAR), ',' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE own), '') AS mask_starts,
    coalesce(string_agg(CAST(CAST(until AS BIGINT) AS VARCHAR), ',' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE own), '') AS mask_ends
FROM placed GROUP BY conv_id, speaker, part, section
"""
