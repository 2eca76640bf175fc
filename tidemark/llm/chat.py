"""Multi-party perspective rotation of dialogues.

Native DataFrame operations only. For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users:

    <|user name=bob|>\\nHello.<|end|>\\n<|assistant|>\\nHi, Bob.<|end|>\\n

A turn's text and end mark are trained on (mask 1) where the assistant speaks, everything else isn't (mask 0).
``masks`` are the trained stretches as [start, end) in code points of the rendered part.

A conversation may be of any length, so a rendering comes in parts: part ``p`` holds the turns ranked
``p * part_turns`` and on, and the parts of a (conversation, speaker) joined in order are the whole dialogue.
Ranks are counted in buckets of turn numbers, so a long conversation is spread over many tasks; only rows that
share conversation and turn number (ties, which a dialogue has few of) are always ordered together.

Participants are told apart by their role as it stands. In headers a role's white space and ``<|>~`` become ``_``; where
several roles of a conversation come out alike, the second of them in order of the role (NULL last) is ``name~2``, and so on.

Defined results: turns go by turn number (NULL last), then role (NULL last), then text (NULL first); equal rows
are turns of their own; a NULL role is a participant that speaks as ``unknown``; a NULL text is empty; a NULL conv_id is a conversation of its own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, stored

PART_TURNS = 64
#: Turn numbers per bucket of the ranking.
TURNS_PER_BUCKET = 1024


def speaker_name(role: str) -> Column:
    """The role as it stands in a header."""
    return F.regexp_replace(F.coalesce(F.col(role), F.lit("unknown")), r"[\s<|>~]", "_")


def speakers_of(rows: DataFrame) -> DataFrame:
    """(_conv, _role, speaker): the participants, under names that are theirs alone in a conversation."""
    each = rows.select("conv", "role").distinct().withColumn("clean", speaker_name("role")).withColumn("among", F.struct("conv", "clean"))
    number = F.row_number().over(Window.partitionBy("among").orderBy(F.col("role").asc_nulls_last()))
    named = F.when(number == 1, F.col("clean")).otherwise(F.concat("clean", F.lit("~"), number))
    return each.select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), named.alias("speaker"))


def rotate(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS
) -> DataFrame:
    """(conversation, speaker, part, n_turns, n_own_turns, text, masks) for every participant and part."""
    rows = turns.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    late = F.coalesce(F.floor(F.col("turn") / TURNS_PER_BUCKET).cast("long"), F.lit(2**62))
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), "body"]
    placed = stored(ranked(rows, ["conv"], late, order, "place").withColumn("part", F.floor(F.col("place") / part_turns).cast("long")))
    speakers = stored(speakers_of(placed))
    own = speakers.select(F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("speaker").alias("name"))
    named = placed.join(own, F.col("conv").eqNullSafe(F.col("_c")) & F.col("role").eqNullSafe(F.col("_r"))).select(*placed.columns, "name")
    mine = F.col("name") == F.col("speaker")
    seen = named.join(speakers.select("_conv", "speaker"), F.col("conv").eqNullSafe(F.col("_conv")))
    header = F.when(mine, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), "name", F.lit("|>\n")))
    trained = F.concat("body", F.lit("<|end|>"))
    line = F.struct("place", header.alias("header"), trained.alias("said"), mine.alias("mine"))
    parts = seen.groupBy(F.col("conv"), "speaker", "part").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    # One pass over at most ``part_turns`` lines: the length so far and the stretches found.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["header"])
        end = begin + F.length(x["said"])
        stretch = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(x["mine"], F.concat(state["found"], stretch)).otherwise(state["found"]).alias("found"))

    return parts.select(
        F.col("conv").alias(conversation),
        "speaker",
        "part",
        F.size("lines").cast("long").alias("n_turns"),
        F.size(F.filter("lines", lambda x: x["mine"])).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("lines", lambda x: F.concat(x["header"], x["said"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.transform(F.aggregate("lines", start, step)["found"], lambda m: F.concat(m["start"], F.lit("-"), m["end"])), ",").alias("masks"),
    )
