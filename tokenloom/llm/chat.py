"""Chat formatting: every dialogue once for each participant, with that participant as the assistant.

For each participant the turns are rendered with that speaker as assistant and all others as named users; system turns
stay what they are and are no participant. A row is one rendered turn with its place in the whole rendering: joining a
rendering's segments in the order of ``start`` gives its text, and no dialogue is ever held in one row or task. What the
model is trained on is the assistant's text with its end mark, given as [mask_start, mask_end) in characters.

Places are prefix sums of segment lengths, summed by blocks of turns first, so a very long dialogue is spread over tasks.

Edge cases: a null speaker is the participant ``unknown``, a null text is empty, a null turn comes first, null
conversation ids are one dialogue; turns with equal numbers are ordered by speaker and text, and repeated rows are
rendered each; a dialogue of system turns alone has no rendering; ``<|`` in texts and names is written ``< |``, and in
names ``|>`` is written ``| >`` and a line end or other control character a blank, so neither can pass for a mark; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.ordering import prefix_sum

END = "<|end|>\n"
TRAINED_END = len("<|end|>")
BLOCK_TURNS = 256


def plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def plain_name(name: Column) -> Column:
    """A name on one line that neither ends the mark it stands in nor, with what follows, begins another."""
    line = F.regexp_replace(name, r"[\p{Cc}\p{Zl}\p{Zp}]", " ")
    return F.regexp_replace(F.replace(plain(line), F.lit("|>"), F.lit("| >")), "([<|])$", "$1 ")


def assembled(turns: DataFrame, chars: int = 1 << 20) -> DataFrame:
    """conv_id, perspective, chunk, text and masks of the rows of ``perspectives``: renderings as texts.

    A rendering of up to ``chars`` characters is one row with chunk 0; a longer one is cut between turns about every ``chars``
    characters, so no row grows with its dialogue. Masks are [start, end) within the row's text.
    """
    cut = F.floor(F.col("start") / chars).alias("chunk")
    held = F.struct("start", "segment", "mask_start", "mask_end")
    rows = turns.groupBy("conv_id", "perspective", cut).agg(F.array_sort(F.collect_list(held)).alias("turns"))
    first = F.col("turns")[0]["start"]
    trained = F.filter("turns", lambda t: t["mask_start"].isNotNull())
    masks = F.transform(trained, lambda t: F.struct((t["mask_start"] - first).alias("start"), (t["mask_end"] - first).alias("end")))
    text = F.array_join(F.transform("turns", lambda t: t["segment"]), "")
    return rows.select("conv_id", "perspective", "chunk", text.alias("text"), masks.alias("masks"))


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: str = "system",
) -> DataFrame:
    """conv_id, perspective, turn, part, segment, start, mask_start, mask_end: one row for each participant and turn."""
    said = turns.select(
        F.struct(F.col(conversation).alias("id")).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    people = said.where(F.col("speaker") != system).select("conv", F.col("speaker").alias("perspective")).distinct()
    part = (
        F.when(F.col("speaker") == system, "system")
        .when(F.col("speaker") == F.col("perspective"), "assistant")
        .otherwise("user")
    )
    name = F.when(F.col("part") == "user", F.concat(F.lit(" name="), plain_name(F.col("speaker")))).otherwise("")
    rotated = (
        said.join(people, "conv")
        .withColumn("part", part)
        .withColumn("head", F.concat(F.lit("<|"), F.col("part"), name, F.lit("|>\n")))
        .withColumn("body", plain(F.col("text")))
        .withColumn("segment", F.concat("head", "body", F.lit(END)))
    )
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))
    placed = prefix_sum(rotated, F.length("segment"), ["turn", "speaker", "text"], block, ["conv", "perspective"], "start")
    trained = F.col("part") == "assistant"
    begin = F.col("start") + F.length("head")
    return placed.select(
        F.col("conv.id").alias("conv_id"),
        "perspective",
        "turn",
        "part",
        "segment",
        "start",
        F.when(trained, begin).alias("mask_start"),
        F.when(trained, begin + F.length("body") + TRAINED_END).alias("mask_end"),
    )
