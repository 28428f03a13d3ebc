"""Chat formatting: multi-party perspective rotation.

For each participant of a dialogue the dialogue is rendered once with that speaker as the assistant; the others become users
with their names, and turns of the system stay the system's. The spans of the assistant's own words (and of the mark that ends
them) are the parts that a model is trained on; all else is masked.

A perspective is the whole dialogue in one row, so a dialogue must fit a task, as a text must. For dialogues that don't, `part` renders so many
turn numbers to a row; each part has the perspectives of all participants of the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def safe(text: Column) -> Column:
    """Texts can't hold the marks: `<|` becomes `< |`."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotated(turns: DataFrame, part: int | None = None) -> DataFrame:
    """(conv_id[, part], speaker, n_turns, n_own, text, spans array<struct<start, end>>) for each dialogue and participant.

    turns has conv_id, turn, role and text; other columns are ignored. Participants are the distinct roles but the system's, as
    they stand there; a null role is a participant of its own. What is shown of a role has blanks for line breaks, since it stands in a line, and null is shown as
    `unknown`; participants whose names look alike stay apart, each with its row. With part, a dialogue's turns k * part
    to (k + 1) * part - 1 are a row of their own, whose part is k. start and end count code points of text; [start, end) is trained on. Turns come in
    order of turn, then the shown role, text and role (nulls first), repeated rows included; a null turn counts as turn 0. A dialogue of system turns
    alone has no participant and no row. A null conv_id is a dialogue of its own. A null text is empty. An empty table gives an
    empty table.
    """
    rows = turns.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.translate(safe(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))), "\r\n", "  ").alias("role"),
        safe(F.col("text")).alias("text"),
        F.col("role").cast("string").alias("who"),
    ).withColumn("part", F.floor(F.col("turn") / part).cast("long") if part else F.lit(0).cast("long"))
    speakers = rows.where(~F.col("who").eqNullSafe(SYSTEM)).select("conv_id", F.col("role").alias("speaker"), F.col("who").alias("speaks")).distinct()
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "who"))).alias("said"))
    views = parts.join(speakers, parts.conv_id.eqNullSafe(speakers.conv_id)).select(parts.conv_id, "part", "speaker", "speaks", "said")

    def segment(x: Column) -> Column:
        """(head, body, own) of a turn."""
        own = x["who"].eqNullSafe(F.col("speaks"))
        head = F.when(own, "assistant").when(x["who"] == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), x["role"]))
        return F.struct(F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"), F.concat(x["text"], F.lit(CLOSE)).alias("body"), own.alias("own"))

    def ends(segments: Column) -> Column:
        """Segments with the place at which each ends; each is followed by a line break."""
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"))

        def add(state: Column, s: Column) -> Column:
            begin = state["at"] + F.length(s["head"])
            end = begin + F.length(s["body"])
            span = F.array(F.struct(begin.alias("start"), end.alias("end")))
            return F.struct((end + 1).alias("at"), F.when(s["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

        return F.struct(
            F.size(segments).cast("long").alias("n_turns"),
            F.size(F.filter(segments, lambda s: s["own"])).cast("long").alias("n_own"),
            F.array_join(F.transform(segments, lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("text"),
            F.aggregate(segments, start, add)["spans"].alias("spans"),
        )

    view = views.select("conv_id", "part", "speaker", let(F.transform("said", segment), ends).alias("view"))
    return view.select("conv_id", *["part"] * bool(part), "speaker", "view.*")
