"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered with that speaker as
the assistant and all others as named users; only the assistant's words are trained on.
A rendering is returned as its segments, one per turn, with the offsets of the segment
and of its trained part in the whole rendering, so a conversation of any length stays
spread over tasks (offsets are running sums over chunks of turns).

A participant is a distinct role other than those in ``system_roles``; a conversation
without one has no rendering. Null roles are named ``unknown``, null texts are empty,
null turns come first. Ties and repeated rows are ordered by role and text and all
stay. An empty table gives no rows; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sequence import running, sequence, unchunked

START, STOP = "<|im_start|>", "<|im_end|>\n"
#: Turns per chunk of the running offsets.
CHUNK_TURNS = 1024


def _plain(c: Column) -> Column:
    """Text that cannot be taken for the template's own marks."""
    return F.regexp_replace(c, r"<\|", "< |")


def rotate(turns: DataFrame, system_roles: tuple[str, ...] = ("system",), conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """Segments of every rendering: conv_id, perspective, turn, role, name, segment, start,
    end, mask_start, mask_end (offsets in the rendering, null where nothing is trained)."""
    t = turns.select(
        F.col(conv).alias("conv_id"), F.coalesce(F.col(turn).cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    people = t.where(~F.col("name").isin(*system_roles)).select(F.col("conv_id").alias("_conv"), F.col("name").alias("perspective")).distinct()
    rows = t.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("name") == F.col("perspective")
    kind = F.when(own, "assistant").when(F.col("name").isin(*system_roles), "system").otherwise("user")
    tag = F.when(kind == "user", F.concat(F.lit(" name="), F.regexp_replace(F.col("name"), r"[^\pL\pN_.-]", "_"))).otherwise("")
    head = F.concat(F.lit(START), kind, tag, F.lit("\n"))
    rows = rows.select("conv_id", "perspective", "turn", "name", "text", kind.alias("role"), head.alias("_head"),
                       F.concat(head, _plain(F.col("text")), F.lit(STOP)).alias("segment"))
    seq = sequence(rows, ["conv_id", "perspective"], "turn", ["name", "text"], width=float(CHUNK_TURNS))
    # Equal rows share an order; each still gets a place of its own from the row-wise frame.
    rows = unchunked(running(rows, seq, {"end": ("sum", F.length("segment").cast("long"))}))
    start = F.col("end") - F.length("segment")
    return rows.select(
        "conv_id", "perspective", F.when(F.col("turn") != -(1 << 62), F.col("turn")).alias("turn"), "role", "name", "segment",
        start.alias("start"), "end",
        F.when(F.col("role") == "assistant", start + F.length("_head")).alias("mask_start"),
        F.when(F.col("role") == "assistant", F.col("end") - 1).alias("mask_end"))
