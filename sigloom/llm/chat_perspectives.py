"""Dialogues of several parties, rendered once for each participant with that speaker as the assistant.

In a rendering the speaker's own messages are the assistant's, those of all others are messages of named users, system
messages stay what they are. Spans mark what the assistant says, with its closing mark, as the part to learn from.
Long dialogues come in parts of ``PART_MESSAGES`` messages, so no row grows with its dialogue. Messages of dialogues too
long for one task are numbered across tasks. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.operators.numbering import number_rows

# The marks of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"
PART_MESSAGES = 512
#: Dialogues of more messages are sorted across tasks.
TASK_MESSAGES = 500_000


def _plain(text: Column) -> Column:
    """Contents can't close or open a message: the beginning of a mark is broken by a space."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(conversations: DataFrame) -> DataFrame:
    """One row for each participant and part of each dialogue:

    ``conv_id, perspective, part, n_messages, n_own, rendered, learn`` with ``learn`` an array of ``start, end`` in code
    points of ``rendered``, end exclusive. Needs ``conv_id, turn, role, text``; other columns are ignored.

    Messages stand by turn (null first), then speaker, then text; repeated rows are one message. A null or blank role is
    the speaker "unknown". A null text is empty. System messages take part in no one's name: a dialogue of only these
    gives no rows, and neither does an empty table. All messages with a null conv_id are one dialogue. Parts count runs of
    PART_MESSAGES messages from 0, and a participant gets a row for every part, also one without own messages. A very long
    text stays whole in its part.
    """
    said = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.trim("role") == "", UNKNOWN).otherwise(F.coalesce(_plain(F.col("role")), F.lit(UNKNOWN))).alias("speaker"),
        _plain(F.col("text")).alias("text"),
    )
    said = said.withColumn("speaker", F.when(F.col("speaker") == "", UNKNOWN).otherwise(F.col("speaker"))).distinct()
    numbered = number_rows(said, ["conv_id"], ["turn", "speaker", "text"], TASK_MESSAGES)
    part = F.floor(F.col("pos") / PART_MESSAGES).cast("long").alias("part")
    message = F.struct("pos", "speaker", "text")
    parts = numbered.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(message)).alias("messages"))
    speakers = said.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    p, s = parts.alias("p"), speakers.alias("s")
    each = p.join(s, F.col("p.conv_id").eqNullSafe(F.col("s.conv_id"))).select("p.conv_id", "s.perspective", "p.part", "p.messages")
    own = lambda m: m["speaker"] == F.col("perspective")

    def block(m: Column) -> Column:
        name = F.when(m["speaker"] == SYSTEM, SYSTEM).when(own(m), "assistant").otherwise(F.concat(F.lit("user name="), m["speaker"]))
        head = F.concat(F.lit(OPEN), name, F.lit("\n"))
        return F.struct(own(m).alias("own"), head.alias("head"), F.concat(m["text"], F.lit(CLOSE)).alias("body"))

    blocks = each.select("conv_id", "perspective", "part", F.transform("messages", block).alias("blocks"))
    empty = F.struct(F.lit(0).alias("length"), F.array().cast("array<struct<start:int,end:int>>").alias("learn"))

    def advance(state: Column, b: Column) -> Column:
        start = state["length"] + F.length(b["head"])
        end = start + F.length(b["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("length"), F.when(b["own"], F.concat(state["learn"], span)).otherwise(state["learn"]).alias("learn"))

    return blocks.select(
        "conv_id", "perspective", "part",
        F.size("blocks").cast("long").alias("n_messages"),
        F.size(F.filter("blocks", lambda b: b["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit("\n"))), "").alias("rendered"),
        F.aggregate("blocks", empty, advance)["learn"].alias("learn"),
    )
