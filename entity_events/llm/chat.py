"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events in sequence: whole messages, streamed deltas that add to a message, edits
that replace its text, and regenerations that throw a message and all after it away and begin it anew. The
log is partitioned by conversation and message, sorted by sequence and folded into final messages, which a
template then renders. The template marks turns with control strings; inside texts, the letters that begin
any control string are escaped, so that no text can end a turn, and reading back undoes it.

Plan: events are shuffled by (conversation, message), so a conversation with a third of all events is folded
message by message in many tasks; where regenerations cut a log is found on rows without texts. Messages are
escaped before they meet, and one shuffle by conversation puts the finished pieces in order: a conversation's
rendered text is one value of the result, so its pieces meet in one row. Reading back is a pass of
``mapInArrow``.

Defined results: a null text or role counts as empty; a null conversation or turn is a value of its own, and
null turns come first; events of one sequence number are taken in order of kind, role and text; repeated rows
are repeated messages when they come as rows (``message_events``) and repeated events when they come as a
log; an empty log gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"

START, END = "<|turn|>", "<|end|>"
ROLE_END = "\n"
ASSISTANT = "assistant"

#: The escape letter first, then what begins control strings of this and other templates.
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lbr;"))
_TURN = re.compile(rf"{re.escape(START)}([^\n<]*)\n([^<]*){re.escape(END)}")


def escaped(text: Column) -> Column:
    for letter, name in _ESCAPES:
        text = F.replace(text, F.lit(letter), F.lit(name))
    return text


def unescaped(text: str) -> str:
    for letter, name in reversed(_ESCAPES):
        text = text.replace(name, letter)
    return text


def message_events(rows: DataFrame) -> DataFrame:
    """The log of a table that has one row per finished turn (conv_id, turn, role, text)."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    # Rows of one turn number are messages of their own; their number tells them apart.
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.select(
        "conv_id",
        F.struct("turn", F.row_number().over(same).alias("place")).alias("message"),
        F.struct("turn", F.lit(0).alias("place")).alias("seq"),
        F.lit(MESSAGE).alias("kind"),
        "role",
        "text",
    )


def folded(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, message, seq, kind, role, text).

    ``message`` orders the messages of a conversation, ``seq`` the events. A message, an edit and a
    regeneration set a text; deltas add to it. What a regeneration of this or an earlier message came after
    is discarded. A delta or edit of a message that was discarded begins it anew.
    """
    events = events.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("role", F.coalesce("role", F.lit("")))
    # The last regeneration of this or an earlier message, from rows without texts.
    cuts = events.groupBy("conv_id", "message").agg(F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).alias("cut"))
    cuts = cuts.groupBy("conv_id").agg(F.collect_list(F.when(F.col("cut").isNotNull(), F.struct("message", "cut"))).alias("cuts"))
    cuts = cuts.where(F.size("cuts") > 0).withColumnRenamed("conv_id", "cut_conv")
    events = events.join(cuts, F.col("conv_id").eqNullSafe(F.col("cut_conv")), "left").drop("cut_conv")
    earlier = F.filter("cuts", lambda c: c["message"] <= F.col("message"))
    discarded = F.exists(earlier, lambda c: (F.col("seq") < c["cut"]))
    events = events.where(~F.coalesce(discarded, F.lit(False))).drop("cuts")

    sets = F.col("kind") != DELTA
    order = F.struct("seq", "kind", "role", "text")
    events = events.withColumn("event", F.struct("seq", sets.alias("sets"), "kind", "role", "text"))
    messages = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list("event")).alias("log"), F.max_by("role", order).alias("role")
    )
    text = F.aggregate(
        "log", F.lit(""), lambda so_far, e: F.when(e["sets"], e["text"]).otherwise(F.concat(so_far, e["text"]))
    )
    return messages.select("conv_id", "message", "role", text.alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss``: where the mask lies, in code points of ``formatted``.

    The mask covers the texts of the assistant, without their marks.
    """
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(ROLE_END))
    body = escaped(F.col("text"))
    pieces = messages.select(
        "conv_id",
        F.struct(
            "message",
            "role",
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
        ).alias("part"),
    )
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: p["piece"]), "")
    lengths = F.transform(
        "parts", lambda p: F.struct((p["role"] == ASSISTANT).alias("counts"), p["head"].alias("head"), p["body"].alias("body"))
    )
    return whole.select("conv_id", formatted.alias("formatted"), lengths.alias("lengths")).mapInArrow(
        _with_mask, f"conv_id {messages.schema['conv_id'].dataType.simpleString()}, formatted string, loss array<struct<start:long,end:long>>"
    )


def _with_mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        masks = []
        for lengths in batch.column("lengths").to_pylist():
            at, mask = 0, []
            for part in lengths:
                at += part["head"]
                if part["counts"]:
                    mask.append({"start": at, "end": at + part["body"]})
                at += part["body"] + len(END)
            masks.append(mask)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("formatted"), pa.array(masks, span)], ["conv_id", "formatted", "loss"]
        )


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of rendered conversations, each read from ``formatted`` and ``loss`` alone."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted, mask in zip(batch.column("formatted"), batch.column("loss")):
                text, spans = formatted.as_py(), mask.as_py()
                turns = parsed(text)
                all_turns, loss, loss_chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, said in turns:
                    all_turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescaped(text[span["start"] : span["end"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
                rows.append((len(turns), all_turns.hexdigest(), loss_chars, loss.hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *arrays],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return conversations.select("conv_id", "formatted", "loss").mapInArrow(
        digests,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
