"""Chat formatting: conversations folded from an event log, then rendered.

The log holds one row per event: ``conv_id, message_id, seq, step, kind, role,
text``. ``kind`` is one of

- ``open``        the message starts (its role; ``text`` may hold a first part),
- ``delta``       streamed text, appended,
- ``edit``        the whole text is replaced; later deltas append to it,
- ``regenerate``  the text so far is thrown away; later deltas rebuild it.

Events are ordered by ``(seq, step)``. The fold runs per message first (the
text after the last reset), so a long conversation is spread over its
messages; only final messages meet in the conversation's one output row.

Defined cases: NULL text counts as empty and NULL role as empty; a NULL
``seq`` sorts first; events that tie on ``(seq, step)`` follow kind, role and
text, and messages that tie follow role and text; an event of another kind
is ignored; events with a NULL ``conv_id`` form one conversation; an empty log
gives no rows. Extra columns are not read.

Only DataFrame functions run here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this template and of other common chat templates; none
# is a prefix of another, and all begin with "<" or "[".
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
RESETS = ("open", "edit", "regenerate")
KINDS = (*RESETS, "delta")


def escape(text: Column) -> Column:
    """Backslashes are doubled; a backslash goes behind the first character of each control string.

    No control string holds a backslash, so none is left in the result.
    """
    firsts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?:{firsts})", "$0\\\\")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, message_id, seq, step, role, text``."""
    ev = (events.filter(F.col("kind").isin(*KINDS))
          .groupBy("conv_id", "message_id")
          .agg(F.sort_array(F.collect_list(F.struct("seq", "step", "kind", "role", "text"))).alias("ev")))
    last = F.array_max(F.transform("ev", lambda e, i: F.when(e["kind"].isin(*RESETS), i).otherwise(F.lit(0))))
    parts = F.transform(
        F.slice("ev", last + 1, F.size("ev")),
        lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(F.coalesce(e["text"], F.lit(""))))
    roles = F.filter(F.transform("ev", lambda e: e["role"]), lambda r: r.isNotNull())
    return ev.select("conv_id", "message_id", F.get("ev", F.lit(0))["seq"].alias("seq"),
                     F.get("ev", F.lit(0))["step"].alias("step"),
                     F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
                     F.array_join(parts, "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_mask``.

    ``loss_mask`` lists the spans that bear loss as ``(turn, start, length)``:
    code points of the escaped text, counted from the end of the turn's start
    marker, so no running offset over the conversation is needed.
    """
    conv = messages.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "step", "role", "text"))).alias("m"))
    conv = conv.select("conv_id", F.transform(
        "m", lambda x: F.struct(x["role"].alias("role"), escape(x["role"]).alias("er"),
                                escape(x["text"]).alias("et"))).alias("m"))
    turns = F.transform("m", lambda x: F.concat(F.lit(START), x["er"], F.lit(SEP), x["et"], F.lit(END)))
    mask = F.filter(F.transform("m", lambda x, i: F.struct(
        i.alias("turn"), (F.length(x["er"]) + len(SEP)).alias("start"), F.length(x["et"]).alias("length"),
        (x["role"] == loss_role).alias("loss"))), lambda s: s["loss"])
    return conv.select(
        "conv_id", F.size("m").cast("long").alias("n_turns"), F.array_join(turns, "").alias("formatted"),
        F.transform(mask, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"),
                                             s["length"].alias("length"))).alias("loss_mask"))


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Event log to formatted conversations (see :func:`fold_events` and :func:`render`)."""
    return render(fold_events(events), loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts parsed from the output alone.

    Adds ``turns array<struct<role,text>>`` and ``loss_texts array<string>``.
    """
    seg = formatted.withColumn("_seg", F.expr(f"slice(split(formatted, '{re.escape(START)}', -1), 2, 2147483647)"
                                              .replace("\\", "\\\\")))
    sep, end = re.escape(SEP), re.escape(END)
    turn = lambda s: F.struct(
        unescape(F.regexp_extract(s, f"(?s)^(.*?){sep}", 1)).alias("role"),
        unescape(F.regexp_extract(s, f"(?s)^.*?{sep}(.*?){end}", 1)).alias("text"))
    return (seg.withColumn("turns", F.transform("_seg", turn))
            .withColumn("loss_texts", F.transform("loss_mask", lambda s: unescape(
                F.substring(F.get("_seg", s["turn"]), s["start"] + 1, s["length"]))))
            .drop("_seg"))


def events_of_turns(rows: DataFrame, chunk: int = 4096) -> DataFrame:
    """A log that streams each row ``conv_id, turn, role, text`` as one message.

    Each row opens a message and sends its text in deltas of ``chunk`` code
    points. The message id only tells the rows of one scan apart; it is not
    part of any result.
    """
    r = rows.select("conv_id", F.monotonically_increasing_id().alias("message_id"),
                    F.col("turn").cast("long").alias("seq"), "role",
                    F.coalesce("text", F.lit("")).alias("_t"))
    n = F.floor((F.length("_t") + (chunk - 1)) / chunk).cast("int")
    opened = F.array(F.struct(F.lit(0).alias("step"), F.lit("open").alias("kind"), F.col("role"),
                              F.lit("").alias("text")))
    deltas = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(
        i.alias("step"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
        F.substring(F.col("_t"), (i - 1) * chunk + 1, F.lit(chunk)).alias("text")))
    return r.select("conv_id", "message_id", "seq", F.explode(F.concat(opened, deltas)).alias("e")).select(
        "conv_id", "message_id", "seq", "e.step", "e.kind", "e.role", "e.text")
