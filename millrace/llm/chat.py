"""Chat logs: fold an event log into final messages, render them with a template, read them back.

Only DataFrame functions; no Python on the executors.

Events have `conv_id`, `message` (any orderable id within the conversation), `seq` (any orderable
value), `kind`, `role` and `text`:

* `open` starts a message and names its role;
* `delta` appends its text to the message's draft;
* `edit` replaces the draft by its text;
* `regenerate` throws the draft away, so that the deltas after it make a new one.

Defined results: an event delivered twice counts once; different events with an equal `seq` are
folded in the order of kind, role and text; a message that was never opened has an empty role; a
null text is empty; a null `seq`, `message` or `conv_id` sorts first and is kept. Events of unknown
kind add nothing. Messages of a conversation follow the `seq` of their first event. An empty log
gives an empty table, and columns of other names are ignored.

Scale: events are grouped by conversation and message, so a long conversation is folded by many
tasks; only the rendered text, which is one value by nature, is put together by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template. A role is URL-encoded, so it cannot end its mark; a text never holds `<|`.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def escape(text: Column) -> Column:
    """`<|` -> `<\\|`, `<\\|` -> `<\\\\|` and so on: one backslash more in every such run."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, seq (of the first event), role, text."""
    log = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_set(F.struct("seq", "kind", "role", "text"))).alias("log")
    )
    resets = F.transform("log", lambda e, i: F.when(e["kind"].isin("open", "edit", "regenerate"), i).otherwise(F.lit(0)))
    log = log.withColumn("from", F.array_max(resets))
    live = F.filter("log", lambda e, i: (i >= F.col("from")) & e["kind"].isin("delta", "edit"))
    opened = F.filter("log", lambda e: e["kind"] == "open")
    return log.select(
        "conv_id", "message", F.col("log")[0]["seq"].alias("seq"),
        F.coalesce(F.get(opened, F.lit(0))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (spans of code points, start and end).

    The loss covers the texts of role `learn`, without the marks around them.
    """
    order = Window.partitionBy("conv_id").orderBy("seq", "message").rowsBetween(Window.unboundedPreceding, 0)
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit(CLOSE))
    parts = messages.withColumns({"head": head, "body": escape(F.col("text"))})
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(END)))
    parts = parts.withColumn("stop", F.sum(F.char_length("piece")).over(order) - F.lit(len(END)))
    span = F.struct((F.col("stop") - F.char_length("body")).alias("start"), F.col("stop").alias("end"))
    parts = parts.withColumn("span", F.when(F.col("role") == learn, span))
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "message", "piece", "span"))).alias("parts")
    )
    spans = F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull())
    return whole.select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"), spans.alias("loss")
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """From `formatted` and `loss` alone: conv_id, turns (role, text), learned (text under the loss), formatted."""
    pieces = F.split("formatted", r"<\|end\|>")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(piece, r"\|>", 2)
        return F.struct(
            F.url_decode(F.substring(halves[0], len(OPEN) + 1, 2**31 - 1)).alias("role"), unescape(halves[1]).alias("text")
        )

    under = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return rendered.select(
        "conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(under, "").alias("learned"), "formatted"
    )


def events_of(conversations: DataFrame, chunk: int = 200) -> DataFrame:
    """An event log that ends in the given rows (conv_id, turn, role, text).

    Each row is streamed in chunks. Every third turn is first streamed wrongly and regenerated, and
    every fifth is streamed wrongly and edited, so that folding has something to undo. Rows of one
    turn follow role and text.
    """
    place = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text", F.row_number().over(place).cast("long").alias("slot"))
    said = F.coalesce("text", F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(said) - 1, F.lit(0)), F.lit(chunk))

    def event(kind: str, role: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), role.cast("string").alias("role"), text.cast("string").alias("text"))

    none = F.lit(None)
    stream = F.transform(starts, lambda s: event("delta", none, F.substring(said, s + 1, F.lit(chunk))))
    draft = F.array(event("delta", none, F.upper(F.col("role"))), event("delta", none, F.lit("<|end|>")))
    undone = F.coalesce(F.col("turn"), F.lit(0))
    body = (
        F.when(undone % 5 == 4, F.concat(draft, F.array(event("edit", none, F.col("text")))))
        .when(undone % 3 == 1, F.concat(draft, F.array(event("regenerate", none, none)), stream))
        .otherwise(stream)
    )
    log = rows.select(
        "conv_id", F.struct("turn", "slot").alias("message"),
        F.posexplode(F.concat(F.array(event("open", F.col("role"), none)), body)).alias("step", "event"),
    )
    return log.select(
        "conv_id", "message", F.struct("message.turn", "message.slot", "step").alias("seq"), "event.kind", "event.role", "event.text"
    )
