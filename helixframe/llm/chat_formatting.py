r"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

Events (conv_id, seq, turn, role, kind, text) are partitioned by conversation and sorted by
sequence. `message` and `edit` set a turn's text, `regenerate` sets it and discards what later turns held
before, `delta` appends. The final turns are rendered with a template that
marks them, and the places of assistant texts are kept as the loss mask.

Template: ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts and roles every run of bars after
a ``<`` gets one bar more, so no text can hold a control string; roles also write \ and
line ends as ``\\`` and ``\n``. Both are undone by `parse`.

Defined results: null text and null role are empty; an unknown kind counts as `message`; events of equal
sequence are ordered by kind and text; a null conv_id is a conversation of its own;
an empty table gives no rows; other columns are ignored. One exchange, by conv_id: a conversation is one
output row, so it is the unit that must fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def fold(events: DataFrame) -> DataFrame:
    """Final turns (conv_id, turn, role, text)."""
    e = events.select("conv_id", "turn", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("cut", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)).where("cut is null or seq > cut")
    sets = F.max(F.when(F.col("kind") != "delta", F.col("seq")))
    turns = e.groupBy("conv_id", "turn").agg(sets.alias("since"), F.sort_array(F.collect_list(F.struct("seq", "kind", "text", "role"))).alias("own"))
    own = F.filter("own", lambda x: F.col("since").isNull() | (x.seq >= F.col("since")))
    own = turns.select("conv_id", "turn", own.alias("own"))
    return own.select("conv_id", "turn", F.element_at("own", -1).role.alias("role"), F.array_join(F.transform("own", lambda x: x.text), "").alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans array<struct<start, length>>, code points from 0, in order."""
    role, body = _escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    t = turns.select("conv_id", "turn", F.col("role").eqNullSafe("assistant").alias("learned"), role.alias("role"), body.alias("body"))
    piece = F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(END))
    size = F.length("role") + F.length("body") + F.lit(len(START) + 1 + len(END))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("offset", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0).cast("long")))
    span = F.when(F.col("learned"), F.struct((F.col("offset") + F.length("role") + F.lit(len(START) + 1)).alias("start"), F.length("body").cast("long").alias("length")))
    rows = t.select("conv_id", F.struct("turn", piece.alias("piece"), span.alias("span")).alias("r"))
    done = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("r"))
    return done.select(
        "conv_id",
        F.array_join(F.transform("r", lambda x: x.piece), "").alias("formatted"),
        F.filter(F.transform("r", lambda x: x.span), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns array<struct<role, text>> that a formatted conversation holds."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p: p != "")
    head = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substring(p, F.length(head(p)) + 2, F.length(p) - F.length(head(p)) - F.lit(1 + len(END)))
    return F.transform(pieces, lambda p: F.struct(_unescape_role(head(p)).alias("role"), unescape(body(p)).alias("text")))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, read from the formatted text."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s.start + 1).cast("int"), s.length.cast("int"))))


def format_events(events: DataFrame) -> DataFrame:
    return render(fold(events))


def from_messages(conversations: DataFrame) -> DataFrame:
    """The event log of plain message rows (conv_id, turn, role, text): each row is a turn, repeated rows too."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", at.alias("seq"), at.alias("turn"), "role", F.lit("message").alias("kind"), "text")
