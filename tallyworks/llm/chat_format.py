"""Chat formatting: budgeted windows of whole turns, in DataFrame operations only.

Prefix sums of turn tokens cut a conversation into spans of whole turns. A span is
written as one window: the leading system turn again, then earlier turns as far
as the history limit allows, then the span's own turns. Only the texts of the
span's own assistant turns are under the loss mask, so a repeated turn is never a
target twice.

Template, one piece per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``; in roles a line feed gets a
backslash in front. So no text can make up a control string, and dropping each
backslash that stands before a character gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens the template adds to a turn.
OVERHEAD = 4
TOKEN = "[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r\\f]"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """An estimate without a vocabulary: runs of ASCII word characters, and single other ones."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def format_windows(
    conversations: DataFrame, budget: int = 1024, history: int = 256, tokens_col: str | None = None
) -> DataFrame:
    """One row per window: conv_id, window, text, loss, n_context, n_turns, n_tokens.

    ``loss`` holds the (start, length) of every target in code points of ``text``; the
    first ``n_context`` pieces are repeated ones. A window holds at most ``budget``
    tokens unless one turn alone is longer; such a turn is its own span, whole.
    ``tokens_col`` names exact token counts; without it they are estimated.

    Null texts and roles count as empty, null turns come first, rows with the same
    turn are ordered by role and text and all kept; rows without conv_id make up one
    conversation. One shuffle by conversation; no array holds more than a window.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        (F.col(tokens_col) if tokens_col else F.lit(None)).cast("long").alias("given"),
    )
    conversation = Window.partitionBy("conv_id")
    ordered = conversation.orderBy(F.asc_nulls_first("turn"), "role", "text")
    up_to_here = Window.unboundedPreceding, Window.currentRow
    rows = rows.select(
        "conv_id",
        "role",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.coalesce("given", turn_tokens(F.col("text"))) + OVERHEAD).alias("tokens"),
        F.row_number().over(ordered).alias("at"),
    )
    by_place = conversation.orderBy("at")
    leading = (F.col("at") == 1) & (F.col("role") == "system")
    rows = rows.withColumn("leading", leading)
    counted = F.when(F.col("leading"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumn(
        "start",
        F.when(F.col("leading"), -1).otherwise(
            F.sum(counted).over(by_place.rowsBetween(*up_to_here)) - counted
        ),
    ).withColumn(
        "system",
        F.first(F.when(F.col("leading"), F.struct("head", "body", "tokens"))).over(
            by_place.rowsBetween(*up_to_here)
        ),
    )
    # Turns that start in the same half of what the budget leaves share a span, and a
    # turn longer than that half stands alone: so a span never outgrows the budget.
    left = F.greatest(
        F.lit(2), F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0))
    )
    rows = rows.withColumn("half", F.floor(left / 2))
    rows = rows.withColumn("slot", F.floor(F.greatest("start", F.lit(0)) / F.col("half")))
    long_turn = ~F.col("leading") & (F.col("tokens") > F.col("half"))
    new_span = (F.lag("slot").over(by_place) != F.col("slot")) | (
        (long_turn | F.lag(long_turn).over(by_place)) & ~F.lag("leading").over(by_place)
    )
    rows = rows.withColumn("opens", F.coalesce(new_span, F.lit(False)))
    reach = by_place.rowsBetween(*up_to_here)
    rows = rows.withColumn("window", F.sum(F.col("opens").cast("long")).over(reach))
    piece = F.struct("at", "head", "body", F.lit(False).alias("target"), "tokens")
    before = conversation.orderBy("start").rangeBetween(-history, -1)
    rows = rows.withColumn(
        "earlier", F.collect_list(F.when(~F.col("leading"), piece)).over(before)
    ).withColumn("earlier", F.when(F.col("opens"), F.col("earlier")))
    own = F.struct(
        "at", "head", "body", (F.col("role") == "assistant").alias("target"), "tokens"
    )
    spans = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(own)).alias("own"),
        F.first("earlier", ignorenulls=True).alias("earlier"),
        F.first("system", ignorenulls=True).alias("system"),
    )
    repeated = F.when(
        (F.col("window") > 0) & F.col("system").isNotNull(),
        F.array(
            F.struct(
                F.lit(0).alias("at"),
                F.col("system.head").alias("head"),
                F.col("system.body").alias("body"),
                F.lit(False).alias("target"),
                F.col("system.tokens").alias("tokens"),
            )
        ),
    ).otherwise(F.expr("slice(own, 1, 0)"))
    earlier = F.coalesce(F.sort_array("earlier"), F.expr("slice(own, 1, 0)"))
    spans = spans.select("conv_id", "window", F.concat(repeated, earlier).alias("context"), "own")
    spans = spans.select(
        "conv_id",
        "window",
        F.concat("context", "own").alias("pieces"),
        F.size("context").alias("n_context"),
        F.size("own").alias("n_turns"),
    )
    written = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
    )
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("loss"),
    )

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        target = F.struct(begin.alias("start"), F.length(p["body"]).alias("length"))
        loss = F.when(p["target"], F.array_append(acc["loss"], target)).otherwise(acc["loss"])
        after = begin + F.length(p["body"]) + F.lit(len(END))
        return F.struct(after.alias("at"), loss.alias("loss"))

    return spans.select(
        "conv_id",
        "window",
        written.alias("text"),
        F.aggregate("pieces", empty, step, lambda acc: acc["loss"]).alias("loss"),
        "n_context",
        "n_turns",
        F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_tokens"),
    )


def turns_of(text: Column, n_context: Column) -> Column:
    """The turns written first in a window, read back from its text: array of (role, text)."""
    pieces = F.split(text, r"<\|im_end\|>\n")
    own = F.slice(pieces, n_context + 1, F.size(pieces) - 1 - n_context)
    pattern = F.lit(r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)$")
    return F.transform(
        own,
        lambda p: F.struct(
            unescape(F.regexp_replace(p, pattern, F.lit("$1"))).alias("role"),
            unescape(F.regexp_replace(p, pattern, F.lit("$2"))).alias("text"),
        ),
    )


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask of a window, unescaped."""
    parts = F.transform(loss, lambda s: F.substring(text, s["start"] + 1, s["length"]))
    return unescape(F.array_join(parts, ""))
