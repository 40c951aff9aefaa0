"""Conversations as training samples of a bounded token budget.

Prefix sums of turn tokens choose turn-aligned windows. Each window after the first repeats the
leading system turn and the latest turns that fit the history allowance; what it repeats is
outside the loss mask, so each assistant turn is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import let

BEGIN, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates; inside a text each gets a backslash after its
# first character, and backslashes are doubled.
CONTROLS = (BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
BUDGET, HISTORY = 1024, 256


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _head(role: Column) -> Column:
    """Start of a turn; a line break inside a role is escaped, as the header ends at one."""
    name = F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.lit(BEGIN), name, F.lit("\n"))


def token_estimate(text: Column) -> Column:
    """Tokens a turn takes: a token per four code points, and four for its marks."""
    return (F.ceil(F.length(text) / 4) + 4).cast("long")


def _prefix_sums(values: Column) -> Column:
    """[0, v1, v1 + v2, ...]"""
    return F.aggregate(values, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1) + x)))


def _starts(sums: Column, n: Column, room: Column) -> Column:
    """First turns of the windows: a window closes before the turn that would pass ``room``."""
    return F.aggregate(
        F.sequence(F.lit(1), n), F.array(F.lit(0)),
        lambda acc, i: let(F.element_at(acc, -1), lambda s: F.when(
            (F.get(sums, i) - F.get(sums, s) > room) & (i - 1 > s),
            F.concat(acc, F.array(i - 1))).otherwise(acc)))


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", budget: int = BUDGET,
                         history: int = HISTORY, tokens=token_estimate) -> DataFrame:
    """One row per window: ``conv_id, window, n_windows, n_context, sample, mask``.

    ``sample`` is the formatted text, ``mask`` lists the (start, length) spans in code points
    that bear loss, and ``n_context`` counts the leading turns that repeat earlier ones.

    Turns are taken in the order of ``turn``, then role and text; null texts and roles count as
    empty, repeated rows are turns of their own, and rows without a conversation id form one
    conversation. A turn longer than the budget makes a window of its own and is not cut. A
    conversation is one record here: its turns meet in one row. Other columns are ignored; an
    empty table gives no windows.
    """
    empty = F.lit("")
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"),
                   F.coalesce(F.col(text), empty).alias("text"))
    turns = rows.groupBy(F.col(conv).alias("conv_id")).agg(
        F.sort_array(F.collect_list(one)).alias("turns"))

    laid = turns.select("conv_id", F.transform("turns", lambda t: F.struct(
        t.role.alias("role"), tokens(t.text).alias("tokens"), _head(t.role).alias("head"),
        escape(t.text).alias("body"))).alias("turns"))
    laid = laid.withColumn("system", F.get("turns", F.lit(0)).role == SYSTEM_ROLE)
    laid = laid.withColumn("sums", _prefix_sums(F.transform("turns", lambda t: t.tokens)))
    room = F.greatest(F.lit(1).cast("long"), F.lit(budget - history) - F.when(
        F.col("system"), F.get("sums", F.lit(1))).otherwise(0))
    laid = laid.withColumn("starts", _starts(F.col("sums"), F.size("turns"), room))
    first = F.when(F.col("system"), 1).otherwise(0)
    n = F.size("turns")

    wins = laid.select("conv_id", "turns", "system", "sums", n.alias("n"), first.alias("first"),
                       F.size("starts").alias("n_windows"), "starts",
                       F.posexplode("starts").alias("window", "start"))
    wins = wins.withColumn("stop", F.coalesce(F.get("starts", F.col("window") + 1), "n"))
    # The earliest turn whose distance to the start is within the history allowance.
    back = F.filter(F.sequence(F.lit(0), F.col("start")), lambda h: (
        (F.get("sums", F.col("start")) - F.get("sums", h) <= history) & (h >= F.col("first"))))
    wins = wins.withColumn("back", F.when(F.col("start") <= F.col("first"), F.col("start"))
                           .otherwise(F.get(back, F.lit(0))))
    repeats_system = F.col("system") & (F.col("start") > 0)
    shown = F.concat(
        F.when(repeats_system, F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0)),
        F.slice("turns", F.col("back") + 1, F.col("stop") - F.col("back")))
    wins = wins.select(
        "conv_id", "window", "n_windows", shown.alias("shown"),
        (F.col("start") - F.col("back") + F.when(repeats_system, 1).otherwise(0))
        .alias("n_context"))

    close = END + "\n"
    ends = _prefix_sums(F.transform("shown", lambda t: (
        F.length(t.head) + F.length(t.body) + len(close)).cast("long")))
    spans = let(ends, lambda at: F.transform("shown", lambda t, i: F.struct(
        (F.get(at, i) + F.length(t.head)).alias("start"),
        F.length(t.body).cast("long").alias("length"),
        ((t.role == TARGET_ROLE) & (i >= F.col("n_context"))).alias("target"))))
    mask = F.transform(F.filter(spans, lambda s: s.target),
                       lambda s: F.struct(s.start.alias("start"), s.length.alias("length")))
    sample = F.array_join(F.transform("shown", lambda t: F.concat(
        t.head, t.body, F.lit(close))), "")
    return wins.select("conv_id", "window", "n_windows", "n_context",
                       sample.alias("sample"), mask.alias("mask"))


def read_back(samples: DataFrame) -> DataFrame:
    """The conversations of formatted windows: ``conv_id, turns (role, text), targets``.

    Turns come from the marks in the samples, each once; ``targets`` are the unescaped texts
    under the mask, in order.
    """
    pieces = F.split("sample", r"<\|im_start\|>")  # the first is empty
    body_end = len(END) + 1
    parsed = F.transform(
        F.filter(pieces, lambda p, i: i > F.col("n_context")),
        lambda p: let(F.regexp_extract(p, r"^((?:[^\\\n]|\\[\s\S])*+)\n", 1), lambda h: F.struct(
            unescape(h).alias("role"),
            unescape(F.substring(p, F.length(h) + 2, F.length(p) - F.length(h) - 1 - body_end))
            .alias("text"))))
    masked = F.transform("mask", lambda s: unescape(
        F.substring(F.col("sample"), (s.start + 1).cast("int"), s.length.cast("int"))))
    one = samples.select("conv_id", F.struct(
        "window", parsed.alias("turns"), masked.alias("targets"),
        F.length("sample").cast("long").alias("chars")).alias("w"))
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    flat = lambda c: F.flatten(F.transform("w", lambda x: x[c]))
    return whole.select("conv_id", flat("turns").alias("turns"), flat("targets").alias("targets"),
                        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x.chars)
                        .alias("formatted_chars"))


def digests(conversations: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_back`` returns, one row per conversation."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("targets", "")
    return conversations.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
