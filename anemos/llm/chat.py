"""Conversations formatted as windows of bounded length for training.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``. Roles and texts may hold
any string: a control string inside gets a backslash after its first character (one
more than it already has there), which reading takes away again.

The turns of a conversation lie one after another on a line, each as long as its
tokens; prefix sums give their places. Tokens are an estimate, a quarter of the characters, unless another
count is given: ``piece_tokens`` is nearer where a character is a token or more. The line is cut every ``span`` tokens. Turns
between the same two cuts make a window; a turn across a cut has a window of its own.
So no window brings more than ``span`` new tokens, but for a single turn longer than
that, and each turn is new in one window. Before its new turns a window repeats the
system turn that opens the conversation and the whole turns of the ``history`` tokens
before it. Only the new assistant turns are under the loss mask.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import let, whole

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Strings that common templates read as control.
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
SPAN = 1536
HISTORY = 256
CHUNK = 4096
CHARS_PER_TOKEN = 4

_TAILS = "|".join(sorted({"".join("\\" + c if not c.isalnum() else c for c in s[1:].lstrip("<")) for s in CONTROL}))


def escaped(text: Column) -> Column:
    """The text without control strings; ``unescaped`` undoes it."""
    return F.regexp_replace(text, f"([<\\[])(\\\\*)(?={_TAILS})", "$1\\\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])\\\\(\\\\*)(?={_TAILS})", "$1$2")


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped(whole(role)), F.lit(SEP), escaped(whole(text)), F.lit(END))


def estimated_tokens(piece: Column) -> Column:
    """A token for each four characters, rounded up."""
    return F.ceil(F.length(piece) / F.lit(CHARS_PER_TOKEN)).cast("long")


def piece_tokens(piece: Column) -> Column:
    """Runs of letters, and single digits, signs and characters of scripts without spaces."""
    single = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}"
    return F.regexp_count(piece, F.lit(f"[\\p{{L}}&&[^{single}]]+|[^\\s\\p{{L}}]|[{single}]")).cast("long")


def placed_turns(turns: DataFrame, tokens: Callable[[Column], Column] = estimated_tokens) -> DataFrame:
    """conv_id, turn, role, piece (the formatted turn), start and end on the conversation's line.

    Prefix sums are taken within runs of ``CHUNK`` turn numbers and over the runs, so a
    conversation of very many turns is not one task's work.
    """
    piece = formatted_turn(F.col("role"), F.col("text"))
    rows = turns.select("conv_id", "turn", "role", piece.alias("piece"))
    rows = rows.withColumns({
        "tokens": tokens(F.col("piece")),
        "run": F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))).cast("long"),
    })
    runs = rows.groupBy("conv_id", "run").agg(F.sum("tokens").alias("run_tokens"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("conv_id").alias("_conv"), F.col("run").alias("_run"),
        F.coalesce(F.sum("run_tokens").over(before), F.lit(0)).alias("offset"),
    )
    rows = rows.join(runs, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("run") == F.col("_run")))
    order = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "piece")
    end = F.col("offset") + F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("end", end).select(
        "conv_id", "turn", "role", "piece", (F.col("end") - F.col("tokens")).alias("start"), "end")


def format_conversations(turns: DataFrame, span: int = SPAN, history: int = HISTORY,
                         tokens: Callable[[Column], Column] = estimated_tokens) -> DataFrame:
    """One row per window: conv_id, window (increasing within a conversation), text,
    n_context (repeated turns at its head), n_turns (new ones), tokens, and loss, the
    stretches (start, length in code points) of ``text`` under the loss mask.

    ``turns`` holds conv_id, turn, role, text; turns are put in order of turn, role and text, null
    turns first. Null roles and texts are empty, a null conv_id is a conversation of its
    own, repeated rows are repeated turns. A conversation has at least one turn, so no
    rows give no windows. Other columns are not read. ``history`` is at most ``span``;
    both are in the unit of ``tokens``, a native expression that counts the tokens of a formatted
    turn, at least one.
    """
    if not 0 <= history <= span:
        raise ValueError("history is at most span")
    rows = placed_turns(turns, tokens)
    cell = F.call_function("div", F.col("start"), F.lit(span).cast("long"))
    last = F.call_function("div", F.col("end") - 1, F.lit(span).cast("long"))
    rows = rows.withColumn("window", cell * 2 + (cell != last).cast("int"))
    rows = rows.withColumn("first_cell", cell)

    opening = rows.where((F.col("start") == 0) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("_conv"), F.col("piece").alias("system_piece"))
    windows = rows.groupBy("conv_id", "window").agg(F.min("start").alias("window_start")).select(
        F.col("conv_id").alias("_conv"), F.col("window").alias("_window"), "window_start")

    # A window that repeats a turn starts at most ``history`` <= ``span`` after it.
    nearby = rows.where(F.col("end") - F.col("start") <= history).withColumn(
        "later", F.explode(F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(3)), lambda at: F.col("first_cell") * 2 + at),
            lambda at: at > F.col("window"))))
    repeated = nearby.join(
        windows,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("later") == F.col("_window"))
        & (F.col("start") >= F.col("window_start") - history) & (F.col("end") <= F.col("window_start")),
    ).where(~((F.col("start") == 0) & F.coalesce(F.col("role") == "system", F.lit(False)))).select(
        "conv_id", F.col("later").alias("window"), F.lit(1).alias("part"), "start", "piece", F.lit(False).alias("loss"))
    heads = windows.where("window_start > 0").join(opening.withColumnRenamed("_conv", "conv_id"),
                                                   F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", F.col("_window").alias("window"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("start"),
        F.col("system_piece").alias("piece"), F.lit(False).alias("loss"))
    fresh = rows.select(
        "conv_id", "window", F.lit(2).alias("part"), "start", "piece",
        F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("loss"))

    parts = F.sort_array(F.collect_list(F.struct("part", "start", "piece", "loss")))
    packed = fresh.unionByName(repeated).unionByName(heads).groupBy("conv_id", "window").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["piece"]), "")
    head = F.lit(len(START)), F.lit(len(SEP)), F.lit(len(END))

    def masked(all_parts: Column) -> Column:
        empty = F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:bigint,length:bigint>>").alias("found"))

        def add(state: Column, part: Column) -> Column:
            text_at = F.instr(part["piece"], SEP) + head[1] - 1
            stretch = F.struct(
                (state["at"] + text_at).cast("long").alias("start"),
                (F.length(part["piece"]) - text_at - head[2]).cast("long").alias("length"))
            found = F.when(part["loss"], F.concat(state["found"], F.array(stretch))).otherwise(state["found"])
            return F.struct((state["at"] + F.length(part["piece"])).cast("long").alias("at"), found.alias("found"))

        return F.aggregate(all_parts, empty, add, lambda state: state["found"])

    return packed.select(
        "conv_id", "window", text.alias("text"),
        F.size(F.filter("parts", lambda p: p["part"] < 2)).alias("n_context"),
        F.size(F.filter("parts", lambda p: p["part"] == 2)).alias("n_turns"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + tokens(p["piece"])).alias("tokens"),
        masked(F.col("parts")).alias("loss"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """Per window what its text holds: conv_id, window, turns (role and text of the new
    turns, in order) and loss_text (the unescaped text under the mask), read from the text alone."""

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(START) + 1, 2**31 - 1)
        cut = F.instr(body, SEP)
        return F.struct(
            unescaped(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substring(body, cut + len(SEP), F.length(body))).alias("text"))

    pieces = F.split(F.col("text"), _literal(END), -1)
    fresh = let(pieces, lambda all_: F.slice(all_, F.col("n_context") + 1, F.size(all_) - 1 - F.col("n_context")))
    loss = F.transform("loss", lambda s: unescaped(
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select(
        "conv_id", "window", F.length("text").cast("long").alias("formatted_chars"),
        F.transform(fresh, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"))


def _literal(marker: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in marker)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its formatted windows: n_turns, turns_sha256 (role, newline,
    text, newline of each turn), loss_chars, loss_sha256 and formatted_chars.

    The digests are of one string per conversation, so a conversation must fit into a row.
    """
    read = read_turns(windows).select(
        "conv_id", "window", "formatted_chars", "loss_text", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
    )
    joined = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"),
        F.sum(F.length("loss_text")).cast("long").alias("loss_chars"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss_text"))).alias("parts"),
    )
    return joined.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        "loss_chars", F.sha2(F.array_join(F.transform("parts", lambda p: p["loss_text"]), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )
