"""Chat formatting: logged snapshots of a growing conversation collapse into the longest, which is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE = "<|", "<|end|>"
HASHES = ["h1", "h2"]


def _said(role: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")]


def _hashes() -> list[Column]:
    """Two hashes of a turn at its place."""
    return [F.xxhash64("pos", "role", "text"), F.xxhash64(F.lit("second"), "text", "role", "pos")]


def single_turns(turns: DataFrame, conv: str, role: str, text: str) -> DataFrame:
    """Rows without an id as conversations of one turn, in the columns of :func:`turn_prefixes`. Nothing is grouped."""
    flat = turns.select(F.col(conv).alias("conv"), F.lit(1).cast("bigint").alias("pos"), *_said(role, text))
    return flat.select("*", *[h.alias(name) for h, name in zip(_hashes(), HASHES, strict=True)], F.lit(False).alias("goes_on"))


def turn_prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each turn with its position in its conversation, the conversation's length, and the hash of all turns up to it.

    Turns are ordered by turn, then role, then text (nulls first). The rolling hash is the running XOR
    of two position-salted 64-bit hashes, so equal hashes mean an equal sequence of turns.
    """
    flat = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *_said(role, text))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    placed = flat.withColumn("pos", F.row_number().over(order).cast("bigint"))
    upto = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        "conv", "pos", "role", "text",
        *[F.bit_xor(h).over(upto).alias(name) for h, name in zip(_hashes(), HASHES, strict=True)],
        F.lead(F.lit(True), 1, False).over(order).alias("goes_on"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """The distinct conversations that are no strict prefix of another: conv, n_turns, n_copies.

    Equal conversations are first merged (the smallest id stands for them), prefixes are made distinct
    in a partial aggregate, and one anti-join removes what a longer conversation begins with. So a turn
    or a conversation that many logs share is one row on either side of the join.
    """
    whole = (
        prefixes.where(~F.col("goes_on"))
        .groupBy(F.col("pos").alias("n_turns"), *HASHES)
        .agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    )
    begun = prefixes.where("goes_on").select(F.col("pos").alias("n_turns"), *HASHES).distinct()
    return whole.join(begun, ["n_turns", *HASHES], "left_anti").select("conv", "n_turns", "n_copies", *HASHES)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per maximal conversation: ``conv``, n_turns, n_copies (equal logs it stands for), chat.

    A turn reads ``<|role|>``, a line break, the text, ``<|end|>`` and a line break; ``<|`` inside a role
    or text becomes ``< |``. A null role reads ``unknown``, a null text is empty, each row without an id is
    a conversation of its own, repeated rows are repeated turns. Other columns are ignored; an empty table gives
    an empty result. Snapshots that go are dropped before anything is rendered; only a kept conversation's own
    turns meet in one task, as they form one value.
    """
    named = turn_prefixes(turns.where(F.col(conv).isNotNull()), conv, turn, role, text)
    lone = single_turns(turns.where(F.col(conv).isNull()), conv, role, text)
    chosen = maximal_conversations(named.select("conv", "pos", *HASHES, "goes_on").unionByName(lone.select("conv", "pos", *HASHES, "goes_on")))
    safe = lambda c: F.replace(F.col(c), F.lit(OPEN), F.lit("< |"))
    line = F.concat(F.lit(OPEN), safe("role"), F.lit("|>\n"), safe("text"), F.lit(CLOSE + "\n"))
    kept = named.select("conv", "pos", "role", "text").join(chosen.select("conv", "n_turns", "n_copies"), "conv")
    lines = kept.groupBy("conv").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("turns"))
    chats = lines.select("conv", "n_turns", "n_copies", F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("chat"))
    single = lone.groupBy(*HASHES).agg(F.first(line).alias("chat")).join(chosen.where("conv IS NULL AND n_turns = 1"), HASHES)
    return chats.unionByName(single.select("conv", "n_turns", "n_copies", "chat")).withColumnRenamed("conv", conv)
