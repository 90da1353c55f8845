"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent turns of one role are merged into a block.
A block opens with ``<s>[INST] ``, ``<s>[REPLY] ``, ``<s>[SYS] `` or ``<s>[ROLE-<hex of the role>] ``, joins its texts
with `` [TURN] `` and closes with `` [/INST]``, `` </s>``, `` [/SYS]`` or `` [/ROLE]``. Inside texts a backslash is
doubled and ``[`` and ``<`` get a backslash in front, so that no control string can occur in a text and the escape
can be undone. The output is a list of segments with a loss flag: assistant texts are under the loss, controls never.

Defined results: a NULL text or role is empty; turns of equal number are ordered by role and text, NULL first, and
repeated rows stay; NULL conversation ids form one conversation; an empty table gives no rows; further columns are
ignored. A conversation is one output row and so as large as its text; every expression is linear in its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, TURN = "<s>[", " [TURN] "
TAGS = {"user": "INST", "assistant": "REPLY", "system": "SYS"}
CLOSES = {"REPLY": " </s>"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in ("[", "<"):
        out = F.replace(out, F.lit(mark), F.lit("\\" + mark))
    return out


def unescape(text: Column) -> Column:
    """Each ``[`` and ``<`` loses the backslash put before it; what is left of backslashes is doubled."""
    out = text
    for mark in ("<", "["):
        out = F.replace(out, F.lit("\\" + mark), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _tag(role: Column) -> Column:
    tag = F.concat(F.lit("ROLE-"), F.hex(role.cast("binary")))
    for name, short in TAGS.items():
        tag = F.when(role == name, F.lit(short)).otherwise(tag)
    return tag


def _close(tag: Column) -> Column:
    close = F.concat(F.lit(" [/"), F.split_part(tag, F.lit("-"), F.lit(1)), F.lit("]"))
    for name, text in CLOSES.items():
        close = F.when(tag == name, F.lit(text)).otherwise(close)
    return close


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, blocks): blocks of role and texts, in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    place = F.sequence(F.lit(0), n - 1)
    first = F.filter(place, lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]))
    begun = sorted_turns.select("conv_id", "turns", first.alias("first"))
    block = F.transform(
        "first",
        lambda i, k: F.struct(
            F.get("turns", i)["role"].alias("role"),
            F.slice(
                F.col("turns"), i + 1, F.coalesce(F.get("first", k + 1), F.size("turns")) - i
            ).getField("text").alias("texts"),
        ),
    )
    return begun.select("conv_id", block.alias("blocks"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss) and formatted, their concatenation."""

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def laid_out(block: Column) -> Column:
        tag = _tag(block["role"])
        loss = tag == "REPLY"
        texts = F.flatten(
            F.transform(
                block["texts"],
                lambda text, i: F.array(
                    segment(F.when(i == 0, F.lit("")).otherwise(F.lit(TURN)), F.lit(False)), segment(escape(text), loss)
                ),
            )
        )
        return F.concat(
            F.array(segment(F.concat(F.lit(OPEN), tag, F.lit("] ")), F.lit(False))),
            F.slice(texts, F.lit(2), F.size(texts)),
            F.array(segment(_close(tag), F.lit(False))),
        )

    laid = blocks(turns).select("conv_id", F.flatten(F.transform("blocks", laid_out)).alias("segments"))
    return laid.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    tag = lambda part: F.substring_index(part, "] ", 1)
    role = lambda t: F.unhex(F.split_part(t, F.lit("-"), F.lit(2))).cast("string")

    def named(t: Column) -> Column:
        out = role(t)
        for name, short in TAGS.items():
            out = F.when(t == short, F.lit(name)).otherwise(out)
        return out

    def turns_of(part: Column) -> Column:
        body = F.substring(part, F.length(tag(part)) + 3, F.length(part) - F.length(tag(part)) - 2 - F.length(_close(tag(part))))
        return F.transform(
            F.split(body, r"\Q" + TURN + r"\E", -1),
            lambda text: F.struct(named(tag(part)).alias("role"), unescape(text).alias("text")),
        )

    parts = F.filter(F.split(formatted, r"\Q" + OPEN + r"\E", -1), lambda part: part != "")
    return F.flatten(F.transform(parts, turns_of))


def digest(formatted: DataFrame) -> DataFrame:
    """The columns of the contract, read back from the formatted text and its loss flags."""
    read = formatted.select(
        "conv_id",
        "formatted",
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
        ).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
