r"""Chat formatting with Spark expressions only.

Turns of a conversation are collected, sorted and written into one text:

    <|turn|>role<|text|>first text<|part|>next text of the same role<|end|>...

Adjacent turns of one role share a block. Control strings all begin with ``<|``.
In texts and roles a backslash is put before each backslash and before each bar
that follows ``<``, so ``<|`` never occurs in them and the way back is exact.

Turns sort by (turn, role, text), nulls first, so ties and repeated rows have one
order. Null texts and roles are empty ones. Rows without a conversation id form one
conversation. A conversation is one text, as its reader wants it, so it has to fit a
task; what is spread over tasks is the conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import quoted

TURN = "<|turn|>"
TEXT = "<|text|>"
PART = "<|part|>"
END = "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=<)\|", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """(conv_id, formatted, segments), one row per conversation.

    ``segments`` is the text in pieces with the loss mask: an array of
    (text, loss), whose texts joined are ``formatted``.
    """
    plain = rows.select(
        quoted(conversation).alias("conv_id"),
        F.struct(
            quoted(turn).alias("turn"),
            F.coalesce(quoted(role), F.lit("")).alias("role"),
            F.coalesce(quoted(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = F.sort_array(F.collect_list("t"))
    chats = plain.groupBy("conv_id").agg(sorted_turns.alias("turns"))

    def pieces(t: Column, i: Column) -> Column:
        opened = F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
        before = F.get("turns", i - 1)["role"]
        head = (
            F.when(i == 0, opened)
            .when(before == t["role"], F.lit(PART))
            .otherwise(F.concat(F.lit(END), opened))
        )
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(*trained_roles).alias("loss")),
        )

    last = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("turns", pieces)), last)
    chats = chats.select("conv_id", segments.alias("segments"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select("conv_id", formatted.alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, an array of (role, text)."""
    blocks = F.split(formatted, r"\Q" + END + r"\E")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        halves = F.split(block, r"\Q" + TEXT + r"\E", 2)
        role = unescape(F.substr(halves[0], F.lit(len(TURN) + 1)))
        texts = F.split(halves[1], r"\Q" + PART + r"\E")
        return F.transform(
            texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def masked_text(segments: Column) -> Column:
    """What the loss mask covers, unescaped."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def chat_digests(chats: DataFrame) -> DataFrame:
    """Counts and hashes read back from the output of ``format_conversations``."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("segments")).alias("trained"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("trained").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
