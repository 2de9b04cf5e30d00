import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martkit.llm.chat import chat_digests, format_conversations, read_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROL = st.lists(
    st.sampled_from(
        ["<|", "|", "<", "\\", "<|end|>", "<|part|>", "<|turn|>", "<|text|>", "a", "\n", "é", "😀", " "]
    ),
    max_size=8,
).map("".join)


def expected(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in chats.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256(every.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def digests(frame):
    return {tuple(r)[0]: tuple(r)[1:5] for r in chat_digests(format_conversations(frame)).collect()}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from([1, 2, None]),
            st.sampled_from([0, 1, 2, None]),
            st.one_of(st.sampled_from(["user", "assistant", None]), CONTROL),
            st.one_of(st.none(), CONTROL),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_round_trip(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert digests(frame) == expected(rows)


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    chat = format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert chat["formatted"] == (
        "<|turn|>user<|text|>a<|part|>b<|end|><|turn|>assistant<|text|>c<|end|>"
    )
    assert "".join(s["text"] for s in chat["segments"]) == chat["formatted"]
    assert [s["text"] for s in chat["segments"] if s["loss"]] == ["c"]


def test_long_conversation_and_clashing_columns(spark):
    frame = spark.range(20_000).select(
        F.lit(9).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text <|end|> "), F.col("id").cast("string")).alias("text"),
        F.lit(1).alias("turns"),
        F.lit(2).alias("segments"),
        F.lit(3).alias("t"),
    )
    row = chat_digests(format_conversations(frame)).first()
    assert row["n_turns"] == 20_000
    turns = format_conversations(frame).select(F.size(read_turns(F.col("formatted"))).alias("n"))
    assert turns.first()["n"] == 20_000


def test_empty_table(spark):
    assert chat_digests(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
