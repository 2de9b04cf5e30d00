"""Small frames with the awkward rows that every operator has to bear."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Columns whose names working columns might clash with.
CLASHING = ["key", "tie", "node", "n", "copy", "part", "rank", "region", "size", "bucket", "u", "v"]

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven other animals look on from "
    "a hill above the old mill and wonder what all of the noise in the valley is about"
)


def awkward_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows."""
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
    rows = [
        (1, PROSE, "en", "a", 5),
        (2, PROSE, "en", "a", 5),
        (2, PROSE, "en", "a", 5),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (None, PROSE + " indeed", "en", "b", 5),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (5, long, "en", "b", len(long)),
        (6, "x", "de", "b", 1),
        (7, " \n\t ", "de", None, 4),
        (8, "Grüße aus Köln, 你好 \U0001f600 ça va", "de", "a", 30),
        (9, PROSE.replace("seven", "eight"), "en", "c", 5),
        (-4, "12 34 56 %%% &&&", "fr", "c", 5),
    ]
    return rows


def awkward(spark, clashing=True):
    frame = spark.createDataFrame(awkward_rows(), SCHEMA)
    if clashing:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"cast(null as string) as `{name}`")
    return frame


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
