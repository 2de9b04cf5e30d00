r"""Labelled findings for the forest of :mod:`martkit.llm.secrets`.

Each is a text made of a shape below, with random letters, corpus words and numbers put
in. Secrets come with and without a cue before them, and so do things that only look like
secrets, so that no single cue says which is which:

==========  =====  =======================================================
secret      label  ``AKIA`` keys, forge tokens, JWTs; random keys after an
                   assignment, after a key word, and without any cue;
                   passwords after an assignment
hash         0     commit and content hashes, UUIDs, with cues of their own
words        0     paths, slugs, identifiers and addresses of corpus words,
                   also as the value of an assignment
files        0     random names of files within paths and addresses
numbers      0     long numbers and dates
placeholder  0     values such as ``your-token-here`` after an assignment
==========  =====  =======================================================

Made by expressions from row numbers; the number of rows is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that stand in where the corpus has too few.
FEW_WORDS = ["alpha", "window", "letter", "garden", "market", "silver", "number", "travel"]


def _digest(what: str, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(f"{seed} {what}"), F.col("id").cast("string")), 256)


def _number(what: str, seed: int, below: int) -> Column:
    """A number from 0 on, drawn by row."""
    return F.pmod(F.xxhash64(F.lit(what), F.lit(seed), F.col("id")), F.lit(below)).cast("int")


def _letters(what: str, seed: int) -> Column:
    """More than 70 letters and digits."""
    raw = F.concat(*[F.base64(F.unhex(_digest(f"{what} {i}", seed))) for i in range(2)])
    return F.translate(raw, "+/=", "")


def _cut(text: Column, least: int, most: int, seed: int) -> Column:
    return F.left(text, F.lit(least) + _number(f"{least} {most}", seed, most - least + 1))


def example_texts(
    spark: SparkSession, rows: int, words: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """(doc_id, text, wanted, label): texts around one finding each, the finding, and its label."""
    vocabulary = F.array(*[F.lit(w) for w in (words if words and len(words) >= 8 else FEW_WORDS)])
    held = len(words) if words and len(words) >= 8 else len(FEW_WORDS)

    def word(i: int) -> Column:
        return F.get(vocabulary, _number(f"word {i}", seed, held))

    def joined(sign: str, first: int = 0, n: int = 4) -> Column:
        return F.concat_ws(sign, *[word(first + i) for i in range(n)])

    random = _letters("key", seed)
    hexes = F.concat(_digest("hex", seed), _digest("hex more", seed))
    key = F.when(_number("hex?", seed, 2) == 0, _cut(random, 20, 48, seed)).otherwise(
        _cut(hexes, 32, 64, seed)
    )
    name = F.get(
        F.array(*[F.lit(x) for x in ("token", "secret", "api_key", "password", "auth", "access_key")]),
        _number("name", seed, 6),
    )
    sign = F.get(F.array(*[F.lit(x) for x in (" = \"", ": ", "=", " = ", "='")]), _number("sign", seed, 5))
    close = F.when(F.right(sign, F.lit(1)).isin('"', "'"), F.right(sign, F.lit(1))).otherwise("")
    assigned = F.concat(name, sign)
    cue = F.get(
        F.array(*[F.lit(x) for x in ("key ", "the secret ", "use this token ", "credential ", "passwd ")]),
        _number("cue", seed, 5),
    )
    upper = F.upper(random)
    digits = F.translate(hexes, "abcdef", "")
    uuid = F.regexp_replace(
        F.left(hexes, F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    hashed = F.get(
        F.array(*[F.lit(x) for x in ("commit ", "sha256:", "md5 ", "checksum ", "etag \"", "index ", "")]),
        _number("hashed", seed, 7),
    )
    jwt = F.concat(F.lit("eyJ"), _cut(random, 12, 30, seed), F.lit("."), F.left(upper, F.lit(24)))
    password = F.concat(
        F.initcap(word(7)),
        _number("pass", seed, 9000).cast("string"),
        F.get(F.array(*[F.lit(x) for x in ("", "!", "$", "#", "@x")]), _number("mark", seed, 5)),
        F.left(F.substring(random, 5, 4), _number("end", seed, 5)),
    )
    none = F.lit("")
    # (label, before, finding, after)
    shapes = [
        (1, none, F.concat(F.lit("AKIA"), F.left(upper, F.lit(16))), none),
        (1, none, F.concat(F.lit("ghp_"), F.left(random, F.lit(36))), none),
        (1, F.lit("Bearer "), jwt, none),
        (1, assigned, key, close),
        (1, assigned, _cut(random, 16, 40, seed + 1), close),
        (1, cue, key, none),
        (1, none, _cut(random, 24, 48, seed + 2), none),
        (1, assigned, password, close),
        (0, hashed, F.left(hexes, F.lit(40)), none),
        (0, hashed, _cut(hexes, 32, 64, seed + 3), none),
        (0, F.concat(word(8), F.lit(" id=")), uuid, none),
        (0, F.lit("/srv/"), joined("/"), F.lit("/file")),
        (0, F.lit("https://example.org/"), joined("-"), F.lit("/")),
        (0, none, joined("_"), F.lit("()")),
        (0, assigned, joined("-"), close),
        (0, assigned, F.concat(joined("_", 3, 3), F.lit("_here")), close),
        (0, cue, F.concat_ws("", *[F.initcap(word(i)) for i in range(4)]), none),
        (0, none, F.left(F.concat(F.lit("4"), digits), F.lit(16)), none),
        (0, assigned, F.concat(F.lit("your-"), name, F.lit("-"), joined("-", 2, 2)), close),
        (0, F.lit("https://cdn.example."), F.concat(F.lit("org/"), key, F.lit("/main")), F.lit(".js")),
        (0, F.lit("D:\\cache\\"), _cut(random, 20, 40, seed + 4), F.lit(".bin")),
        (0, F.lit("see "), F.concat(joined("/"), F.lit("-2024-"), F.left(digits, F.lit(2))), none),
    ]
    made = F.array(
        *[
            F.struct(
                before.alias("lead"), found.alias("wanted"), after.alias("tail"),
                F.lit(float(label)).alias("label"),
            )
            for label, before, found, after in shapes
        ]
    )
    picked = spark.range(rows).select("id", F.get(made, F.pmod("id", F.lit(len(shapes)))).alias("x"))
    text = F.concat(joined(" ", 11), F.lit(" "), "x.lead", "x.wanted", "x.tail", F.lit(" "), word(15))
    return picked.select(F.col("id").alias("doc_id"), text.alias("text"), "x.wanted", "x.label")
