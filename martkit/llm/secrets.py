r"""Secret scans: a wide pattern finds candidates, a random forest removes false ones.

A candidate is a run of LEAST or more key-like characters, also of several parts joined
by points, or the value, of SHORTEST or more signs, of an assignment. Its features are
length, changes between kinds of characters, shares of kinds, how much of it consists of words of
the corpus' own dictionary, slashes in and around it (paths), and the words and signs
next to it. The forest is trained on labelled findings: those a caller gives, or the
documented set of :mod:`martkit.llm.findings`, whose labels follow from how a finding was
made and not from any feature. All but the bounded training sample runs as Spark
expressions over whole texts.

Null and empty texts have no findings. Places count code points. Repeated rows are
answered one by one. If a caller's labels are all alike, all findings are kept and their
score is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import quoted
from martkit.llm.findings import example_texts
from martkit.operators.joins import lookup_join
from martkit.session import materialize

LEAST = 16
# No candidate is shorter.
SHORTEST = 6
# The context of a candidate, in characters, whatever candidates lie in it.
BEFORE, AFTER = 40, 12
# What assigns a value is no padding of the name before it.
PADDING = r"(?:={1,2}(?![\"'`]?[A-Za-z0-9_+/=$@#%^*~\-]))?"
# A run, or runs that points join, as those of tokens.
TAIL = rf"(?:\.[A-Za-z0-9_+/\-]{{{SHORTEST},}})*+"
JWT = r"eyJ[A-Za-z0-9_\-]{8,}(?:\.{1,2}[A-Za-z0-9_\-]+){1,4}"
CANDIDATE = rf"{JWT}|[A-Za-z0-9_+/\-]{{{LEAST},}}{TAIL}{PADDING}"
# The dictionary: all words of three letters or more that so many documents hold.
LEAST_DOCS = 2
LEAST_LETTERS = 3
# Words of a candidate: runs of letters, parted where the case changes.
BORDER = r"[^\p{L}]+|(?<=\p{Ll})(?=\p{Lu})|(?<=\p{Lu})(?=\p{Lu}\p{Ll})"
# Rows of the documented set, and corpus words in them.
EXAMPLES, EXAMPLE_WORDS = 8000, 256
# Different labelled findings that the forest is trained on, about so many of each label;
# each weighs as much as it has copies.
SAMPLE = 4000
TREES, DEPTH = 24, 6
# Candidates of a text whose ends are summed up together.
RUN = 256
KEPT = 0.5

# Signs of a secret, by prefix of a known key format or by assignment.
KNOWN_KEY = rf"^{JWT}$|" + r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
NAMES = r"(token|secret|passw(or)?d|pwd|(api|access|secret|private)_?key|auth|credential|bearer)"
ASSIGNED = rf"(?i){NAMES}[\"']?\s*[:=]\s*[\"']?$"
# The value of an assignment, of any signs but blanks: up to the closing quote, or less
# the punctuation of the sentence or call around it and other parameters of an address.
# Java's expressions alone look back so far.
VALUE = (
    r"(?<=[:=]\s{0,4}[\"']?)(?<![^\"'\s:=])(?![:=])"
    rf"(?<=(?i:{NAMES})[\"']?\s{{0,4}}[:=]\s{{0,4}}[\"']?)"
    rf"(?:(?<=\")[^\s\"]{{{SHORTEST},}}+(?=\")|(?<=')[^\s']{{{SHORTEST},}}+(?=')"
    rf"|[^\s\"'`]{{{SHORTEST},}}?(?<![,;.:!?)\]}}>&])"
    r"(?=[,;.:!?)\]}>&]*+(?:[\s\"'`]|$)|[,;.:!?)\]}>]*+&[A-Za-z_]++=))"
)
FINDING = f"{VALUE}|{CANDIDATE}"
KEY_WORD = r"(?i)(token|secret|passw|pwd|key|auth|credential|bearer)"
EXAMPLE_WORD = r"(?i)(example|sample|dummy|placeholder|sha(1|256)?|md5|uuid|commit|checksum|hash)"

FEATURES = [
    "length",
    "changes",
    "digits",
    "capitals",
    "hex",
    "signs",
    "covered",
    "slashes",
    "in_path",
    "assigned",
    "key_word",
    "example_word",
    "in_quotes",
    "known_key",
]


def dictionary(docs: DataFrame, text: str = "text", least: int = LEAST_DOCS) -> DataFrame:
    """(word): every word of ``least`` documents or more.

    Letters beside digits and signs are no words, or copied keys would teach their own.
    """
    tokens = F.split(F.lower(quoted(text)), r"[^\p{L}\p{N}_+/=\-]+")
    tokens = F.filter(tokens, lambda t: ~F.rlike(t, F.lit(r"[\p{N}_+=]")))
    words = F.flatten(F.transform(tokens, lambda t: F.split(t, r"[/\-]+")))
    words = F.filter(words, lambda w: F.char_length(w) >= LEAST_LETTERS)
    words = docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word")
    return words.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("word")


def add_coverage(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """``candidates`` with ``covered``, the share of ``found`` that words make up.

    Words are looked up once for each different part of the different findings.
    """
    different = materialize(candidates.select("found").distinct(), "secret-founds")
    parts = F.transform(F.split("found", BORDER), lambda w: F.lower(w))
    parts = F.filter(parts, lambda w: F.char_length(w) >= LEAST_LETTERS)
    parts = materialize(different.select("found", F.explode(parts).alias("word")), "secret-parts")
    known = lookup_join(parts.select("word").distinct(), words, ["word"], "inner")
    known = materialize(known, "secret-words")
    hits = lookup_join(parts, known, ["word"], "inner")
    letters = hits.groupBy("found").agg(F.sum(F.char_length("word")).alias("letters"))
    letters = materialize(letters, "secret-coverage")
    rows = lookup_join(candidates, letters, ["found"], "left")
    share = F.coalesce(F.col("letters"), F.lit(0)) / F.char_length("found")
    return rows.withColumn("covered", share.cast("double")).drop("letters")


def running_sums(steps: Column) -> Column:
    """The sums of an array of numbers up to each of them.

    Adding to an array copies it, so sums are made within runs of RUN numbers, then
    over the runs; the work is in proportion to the numbers for many millions of them.
    """

    def added(values: Column, start: Column) -> Column:
        kind = "struct<at: bigint, sums: array<bigint>>"
        first = F.struct(start.alias("at"), F.array().alias("sums")).cast(kind)

        def add(acc: Column, value: Column) -> Column:
            now = acc["at"] + value
            return F.struct(now.alias("at"), F.concat(acc["sums"], F.array(now)).alias("sums"))

        return F.aggregate(values, first, add, lambda acc: acc["sums"])

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use(value)``, the value being computed once, not each time it is looked at."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    zero = F.lit(0).cast("bigint")

    def cut(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(RUN))
        return F.transform(starts, lambda at: F.slice(values, at, F.lit(RUN)))

    def join(runs: Column) -> Column:
        sums = F.transform(runs, lambda run: F.aggregate(run, zero, lambda a, b: a + b))
        before = F.concat(F.array(zero), added(sums, zero))
        return bound(
            before,
            lambda first: F.transform(runs, lambda run, i: added(run, F.get(first, i))),
        )

    return F.flatten(bound(steps, lambda values: bound(cut(values), join)))


def find_candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, found, before, after), one row per candidate."""
    rows = docs.select(quoted(key).alias("doc_id"), quoted(text).alias("text"))
    rows = rows.where(F.col("text").rlike(FINDING))
    rows = rows.select(
        "doc_id",
        F.split("text", FINDING).alias("gaps"),
        F.regexp_extract_all("text", F.lit(FINDING), F.lit(0)).alias("hits"),
    )

    def joined(i: Column, first: int, last: int, part: Callable[[Column], Column]) -> Column:
        """Gaps and candidates in turn about the gap before candidate i, each cut by ``part``."""
        at = F.sequence(F.greatest(i + first, F.lit(0)), i + last)

        def piece(j: Column) -> Column:
            found = F.when(j < i + last, part(F.get("hits", j))).otherwise("")
            return F.concat(part(F.get("gaps", j)), F.coalesce(found, F.lit("")))

        return F.array_join(F.transform(at, piece), "")

    def hit(found: Column, i: Column) -> Column:
        # so many pieces hold BEFORE and AFTER characters, as none is empty but gaps
        before = joined(i, -BEFORE // SHORTEST, 0, lambda x: F.right(x, F.lit(BEFORE)))
        after = joined(i + 1, 0, -(-AFTER // SHORTEST), lambda x: F.left(x, F.lit(AFTER)))
        return F.struct(
            found.alias("found"),
            F.right(before, F.lit(BEFORE)).alias("before"),
            F.left(after, F.lit(AFTER)).alias("after"),
            (F.char_length(F.get("gaps", i)) + F.char_length(found)).alias("step"),
        )

    rows = rows.select("doc_id", F.transform("hits", hit).alias("hits"))
    ends = running_sums(F.transform("hits", lambda h: h["step"]))
    rows = rows.select("doc_id", F.explode(F.arrays_zip(F.col("hits"), ends.alias("end"))).alias("h"))
    return rows.select(
        "doc_id",
        (F.col("h.end") - F.char_length("h.hits.found")).cast("bigint").alias("start"),
        F.col("h.end").cast("bigint").alias("end"),
        "h.hits.found",
        "h.hits.before",
        "h.hits.after",
    )


def add_features(candidates: DataFrame, words: DataFrame) -> DataFrame:
    candidates = add_coverage(candidates, words)
    found, before, after = F.col("found"), F.col("before"), F.col("after")
    length = F.char_length(found).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(found, F.lit(pattern)) / length

    number = {
        "length": length,
        "changes": F.regexp_count(
            found,
            F.lit(r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
        )
        / length,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "hex": share("[0-9a-fA-F]"),
        "signs": share("[^A-Za-z0-9]"),
        "covered": F.col("covered"),
        "slashes": share("/"),
        "in_path": F.rlike(before, F.lit(r"[/\\.]$")) | F.rlike(after, F.lit(r"^[/\\.][A-Za-z0-9]")),
        "assigned": F.rlike(before, F.lit(ASSIGNED)),
        "key_word": F.rlike(before, F.lit(KEY_WORD)),
        "example_word": F.rlike(before, F.lit(EXAMPLE_WORD)),
        "in_quotes": F.rlike(before, F.lit("[\"'`]$")) & F.rlike(after, F.lit("^[\"'`]")),
        "known_key": F.rlike(found, F.lit(KNOWN_KEY)),
    }
    return candidates.withColumns({name: number[name].cast("double") for name in FEATURES})


def example_findings(
    spark: SparkSession, words: DataFrame, rows: int = EXAMPLES, seed: int = 42
) -> DataFrame:
    """(found, before, after, label) of the documented set, with words of the corpus in it."""
    some = words.orderBy(F.xxhash64("word", F.lit(seed)), "word").limit(EXAMPLE_WORDS).collect()
    made = materialize(example_texts(spark, rows, [r["word"] for r in some], seed), "secret-examples")
    found = find_candidates(made).join(made.select("doc_id", "wanted", "label"), "doc_id")
    found = found.where(F.col("found") == F.col("wanted"))
    return found.select("found", "before", "after", "label")


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, start, end, found, score, kept) of every candidate.

    ``labelled`` holds findings to learn from: found, before, after, and label (1.0 for a
    secret). Without it those of ``example_findings`` are taken. At most about ``sample``
    different ones of each label are drawn.
    """
    words = materialize(dictionary(docs, text), "secret-dictionary")
    candidates = materialize(find_candidates(docs, key, text), "secret-candidates")
    findings = materialize(add_features(candidates, words), "secrets")
    if labelled is None:
        labelled = example_findings(docs.sparkSession, words, seed=seed)
    given = labelled.select("found", "before", "after", "label")
    given = add_features(materialize(given, "secret-given"), words)
    given = given.where(F.col("label").isin(0.0, 1.0))
    # copies, which no feature parts, are one finding of more weight
    given = given.groupBy("label", *FEATURES).agg(F.count(F.lit(1)).alias("copies"))
    given = materialize(given, "secret-findings")
    drawn = F.pmod(F.xxhash64(*FEATURES, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sizes = given.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("first"))
    sizes = {r["label"]: (r["n"], r["first"]) for r in sizes.collect()}
    out = ["doc_id", "start", "end", "found"]
    if len(sizes) < 2:
        return findings.select(*out, F.lit(None).cast("double").alias("score"), F.lit(True).alias("kept"))
    # the first by the draw always comes, so both labels do
    bound = {label: max(sample / n, first) for label, (n, first) in sizes.items()}
    chance = F.when(F.col("label") == 1, bound[1.0]).otherwise(bound[0.0])
    training = given.where(drawn <= chance).orderBy("label", *FEATURES)
    training = materialize(training, "secret-labels")
    weights = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    # both labels weigh the same
    weight = F.col("copies") / F.when(F.col("label") == 1, weights[1.0]).otherwise(weights[0.0])
    training = training.withColumn("weight", weight * sum(weights.values()))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=seed,
        featureSubsetStrategy="sqrt",
        weightCol="weight",
    )
    model = forest.fit(assembler.transform(training))
    scored = model.transform(assembler.transform(findings))
    score = vector_to_array("probability")[1]
    return scored.select(*out, score.alias("score"), (score >= KEPT).alias("kept"))
