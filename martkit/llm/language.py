"""Language identification by nearest centroid.

A text is lower-cased, what is no letter becomes a word boundary, and its runs of one
to three characters are hashed to DIMENSIONS counts. Counts are damped and weighed by
inverse document frequency over all training documents, and scaled to length one. Each
language has several centroids, found by spherical k-means; the nearest one by cosine
names the language. A text that is further from all centroids than texts of its length
in that language ever are is rejected; all training documents are measured for it.

Texts are read whole. Null texts and texts without a letter are ``und`` and rejected.
Training leaves out rows without text, language or id. Without any training row every
text is ``und``. Rows with equal ids are answered one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, once, quoted
from martkit.session import materialize

DIMENSIONS = 1 << 13
LONGEST = 3
CENTROIDS = 4
# Centroids are fitted on about so many documents of each language, chosen by a hash
# of the id; document frequencies count all training documents.
SAMPLE = 400
ROUNDS = 12
LOT = 256
UNKNOWN = "und"
# A text is rejected when its cosine is below this part of what all but one in 200
# training texts of its language and length class reach. A class of fewer texts takes
# the threshold of the nearest class that has so many, or a lower one of its own.
MARGIN = 0.5
LOW = 0.005
CLASS_ROWS = 20
# Length classes there are at most; an Arrow string has fewer than 2^31 letters.
CLASSES = 31


def _letters() -> np.ndarray:
    return np.fromiter(
        (chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1
    )


def counts(text: str) -> tuple[np.ndarray, int]:
    """(hashed n-gram counts, number of letters) of a whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = once("letters", _letters)[codes]
    total = np.zeros(DIMENSIONS, dtype=np.float32)
    n = int(letter.sum())
    if not n:
        return total, 0
    codes = np.where(letter, codes, 32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    for width in range(1, LONGEST + 1):
        grams = np.full(len(codes) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            grams = (grams + codes[i : i + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        grams = (grams * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift
        total += np.bincount(grams.astype(np.int64), minlength=DIMENSIONS)
    return total, n


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(tf) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Up to ``k`` unit centroids; starts from rows far from one another."""
    chosen = [rows.sum(axis=0)]
    chosen[0] /= max(np.linalg.norm(chosen[0]), 1e-12)
    while len(chosen) < min(k, len(rows)):
        nearest = (rows @ np.array(chosen).T).max(axis=1)
        # not the very furthest, which is an outlier
        chosen.append(rows[np.argsort(nearest, kind="stable")[len(rows) // 10]])
    centroids = np.array(chosen, dtype=np.float32)
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        for j in range(len(centroids)):
            if (owner == j).any():
                mean = rows[owner == j].mean(axis=0)
                centroids[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


@dataclass
class LanguageModel:
    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    # least cosine by language and length class, the number of bits of the number of letters
    least: dict[tuple[str, int], float] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool, int]]:
        """(language, cosine, rejected, letters) of each text."""
        out: list[tuple[str, float, bool, int]] = []
        for at in range(0, len(texts), LOT):
            found = [counts(t or "") for t in texts[at : at + LOT]]
            if not self.languages:
                out += [(UNKNOWN, 0.0, True, n) for _, n in found]
                continue
            cosines = vectors(np.array([c for c, _ in found]), self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1)
            for i, (_, n) in enumerate(found):
                if not n:
                    out.append((UNKNOWN, 0.0, True, 0))
                    continue
                score = min(1.0, max(0.0, float(cosines[i, best[i]])))
                name = self.languages[best[i]]
                far = score < self.least.get((name, min(n.bit_length(), CLASSES)), 0.0)
                out.append((name, score, far, n))
        return out


def thresholds(
    lows: dict[tuple[str, int], tuple[float, int]], languages: list[str]
) -> dict[tuple[str, int], float]:
    """The least cosine of every language and length class.

    ``lows`` has the low cosine and the number of texts of those that occur. A language
    without a filled class takes the others' lowest; without any there is no threshold.
    """
    filled = {at: low for at, (low, n) in lows.items() if n >= CLASS_ROWS}
    out = {}
    for name in languages:
        own = {w: low for (lang, w), low in filled.items() if lang == name}
        for _, w in filled if not own else ():
            own[w] = min(low for (_, other), low in filled.items() if other == w)
        for width in range(1, CLASSES + 1) if own else ():
            low = min((abs(width - w), reach) for w, reach in own.items())[1]
            if (name, width) not in filled:
                low = min(low, lows.get((name, width), (low, 0))[0])
            out[name, width] = MARGIN * low
    return out


def class_lows(rows: DataFrame, model: LanguageModel) -> dict[tuple[str, int], tuple[float, int]]:
    """(low cosine, texts) by language and length class, of all of ``rows`` with letters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(1).to_pylist())
            columns = [pa.array([r[1] for r in found], pa.float64())]
            columns.append(pa.array([r[3].bit_length() for r in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["lang", "score", "width"]
            )

    scored = rows.select(F.col("lang").cast("string"), "text")
    scored = scored.mapInArrow(reach, "lang string, score double, width bigint").where("width > 0")
    low = scored.groupBy("lang", F.least("width", F.lit(CLASSES)).alias("width")).agg(
        F.percentile_approx("score", LOW).alias("low"), F.count(F.lit(1)).alias("n")
    )
    return {(r["lang"], r["width"]): (r["low"], r["n"]) for r in low.collect()}


def held_out(key: Column) -> Column:
    """Whether a document is kept for testing; one without an id is not."""
    check = F.crc32(key.cast("string").cast("binary"))
    return F.coalesce(F.pmod(check, F.lit(4)) == 2, F.lit(False))


def fit_languages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    sample: int = SAMPLE,
    centroids: int = CENTROIDS,
) -> LanguageModel:
    """A model from the documents that are not held out.

    The driver gets DIMENSIONS counts, ``centroids`` vectors of each language, and one row
    for each of its length classes.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(
        quoted(key).alias("doc_id"), quoted(text).alias("text"), quoted(language).alias("lang")
    )
    rows = rows.where("doc_id is not null and text is not null and lang is not null")
    rows = rows.where(~held_out(F.col("doc_id")))

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for body in batch.column(0):
                total += counts(body.as_py())[0] > 0
            n += batch.num_rows
        if n:
            dims = np.append(np.arange(DIMENSIONS), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims), pa.array(np.append(total, n))], names=["dim", "n"]
            )

    seen = rows.select("text").mapInArrow(presence, "dim bigint, n bigint")
    totals = {r["dim"]: r["n"] for r in seen.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    frequency = np.array([totals.get(d, 0) for d in range(DIMENSIONS)], dtype=np.float64)
    idf = np.log((1 + totals.get(-1, 0)) / (1 + frequency)) + 0.01
    idf = idf.astype(np.float32)

    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chance = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    # few rows, one per language
    chosen = rows.join(materialize(sizes, "languages"), "lang").where(drawn < chance)
    chosen = materialize(chosen.select("lang", "doc_id", "text"), "language-sample")

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        tf = [c for c, n in map(counts, group["text"]) if n]
        if not tf:
            return pd.DataFrame({"lang": [], "centroid": []}, dtype=object)
        found = spherical_kmeans(vectors(np.array(tf), idf), centroids)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": list(found)})

    fitted = chosen.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>")
    found = sorted(fitted.collect(), key=lambda r: r["lang"])
    model = LanguageModel(
        [r["lang"] for r in found], np.array([r["centroid"] for r in found], np.float32), idf
    )
    model.least = thresholds(class_lows(rows, model), model.languages)
    return model


PREDICTED = "doc_id bigint, lang_pred string, score double, rejected boolean, letters bigint"


def identify(
    docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score, rejected, letters) of every document."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(1).to_pylist())
            columns = list(zip(*found)) or [()] * 4
            types = [pa.string(), pa.float64(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), t) for c, t in zip(columns, types))],
                names=["doc_id", "lang_pred", "score", "rejected", "letters"],
            )

    rows = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return rows.mapInArrow(predict, PREDICTED)


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they are."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        return pa.array([not r[2] for r in shared.value.predict(texts.to_pylist())], pa.bool_())

    return docs.where(known(quoted(text)))
