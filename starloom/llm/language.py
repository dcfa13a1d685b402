"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 fixed by its code point. A trigram's
vector binds (multiplies) its letters' vectors, each permuted (rolled) by its place.
A text is the bundle (sum) of its trigrams' vectors; a language's prototype bundles
the unit vectors of its training texts. A text gets the language whose prototype
has the largest cosine with it.
"""

from __future__ import annotations

import sys
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import map_texts, strings_of

DIMENSIONS = 1024
#: Trigram vectors that a worker remembers; beyond it they are made anew.
REMEMBERED = 32_768
#: About so many labelled texts are learned from, of each language ``LEAST_TRAIN`` at least.
MAX_TRAIN, LEAST_TRAIN = 20_000, 100
#: Code points of a text that are counted at a time.
BLOCK = 1 << 20
UNKNOWN = "und"


class Profiles(NamedTuple):
    """Languages and their unit prototypes, a row each."""

    languages: list[str]
    prototypes: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)], dtype=bool)


@cache
def _letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng(code).choice(np.array([-1, 1], dtype=np.int8), DIMENSIONS)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter trigrams; what is between letters is one blank."""
    codes: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    carried = np.array([32], dtype=np.uint64)
    for at in range(0, len(text), BLOCK):
        raw = text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, dtype=np.uint32).astype(np.uint64)
        points = np.where(_letters()[points], points, np.uint64(32))
        points = np.concatenate((carried, points, [np.uint64(32)] if at + BLOCK >= len(text) else []))
        points = points.astype(np.uint64)
        blank = points == 32
        points = points[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]
        if len(points) >= 3:
            packed = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
            code, count = np.unique(packed, return_counts=True)
            codes.append(code)
            counts.append(count)
        carried = points[-2:]
    if not codes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    code, back = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)


class Bundler:
    """Bundles texts; keeps the vectors of trigrams it has met."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, DIMENSIONS), dtype=np.int8)

    def _rows_of(self, codes: np.ndarray) -> list[int]:
        known = [self.rows.get(c, -1) for c in codes.tolist()]
        new = [k for k, row in enumerate(known) if row < 0]
        if not new:
            return known
        if len(self.rows) + len(new) > REMEMBERED and self.rows:
            self.rows = {}
            return self._rows_of(codes)
        while len(self.rows) + len(new) > len(self.vectors):
            self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
        for k in new:
            code = int(codes[k])
            row = self.rows[code] = len(self.rows)
            a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
            first, second = np.roll(_letter_vector(a), 2), np.roll(_letter_vector(b), 1)
            self.vectors[row] = first * second * _letter_vector(c)
            known[k] = row
        return known

    def unit(self, text: str) -> np.ndarray | None:
        """The text's bundle with length 1; None without letters."""
        codes, counts = trigrams(text)
        total = np.zeros(DIMENSIONS, dtype=np.float32)
        for at in range(0, len(codes), 4096):
            rows = self._rows_of(codes[at : at + 4096])
            part = self.vectors[rows].astype(np.float32)
            total += counts[at : at + 4096].astype(np.float32) @ part
        length = float(np.sqrt(total @ total))
        return total / length if length else None


def most_of_each(counts: list[int], total: int) -> int:
    """The largest bound for which the sum of min(count, bound) is within ``total``."""
    left, ordered = total, sorted(counts)
    for k, count in enumerate(ordered):
        bound = left // (len(ordered) - k)
        if count > bound:
            return bound
        left -= count
    return total


def sample_of(labelled: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Distinct (text, lang) to learn from, chosen within each language by a hash of the text.

    Languages share ``max_train`` evenly; what small ones leave goes to the others. A language
    whose distinct texts are within its part, or ``LEAST_TRAIN``, is taken whole; of the others
    about the larger of the two is taken, so more than ``max_train`` only with many languages.
    """
    rows = labelled.select("text", "lang").where("lang is not null and text is not null")
    key = F.xxhash64("text")
    sizes = rows.select("lang", key.alias("key")).distinct().groupBy("lang").count().collect()
    bound = max(LEAST_TRAIN, most_of_each([r["count"] for r in sizes], max_train))
    limits = [(r.lang, int(bound / r["count"] * (1 << 30))) for r in sizes if r["count"] > bound]
    limited = labelled.sparkSession.createDataFrame(limits, "limited string, below long")
    return (
        rows.join(F.broadcast(limited), F.col("lang") == F.col("limited"), "left")
        .where(F.col("below").isNull() | (F.pmod(key, F.lit(1 << 30)) < F.col("below")))
        .select("text", "lang")
        .distinct()
    )


def learn(labelled: DataFrame, max_train: int = MAX_TRAIN) -> Profiles:
    """Profiles from (text, lang) rows; rows without a language are left out.

    Learns from ``sample_of`` the rows: every language has texts in it, and a repeated text
    counts once. Their bundles are summed on the executors; a few rows a language come back.
    """
    sample = sample_of(labelled, max_train)
    bundler: list[Bundler] = []

    def bundle(batch: pa.RecordBatch) -> dict:
        if not bundler:
            bundler.append(Bundler())
        sums: dict[str, np.ndarray] = {}
        for text, lang in zip(strings_of(batch), strings_of(batch, "lang")):
            unit = bundler[0].unit(text)
            if unit is not None:
                sums[lang] = sums.get(lang, 0) + unit
        return {"lang": list(sums), "total": [v.tolist() for v in sums.values()]}

    parts = map_texts(sample.repartition(8), bundle, "lang string, total array<float>").collect()
    languages = sorted({p.lang for p in parts})
    found = np.zeros((len(languages), DIMENSIONS), dtype=np.float64)
    for p in parts:
        found[languages.index(p.lang)] += p.total
    found /= np.maximum(np.sqrt((found**2).sum(1, keepdims=True)), 1e-12)
    return Profiles(languages, found.astype(np.float32))


def predictor(profiles: Profiles):
    """A column function of a text: struct (lang_pred, score)."""
    bundler: list[Bundler] = []

    def predict(texts: pa.Array) -> pa.Array:
        if not bundler:
            bundler.append(Bundler())
        langs, scores = [], []
        for text in texts.to_pylist():
            unit = bundler[0].unit(text or "") if profiles.languages else None
            if unit is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
            else:
                cosines = profiles.prototypes @ unit
                best = int(cosines.argmax())
                langs.append(profiles.languages[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return F.arrow_udf(predict, "struct<lang_pred: string, score: double>")


def identify(docs: DataFrame, profiles: Profiles, text: Column | str = "text") -> DataFrame:
    """``docs``, all columns, with ``language``: struct (lang_pred, score).

    A text that is null or has no letter, and any text if no language was learned,
    is ``und`` with score 0; score is the cosine with the chosen prototype, 0 at
    least. Of equal cosines the first language by name wins.
    """
    column = F.col(text) if isinstance(text, str) else text
    return docs.withColumn("language", predictor(profiles)(column))


def has_letter(text: str) -> Column:
    """Whether a text column has a letter, as ``trigrams`` sees it; null has none."""

    def check(texts: pa.Array) -> pa.Array:
        return pa.array([any(map(str.isalpha, (t or "").lower())) for t in texts.to_pylist()], pa.bool_())

    return F.arrow_udf(check, "boolean")(text)


def with_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows of ``docs``, all columns, whose language can be told; a null ``lang`` becomes the predicted one.

    Rows that ``identify`` calls ``und``, without a letter that is, go; a stated language
    stays as it is. If none was learned, rows with a letter stay, and null languages too.
    """
    if not profiles.languages:
        return docs.where(has_letter("text"))
    # not deterministic to the planner, or it would predict once for the filter and once for the column
    found = docs.withColumn("__language", predictor(profiles).asNondeterministic()("text"))
    told = found.where(F.col("__language.lang_pred") != UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "__language.lang_pred")).select(*docs.columns)
