"""Toxicity scores from bags of subword embeddings.

A word's subwords are its character n-grams with marked ends and the word itself,
hashed into ``BUCKETS`` vectors. A text is the mean of the vectors of all its
subwords, which a linear softmax classifies; vectors and softmax are trained
together. An unseen misspelling shares most n-grams with the words it comes from.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import stored

#: Hashed subword vectors, their length, and the lengths of n-grams.
BUCKETS, DIMENSIONS, SHORTEST, LONGEST = 1 << 17, 8, 3, 5
#: At most so many texts of either label are learned from, and so many words of a text's ends
#: are one subword run: longer "words" are cut into pieces of this length.
MAX_TRAIN, LONGEST_WORD = 3_000, 64
#: Bytes of texts of either label that are learned from, and of the longest such text.
MAX_BYTES, LONGEST_TEXT = 32 * 1024 * 1024, 256 * 1024
EPOCHS, BATCH, RATE = 8, 64, 0.5
#: Words whose subword sums a worker remembers.
REMEMBERED = 500_000

WORD = re.compile(r"\w{1,%d}" % LONGEST_WORD)


#: A subword that every text has once, the only one of a text without words.
END = np.array([zlib.crc32(b"</>") % BUCKETS], dtype=np.int32)


class Model(NamedTuple):
    """What is left of vectors and softmax for scoring: a number for each bucket, and a bias."""

    weights: np.ndarray
    bias: float


def subwords(word: str) -> list[str]:
    """A word's n-grams, and the word."""
    marked = f"<{word}>"
    grams = [marked]
    for n in range(SHORTEST, LONGEST + 1):
        grams.extend([marked[i : i + n] for i in range(len(marked) - n + 1)])
    return grams


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


def _bag(text: str, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, and the share of its subwords that each has."""
    parts = [END]
    for word in WORD.findall(text.lower()):
        part = known.get(word)
        if part is None:
            if len(known) > REMEMBERED // 4:
                known.clear()
            part = known[word] = np.array([bucket(g) for g in subwords(word)], dtype=np.int32)
        parts.append(part)
    index, counts = np.unique(np.concatenate(parts), return_counts=True)
    return index.astype(np.int32), (counts / counts.sum()).astype(np.float32)


def train(
    texts: list[str], labels: list[int], shares: tuple[float, float] | None = None, seed: int = 7
) -> Model:
    """Vectors and softmax by AdaGrad on the cross entropy, in numpy.

    ``shares``: what share of all labelled texts has label 0 and 1, if the texts given
    are not in these shares. Labels of one kind only, or none, give a constant score.
    """
    y = np.asarray(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.mean(y) * 12 - 6) if len(y) else 0.0)
    known: dict[str, np.ndarray] = {}
    bags = [_bag(t, known) for t in texts]
    known.clear()
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_vectors = np.full((BUCKETS, 1), 1e-6, np.float32)
    seen_softmax, seen_bias = np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)
    share = np.bincount(y, minlength=2) / len(y)
    shares = share if shares is None else np.asarray(shares)
    balance = (shares / share)[y].astype(np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            index = np.concatenate([bags[r][0] for r in rows])
            parts = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            taken = vectors[index] * parts[:, None]
            mean = np.stack(
                [np.bincount(owner, taken[:, d], len(rows)) for d in range(DIMENSIONS)], axis=1
            ).astype(np.float32)
            logits = mean @ softmax + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            chance[np.arange(len(rows)), y[rows]] -= 1
            slope = chance * (balance[rows] / len(rows))[:, None]
            to_mean = slope @ softmax.T
            for value, seen, step in (
                (softmax, seen_softmax, mean.T @ slope),
                (bias, seen_bias, slope.sum(0)),
            ):
                seen += step**2
                value -= rate * step / np.sqrt(seen)
            spread = to_mean[owner] * parts[:, None]
            step = np.stack(
                [np.bincount(index, spread[:, d], BUCKETS) for d in range(DIMENSIONS)], axis=1
            ).astype(np.float32)
            seen_vectors += (step**2).mean(1, keepdims=True)
            vectors -= rate * step / np.sqrt(seen_vectors)
    return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts; remembers the sums of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[float, int]] = {}
        self.grams: dict[str, float] = {}

    def _gram(self, gram: str) -> float:
        if len(self.grams) > REMEMBERED:
            self.grams.clear()
        found = self.grams[gram] = float(self.model.weights[bucket(gram)])
        return found

    def _word(self, word: str) -> tuple[float, int]:
        grams, own = self.grams, subwords(word)
        total = float(self.model.weights[bucket(own[0])])
        for g in own[1:]:
            total += grams[g] if g in grams else self._gram(g)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = self.known[word] = (total, len(own))
        return found

    def score(self, text: str) -> float:
        known, total, count = self.known, float(self.model.weights[END[0]]), 1
        for word in WORD.findall(text.lower()):
            found = known.get(word) or self._word(word)
            total += found[0]
            count += found[1]
        logit = total / count + self.model.bias
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, logit)))))


def _share(column: str | Column, shares: dict[int, float]) -> Column:
    """Whether the hash of a column falls into the share of a row's label."""
    hashed = F.pmod(F.xxhash64(column, F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for label, part in shares.items():
        share = F.when(F.col("toxic") == label, part).otherwise(share)
    return hashed < share


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_bytes: int = MAX_BYTES
) -> tuple:
    """About ``max_train`` texts and ``max_bytes`` at most of either label; their labels; shares.

    Labels are counted and sampled by a hash of the id first; only that sample, whose size the
    bound gives, is sent to the texts, which so are read but not shuffled. An id may still
    stand on any number of rows: the distinct texts met are stored, counted and sampled again,
    by a hash of the text, and only what is left by both bounds comes to the driver. Texts
    longer than ``LONGEST_TEXT`` are not learned from; they are scored as any other.
    """
    rows = labels.select("doc_id", F.col("toxic").cast("int")).where("toxic in (0, 1) AND doc_id IS NOT NULL").distinct()
    sizes = dict(rows.groupBy("toxic").count().collect())
    sample = rows.where(_share("doc_id", {label: min(1.0, max_train / count) for label, count in sizes.items()}))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= LONGEST_TEXT)
    met = stored(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic").distinct(), "toxicity-sample")
    found = met.groupBy("toxic").agg(F.count("*").alias("count"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    kept = {r.toxic: min(1.0, max_train / r["count"], max_bytes / max(1, r.bytes)) for r in found}
    pairs = sorted((r.text, r.toxic) for r in met.where(_share("text", kept)).collect())
    if not pairs:
        return [], [], None
    total = sum(sizes.values())
    shares = (sizes.get(0, 0) / total, sizes.get(1, 0) / total)
    return [t for t, _ in pairs], [k for _, k in pairs], shares


def learn(
    docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_bytes: int = MAX_BYTES
) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, toxic 0 or 1).

    Other labels, null ids, and labels without a document are left out. Every distinct text
    of an id takes its label; a text under both labels is learned from under both. Repeated
    rows count once.
    """
    return train(*labelled_sample(docs, labels, max_train, max_bytes))


def scorer(model: Model):
    """A column function of a text: its score, 0 to 1. Null and empty texts get the bias alone."""
    made: list[Scorer] = []

    def score(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Scorer(model))
        return pa.array([made[0].score(t or "") for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(score, "double")
