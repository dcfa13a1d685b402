"""Importance resampling of documents towards a target, over hashed n-grams.

A 256-byte table lower-cases A-Z and blanks separators in UTF-8; ``bytes.split`` gives the
words. The crc32 of a word seeds that of the n-gram which goes on from it, so no n-gram is
ever put together. Counters add up the buckets of a task, and only as many numbers as there
are buckets leave it. A document's weight is the floored mean, over its n-grams, of how much
likelier each is in the target than in the corpus; Gumbel noise from a hash of its id turns
the highest scores into a draw without replacement in proportion to the weights.

Rows: null texts have no words; a text without words has weight 0 and its noise as score.
Repeated rows and repeated ids are documents each; two rows of one id have the same noise,
and if their scores tie as well, either may come first. A null id counts as empty in the
noise and before all others in ties. Long texts are worked off in pieces between two words.
An empty corpus gives no rows; an empty target is one of no n-grams.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from operator import mod
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import map_texts, stored, texts_of

BUCKETS, LONGEST, FEWEST_WORDS, SEED = 10_000, 2, 20, 7
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20


def byte_table() -> bytes:
    """A-Z to a-z; digits, a-z and bytes beyond ASCII stay; all others to a blank."""
    kept = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)}
    return bytes(b + 32 if 65 <= b <= 90 else b if b in kept else 32 for b in range(256))


TABLE = byte_table()


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a piece at a time."""
    blanked, at = text.translate(TABLE), 0
    while at < len(blanked):
        end = blanked.find(b" ", at + PIECE) if len(blanked) - at > PIECE else len(blanked)
        end = len(blanked) if end < 0 else end
        found = blanked[at:end].split()
        if found:
            yield found
        at = end


def features(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[int]]]:
    """Words of each piece of a text, and the crc32 of every n-gram that ends in the piece."""
    # crc32 of the n-grams of each length that end at the last word of the piece before
    before: list[list[int]] = [[] for _ in range(longest)]
    for words in word_lists(text):
        spaced = [b" " + w for w in words]
        grams = list(map(crc32, words))
        found, seeds = list(grams), before[0] + grams
        before[0] = seeds[-1:]
        for n in range(1, longest):
            # an n-gram goes on from the shorter one that ends at the word before its last
            skipped = len(words) - (len(seeds) - 1)
            grams = list(map(crc32, spaced[skipped:], seeds))
            found += grams
            seeds = before[n] + grams
            before[n] = seeds[-1:]
        yield len(words), found


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for value in texts_of(batch, text):
                for _, found in features(value, longest):
                    counts.update(map(mod, found, repeat(buckets)))
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                ["bucket", "count"],
            )

    parts = df.select(text).mapInArrow(run, "bucket int, count long")
    out = np.zeros(buckets, np.int64)
    for bucket, count in parts.groupBy("bucket").agg(F.sum("count")).collect():
        out[bucket] = count
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """1000 times the log of how much likelier each bucket is in the target, floored."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log(((t + 1.0) * (s_all + buckets)) / ((s + 1.0) * (t_all + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]


def noise(doc_id: str, seed: int = SEED) -> int:
    """A thousandth of Gumbel noise from the first 32 bits of a hash of the id, floored."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """(key, n_words, n_features, weight, score) of each row of ``docs``."""
    gain = gains(
        bucket_counts(docs, text, buckets, longest), bucket_counts(target, text, buckets, longest)
    )

    def weigh(batch: pa.RecordBatch) -> dict:
        words, sizes, weights, totals = [], [], [], []
        names = batch.column(batch.schema.get_field_index("name")).to_pylist()
        for name, value in zip(names, texts_of(batch, text)):
            n_words = n_features = total = 0
            for count, found in features(value, longest):
                n_words += count
                n_features += len(found)
                total += sum(map(gain.__getitem__, map(mod, found, repeat(buckets))))
            weight = total // n_features if n_features else 0
            words.append(n_words)
            sizes.append(n_features)
            weights.append(weight)
            totals.append(weight + noise(name, seed))
        ids = batch.column(batch.schema.get_field_index(key))
        return {key: ids, "n_words": words, "n_features": sizes, "weight": weights, "score": totals}

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(key, text, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"))
    schema = f"`{key}` {kind}, n_words long, n_features long, weight long, score long"
    return map_texts(named, weigh, schema)


def ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with the number of each row in the given order, from 1, as the column ``name``.

    Rows are ranged and sorted over all tasks and written; a row's number is its place in its
    own part after the sizes of the parts before. Only these sizes, one for each part, meet
    on the driver.
    """
    spark = df.sparkSession
    placed = stored(df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__place", 33).cast("int")
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for number, size in sizes:
        offsets.append((number, total))
        total += size
    before = spark.createDataFrame(offsets, "__part int, __before long")
    own = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn("__part", part).join(F.broadcast(before), "__part")
    return joined.select(*df.columns, (F.col("__before") + own + 1).alias(name))


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 25,
    fewest_words: int = FEWEST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of each row; rows not drawn have no rank.

    Drawn are the highest scores of the rows with ``fewest_words`` at least, floor of
    ``percent`` of these, ties by the smaller key.
    """
    # the last column tells equal rows apart, so that ranges can cut a group of them
    salted = scores(docs, target, key, text, longest, buckets, seed).withColumn(
        "__salt", F.monotonically_increasing_id()
    )
    scored = stored(salted, "scores")
    eligible = F.col("n_words") >= fewest_words
    drawn = percent * scored.where(eligible).count() // 100
    columns = [key, "n_words", "n_features", "weight", "score"]
    first = [F.desc("score"), F.asc_nulls_first(key), "n_features", "weight", "__salt"]
    numbered = ranked(scored.where(eligible), first, "rank").select(
        *columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    )
    others = scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return numbered.unionByName(others)
