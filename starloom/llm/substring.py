"""Removal of repeated passages, found by difference-cover anchors.

A cover of the residues modulo ``PERIOD`` holds, for every difference, two residues
with that difference. Short windows (anchors) are hashed only where a word's position
modulo the period is in the cover. Wherever two documents share a passage of ``window``
words, there is an offset below the period at which both have an anchor of
``window - PERIOD + 1`` words inside the passage, and the two anchors are equal. So
every shared passage has a shared anchor, and a fifth of the positions is hashed.

Windows around anchors that are shared by documents are then extended to the full
length, hashed with 128 bits, and compared: the smallest doc_id that has a window is
pre-aggregated, and joined back to the documents that have it too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import drop_stored, map_texts, stored_alone, texts_of

#: A perfect difference set, every difference modulo 31 exactly once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
WINDOW = 50
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of each run of ``size`` values, built from runs of doubled sizes."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    run, length, done, done_length = hashes, 1, None, 0
    mask = (1 << 64) - 1
    while True:
        if size & length:
            if done is None:
                done = run
            else:  # the longer run stands before what is done
                count = min(len(run), len(done) - length)
                power = np.uint64(pow(base, done_length, 1 << 64) & mask)
                done = run[:count] * power + done[length : length + count]
            done_length += length
        if 2 * length > size:
            break
        power = np.uint64(pow(base, length, 1 << 64) & mask)
        run = run[:-length] * power + run[length:]
        length *= 2
    found = done ^ (done >> np.uint64(29))
    return (found * np.uint64(0xBF58476D1CE4E5B9)) ^ (found >> np.uint64(32))


def anchors_of(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the cover where an anchor fits, and the anchors' hashes."""
    size = window - PERIOD + 1
    found = rolling(hashes, size, _BASES[0])
    places = np.arange(len(found))
    places = places[np.isin(places % PERIOD, COVER)]
    return places, found[places]


def windows_around(hashes: np.ndarray, shared: np.ndarray, window: int) -> np.ndarray:
    """Which windows hold an anchor whose hash is in ``shared``."""
    count = max(0, len(hashes) - window + 1)
    places, found = anchors_of(hashes, window)
    places = places[np.isin(found, shared)]
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, np.clip(places - (PERIOD - 1), 0, count), 1)
    np.add.at(steps, np.clip(places + 1, 0, count), -1)
    return np.cumsum(steps[:-1]) > 0


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(anchor, doc_id, part): the distinct anchors of each row of ``docs`` (doc_id, part, text)."""

    def per_batch(batch: pa.RecordBatch) -> dict:
        hashes = [np.unique(anchors_of(word_hashes(t.split()), window)[1]) for t in texts_of(batch)]
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        return {
            "anchor": _signed(np.concatenate(hashes)),
            "doc_id": batch.column(0).take(pa.array(owner)),
            "part": batch.column(1).take(pa.array(owner)),
        }

    return map_texts(docs, per_batch, f"anchor long, doc_id {_kind(docs)}, part int")


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _candidate_windows(docs: DataFrame, window: int) -> DataFrame:
    """(high, low, doc_id, part) of the distinct windows around shared anchors of each row."""

    def per_batch(batch: pa.RecordBatch) -> dict:
        high, low = [], []
        lists = batch.column(3).to_pylist()
        for text, shared in zip(texts_of(batch), lists):
            hashes = word_hashes(text.split())
            wanted = windows_around(hashes, np.array(shared or [], np.int64).view(np.uint64), window)
            a, first = np.unique(rolling(hashes, window, _BASES[0])[wanted], return_index=True)
            high.append(a)
            low.append(rolling(hashes, window, _BASES[1])[wanted][first])
        owner = np.repeat(np.arange(len(high)), [len(h) for h in high])
        return {
            "high": _signed(np.concatenate(high)),
            "low": _signed(np.concatenate(low)),
            "doc_id": batch.column(0).take(pa.array(owner)),
            "part": batch.column(1).take(pa.array(owner)),
        }

    return map_texts(docs, per_batch, f"high long, low long, doc_id {_kind(docs)}, part int")


def _later_than_first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key also stands in a document with a smaller id, plus that id as ``first``."""
    shared = stored_alone(
        rows.groupBy(*keys)
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select(*keys, "first"),
        "shared",
    )
    return rows.join(shared, keys)


def _part() -> Column:
    """A number of the text: lists are kept by id and text, so that an id on many rows has many short ones.

    Two texts of an id with one number share a list, which changes nothing: whether a window
    also stands in a document with a smaller id is the same for both.
    """
    return F.pmod(F.xxhash64("text"), F.lit((1 << 31) - 1)).cast("int")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(repeating, repeating_part, windows, copies): what of a text also starts under a smaller id.

    ``windows``: hashes of such windows. ``copies``: md5 of the text if it is a whole text of
    a document with a smaller id; its windows are not listed, as all of them repeat. Texts
    with neither have no row.
    """
    named = docs.where("doc_id is not null and text is not null").select("doc_id", _part().alias("part"), "text")
    texts = named.select("doc_id", "part", F.md5(F.col("text").cast("binary")).alias("copy"))
    copies = stored_alone(
        _later_than_first(texts, ["copy"]).where("doc_id > first").select("doc_id", "part", "copy").distinct(), "copies"
    )
    all_anchors = stored_alone(anchors(named, window), "anchors")
    shared = _later_than_first(all_anchors, ["anchor"])
    marks = shared.select("doc_id", "part", "anchor", F.lit(None).cast("string").alias("copy")).union(
        copies.select("doc_id", "part", F.lit(None).cast("long").alias("anchor"), "copy")
    )
    by_text = stored_alone(
        marks.groupBy(F.col("doc_id").alias("marked"), F.col("part").alias("marked_part")).agg(
            F.collect_set("anchor").alias("shared"), F.collect_set("copy").alias("copies")
        ),
        "marks",
    )
    drop_stored(all_anchors)
    own = named.join(by_text, (F.col("doc_id") == F.col("marked")) & (F.col("part") == F.col("marked_part")))
    own = own.where(~F.array_contains("copies", F.md5(F.col("text").cast("binary"))))
    windows = stored_alone(_candidate_windows(own.select("doc_id", "part", "text", "shared"), window), "windows")
    drop_stored(by_text)
    repeated = _later_than_first(windows, ["high", "low"]).where("doc_id > first")
    rows = repeated.select("doc_id", "part", "high", F.lit(None).cast("string").alias("copy")).union(
        copies.select("doc_id", "part", F.lit(None).cast("long").alias("high"), "copy")
    )
    out = stored_alone(
        rows.groupBy(F.col("doc_id").alias("repeating"), F.col("part").alias("repeating_part")).agg(
            F.collect_set("high").alias("windows"), F.collect_set("copy").alias("copies")
        ),
        "repeats",
    )
    drop_stored(windows)
    return out


def kept_words(text: bytes, repeated: np.ndarray | None, whole: bool, window: int) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were. ``whole``: the text is a copy of another."""
    words = text.split()
    if whole and len(words) >= window:
        return [], len(words)
    if repeated is None or not len(repeated) or len(words) < window:
        return words, len(words)
    marked = np.isin(rolling(word_hashes(words), window, _BASES[0]), repeated)
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(marked)
    steps[starts] += 1
    steps[starts + window] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], len(words)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each row of ``docs`` without repeated words.

    A word goes if a run of ``window`` words that covers it also starts in a document
    with a smaller doc_id, judged on the texts as they came. ``kept``: the other words,
    joined by a blank. Null and empty texts have no words; rows without doc_id, and rows
    that share a doc_id, take nothing from each other; texts shorter than ``window``
    words stay whole.
    """
    found = repeats(docs, window)
    plain = docs.select("doc_id", "text").join(
        found, (F.col("doc_id") == F.col("repeating")) & (_part() == F.col("repeating_part")), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            lists, copies = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for text, some, whole in zip(texts_of(batch), lists, copies):
                repeated = None if some is None else np.array(some, np.int64).view(np.uint64)
                copy = bool(whole) and hashlib.md5(text).hexdigest() in whole
                stay, n = kept_words(text, repeated, copy, window)
                sizes.append(n)
                removed.append(n - len(stay))
                kept.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    schema = f"doc_id {_kind(docs)}, n_words long, n_removed long, kept string"
    return plain.select("doc_id", "text", "windows", "copies").mapInArrow(run, schema)
