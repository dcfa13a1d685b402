"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes marks chunk boundaries: at block size 2^k, where its
last k bits are ones. A chunk gives one of 64 letters by its content, a text the
letters of its chunks at a block size that fits its length, and at twice that size.
A chunk that finds no boundary for four block sizes ends there, so texts that repeat
one line have letters as well. An edit changes the letters of its own chunks only. Two fingerprints are compared at
block sizes that both have, by the edit distance of their letters.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starloom.llm.shared import stored

#: Bytes of the rolling hash, most letters of a signature, longest chunk in block sizes.
ROLLING, MOST, LONGEST = 7, 64, 4
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Bytes that are rolled, and pairs of signatures that are compared, at a time.
BLOCK, PAIRS = 1 << 20, 8_192


class Print(NamedTuple):
    """Block size as a power of two, and the letters at it and at the next one."""

    power: int
    fine: str
    coarse: str

    def __str__(self) -> str:
        return f"{1 << self.power}:{self.fine}:{self.coarse}"


def _ones(data: bytes) -> np.ndarray:
    """For each byte, with how many ones the rolling hash that ends there ends."""
    found = np.empty(len(data), np.uint8)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(data), BLOCK):
        begin = max(0, at - ROLLING + 1)
        part = whole[begin : at + BLOCK].astype(np.uint32) + np.uint32(1)
        value = np.zeros(len(part), np.uint32)
        for back in range(min(ROLLING, len(part))):
            factor = np.uint32(pow(0x01000193, back + 1, 1 << 32))
            value[back:] += part[: len(part) - back] * factor
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(13)
        lowest_zero = ~value & (value + np.uint32(1))
        ones = np.bitwise_count(lowest_zero - np.uint32(1)).astype(np.uint8)
        found[at : at + BLOCK] = ones[at - begin :]
    return found


def _ends(ones: np.ndarray, power: int) -> list[int]:
    """Where the first ``MOST`` chunks end (exclusive), the last at the end of the text."""
    longest, out, begin = LONGEST << power, [], 0
    for end in np.flatnonzero(ones >= power)[:MOST] + 1:
        forced = range(begin + longest, int(end), longest)
        out.extend(forced[:MOST])
        out.append(int(end))
        begin = int(end)
    if begin < len(ones):
        out.extend(range(begin + longest, len(ones), longest)[:MOST])
    out = out[: MOST - 1]
    return out if out and out[-1] == len(ones) else [*out, len(ones)]


def _letters(data: bytes, ends: list[int]) -> str:
    """A letter for each chunk; the last of ``MOST`` letters covers all that is left."""
    begin, out = 0, []
    for end in ends:
        out.append(LETTERS[zlib.crc32(data[begin:end]) >> 7 & 63])
        begin = end
    return "".join(out)


def fingerprint(text: str) -> Print:
    """The print of a whole text; equal texts have equal prints. Empty: no letters."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return Print(0, "", "")
    ones = _ones(data)
    power = max(0, (len(data) - 1).bit_length() - 6)
    fine, coarse = (_letters(data, _ends(ones, k)) for k in (power, power + 1))
    return Print(power, fine, coarse)


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distances of pairs of signatures, bit-parallel, all pairs side by side."""
    code = {c: k for k, c in enumerate(LETTERS)}
    n = len(left)
    long_left = np.array([len(s) for s in left], np.int64)
    long_right = np.array([len(s) for s in right], np.int64)
    places = np.zeros((n, len(LETTERS)), np.uint64)
    for row, s in enumerate(left):
        for bit, c in enumerate(s):
            places[row, code[c]] |= np.uint64(1 << bit)
    codes = np.zeros((n, MOST), np.int64)
    for row, s in enumerate(right):
        codes[row, : len(s)] = [code[c] for c in s]
    one, zero = np.uint64(1), np.uint64(0)
    top = one << (np.maximum(long_left, 1) - 1).astype(np.uint64)
    up, down = np.full(n, ~zero), np.zeros(n, np.uint64)
    score = long_left.copy()
    rows = np.arange(n)
    for j in range(int(long_right.max(initial=0))):
        here = j < long_right
        same = places[rows, codes[:, j]]
        vertical = same | down
        level = (((same & up) + up) ^ up) | same
        more, less = down | ~(level | up), up & level
        score += here * (((more & top) != 0).astype(np.int64) - ((less & top) != 0))
        more, less = (more << one) | one, less << one
        up, down = less | ~(vertical | more), more & vertical
    return np.where(long_left == 0, long_right, score)


def likenesses(pairs: list[tuple[Print, Print]]) -> list[float]:
    """How like the prints of each pair are, 0 to 1.

    Equal prints: 1. Otherwise 1 less the edit distance by the longer length, the best
    of the block sizes that both have; 0 if there is none, or if one text is empty.
    """
    left, right, owner = [], [], []
    out = [float(a == b) for a, b in pairs]
    for k, (a, b) in enumerate(pairs):
        if a == b or not a.fine or not b.fine:
            continue
        of_a = {a.power: a.fine, a.power + 1: a.coarse}
        of_b = {b.power: b.fine, b.power + 1: b.coarse}
        for power in of_a.keys() & of_b.keys():
            left.append(of_a[power])
            right.append(of_b[power])
            owner.append(k)
    for at in range(0, len(left), PAIRS):
        some_left, some_right = left[at : at + PAIRS], right[at : at + PAIRS]
        distances = edit_distances(some_left, some_right).tolist()
        for k, x, y, d in zip(owner[at : at + PAIRS], some_left, some_right, distances):
            out[k] = max(out[k], 1 - d / max(len(x), len(y)))
    return out


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by as much of the start of ``after``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


ROW = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], after: list[str]) -> dict:
    """Result columns for texts and the texts that follow them."""
    prints = {t: fingerprint(t) for t in {*texts, *after}}
    own, follow = [prints[t] for t in texts], [prints[t] for t in after]
    changed = [edited(t, a) for t, a in zip(texts, after)]
    of_changed = [fingerprint(t) for t in changed]
    near = likenesses([*zip(own, of_changed), *zip(own, follow)])
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [
            hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed
        ],
        "fingerprint": [str(p) for p in own],
        "edited_fingerprint": [str(p) for p in of_changed],
        "near_edited": near[: len(texts)],
        "near_next": near[len(texts) :],
    }


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: its print, and that of its edited text.

    Documents are ranged by doc_id (nulls first; rows with one id by a hash of the text,
    then the text), the last is followed by the first. Null texts are empty. A partition
    compares its own neighbours; its first and last document are written with their
    texts, two for each partition, and paired across partitions by number.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {ROW}, part int, role string, text string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def batch_of(columns: dict, **more) -> pa.RecordBatch:
        n = len(columns["doc_id"])
        full = {f.name: columns.get(f.name, [more.get(f.name)] * n) for f in arrow}
        return pa.RecordBatch.from_arrays([pa.array(full[f.name], f.type) for f in arrow], schema=arrow)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if not ids:
                continue
            if last is None:
                yield batch_of({"doc_id": ids[:1], "text": texts[:1]}, part=part, role="head")
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            for at in range(0, len(ids) - 1, 500):
                stop = min(at + 500, len(ids) - 1)
                found = _compared(ids[at:stop], texts[at:stop], texts[at + 1 : stop + 1])
                yield batch_of(found, part=part, role="row")
            last = ids[-1], texts[-1]
        if last is not None:
            yield batch_of({"doc_id": [last[0]], "text": [last[1]]}, part=part, role="tail")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, after = (c.to_pylist() for c in batch.columns)
            if ids:
                yield batch_of(_compared(ids, texts, after), role="row")

    ranged = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    found = stored(ranged.mapInArrow(neighbours, schema), "neighbours")
    names = ["doc_id", *(f.name for f in StructType.fromDDL(ROW))]
    spark = docs.sparkSession
    parts = sorted(r.part for r in found.where("role = 'head'").select("part").collect())
    following = spark.createDataFrame(
        list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next_part int"
    )
    heads = found.where("role = 'head'").select(
        F.col("part").alias("next_part"), F.col("text").alias("after")
    )
    tails = found.where("role = 'tail'").select("doc_id", "part", "text")
    joined = tails.join(following, "part").join(heads, "next_part").select("doc_id", "text", "after")
    across = joined.mapInArrow(pairs, schema)
    return found.where("role = 'row'").select(*names).union(across.select(*names))
