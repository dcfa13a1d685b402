"""Exact token counts of whole texts by overlap resynchronisation.

A text of more than ``chunk`` characters is encoded in chunks that overlap, with
offsets, and the chunks are spliced at a stable boundary inside the overlap: a place
where white space follows a character that is not white space. The byte-level
pre-tokenizer can't look or reach across such a place from the left, and what
follows it is read from there on alone, so the whole text has a token boundary there
as well, and the counts on both sides add up. Both chunks' offsets must show the
boundary; if the overlap has no such place, the overlap is widened, in the end to
the whole rest of the text.

The library encodes about a megabyte a second, so shorter texts, most of them, are
cut at all their stable boundaries instead; the library encodes each piece (a word
with the white space before it) once, and a worker remembers its count. That is the
same splice with every boundary taken and no overlap left: both ways count the same
texts alike, whatever the chunk.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.shared import map_texts, strings_of

#: Characters encoded at once, and by which neighbouring chunks overlap at first.
CHUNK, OVERLAP = 32_768, 256
#: Pieces that a worker remembers, and their longest.
REMEMBERED, LONGEST_PIECE = 500_000, 48
STABLE = re.compile(r"(?<=\S)[ \n]")
#: White space as the pre-tokenizer's pattern has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


@lru_cache(maxsize=4)
def load(name: str):
    """The tokenizer of a file name in the public tokenizers' folder, or of a path."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    import public_tokenizers
    from tokenizers import Tokenizer

    path = name if os.sep in name else public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _starts_and_ends(tokenizer, text: str, begin: int, end: int) -> tuple[list[int], list[int]]:
    """Token starts and ends of text[begin:end], as positions in the whole text."""
    offsets = tokenizer.encode(text[begin:end], add_special_tokens=False).offsets
    return [begin + s for s, _ in offsets], [begin + e for _, e in offsets]


def _splice(text: str, low: int, high: int, left: tuple, right: tuple) -> tuple[int, int, int] | None:
    """A stable boundary in (low, high) with both token indices, if the encodings meet there."""
    (left_starts, left_ends), (right_starts, right_ends) = left, right
    middle = (low + high) // 2
    places = [m.start() for m in STABLE.finditer(text, low + 1, high)]
    for place in sorted(places, key=lambda p: abs(p - middle)):
        i, j = bisect_left(left_starts, place), bisect_left(right_starts, place)
        met = i < len(left_starts) and left_starts[i] == place
        met = met and j < len(right_starts) and right_starts[j] == place
        if met and (not i or left_ends[i - 1] == place) and (not j or right_ends[j - 1] == place):
            return place, i, j
    return None


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length; memory follows ``chunk`` unless overlaps must widen."""
    n, total = len(text), 0
    begin, end = 0, min(chunk, n)
    left = _starts_and_ends(tokenizer, text, begin, end)
    first = 0  # tokens of ``left`` before this are counted already
    while end < n:
        width, spliced = overlap, None
        while spliced is None:
            start = max(begin, end - width)
            stop = min(n, max(end + chunk - width, end + width))
            right = _starts_and_ends(tokenizer, text, start, stop)
            spliced = _splice(text, start, end, left, right)
            if spliced is not None and spliced[1] < first:
                spliced = None
            if spliced is None:
                if start == begin:  # no common boundary at all: take both as one
                    end = stop
                    left = _starts_and_ends(tokenizer, text, begin, end)
                    break
                width *= 2
        if spliced is not None:
            _, i, j = spliced
            total += i - first
            begin, end, left, first = start, stop, right, j
    return total + len(left[0]) - first


class PieceCounter:
    """Counts texts by the pieces between their stable boundaries."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        pieces = [PIECE.findall(t) for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list({p for some in pieces for p in some if p not in known})
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update(zip(new, map(len, encoded)))
        counts = [sum(map(known.__getitem__, some)) for some in pieces]
        for piece in new:
            if len(piece) > LONGEST_PIECE:
                del known[piece]
        return counts


def token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``, as the library counts them.

    ``tokenizer``: a byte-level BPE file. No begin, end or added special tokens;
    special strings inside texts are handled as the library does by default. Null
    and empty texts have 0 tokens; repeated rows and null ids give a row each.
    """
    counters: list[PieceCounter] = []

    def per_batch(batch: pa.RecordBatch) -> dict:
        if not counters:
            counters.append(PieceCounter(load(tokenizer)))
        texts = strings_of(batch)
        counts = [0] * len(texts)
        short = [k for k, t in enumerate(texts) if len(t) <= chunk]
        for at in range(0, len(short), 64):
            some = short[at : at + 64]
            for k, n in zip(some, counters[0].count([texts[k] for k in some])):
                counts[k] = n
        for k, text in enumerate(texts):
            if len(text) > chunk:
                counts[k] = count_long(counters[0].tokenizer, text, chunk, overlap)
        sizes = [len(t.encode()) for t in texts]
        return {"doc_id": batch.column(0), "n_bytes": sizes, "n_tokens": counts}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"
    return map_texts(docs.select("doc_id", "text"), per_batch, schema)
