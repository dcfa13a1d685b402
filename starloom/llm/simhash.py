"""SimHash near copies by pivot distance tables.

A fingerprint's row of the pivot table holds its Hamming distances to many fixed
reference fingerprints. By the triangle inequality two fingerprints within ``bits``
differ by at most ``bits`` in every coordinate, so a pair is discarded by its
largest coordinate difference, and only the rest are verified bit by bit.

Pairs meet in cells: the 64 bits are cut into ``bits + 2`` blocks, of which a pair
within ``bits`` agrees on two at least, so each pair of blocks is one way to meet
and no link is lost. Only distinct fingerprints enter. A cell with more than
``CELL_ROWS`` of them is cut into chunks and each pair of chunks is a task's work of
its own; what leaves a cell is a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.shared import map_texts, stored, texts_of

#: Fingerprints of one cell that a task compares with each other.
CELL_ROWS = 2048
#: Reference fingerprints of the pivot table.
PIVOTS = 32
#: Shingles whose bits are counted at a time.
BLOCK = 65_536


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text: bit set if set in over half of the XXH64 of its word shingles.

    A-Z are lowered, words are runs without ASCII white space, repeats count. Fewer
    words than a shingle are one shingle; no words give zero.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = max(1, n - shingle + 1)
    first, last = starts[:total], ends[min(n, shingle) - 1 :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, BLOCK):
        spans = zip(first[at : at + BLOCK].tolist(), last[at : at + BLOCK].tolist())
        hashes = np.array([digest(line[s:e], 42) for s, e in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_key, fp) of every row: a hash of the text, the fingerprint as a signed long.

    Null text is empty.
    """

    def per_batch(batch: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64)
        return {"doc_id": batch.column(0), "text_key": batch.column(2), "fp": prints.view(np.int64)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return map_texts(rows, per_batch, f"doc_id {kind}, text_key long, fp long")


def _references() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of local links (a, b) between 0..size-1."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    while not np.array_equal(root, root[root]):
        root = root[root]
    linked = np.flatnonzero(root != np.arange(size))
    return linked, root[linked]


def _linked_in_cell(fp: np.ndarray, table: np.ndarray, cross: np.ndarray | None, bits: int):
    """Stars over the links of one cell. ``cross``: the chunk side, if only pairs across count."""
    left = np.arange(len(fp)) if cross is None else np.flatnonzero(cross == 0)
    right = left if cross is None else np.flatnonzero(cross == 1)
    found_a, found_b = [], []
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        near = np.ones((len(rows), len(right)), dtype=bool)
        for pivot in range(0, 4):
            near &= np.abs(table[rows, pivot][:, None] - table[right, pivot][None, :]) <= bits
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        keep = i < j if cross is None else i != j
        i, j = i[keep], j[keep]
        for some in range(0, len(i), 1 << 17):
            x, y = i[some : some + (1 << 17)], j[some : some + (1 << 17)]
            ok = np.abs(table[x] - table[y]).max(1) <= bits
            x, y = x[ok], y[ok]
            ok = np.bitwise_count(fp[x] ^ fp[y]) <= bits
            found_a.append(x[ok])
            found_b.append(y[ok])
    if not found_a:
        return np.empty(0, int), np.empty(0, int)
    return _forest(np.concatenate(found_a), np.concatenate(found_b), len(fp))


def _links_of_sorted(cell, pair, side, fp, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal (cell, pair) of sorted rows."""
    n = len(fp)
    change = np.flatnonzero((cell[1:] != cell[:-1]) | (pair[1:] != pair[:-1])) + 1
    begin = np.concatenate(([0], change))
    sizes = np.diff(np.concatenate((begin, [n])))
    run = np.repeat(np.arange(len(begin)), sizes)
    alone = sizes[run] == 1
    fp, side, run, pair = fp[~alone], side[~alone], run[~alone], pair[~alone]
    if not len(fp):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    references = _references()
    table = np.stack([np.bitwise_count(fp ^ r) for r in references], axis=1).astype(np.int8)
    sizes = np.unique(run, return_counts=True)[1]
    ends = np.cumsum(sizes)
    whole = (pair >> 32) == (pair & 0xFFFFFFFF)
    small = (sizes <= 8)[np.repeat(np.arange(len(sizes)), sizes)] & whole
    a, b = [], []
    for step in range(1, 8):  # short runs together, row against the next rows
        i = np.flatnonzero(small[:-step] & (run[:-step] == run[step:])) if len(fp) > step else []
        if not len(i):
            break
        i = i[np.abs(table[i] - table[i + step]).max(1) <= bits]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= bits]
        a.append(fp[i])
        b.append(fp[i + step])
    for k in np.flatnonzero(~small[ends - sizes]):
        at = slice(ends[k] - sizes[k], ends[k])
        crossing = None if whole[at.start] else side[at]
        x, y = _linked_in_cell(fp[at], table[at], crossing, bits)
        a.append(fp[at][x])
        b.append(fp[at][y])
    return np.concatenate(a), np.concatenate(b)


def links(prints: DataFrame, bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b) over distinct fingerprints ``prints`` (fp): links that connect all within ``bits``.

    Every pair within ``bits`` is connected by the links given, directly or by others.
    """
    blocks = bits + 2
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [
        F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1)
        for low, high in zip(edges, edges[1:])
    ]
    ways = [
        F.struct(
            F.xxhash64(F.lit(k), part[i], part[j]).alias("cell"),
            F.col("fp"),
        )
        for k, (i, j) in enumerate(combinations(range(blocks), 2))
    ]
    cells = prints.select(F.inline(F.array(*ways)))
    heavy = (
        cells.groupBy("cell").count().where(F.col("count") > cell_rows)
        .select(F.col("cell").alias("heavy"), F.ceil(F.col("count") / cell_rows).alias("chunks"))
    )
    own = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks"))
    dealt = (
        cells.join(heavy, F.col("cell") == F.col("heavy"), "left")
        .withColumn("own", F.coalesce(own, F.lit(0).cast("long")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)))
        .select(
            "cell",
            (F.shiftleft(F.least("own", "other"), 32) + F.greatest("own", "other")).alias("pair"),
            (F.col("own") > F.col("other")).cast("long").alias("side"),
            "fp",
        )
        .repartition("cell", "pair")
        .sortWithinPartitions("cell", "pair")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            if not len(columns[0]):
                continue
            cell, pair = columns[:2]
            open_run = (cell == cell[-1]) & (pair == pair[-1])
            cut = len(cell) - int(open_run.sum())
            rest = [c[cut:] for c in columns]
            if cut:
                yield found([c[:cut] for c in columns])
        if rest is not None and len(rest[0]):
            yield found(rest)

    def found(columns: list[np.ndarray]) -> pa.RecordBatch:
        cell, pair, side, fp = columns
        a, b = _links_of_sorted(cell, pair, side, fp.view(np.uint64), bits)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    return dealt.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, text_key, fp, component_id): the groups of documents linked by near fingerprints.

    component_id is the smallest doc_id reachable, the own included. Null text is
    empty; texts without words have fingerprint zero and are linked like any other.
    Repeated rows give repeated results. A row without doc_id is linked, but names
    no group: a group of such rows alone has a null component_id.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "fingerprint-classes"
    )
    roots = stored(components(links(classes.select("fp"), bits)), "fingerprint-roots")
    linked = roots.join(classes, F.col("node") == F.col("fp")).select("fp", "root", "first_doc")
    least = linked.groupBy("root").agg(F.min("first_doc").alias("least_doc"))
    named = linked.join(least, "root").select(F.col("fp").alias("linked_fp"), "least_doc")
    labels = stored(
        classes.join(named, F.col("fp") == F.col("linked_fp"), "left").select(
            F.col("fp").alias("class_fp"),
            F.coalesce("least_doc", "first_doc").alias("component_id"),
        ),
        "fingerprint-labels",
    )  # stored, so that the last join is of two scans, whose hot keys Spark can split
    return prints.join(labels, F.col("fp") == F.col("class_fp")).select(
        "doc_id", "text_key", "fp", "component_id"
    )


def hex_of(fp: str) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group of near copies.

    Of repeated rows (same doc_id and text) one stays. Rows without doc_id stay if their
    group has no document with one. What goes, by far the fewer rows, is joined to the
    texts; rows that repeat take a path of their own, if there are any.
    """
    groups = near_copies(docs, shingle, bits)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    marked = stored(
        groups.groupBy(F.col("doc_id").alias("its_doc"), F.col("text_key").alias("its_key"))
        .agg(F.bool_or(stays).alias("stays"), F.count("*").alias("rows"))
        .where("NOT stays OR rows > 1"),
        "copies",
    )
    text_key = F.xxhash64(docs["text"])

    def same(marks: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(marks["its_doc"]) & (text_key == marks["its_key"])

    once = docs.join(marked, same(marked), "left_anti")
    repeating = marked.where("stays")
    if repeating.isEmpty():
        return once
    repeated = (
        docs.join(repeating, same(repeating), "left_semi")
        .withColumn("__text_key", F.xxhash64("text"))
        .dropDuplicates(["doc_id", "__text_key"])
        .drop("__text_key")
    )
    return once.union(repeated)
