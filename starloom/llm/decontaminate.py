"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every item is cut into windows; a window is the set of its word shingles, all of
which a document must hold in place. Shingles are ordered by rarity over all
documents. As a window asks for all of its shingles, its necessary prefix is the
rarest one: documents are joined on that alone. A match must leave room for the
window's words on both sides (length and position bounds), and its words are then
compared with the window's, exactly.

The benchmark side is broadcast in blocks of checked size, so documents are read
once for the shingle counts and once for each block, and their texts never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import stored
from starloom.llm.shingles import blocks, hash_at, positions, words

#: Words of a window, and of a shingle (shorter items: all their words).
WINDOW, SHINGLE = 13, 5
#: What a broadcast row of a window takes besides its words, about.
ROW_BYTES = 200


def windows(benchmark: DataFrame) -> DataFrame:
    """(item, words) for each distinct window of each item; ids as text, null as ''."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words("text").alias("all"),
    ).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (WINDOW - 1), F.lit(1)))
    return (
        items.select("item", "all", F.explode(starts).alias("start"))
        .select("item", F.slice("all", F.col("start"), WINDOW).alias("words"))
        .distinct()
    )


def _shingles(windows_: DataFrame, size: int) -> DataFrame:
    """Windows with each of their shingles: adds offset (0-based) and shingle."""
    starts = F.sequence(F.lit(0), F.size("words") - size)
    placed = windows_.select("*", F.explode(starts).alias("offset"))
    return placed.withColumn("shingle", hash_at("words", F.col("offset"), size))


def _rarest(docs: DataFrame, windows_: DataFrame, size: int) -> DataFrame:
    """Windows with their rarest shingle by its count over all documents, and its offset."""
    shingles = stored(_shingles(windows_, size), "window-shingles")
    distinct = stored(shingles.select(F.col("shingle").alias("known")).distinct(), "shingles")
    placed = positions(docs, size).where("shingle is not null")
    counts = [
        placed.join(block, F.col("shingle") == F.col("known")).groupBy("known").count()
        for block in blocks(distinct, F.lit(64))
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.union(more)
    ranked = shingles.join(total, F.col("shingle") == F.col("known"))
    prefix = ranked.groupBy("item", "words").agg(
        F.min(F.struct("count", "shingle", "offset")).alias("prefix"),
        F.count("*").alias("present"),
    )
    # a window of which the corpus lacks a shingle occurs nowhere
    whole = prefix.where(F.col("present") == F.size("words") - (size - 1))
    return whole.select(
        "item",
        F.col("words").alias("window"),
        F.col("prefix.shingle").alias("rarest"),
        F.col("prefix.offset").alias("offset"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_key, n_words, n_hit, items (sorted array of ids as text).

    A document word inside any occurrence of an item's window is hit. ``text_key`` is
    a hash of the text; rows that repeat both doc_id and text give one row. Null and
    empty texts have no words; null ids are kept, and a null item_id is ''. An empty
    benchmark hits nothing.
    """
    parts = stored(windows(benchmark), "windows")
    named = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), words("text").alias("doc_words")
    )
    sizes = [
        r[0] for r in parts.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()
    ]
    found = named.select(
        "doc_id",
        "text_key",
        F.size("doc_words").alias("n_words"),
        F.lit(None).cast("struct<start: int, size: int>").alias("hit"),
        F.lit(None).cast("string").alias("item"),
    )
    parts_found = []
    for size in sorted(sizes, reverse=True):
        of_size = parts.where(F.least(F.size("words"), F.lit(SHINGLE)) == size)
        prefixes = stored(_rarest(named, of_size, size), "prefixes")
        row_bytes = F.lit(ROW_BYTES) + F.length(F.concat_ws(" ", "window")) * 4
        for block in blocks(prefixes, row_bytes):
            first = not parts_found
            start = F.col("at") - F.col("offset")
            room = (start >= 0) & (start + F.size("window") <= F.size("doc_words"))
            same = F.slice("doc_words", start + 1, F.size("window")) == F.col("window")
            joined = positions(named, size).join(
                block, F.col("shingle") == F.col("rarest"), "left" if first else "inner"
            )
            hit = F.when(room, same) & F.col("window").isNotNull()
            checked = joined.withColumn("occurs", F.coalesce(hit, F.lit(False)))
            kept = F.col("occurs") | (F.col("at") == 0) if first else F.col("occurs")
            parts_found.append(
                checked.where(kept).select(
                    "doc_id",
                    "text_key",
                    F.when(F.col("at") == 0, F.size("doc_words")).alias("n_words"),
                    F.when(F.col("occurs"), F.struct(start.alias("start"), F.size("window").alias("size"))).alias("hit"),
                    F.when(F.col("occurs"), F.col("item")).alias("item"),
                )
            )
    for some in parts_found[1:]:
        parts_found[0] = parts_found[0].union(some)
    rows = parts_found[0] if parts_found else found
    places = F.flatten(
        F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))
    )
    return (
        rows.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.collect_set("hit").alias("hits"),
            F.collect_set("item").alias("items"),
        )
        .select(
            "doc_id",
            "text_key",
            F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
            F.when(F.size("hits") == 0, F.lit(0))
            .otherwise(F.size(F.array_distinct(places)))
            .cast("long")
            .alias("n_hit"),
            F.array_sort("items").alias("items"),
        )
    )


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """A twentieth of the words or more is hit, and at least one."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = stored(
        contamination(docs, benchmark)
        .where(is_contaminated())
        .select(F.col("doc_id").alias("bad_doc"), F.col("text_key").alias("bad_text")),
        "contaminated",
    )
    same = docs["doc_id"].eqNullSafe(bad["bad_doc"]) & (F.xxhash64(docs["text"]) == bad["bad_text"])
    return docs.join(bad, same, "left_anti")
