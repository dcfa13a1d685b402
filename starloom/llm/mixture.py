"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the mixture by the share
it has. A document's number of copies inverts the Poisson distribution with that mean at
a number that a hash of seed and doc_id gives, so a run with the same seed repeats it
wherever rows lie. Copies are rows of their own, and all rows are shuffled by a hash
of seed, doc_id and copy.

A rate above ``MOST_RATE`` is cut into equal parts, each drawn by a hash of its own: the sum
of independent Poisson numbers is one of the whole rate. So the table of chances that is
broadcast has a few hundred numbers a source, whatever the rate, and exact tails.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sources that may be listed; the listed ones, and no more, are broadcast.
MOST_SOURCES = 100_000
#: Beyond this chance a copy more is not counted on: the hash has 52 bits.
TAIL = 2.0**-53
HASH_BITS = 52
#: Rates above this are drawn in parts.
MOST_RATE = 256.0
#: Copies, and rows without an id that are alike, are made so many at a time.
CHUNK = 4096


def _listed(sources) -> list[str]:
    names = sorted(str(s) for s in sources)
    if not names:
        raise ValueError("no target weights")
    if len(names) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources are listed")
    return names


def distribution(rate: float) -> list[float]:
    """Chances that a Poisson number with this mean is at most 0, 1, 2 ..., to the tail."""
    if rate <= 0:
        return [1.0]
    out, total, k = [], 0.0, 0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out.append(min(total, 1.0))
        if k > rate and (1 - total < TAIL or out[-1] == out[-2]):
            return out
        k += 1


def parts_of(rate: float) -> int:
    """How many equal parts a rate is drawn in."""
    return max(1, math.ceil(rate / MOST_RATE))


def rates(sizes: Mapping[str | None, int], weights: Mapping[str, float], other: float, epochs: float) -> dict:
    """Mean repetitions by source (None: all that are not listed together).

    Only sources that have documents share the mixture, in proportion to their weights;
    the mixture is ``epochs`` times as large as the input.
    """
    wanted = {s: float(other if s is None else weights[s]) for s in sizes}
    if any(w < 0 for w in wanted.values()):
        raise ValueError("a weight is negative")
    total_weight, total = sum(wanted.values()), sum(sizes.values())
    if not total_weight:
        return dict.fromkeys(sizes, 0.0)
    return {s: wanted[s] / total_weight * total * epochs / sizes[s] for s in sizes}


def _hash(*parts: Column) -> Column:
    """A number below 2^52 from the md5 of the parts."""
    digest = F.md5(F.concat_ws("/", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def size_of(text: str = "text") -> Column:
    """What a document weighs: its characters, and one for its end."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long") + 1


def _exploded(df: DataFrame, count: str, name: str) -> DataFrame:
    """A row for each number from 1 to ``count``, at most ``CHUNK`` of them in memory at a time."""
    last = F.expr(f"({count} - 1) div {CHUNK}")
    chunks = df.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("__chunk") * CHUNK + 1
    up_to = F.least(F.col(count).cast("long"), first + (CHUNK - 1))
    numbers = F.sequence(first.cast("int"), up_to.cast("int"))
    return chunks.withColumn(name, F.explode(numbers)).drop("__chunk")


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__name``, that numbers are drawn by: the id, or text and number of a row without.

    Rows without an id that are alike in all columns are counted before they are numbered, and
    numbered in chunks that go to tasks of their own, so a hot group is neither one draw nor one task.
    """
    by_text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    with_id = docs.where("doc_id IS NOT NULL").withColumn("__name", F.col("doc_id").cast("string"))
    alike = docs.where("doc_id IS NULL").groupBy(*docs.columns).agg(F.count("*").alias("__alike"))
    last = F.expr(f"(__alike - 1) div {CHUNK}")
    dealt = alike.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = dealt.repartition(F.xxhash64("text", "__chunk")).withColumn(
        "__alike", F.least(F.lit(CHUNK).cast("long"), F.col("__alike") - F.col("__chunk") * CHUNK)
    )
    numbered = _exploded(dealt.withColumnRenamed("__chunk", "__own_chunk"), "__alike", "__number")
    number = F.col("__own_chunk") * CHUNK + F.col("__number")
    without_id = numbered.withColumn("__name", F.concat_ws("/", by_text, number.cast("string")))
    return with_id.unionByName(without_id.select(*docs.columns, "__name"))


def _copies(seed: int) -> Column:
    """Copies of a row: a draw from ``__chances`` for each of its ``__parts``."""

    def draw(*parts: Column) -> Column:
        u = _hash(F.lit(str(seed)), F.col("__name"), *parts) / float(1 << HASH_BITS)
        return F.size(F.filter("__chances", lambda c: c <= u))

    others = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts") - 1),
        F.lit(0),
        lambda total, part: total + draw(F.lit("part"), part.cast("string")),
    )
    return F.when(F.col("__parts") == 1, draw()).otherwise(draw() + others)


def replicated(
    docs: DataFrame,
    weights: Mapping[str, float],
    other: float = 0.0,
    epochs: float = 1.0,
    seed: int = 1,
) -> DataFrame:
    """``docs`` with ``copies`` and ``copy`` (1 to copies), a row for each copy, shuffled.

    ``weights``: target weight of each listed source, by characters; ``other``: of all
    other sources, null included, together. A document whose number is 0 has no row.
    Rows that repeat a doc_id get the same number. A row without doc_id takes a hash of its
    text and its number among the rows that are alike, so each of them draws for itself.
    Columns named copies or copy in ``docs`` give way to these.
    """
    names = _listed(weights)
    docs = docs.drop("copies", "copy")
    spark = docs.sparkSession
    known = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "__source string, __pool int")

    def pooled(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(known), rows["source"] == known["__source"], "left").withColumn(
            "__pool", F.coalesce("__pool", F.lit(-1))
        )

    sums = pooled(docs).groupBy(F.col("__pool").alias("pool")).agg(F.sum(size_of()).alias("size")).collect()
    sizes = {None if r.pool < 0 else names[r.pool]: r.size for r in sums}
    found = rates(sizes, weights, other, epochs)
    place_of = {name: k for k, name in enumerate(names)}
    chances = spark.createDataFrame(
        [
            (-1 if s is None else place_of[s], parts_of(rate), distribution(rate / parts_of(rate)))
            for s, rate in found.items()
        ],
        "__chance_pool int, __parts int, __chances array<double>",
    )
    numbered = (
        pooled(_named(docs))
        .join(F.broadcast(chances), F.col("__pool") == F.col("__chance_pool"))
        .withColumn("copies", _copies(seed))
        .where("copies > 0")
        .select(*docs.columns, "copies", "__name")
    )
    place = _hash(F.lit(str(seed)), F.col("__name"), F.col("copy").cast("string"))
    return (
        _exploded(numbered, "copies", "copy")
        .withColumn("__place", place)
        .repartition("__place")
        .sortWithinPartitions("__place")
        .drop("__place", "__name")
    )
