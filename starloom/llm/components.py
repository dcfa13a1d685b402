"""Connected components of a link table, as alternating joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import drop_stored, stored


def _mark(links: DataFrame) -> tuple:
    """Count and order-free hash of a link table."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _to_least(links: DataFrame, larger_only: bool) -> DataFrame:
    """One star step, stored. ``links`` holds (a, b) with a > b.

    Large step: every larger neighbour of a node is linked with the least of the
    node and its neighbours. Small step: a node and its smaller neighbours are
    linked with the least of these. The least is pre-aggregated and stored, and the
    join back is of two scans, so adaptive execution can split the rows of a hub.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if larger_only:
        both = both.union(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = stored(
        both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least")), "least"
    )
    if larger_only:
        joined = both.where("other > node").join(least, "node")
        pairs = joined.select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        ends = F.explode(F.array("other", "node")).alias("a")
        pairs = both.join(least, "node").select(ends, F.col("least").alias("b"))
    step = stored(pairs.where("a > b").distinct(), "links")
    drop_stored(least)
    return step


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: any comparable type); root is the least node.

    Alternates large and small star steps until nothing changes, a number of rounds
    that grows with the logarithm of the number of nodes. Each round is written to
    the shared folder, so lost executors repeat one step at most. Self links,
    repeated and reversed links and nulls are allowed; no links give no rows.
    """
    ordered = (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct()
    )
    now = stored(ordered, "links")
    mark = _mark(now)
    while mark[0]:
        half = _to_least(now, True)
        step = _to_least(half, False)
        before, mark = mark, _mark(step)
        drop_stored(now)
        drop_stored(half)
        now = step
        if mark == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
