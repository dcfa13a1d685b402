"""Stored partial aggregates of facts, and the choice of the smallest that answers a question.

A node of the lattice groups one fact by some of its own key columns. It holds the sums and
counts that the measures of the fact stand on, a row for each combination of keys, and for
every distinct count the pairs of combination and counted value. Sums of sums and counts of
distinct pairs give the same results as the fact's rows at any coarser grouping, so a rollup
that needs only these keys may read the node in the fact's place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.plans.measures import MEASURES, Aggregates, Base
from starloom.sources.store import TableStore, side_by_side


def plain_name(base: Base) -> str:
    """The name of an aggregate without its home and date role."""
    return base.name.split("__", 2)[2]


def bases_of(home: str) -> dict[str, Base]:
    """Every aggregate that a measure of a home table stands on, by plain name."""
    found = Aggregates(f"{home}__active")
    for measure in MEASURES.values():
        if measure.home == home:
            measure.formula(found)
    return {plain_name(b): b for b in found.bases.values()}


@dataclass(frozen=True)
class Node:
    """Where the aggregates of one home table by some keys are stored."""

    home: str
    keys: tuple[str, ...]
    sums: str
    pairs: dict[str, str] = field(hash=False)
    #: The version of the fact that it was computed from.
    fact: str


class Lattice:
    """The nodes stored so far, for the facts as they are now."""

    def __init__(self, store: TableStore):
        self.store = store
        self.nodes: list[Node] = []

    def add(self, home: str, keys: Sequence[str], rows: DataFrame, fact: str) -> Node:
        """Group a home table by some of its columns and store the result.

        Two shuffles at most of the keys and a few numbers: sums combine before theirs, and so
        do the distinct pairs.
        """
        bases = bases_of(home)
        name = f"lattice.{home}__{'__'.join(keys)}"
        totals = [_first(b).alias(plain) for plain, b in bases.items() if b.kind != "distinct"]
        grouped = rows.groupBy(*keys)
        self.store.write(f"{name}__sums", grouped.agg(*totals) if totals else grouped.agg(F.lit(1).alias("present")))
        pairs = {}
        for plain, base in bases.items():
            if base.kind == "distinct":
                pairs[plain] = f"{name}__{plain}"
                counted = [c for c in rows.columns if plain == f"distinct_{c}"]
                self.store.write(pairs[plain], rows.select(*dict.fromkeys([*keys, *counted])).distinct())
        node = Node(home, tuple(keys), f"{name}__sums", pairs, fact)
        self.nodes = [n for n in self.nodes if n.sums != node.sums] + [node]
        return node

    def covering(self, home: str, needed: set[str], bases: Sequence[Base], fact: str) -> Node | None:
        """The smallest node of the fact's present version with all keys and aggregates; None if there is none."""
        known = [
            node
            for node in self.nodes
            if node.home == home and node.fact == fact and needed <= set(node.keys) and self._has(node, bases)
        ]
        return min(known, key=lambda node: self._bytes(node, bases), default=None)

    def _has(self, node: Node, bases: Sequence[Base]) -> bool:
        stored = set(self.store.read(node.sums).columns)
        return all(plain_name(b) in (node.pairs if b.kind == "distinct" else stored) for b in bases)

    def _bytes(self, node: Node, bases: Sequence[Base]) -> int:
        distincts = [node.pairs[plain_name(b)] for b in bases if b.kind == "distinct"]
        return sum(map(self.store.size_in_bytes, [node.sums, *distincts]))

    def sources(self, node: Node, bases: Sequence[Base]) -> list[tuple[DataFrame, list[Base]]]:
        """Stored rows, and the aggregates over them that equal ``bases`` over the fact's rows."""
        additive = [Base("sum", b.name, F.col(plain_name(b))) for b in bases if b.kind != "distinct"]
        out = [(self.store.read(node.sums), additive)] if additive else []
        for base in bases:
            if base.kind == "distinct":
                out.append((self.store.read(node.pairs[plain_name(base)]), [base]))
        return out


def _first(base: Base) -> Column:
    return F.sum(base.value) if base.kind == "sum" else F.count_if(base.value)


def build_lattice(lattice: Lattice, tables, versions, grains: dict[str, Sequence[Sequence[str]]]) -> Lattice:
    """Store a node for every home table and grain, several at a time.

    ``tables`` gives a home's rows, ``versions`` the version that they are of.
    """
    wanted = [(home, tuple(keys)) for home, all_keys in grains.items() for keys in all_keys]
    side_by_side(lambda node: lattice.add(node[0], node[1], tables(node[0]), versions(node[0])), wanted)
    return lattice
