"""Metric rollup: measures of a model by any of its dimension attributes.

A query names measures, attributes (``"table.column"``) and filters. Measures
that share a home table and date role are computed in one scan; results of
several facts or roles meet on the attribute values (drill-across), never by
joining facts. Rows without a dimension match stay under a NULL member.

Join order follows sizes that are checked, not assumed. Dimensions, the calendar among
them, whose stored size is within ``broadcast_bytes`` are broadcast to the fact. For
larger ones the fact is first cut, at the scan, to the keys that their filters may keep
(a Bloom filter of bounded size), then aggregated by the remaining foreign keys, so a hot key travels as one row per partition and the
join works on partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import bloom
from starloom.operators import time_intelligence as periods
from starloom.operators.lattice import Lattice
from starloom.plans.measures import MEASURES, Aggregates, Base, Measure
from starloom.plans.models import MODEL_TABLES, Relationship, UnrelatedError, path_to

BROADCAST_BYTES = 8 * 1024 * 1024
#: Calendar members that a value which they don't filter is repeated over, at most.
MOST_REPEATED = 200_000

Filters = Mapping[str, object]

#: Calendar columns from the longest period to the shortest, and the label of counted values.
_CHRONOLOGICAL = (periods.YEAR, periods.QUARTER, periods.MONTH, periods.DAY)
_KEY = "__counted_value"


@dataclass(frozen=True)
class Attribute:
    """A column to group by or filter on, and its name in the result."""

    table: str
    column: str
    label: str

    @property
    def inner(self) -> str:
        return f"{self.table}__{self.column}"


def attributes(names: Sequence[str]) -> list[Attribute]:
    """Result columns carry the plain column name, with the table's where two would clash."""
    split = [name.split(".") for name in names]
    plain = [column for _, column in split]
    return [
        Attribute(t, column, column if plain.count(column) == 1 else f"{t}_{column}")
        for t, column in split
    ]


def condition(column: Column, wanted: object) -> Column:
    """A filter value is one value, a list of values, or a function of the column."""
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, (list, tuple, set)):
        return column.isin(*wanted)
    return column == wanted


def keeps_blank(parent: DataFrame, limits: Sequence[tuple[str, object]]) -> Column:
    """Whether filters keep the blank member, rows whose key has no match: a constant that the
    optimizer folds, as the filters are asked of typed NULLs."""
    blanks = [condition(F.lit(None).cast(parent.schema[column].dataType), value) for column, value in limits]
    return reduce(Column.__and__, blanks)


def first_stage(base: Base) -> Column:
    if base.kind == "sum":
        return F.sum(base.value).alias(base.name)
    if base.kind == "count":
        return F.count_if(base.value).alias(base.name)
    return F.count_distinct(base.value).alias(base.name)


def second_stage(base: Base) -> Column:
    """The same aggregate over rows already aggregated by finer keys."""
    if base.kind == "distinct":
        return F.count_distinct(F.col(distinct_key(base))).alias(base.name)
    return F.sum(base.name).alias(base.name)


def distinct_key(base: Base) -> str:
    return f"{base.name}__key"


class MetricModel:
    """One model over published tables. ``sizes`` tells a gold table's bytes on storage.

    With a ``lattice`` of stored aggregates, a pass over a fact reads the smallest of them that
    has all it needs, if it is of the fact's version (``versions``), and the fact otherwise.
    """

    def __init__(
        self,
        name: str,
        tables: Callable[[str], DataFrame],
        sizes: Callable[[str], int],
        broadcast_bytes: int = BROADCAST_BYTES,
        lattice: Lattice | None = None,
        versions: Callable[[str], str] | None = None,
    ):
        self.name = name
        self.tables = tables
        self.sizes = sizes
        self.broadcast_bytes = broadcast_bytes
        self.lattice = lattice
        self.versions = versions

    def table(self, name: str) -> DataFrame:
        return self.tables(MODEL_TABLES[self.name][name])

    # -- queries -------------------------------------------------------------

    def rollup(
        self,
        measures: Sequence[str | Measure],
        by: Sequence[str],
        filters: Filters | None = None,
        date_role: str | None = None,
        unrelated: str = "repeat",
    ) -> DataFrame:
        """Measures by attributes.

        ``date_role`` swaps the date key for measures without one of their own.
        An attribute that no relationship reaches does not filter a measure: its
        value repeats over the members (``unrelated="repeat"``) or the query is
        refused (``"error"``), whether it is grouped by or filtered on. Rows without a
        match are the blank member, which a filter keeps if it holds for NULL.
        """
        asked = [m if isinstance(m, Measure) else MEASURES[m] for m in measures]
        axis = attributes(by)
        self._check(asked, date_role, [*by, *(filters or {})])
        used, formulas = self._formulas(asked, date_role)
        frames = []
        for (home, role, shift), own in used.items():
            bases = list(own.bases.values())
            frame = self._frame(home, role, shift, bases, axis, filters or {}, unrelated)
            frames.append(frame.withColumnsRenamed({b.name: b.name + own.suffix for b in bases}))
        labels = [a.label for a in axis]
        return self._side_by_side(frames, labels).select(*labels, *formulas)

    def _formulas(
        self, asked: Sequence[Measure], date_role: str | None
    ) -> tuple[dict[tuple[str, str | None, str | None], Aggregates], list[Column]]:
        """The aggregates of each pass, and the measures as formulas over them, as asked."""
        used: dict[tuple[str, str | None, str | None], Aggregates] = {}
        formulas = []
        for m in asked:
            role = m.date_role or date_role
            own = used.setdefault(
                (m.home, role, m.shift),
                Aggregates(f"{m.home}__{role or 'active'}", f"__{m.shift or 'now'}"),
            )
            formulas.append(m.formula(own).alias(m.name))
        return used, formulas

    def subtotals(
        self,
        measures: Sequence[str | Measure],
        hierarchy: Sequence[str],
        by: Sequence[str] = (),
        filters: Filters | None = None,
        date_role: str | None = None,
    ) -> DataFrame:
        """Measures at every level of a hierarchy, each level computed from its own rows.

        ``level`` counts the hierarchy columns in force; 0 is the total. ``date_role``
        swaps the date key as in ``rollup``. A year to date at a level is the running sum
        at the end of its period, and a prior year that of its period a year before; both
        are blank where no year is in force.
        """
        asked = [m if isinstance(m, Measure) else MEASURES[m] for m in measures]
        axis = attributes([*by, *hierarchy])
        self._check(asked, date_role, [*by, *hierarchy, *(filters or {})])
        fixed, steps = len(by), len(hierarchy)
        used, formulas = self._formulas(asked, date_role)
        frames = []
        for (home, role, shift), own in used.items():
            self._require_related(home, role, axis)
            bases = list(own.bases.values())
            if shift:
                frame = self._shifted_levels(home, role, shift, bases, axis, filters or {}, fixed)
            else:
                frame = self._aggregate(home, role, bases, axis, filters or {}, levels=(fixed, steps))
            frames.append(frame.withColumnsRenamed({b.name: b.name + own.suffix for b in bases}))
        labels = [*(a.label for a in axis), "level"]
        return self._side_by_side(frames, labels).select(*labels, *formulas)

    def _shifted_levels(
        self,
        home: str,
        role: str | None,
        shift: str,
        bases: Sequence[Base],
        axis: Sequence[Attribute],
        filters: Filters,
        fixed: int,
    ) -> DataFrame:
        """A shifted frame for each level at which a year is in force, stacked."""
        found = []
        for depth in range(len(axis) - fixed + 1):
            upper = axis[: fixed + depth]
            if any(a.table == "date" and a.column in (periods.YEAR, periods.DAY) for a in upper):
                frame = self._shifted(home, role, shift, bases, upper, filters)
                lower = {
                    a.label: F.lit(None).cast(self.table(a.table).schema[a.column].dataType)
                    for a in axis[fixed + depth :]
                }
                found.append(frame.withColumns({**lower, "level": F.lit(depth)}))
        if not found:
            raise ValueError("a shifted measure needs the calendar year or the date")
        return reduce(DataFrame.unionByName, found)

    def _check(self, asked: Sequence[Measure], date_role: str | None, names: Sequence[str]) -> None:
        """Refuse tables, measures and date roles that the model does not have."""
        known = MODEL_TABLES[self.name]
        for table in [m.home for m in asked] + [name.split(".")[0] for name in names]:
            if table not in known:
                raise ValueError(f"model {self.name} has no table {table}")
        for m in asked:
            role = m.date_role or date_role
            if role and path_to(self.name, m.home, "date", role) is None:
                raise ValueError(f"{m.home} has no relationship to the calendar by {role}")

    def _require_related(self, home: str, role: str | None, axis: Sequence[Attribute]) -> None:
        apart = {a.table for a in axis if path_to(self.name, home, a.table, role) is None}
        if apart:
            raise UnrelatedError(f"{home} is not related to {', '.join(sorted(apart))}")

    @staticmethod
    def _side_by_side(frames: Sequence[DataFrame], labels: Sequence[str]) -> DataFrame:
        """Frames merged on their labels. Grouping puts NULL members together, as a
        null-safe full outer join would, in one shuffle for any number of frames."""
        if len(frames) == 1:
            return frames[0]
        stacked = reduce(lambda l, r: l.unionByName(r, allowMissingColumns=True), frames)
        values = [name for name in stacked.columns if name not in labels]
        return stacked.groupBy(*labels).agg(*(F.max(v).alias(v) for v in values))

    # -- one pass over a home table ------------------------------------------

    def _frame(
        self,
        home: str,
        role: str | None,
        shift: str | None,
        bases: Sequence[Base],
        axis: Sequence[Attribute],
        filters: Filters,
        unrelated: str,
    ) -> DataFrame:
        if unrelated == "error" or shift:
            self._require_related(home, role, axis)
        if unrelated == "error":
            self._require_related(home, role, attributes(list(filters)))
        related = [a for a in axis if path_to(self.name, home, a.table, role) is not None]
        apart = [a for a in axis if a not in related]
        if shift:
            return self._shifted(home, role, shift, bases, related, filters)
        frame = self._aggregate(home, role, bases, related, filters)
        return self._repeat(frame, bases, related, apart, filters, home) if apart else frame

    def _aggregate(
        self,
        home: str,
        role: str | None,
        bases: Sequence[Base],
        axis: Sequence[Attribute],
        filters: Filters,
        levels: tuple[int, int] | None = None,
    ) -> DataFrame:
        """Bases of one home table by related attributes, optionally with subtotals."""
        wanted: dict[str, set[str]] = {}
        edges: list[Relationship] = []
        limits: dict[str, list[tuple[str, object]]] = {}
        for a in axis:
            wanted.setdefault(a.table, set()).add(a.column)
        for name, value in filters.items():
            table, column = name.split(".")
            if path_to(self.name, home, table, role) is not None:
                limits.setdefault(table, []).append((column, value))
        for table in [*wanted, *limits]:
            for edge in path_to(self.name, home, table, role) or []:
                if edge not in edges:
                    edges.append(edge)
        own = {e.child_key for e in edges if e.child == home} | {a.column for a in axis if a.table == home}
        own |= {column for column, _ in limits.get(home, [])}
        frames = [
            self._aggregate_rows(rows, home, some, axis, levels, wanted, edges, dict(limits))
            for rows, some in self._sources(home, own, bases)
        ]
        labels = [a.label for a in axis] + (["level"] if levels else [])
        return self._side_by_side(frames, labels)

    def _sources(self, home: str, own: set[str], bases: Sequence[Base]) -> list[tuple[DataFrame, Sequence[Base]]]:
        """What to read for aggregates of a home table by some of its columns: stored aggregates or its rows."""
        if self.lattice is not None:
            fact = MODEL_TABLES[self.name][home]
            node = self.lattice.covering(home, own, bases, self.versions(fact))
            if node is not None:
                return self.lattice.sources(node, bases)
        return [(self.table(home), bases)]

    def _aggregate_rows(
        self,
        rows: DataFrame,
        home: str,
        bases: Sequence[Base],
        axis: Sequence[Attribute],
        levels: tuple[int, int] | None,
        wanted: Mapping[str, set[str]],
        edges: Sequence[Relationship],
        limits: dict[str, list[tuple[str, object]]],
    ) -> DataFrame:
        """Bases over rows that have the home's columns, by related attributes."""
        near = [e for e in edges if self._is_small(e.parent, edges)]
        far = [e for e in edges if e not in near]

        at_home = [condition(F.col(column), value) for column, value in limits.pop(home, [])]
        rows = reduce(DataFrame.where, at_home, rows)
        for edge in edges:
            if edge.child == home and edge.parent == "date":
                rows = self._within_days(rows, edge, limits.get("date", []))
        for a in axis:
            if a.table == home:
                rows = rows.withColumn(a.inner, F.col(a.column))
        for edge in near:
            rows = self._join(rows, home, edge, edges, wanted, limits, small=True)

        for edge in far:
            rows = self._reached(rows, home, edge, limits.get(edge.parent, []))
        if far or levels:
            joined = {e.parent for e in near} | {home}
            keys = {a.inner: F.col(a.inner) for a in axis if a.table in joined}
            for e in far:
                key = self._key_column(home, e)
                if e.child in joined:
                    keys[key] = F.col(key)
            distincts = [b for b in bases if b.kind == "distinct"]
            keys |= {distinct_key(b): b.value for b in distincts}
            partial = [first_stage(b) for b in bases if b.kind != "distinct"]
            grouped = rows.groupBy(*(value.alias(name) for name, value in keys.items()))
            rows = grouped.agg(*partial) if partial else grouped.agg(F.lit(1).alias("present"))
            for edge in far:
                rows = self._join(rows, home, edge, edges, wanted, limits, small=False)
            finish = [second_stage(b) for b in bases]
        else:
            finish = [first_stage(b) for b in bases]

        names = [F.col(a.inner).alias(a.label) for a in axis]
        if not levels:
            return rows.groupBy(*names).agg(*finish)
        fixed, steps = levels
        inner = [a.inner for a in axis]
        sets = [[F.col(n) for n in inner[: fixed + depth]] for depth in range(steps + 1)]
        level = (F.lit(steps) - F.bit_count(F.grouping_id())).cast("int").alias("level")
        rolled = rows.groupingSets(sets, *(F.col(n) for n in inner)).agg(*finish, level)
        return rolled.withColumnsRenamed({a.inner: a.label for a in axis})

    @staticmethod
    def _key_column(home: str, edge: Relationship) -> str:
        return edge.child_key if edge.child == home else f"{edge.child}__{edge.child_key}"

    def _is_small(self, table: str, edges: Sequence[Relationship]) -> bool:
        """Within the broadcast limit, as is every table it is reached through."""
        if self.sizes(MODEL_TABLES[self.name][table]) > self.broadcast_bytes:
            return False
        through = [e.child for e in edges if e.parent == table]
        reached = {e.parent for e in edges}
        return all(child not in reached or self._is_small(child, edges) for child in through)

    def _join(
        self,
        rows: DataFrame,
        home: str,
        edge: Relationship,
        edges: Sequence[Relationship],
        wanted: Mapping[str, set[str]],
        limits: Mapping[str, list[tuple[str, object]]],
        small: bool,
    ) -> DataFrame:
        """Attach one parent's wanted columns; filters on the parent see the blank member too.

        The planner makes a filter that refuses NULL an inner join and moves it to the scan.
        """
        onward = {e.child_key for e in edges if e.child == edge.parent}
        filtered = limits.get(edge.parent, [])
        columns = sorted(wanted.get(edge.parent, set()) | onward | {column for column, _ in filtered})
        key = f"{edge.parent}__joined_on"
        parent = self.table(edge.parent).select(
            F.col(edge.parent_key).alias(key),
            *(F.col(name).alias(f"{edge.parent}__{name}") for name in columns),
        )
        match = F.col(self._key_column(home, edge)) == F.col(key)
        joined = rows.join(F.broadcast(parent) if small else parent, match, "left").drop(key)
        kept = [condition(F.col(f"{edge.parent}__{column}"), value) for column, value in filtered]
        return reduce(DataFrame.where, kept, joined)

    def _reached(
        self,
        rows: DataFrame,
        home: str,
        edge: Relationship,
        limits: Sequence[tuple[str, object]],
    ) -> DataFrame:
        """Rows whose key may be among those that a far parent's filters keep.

        The join after the grouping is exact and drops the others; dropped at the scan, they
        are neither grouped nor shuffled. Kept keys are counted, and a Bloom filter of a size
        to suit is broadcast; beyond what the largest one takes, a semi join does it. Rows
        that meet no parent pass if the filters keep the blank member.
        """
        if edge.child != home or not limits:
            return rows
        parent = self.table(edge.parent)
        kept = reduce(DataFrame.where, [condition(F.col(c), v) for c, v in limits], parent)
        kept = kept.select(F.col(edge.parent_key).alias("kept_key"))
        blank, keys = keeps_blank(parent, limits), kept.count()
        if keys <= bloom.MOST_KEYS:
            bits = bloom.bits_for(keys)
            words = bloom.filter_words(kept, "kept_key", bits).scalar()
            return rows.where(bloom.may_hold(words, F.col(edge.child_key), bits) | blank)
        if parent.sparkSession.range(0, 1, 1, 1).where(blank).isEmpty():
            return rows.join(kept, F.col(edge.child_key) == F.col("kept_key"), "left_semi")
        return rows

    def _within_days(
        self, rows: DataFrame, edge: Relationship, limits: Sequence[tuple[str, object]]
    ) -> DataFrame:
        """Rows whose date key is between the first and last day that the calendar filter keeps.

        The join drops the others anyway, unless every filter keeps the blank member.
        As a range on the fact's own column the filter reaches the scan, which skips
        files written by date.
        """
        if not limits:
            return rows
        calendar = self.table("date")
        days = reduce(DataFrame.where, [condition(F.col(c), v) for c, v in limits], calendar)
        first = days.agg(F.min(edge.parent_key)).scalar()
        last = days.agg(F.max(edge.parent_key)).scalar()
        return rows.where(F.col(edge.child_key).between(first, last) | keeps_blank(calendar, limits))

    # -- attributes out of reach ---------------------------------------------

    def _members(self, apart: Sequence[Attribute], filters: Filters) -> DataFrame:
        """Distinct members of attributes of one table, under the filters on that table."""
        (table,) = {a.table for a in apart}
        rows = self.table(table)
        for name, value in filters.items():
            filtered, column = name.split(".")
            if filtered == table:
                rows = rows.where(condition(F.col(column), value))
        return rows.select(*(F.col(a.column).alias(a.label) for a in apart)).distinct()

    def _repeat(
        self,
        frame: DataFrame,
        bases: Sequence[Base],
        related: Sequence[Attribute],
        apart: Sequence[Attribute],
        filters: Filters,
        home: str,
    ) -> DataFrame:
        """The frame's values repeated over members that do not filter them.

        A grand total is attached to each member as a scalar. Beside other groups only the
        calendar repeats: totals and members stay apart to the end and meet by a broadcast of
        the members, which are counted first and refused beyond ``MOST_REPEATED``.
        """
        values = [b.name for b in bases]
        calendar = [a for a in apart if a.table == "date"]
        others = [a for a in apart if a.table != "date"]
        if others:
            if related or len({a.table for a in others}) > 1:
                raise UnrelatedError(
                    f"{home} is not related to {others[0].table}: ask for it without other groups"
                )
            totals = {name: frame.select(name).scalar() for name in values}
            frame = self._members(others, filters).withColumns(totals)
        if calendar:
            members = self._members(calendar, filters)
            if members.limit(MOST_REPEATED + 1).count() > MOST_REPEATED:
                raise UnrelatedError(f"{home} would be repeated over more than {MOST_REPEATED} calendar members")
            # one for every row, but no constant to the planner, which would cross the two sides
            every = F.pmod(F.xxhash64(*members.columns), F.lit(1))
            repeated = members.withColumn("__beside", every)
            groups = [a.label for a in related] or values
            frame = frame.withColumn("__beside", F.pmod(F.xxhash64(*groups), F.lit(1)))
            frame = frame.join(F.broadcast(repeated), "__beside").drop("__beside")
        return frame

    # -- shifted periods -----------------------------------------------------

    def _shifted(
        self,
        home: str,
        role: str | None,
        shift: str,
        bases: Sequence[Base],
        axis: Sequence[Attribute],
        filters: Filters,
    ) -> DataFrame:
        """Bases of the year to date or of the same period a year before.

        The shift replaces the date filter by another period, so filters on the
        calendar choose among the shifted periods. Columns they name are grouped by
        along and collapsed again: prior periods add up, a year to date is that of the
        last period chosen. The name of a month follows its number. Distinct counts don't
        add up; they are counted from their keys, see ``_first_seen`` and ``_keyed``.
        """
        on_date = {n.split(".")[1]: v for n, v in filters.items() if n.startswith("date.")}
        others = {n: v for n, v in filters.items() if not n.startswith("date.")}
        asked = {a.column: a.label for a in axis if a.table == "date"}
        rest = [a.label for a in axis if a.table != "date"]
        names = [b.name for b in bases]
        distincts = [b for b in bases if b.kind == "distinct"]
        additive = [b for b in bases if b.kind != "distinct"]
        grain = [c for c in dict.fromkeys([*asked, *on_date]) if c != periods.MONTH_NAME]
        if periods.MONTH_NAME in [*asked, *on_date] and periods.MONTH not in grain:
            grain.append(periods.MONTH)
        if shift == "ly" and not grain:
            grain.append(periods.YEAR)
        dated = [Attribute("date", c, c) for c in grain]
        around = [*dated, *(a for a in axis if a.table != "date")]
        whole = set(grain) <= set(asked) or (
            periods.MONTH_NAME in asked and set(grain) - {periods.MONTH} <= set(asked)
        )

        def chosen(frame: DataFrame) -> DataFrame:
            if periods.MONTH in grain:
                frame = frame.withColumn(periods.MONTH_NAME, periods.month_name(periods.MONTH))
            return reduce(DataFrame.where, [condition(F.col(c), v) for c, v in on_date.items()], frame)

        labels = [*(F.col(c).alias(label) for c, label in asked.items()), *(F.col(r) for r in rest)]
        if shift == "ytd":
            frames = [self._aggregate(home, role, additive, around, others)] if additive else []
            frames += [self._first_seen(home, role, b, around, grain, rest, others) for b in distincts]
            frame = chosen(periods.year_to_date(self._side_by_side(frames, [*grain, *rest]), grain, rest, names))
            if whole:
                return frame.select(*labels, *names)
            last = F.struct(*(c for c in _CHRONOLOGICAL if c in grain))
            return frame.groupBy(*labels).agg(*(F.max_by(n, last).alias(n) for n in names))

        def year_before(frame: DataFrame) -> DataFrame:
            return chosen(periods.same_period_last_year(frame, grain, self.table("date")))

        if whole:
            frame = self._aggregate(home, role, bases, around, others)
            return year_before(frame).select(*labels, *names)
        frames = []
        if additive:
            moved = year_before(self._aggregate(home, role, additive, around, others))
            frames.append(moved.groupBy(*labels).agg(*(F.sum(b.name).alias(b.name) for b in additive)))
        for base in distincts:
            moved = year_before(self._keyed(home, role, base, around, others))
            counted = F.count_distinct(F.struct(_KEY)).alias(base.name)
            frames.append(moved.groupBy(*labels).agg(counted))
        return self._side_by_side(frames, [*asked.values(), *rest])

    def _keyed(
        self, home: str, role: str | None, base: Base, around: Sequence[Attribute], filters: Filters
    ) -> DataFrame:
        """The distinct values that a base counts, by attributes; a value is a row for each member."""
        column = base.name.rpartition("__distinct_")[2]
        present = Base("count", f"{home}__{role or 'active'}__count_rows", F.lit(True))
        keyed = self._aggregate(home, role, [present], [*around, Attribute(home, column, _KEY)], filters)
        return keyed.drop(present.name)

    def _first_seen(
        self,
        home: str,
        role: str | None,
        base: Base,
        around: Sequence[Attribute],
        grain: Sequence[str],
        rest: Sequence[str],
        filters: Filters,
    ) -> DataFrame:
        """How many of the values that a base counts are met for the first time in their year, by period.

        These add up: the distinct count of a year to date is the sum of first meetings so far.
        """
        keyed = self._keyed(home, role, base, around, filters)
        keyed = keyed.where(F.col(periods.finest(grain)).isNotNull())
        year = F.col(periods.YEAR) if periods.YEAR in grain else F.year(periods.DAY)
        when = F.struct(*(c for c in _CHRONOLOGICAL if c in grain))
        first = keyed.groupBy(year.alias("__year"), *rest, _KEY).agg(F.min(when).alias("__first"))
        return first.groupBy("__first", *rest).agg(F.count("*").alias(base.name)).select("__first.*", *rest, base.name)
