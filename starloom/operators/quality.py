"""Integrity checks over published tables, as DataFrames of results.

Every check yields a row: table, check, PASS or FAIL, failed rows, details.
Counts are true counts, and keys are pre-aggregated before any shuffle. A grouping each checks all
references by number, by text and to the calendar, without a join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from starloom.operators import bloom
from starloom.operators.conform import duplicate_keys
from starloom.sources.store import TableStore, literal_rows, moment, side_by_side

Tables = Callable[[str], DataFrame]

# Which keys and relationships are checked.
DIMENSION_KEYS = {
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_facility": "facility_key",
    "dim_employee": "employee_key",
    "dim_technician": "technician_key",
    "dim_supplier": "supplier_key",
    "dim_sales_channel": "sales_channel_key",
    "dim_asset": "asset_key",
}
FACT_GRAINS = {
    "fact_sales_order": "sales_order_id",
    "fact_sales_order_line": "sales_order_line_id",
    "fact_purchase_order_line": "purchase_order_line_id",
    "fact_shipment": "shipment_id",
    "fact_inventory_snapshot": "inventory_snapshot_id",
    "fact_work_order": "work_order_id",
    "fact_work_order_part": "work_order_part_id",
    "fact_asset_daily_status": "asset_daily_status_id",
    "bridge_supplier_product": "supplier_product_id",
}
FOREIGN_KEYS = {
    "dim_employee": {"facility_key": "dim_facility"},
    "dim_technician": {"employee_key": "dim_employee", "facility_key": "dim_facility"},
    "dim_asset": {
        "customer_key": "dim_customer",
        "product_key": "dim_product",
        "facility_key": "dim_facility",
    },
    "fact_sales_order": {
        "customer_key": "dim_customer", "sales_channel_key": "dim_sales_channel",
    },
    "fact_sales_order_line": {
        "sales_order_key": "fact_sales_order", "product_key": "dim_product",
    },
    "bridge_supplier_product": {"supplier_key": "dim_supplier", "product_key": "dim_product"},
    "fact_purchase_order_line": {
        "supplier_key": "dim_supplier",
        "product_key": "dim_product",
        "facility_key": "dim_facility",
    },
    "fact_shipment": {"sales_order_key": "fact_sales_order", "facility_key": "dim_facility"},
    "fact_inventory_snapshot": {"product_key": "dim_product", "facility_key": "dim_facility"},
    "fact_work_order": {"asset_key": "dim_asset", "technician_key": "dim_technician"},
    "fact_work_order_part": {"work_order_key": "fact_work_order", "product_key": "dim_product"},
    "fact_asset_daily_status": {"asset_key": "dim_asset"},
}
DATE_KEYS = {
    "fact_sales_order": ["order_date_key", "requested_date_key"],
    "fact_sales_order_line": ["order_date_key", "requested_date_key"],
    "fact_purchase_order_line": ["order_date_key", "expected_date_key", "received_date_key"],
    "fact_shipment": [
        "ship_date_key",
        "promised_delivery_date_key",
        "actual_delivery_date_key",
        "order_date_key",
        "requested_date_key",
    ],
    "fact_inventory_snapshot": ["snapshot_date_key"],
    "fact_work_order": ["opened_date_key", "resolved_date_key"],
    "fact_work_order_part": ["opened_date_key", "resolved_date_key"],
    "fact_asset_daily_status": ["status_date_key"],
}
TOLERANCE = "0.005"


class QualityError(ValueError):
    """Published tables failed integrity checks."""


def result(table: str, name: str, failed: Column, details: Column) -> list[Column]:
    failed = F.coalesce(failed, F.lit(0)).cast("bigint")
    return [
        F.lit(f"gold.{table}").alias("table_name"),
        F.lit(name).alias("validation_name"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        failed.alias("failed_row_count"),
        details.alias("details"),
    ]


def describe(**counts: Column) -> Column:
    """``a=1, b=2`` from named counts."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("0")))
        for name, value in counts.items()
    ]
    return F.concat_ws(", ", *parts)


def _stack(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


# -- one pass over a table ---------------------------------------------------


class RowCheck(NamedTuple):
    """A result that one pass over a table gives, from the counts of the pass."""

    table: str
    name: str
    bad: Mapping[str, Column]
    failed: Column
    details: Column


def _passes(tables: Tables, keys: Mapping[str, str], checks: Sequence[RowCheck]) -> DataFrame:
    """Results of all checks, each table read once, and the key of a keyed one once by itself.

    Missing keys and bad rows are summed as they are read; see ``_repeated`` for repeated keys.
    """
    names, results = list(dict.fromkeys(c.table for c in checks)), []
    keyed = [table for table in names if table in keys]
    repeated = dict(zip(keyed, side_by_side(lambda table: _repeated(tables(table), keys[table]), keyed)))
    for table in names:
        own = [c for c in checks if c.table == table]
        bad = {name: F.count_if(value).alias(name) for c in own for name, value in c.bad.items()}
        df = tables(table)
        if table in keys:
            key = F.col(keys[table])
            counts = df.agg(F.count_if(key.isNull()).alias("null_keys"), *bad.values())
            counts = counts.withColumn("duplicates", F.lit(repeated[table]))
        else:
            counts = df.agg(*bad.values())
        shown = F.array(
            *(
                F.struct(*result(table, c.name, c.failed, c.details))
                for c in own
            )
        )
        results.append(counts.select(F.inline(shown)))
    return _stack(results)


# -- keys --------------------------------------------------------------------


def _repeated(df: DataFrame, key: str) -> int:
    """How many values of a key, null among them, more than one row holds: exact, by hashes first.

    A key whose 64-bit hash no other row has is held once, so numbers are grouped instead of text. Only if a hash
    is held twice, rows with such hashes, or their Bloom filter's if these are many, are grouped by the key itself.
    """
    keys = df.select(F.col(key).alias("key"))
    if not isinstance(keys.schema["key"].dataType, StringType):
        return duplicate_keys(keys, ["key"]).count()
    suspects = duplicate_keys(keys.select(F.xxhash64("key").alias("hashed")), ["hashed"]).select("hashed")
    count = suspects.count()
    if not count:
        return 0
    words = bloom.filter_words(suspects, "hashed", bits := bloom.bits_for(count)).scalar()
    doubtful = keys.where(bloom.may_hold(words, F.xxhash64("key"), bits))
    return duplicate_keys(doubtful, ["key"]).count()


def _dim_key_checks(keys: Mapping[str, str]) -> list[RowCheck]:
    duplicates, nulls = F.col("duplicates"), F.col("null_keys")
    shown = describe(duplicates=duplicates, null_keys=nulls)
    return [RowCheck(t, f"unique_nonnull_{k}", {}, duplicates + nulls, shown) for t, k in keys.items()]


def _grain_checks(grains: Mapping[str, str]) -> list[RowCheck]:
    duplicates = F.col("duplicates")
    shown = describe(repeated_ids=duplicates)
    return [RowCheck(t, f"grain_unique_{k}", {}, duplicates, shown) for t, k in grains.items()]


def check_unique(df: DataFrame, key: str, table: str) -> DataFrame:
    """Whether ``key`` has one row per value."""
    duplicates = F.col("duplicates")
    check = RowCheck(table, f"unique_{key}", {}, duplicates, describe(duplicates=duplicates))
    return _passes(lambda _: df, {table: key}, [check])


def check_dim_keys(tables: Tables, keys: Mapping[str, str] = DIMENSION_KEYS) -> DataFrame:
    """Dimension keys are unique and never NULL."""
    return _passes(tables, keys, _dim_key_checks(keys))


def check_fact_grain(tables: Tables, grains: Mapping[str, str] = FACT_GRAINS) -> DataFrame:
    """Facts have one row per business id."""
    return _passes(tables, grains, _grain_checks(grains))


# -- references --------------------------------------------------------------


class Reference(NamedTuple):
    """A column whose non-null values must be keys of a parent."""

    child: str
    column: str
    parent: str
    parent_key: str
    name: str
    problem: str


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def check_references(
    spark: SparkSession, tables: Tables, references: Sequence[Reference]
) -> DataFrame:
    """Rows per reference whose key the parent lacks, without a join.

    Numbers, text and days are a grouping each: numbers are not carried as text, and the many
    references to the calendar, whose keys are few, leave the rows of all other keys narrow.
    """
    opened = {name: tables(name) for name in dict.fromkeys(n for r in references for n in (r.child, r.parent))}
    groups: dict[tuple[bool, bool], list[Reference]] = {}
    for r in references:
        groups.setdefault((_is_text(opened[r.child], r.column), r.parent == "dim_date"), []).append(r)
    missing = [_grouped(opened, own, text) for (text, _), own in groups.items()]
    numbers = literal_rows(
        spark, ("name", "child", "problem"), [(_name(r), r.child, r.problem) for r in references]
    )
    failed = F.coalesce("missing", F.lit(0)).cast("bigint")
    return numbers.join(F.broadcast(_stack(missing)), "name", "left").select(
        F.concat(F.lit("gold."), F.col("child")).alias("table_name"),
        F.element_at(F.split("name", "/"), -1).alias("validation_name"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        failed.alias("failed_row_count"),
        F.concat(F.col("problem"), F.lit(": "), failed.cast("string")).alias("details"),
    )


def _name(r: Reference) -> str:
    return f"{r.child}/{r.name}"


def _by_child(references: Sequence[Reference]) -> dict[str, list[Reference]]:
    return {child: [r for r in references if r.child == child] for child in dict.fromkeys(r.child for r in references)}


def _counted(counts: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(name, missing) rows of one row of counts, by column."""
    shown = (F.struct(F.lit(name).alias("name"), F.col(column).alias("missing")) for column, name in names.items())
    return counts.select(F.inline(F.array(*shown)))


def _grouped(opened: Mapping[str, DataFrame], references: Sequence[Reference], text: bool) -> DataFrame:
    """(name, missing) of references whose keys are all numbers, or all text, in one grouping.

    Each child is scanned once: its key columns become rows (parent, key) with a
    count in the column of their check, and are summed before the shuffle. Keys of
    parents join the same rows, so one shuffle by (parent, key) brings together what
    a join for each child would, and a hot key is one row from each partition.
    """
    kind = "string" if text else "bigint"
    numbers = {p: n for n, p in enumerate(sorted({(r.parent, r.parent_key) for r in references}))}
    slots: dict[Reference, tuple[int, int]] = {}
    for r in references:
        parent_no = numbers[(r.parent, r.parent_key)]
        slots[r] = (parent_no, sum(n == parent_no for n, _ in slots.values()))
    rows = []
    for child, own in _by_child(references).items():
        keys = [
            F.struct(
                F.lit(slots[r][0]).alias("parent_no"), F.col(r.column).cast(kind).alias("key"), F.lit(slots[r][1]).alias("slot")
            )
            for r in own
        ]
        rows.append(opened[child].select(F.inline(F.array(*keys))).where("key IS NOT NULL").withColumn("known", F.lit(False)))
    for (parent, key), parent_no in numbers.items():
        if _is_text(opened[parent], key) is text:
            known = (F.lit(parent_no).alias("parent_no"), F.col(key).cast(kind).alias("key"))
            rows.append(opened[parent].select(*known, F.lit(-1).alias("slot"), F.lit(True).alias("known")))
    width = 1 + max(slot for _, slot in slots.values())
    held = [F.count_if(F.col("slot") == slot).alias(f"held_{slot}") for slot in range(width)]
    orphans = _stack(rows).groupBy("parent_no", "key").agg(F.bool_or("known").alias("known"), *held).where("NOT known")
    sums = {f"missing_{k}": F.when(F.col("parent_no") == slots[r][0], F.col(f"held_{slots[r][1]}")) for k, r in enumerate(references)}
    counts = orphans.agg(*(F.sum(value).alias(name) for name, value in sums.items()))
    return _counted(counts, {f"missing_{k}": _name(r) for k, r in enumerate(references)})


def foreign_key_references(
    wanted: Mapping[str, Mapping[str, str]] = FOREIGN_KEYS,
) -> list[Reference]:
    parent_keys = {**DIMENSION_KEYS, "fact_sales_order": "sales_order_key", "fact_work_order": "work_order_key"}
    return [
        Reference(
            child, column, parent, parent_keys[parent],
            f"fk_{column}_to_gold.{parent}.{parent_keys[parent]}",
            f"rows whose {column} no {parent} has",
        )
        for child, columns in wanted.items()
        for column, parent in columns.items()
    ]


def date_references(wanted: Mapping[str, Sequence[str]] = DATE_KEYS) -> list[Reference]:
    return [
        Reference(
            child, column, "dim_date", "date_key", f"datekey_{column}_in_dim_date",
            f"rows whose {column} is no day of the calendar",
        )
        for child, columns in wanted.items()
        for column in columns
    ]


def check_foreign_keys(
    spark: SparkSession,
    tables: Tables,
    wanted: Mapping[str, Mapping[str, str]] = FOREIGN_KEYS,
) -> DataFrame:
    """Every non-null foreign key exists in its parent."""
    return check_references(spark, tables, foreign_key_references(wanted))


def check_date_keys(
    spark: SparkSession, tables: Tables, wanted: Mapping[str, Sequence[str]] = DATE_KEYS
) -> DataFrame:
    """Every non-null date key of a fact exists in the calendar."""
    return check_references(spark, tables, date_references(wanted))


# -- values ------------------------------------------------------------------


def amount_check(df: DataFrame, table: str, amount: str, quantity: str, unit: str) -> RowCheck:
    """A stored amount is decimal and equals quantity times unit; a NULL on any side fails."""
    is_decimal = isinstance(df.schema[amount].dataType, DecimalType)
    off = F.abs(F.col(amount) - F.col(quantity) * F.col(unit)) > F.lit(TOLERANCE).cast("decimal(4,3)")
    found = F.col(f"off_{amount}")
    return RowCheck(
        table,
        f"{amount}_correctness",
        {f"off_{amount}": F.coalesce(off, F.lit(True))},
        F.greatest(found, F.lit(0 if is_decimal else 1)),
        describe(decimal_type=F.lit(is_decimal), mismatched_rows=found),
    )


def _purchased(tables: Tables) -> RowCheck:
    table = "fact_purchase_order_line"
    return amount_check(tables(table), table, "purchased_value", "ordered_quantity", "unit_cost")


def _inventory(tables: Tables) -> RowCheck:
    table = "fact_inventory_snapshot"
    return amount_check(tables(table), table, "inventory_value", "quantity_on_hand", "standard_cost")


def _positive() -> RowCheck:
    bad, found = (F.col("line_revenue") <= 0) | (F.col("quantity") <= 0), F.col("nonpositive")
    return RowCheck(
        "fact_sales_order_line", "positive_quantity_and_revenue", {"nonpositive": bad}, found,
        describe(rows_with_nonpositive_quantity_or_revenue=found),
    )


def _nonnegative() -> RowCheck:
    counted = ("quantity_on_hand", "quantity_allocated", "safety_stock_quantity")
    bad, found = reduce(Column.__or__, (F.col(name) < 0 for name in counted)), F.col("negative")
    return RowCheck(
        "fact_inventory_snapshot", "nonnegative_inventory_quantities", {"negative": bad}, found,
        describe(rows_with_negative_inventory_fields=found),
    )


def check_amount(df: DataFrame, table: str, amount: str, quantity: str, unit: str) -> DataFrame:
    return _passes(lambda _: df, {}, [amount_check(df, table, amount, quantity, unit)])


def check_purchased_value(tables: Tables) -> DataFrame:
    return _passes(tables, {}, [_purchased(tables)])


def check_inventory_value(tables: Tables) -> DataFrame:
    return _passes(tables, {}, [_inventory(tables)])


def check_positive_sales(tables: Tables) -> DataFrame:
    return _passes(tables, {}, [_positive()])


def check_nonneg_inventory(tables: Tables) -> DataFrame:
    return _passes(tables, {}, [_nonnegative()])


# -- the suite ---------------------------------------------------------------


def validation_summary(spark: SparkSession, tables: Tables) -> DataFrame:
    """All 63 results. A table is read once for its keys and values, and once for its references."""
    values = [_purchased(tables), _inventory(tables), _positive(), _nonnegative()]
    checks = [*_dim_key_checks(DIMENSION_KEYS), *_grain_checks(FACT_GRAINS), *values]
    return _stack(
        [
            _passes(tables, {**DIMENSION_KEYS, **FACT_GRAINS}, checks),
            check_references(spark, tables, [*foreign_key_references(), *date_references()]),
        ]
    )


def run_gate(spark: SparkSession, tables: Tables, store: TableStore) -> DataFrame:
    """Store the results, then raise if any check failed, so the evidence is kept."""
    stored = store.write("gold.validation_summary", validation_summary(spark, tables))
    failed = stored.where("status = 'FAIL'").count()
    if failed:
        raise QualityError(f"{failed} integrity checks failed; see gold.validation_summary")
    return stored.orderBy("table_name", "validation_name")


def load_audit(
    tables: Tables, names: Sequence[str], run_id: str, profile: str, loaded_at: datetime
) -> DataFrame:
    """Rows per published table, with the run that published them."""
    counts = _stack(
        [
            tables(name).agg(F.lit(f"gold.{name}").alias("table_name"), F.count("*").alias("row_count"))
            for name in names
        ]
    )
    return counts.select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(profile).alias("scale_profile"),
        "table_name",
        "row_count",
        moment(loaded_at).alias("load_timestamp"),
        F.lit("Succeeded").alias("status"),
    )
