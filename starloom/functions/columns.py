"""Column rules used by the publish jobs.

All of them are compositions of JVM-side builtins, so they stay inside
whole-stage code generation. Money is rounded once per row to
``decimal(18,2)`` before anything is summed; dates that decide a status are
parameters, never the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
QUANTITY = "decimal(12,2)"
FRACTION = "decimal(5,4)"

# Warranty length, service hours surcharge, target days.
WARRANTY_MONTHS = 36
CRITICAL_EXTRA_HOURS = 24
HOURS_PER_DAY = 24
OPEN_ORDER_DAYS = 30


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """A money amount. Doubles go straight to two decimals, as the sources hold."""
    return _col(value).cast(MONEY)


def fraction(value: Column | str) -> Column:
    """A rate such as a discount; two exact decimals first, then the narrower type."""
    return money(value).cast(FRACTION)


# -- keys and labels ---------------------------------------------------------


def hash_bucket(value: Column | str, buckets: int, salt: int = 0) -> Column:
    """Stable cohort of a row: the same key lands in the same bucket on every run."""
    hashed = F.xxhash64(_col(value), F.lit(salt))
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def digest_bucket(value: Column | str, buckets: int, salt: str = "") -> Column:
    """A bucket that any engine with md5 can repeat: 60 bits of the digest of salt and value."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), _col(value).cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def code_lookup(code: Column | str, labels: Sequence[str]) -> Column:
    """Label of a zero-based code; an unknown code is NULL, not an error."""
    return F.get(F.array(*(F.lit(label) for label in labels)), _col(code).cast("int"))


def business_id(prefix: str, number: Column | str, width: int) -> Column:
    """Zero-padded id. ``lpad`` would cut a longer number, so that raises instead."""
    digits = _col(number).cast("string")
    too_wide = F.raise_error(F.concat(F.lit(f"{prefix} id wider than {width} digits: "), digits))
    return F.when(
        F.length(digits) > width, too_wide.cast("string")
    ).otherwise(F.concat(F.lit(prefix), F.lpad(digits, width, "0")))


def pair_key(first: Column | str, second: Column | str) -> Column:
    """Key of a row known by two keys, as text; no two pairs share one, however large they are."""
    return F.concat_ws(":", _col(first).cast("string"), _col(second).cast("string"))


def pair_id(prefix: str, key: Column | str, width: int) -> Column:
    """Business id of a pair key: the first part padded, the second as it is."""
    first, second = (F.substring_index(_col(key), ":", place) for place in (1, -1))
    return F.concat(business_id(prefix, first, width), F.lit(":"), second)


def leading_number(value: Column | str) -> Column:
    """The whole number before the first hyphen of a text such as ``10-SPARE``; NULL without one."""
    digits = F.regexp_extract(_col(value), r"^\s*([0-9]+)\s*-", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def display_name(*parts: Column | str, number: Column | str, width: int) -> Column:
    """Name made of its non-null parts and a padded number."""
    return F.concat_ws(" ", *(_col(p) for p in parts), business_id("", number, width))


def batch_id(position: Column | str, size: int) -> Column:
    """One-based batch of a zero-based position, ``size`` rows to a batch."""
    return (F.floor(_col(position) / size) + 1).cast("bigint")


def spread_id(position: Column | str, headers: int, rows: int) -> Column:
    """One-based header of a position when ``rows`` lines spread evenly over ``headers``."""
    share = F.floor((_col(position) * F.lit(headers)) / F.lit(rows))
    return (share + 1).cast("bigint")


# -- dates -------------------------------------------------------------------


def date_key(day: Column | str) -> Column:
    """``yyyyMMdd`` as an int, by arithmetic (no string formatting per row)."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def offset_date(day: Column | str, days: Column | int) -> Column:
    return F.date_add(_col(day), days)


def warranty_expiry(installed: Column | str, months: int = WARRANTY_MONTHS) -> Column:
    return F.add_months(_col(installed), months)


# -- status rules ------------------------------------------------------------


def order_status(ordered: Column | str, cancelled: Column, as_of: Column) -> Column:
    """Orders of the last 30 days are open whatever else is known of them."""
    still_open = F.datediff(as_of, _col(ordered)) < OPEN_ORDER_DAYS
    settled = F.when(cancelled, "Cancelled").otherwise("Completed")
    return F.when(still_open, "Open").otherwise(settled)


def purchase_status(
    received: Column | str, received_qty: Column | str, ordered_qty: Column | str, as_of: Column
) -> Column:
    short = _col(received_qty) < _col(ordered_qty)
    arrived = F.when(short, "Partially Received").otherwise("Received")
    return F.when(_col(received) > as_of, "Open").otherwise(arrived)


def shipment_status(hold: Column | str, delivered: Column | str, as_of: Column) -> Column:
    """A quality hold outranks the dates."""
    moving = F.when(_col(delivered) > as_of, "In Transit").otherwise("Delivered")
    return F.when(_col(hold), "Quality Hold").otherwise(moving)


def work_order_status(resolved: Column | str, waiting: Column, as_of: Column) -> Column:
    done = F.when(waiting, "Waiting for Parts").otherwise("Completed")
    return F.when(_col(resolved) > as_of, "Open").otherwise(done)


def banding(value: Column | str, bands: Sequence[tuple[object, str]], rest: str) -> Column:
    """Label of the first ``(upper bound, label)`` the value is below, else ``rest``."""
    label = F.lit(rest)
    for bound, name in reversed(bands):
        label = F.when(_col(value) < F.lit(bound), name).otherwise(label)
    return label


# -- quantities and money ----------------------------------------------------


def line_revenue(quantity: Column | str, price: Column | str, discount: Column | str) -> Column:
    """Quantity at price less discount, rounded on each line."""
    kept = (F.lit(1) - _col(discount)).cast(FRACTION)
    return (_col(quantity) * _col(price) * kept).cast(MONEY)


def extended(quantity: Column | str, unit_amount: Column | str) -> Column:
    """Quantity times a unit amount: line cost, part cost, purchased or inventory value."""
    return (_col(quantity) * _col(unit_amount)).cast(MONEY)


def unit_cost(standard_cost: Column | str, factor: Column) -> Column:
    """Standard cost scaled by a decimal factor (a double factor would round unpredictably)."""
    return (_col(standard_cost) * factor.cast(FRACTION)).cast(MONEY)


def received_quantity(ordered: Column | str, short: Column) -> Column:
    return F.greatest(F.lit(0), _col(ordered) - short).cast(QUANTITY)


def reorder_point(safety_stock: Column | str, margin: Column | int) -> Column:
    return (_col(safety_stock) + margin).cast("int")


def stockout_flag(on_hand: Column | str, safety_stock: Column | str) -> Column:
    return _col(on_hand) < _col(safety_stock)


def repair_hours(work: Column | str, priority: Column | str) -> Column:
    """One hour of handling, the work itself, and a day more when critical."""
    extra = F.when(_col(priority) == "Critical", CRITICAL_EXTRA_HOURS).otherwise(0)
    return (_col(work) + extra + 1).cast("decimal(10,2)")


def resolve_days(hours: Column | str) -> Column:
    return F.ceil(_col(hours) / HOURS_PER_DAY).cast("int")


def labor_cost(hours: Column | str, rate: Column | int) -> Column:
    return (_col(hours) * rate).cast(MONEY)


def downtime_hours(operating: Column | str) -> Column:
    return (HOURS_PER_DAY - _col(operating)).cast("decimal(5,1)")


def gross_margin(revenue: Column | str, cost: Column | str) -> Column:
    return (_col(revenue) - _col(cost)).cast(MONEY)
