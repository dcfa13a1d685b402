"""Display of results: format strings on final rows, and plain types for clients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from starloom.plans.measures import MEASURES


def formatted(value: Column, pattern: str) -> Column:
    """``$#,##0.00``, ``#,##0``, ``#,##0.0`` or ``0.00%`` applied to a number."""
    places = len(pattern.rstrip("%").partition(".")[2])
    if pattern.endswith("%"):
        digits = F.replace(F.format_number(value * 100, places), F.lit(","), F.lit(""))
        return F.concat(digits, F.lit("%"))
    digits = F.format_number(F.abs(value), places)
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$" if pattern.startswith("$") else ""), digits)


def format_metrics(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The named measure columns as text in their own formats."""
    return df.withColumns({m: formatted(F.col(m), MEASURES[m].format) for m in measures})


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and times as ISO text: equal values in any client."""
    shown = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            value = value.cast("string")
        shown.append(value.alias(field.name))
    return df.select(*shown)
