"""Numbers: clamps, money, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.schemas import AS_WRITTEN, MONEY, RATIO_OPERAND


def as_money(value: Column) -> Column:
    return value.cast(MONEY)


def exact_money(value: Column) -> Column:
    """An amount as it is written; more than four decimals fail the query instead of being rounded."""
    written = value.cast(AS_WRITTEN)
    money = written.cast(MONEY)
    refused = F.raise_error(F.concat(F.lit("an amount has more than four decimals: "), written.cast("string")))
    return F.when(money != written, refused).otherwise(money)


def at_least(value: Column, floor: int) -> Column:
    """The value or the floor, whichever is larger; NULL counts as the floor."""
    return F.greatest(value, F.lit(floor).cast("int"))


def not_below_zero(value: Column) -> Column:
    return F.greatest(as_money(value), as_money(F.lit(0)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` in exact decimals, rounded half away from zero; NULL where the whole is 0."""
    divisor = F.nullif(whole.cast(RATIO_OPERAND), F.lit(0).cast(RATIO_OPERAND))
    return F.round(part.cast(RATIO_OPERAND) / divisor * F.lit(100), digits)


def percent_or_zero(part: Column, whole: Column, digits: int) -> Column:
    """The same for figures on display, which show 0 for a whole that is not positive."""
    return F.when(whole > 0, percent(part, whole, digits)).otherwise(F.lit(0))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    """Rows that meet the condition; NULL conditions do not count, no rows give 0."""
    return F.count(F.when(condition, F.lit(1)))


def decimals_to_double(frame: DataFrame) -> DataFrame:
    """Plain floating point for consumers outside the engine, as the very last step."""
    return frame.select(
        *[
            F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )
