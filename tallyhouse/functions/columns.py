"""Small column builders. Everything here is a built-in Spark expression, nothing leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PERCENT = "decimal(5,2)"
#: Averages of averages are summed in this type: an exact sum does not depend on row order.
FINE = "decimal(18,6)"


def _steps(tests: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    first, *rest = list(tests)
    chain = reduce(lambda acc, t: acc.when(t[0], F.lit(t[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(otherwise))


def below(value: Column, steps: Iterable[tuple[object, object]], otherwise: object) -> Column:
    """Label of the first bound that ``value`` lies under; a NULL value gets ``otherwise``."""
    return _steps(((value < bound, label) for bound, label in steps), otherwise)


def at_most(value: Column, steps: Iterable[tuple[object, object]], otherwise: object) -> Column:
    """As :func:`below`, the bound itself included."""
    return _steps(((value <= bound, label) for bound, label in steps), otherwise)


def at_least(value: Column, steps: Iterable[tuple[object, object]], otherwise: object) -> Column:
    """Label of the first bound that ``value`` reaches; a NULL value gets ``otherwise``."""
    return _steps(((value >= bound, label) for bound, label in steps), otherwise)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over the rows that meet the condition, 0 when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def mean(value: Column) -> Column:
    """Average as one double division of an exact sum by a count (NULLs skipped)."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def per(total: Column, units: Column) -> Column:
    """``total / units`` as double, 0 where ``units`` is not positive (NULL included)."""
    return F.when(units > 0, total.cast("double") / units).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, type_: str = PERCENT) -> Column:
    """``part / whole * 100`` rounded half up into a decimal; NULL on overflow or division by 0."""
    ratio = F.try_divide(part.cast("decimal(20,2)"), whole.cast("decimal(20,2)"))
    return (ratio * 100).try_cast(type_)


def ratio(part: Column, whole: Column, type_: str) -> Column:
    """``part / whole`` rounded half up into a decimal; NULL on overflow or division by 0."""
    return F.try_divide(part.cast("decimal(20,2)"), whole.cast("decimal(20,2)")).try_cast(type_)


def calendar(day: Column, prefix: str = "") -> dict[str, Column]:
    """Calendar attributes of a date: day of week (1 = Sunday), ISO week, month, quarter, year."""
    return {
        f"{prefix}day_of_week": F.dayofweek(day),
        f"{prefix}week": F.weekofyear(day),
        f"{prefix}month": F.month(day),
        f"{prefix}quarter": F.quarter(day),
        f"{prefix}year": F.year(day),
    }


def on_weekend(day: Column) -> Column:
    """True on Saturday and Sunday."""
    return F.dayofweek(day).isin(1, 7)


def surrogate_key(*parts: Column, prefix: str = "evt_", length: int = 16) -> Column:
    """Stable text key: prefix plus the first hex digits of a SHA-256 over the parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts]) if len(parts) > 1 else parts[0].cast("string")
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def bucket_of(key: Column, shares: Iterable[tuple[int, str]], otherwise: str, modulus: int = 100) -> Column:
    """Deterministic weighted label: ``shares`` are cumulative upper bounds of ``key mod modulus``."""
    return below(F.pmod(key, F.lit(modulus)), shares, otherwise)
