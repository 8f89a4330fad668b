"""Aggregate expressions whose result does not depend on row order."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY_SCALE = 4


def money_parts(column: str | Column, scale: int = MONEY_SCALE) -> tuple[Column, Column]:
    """Sums of an amount's whole units and of its fractions as two integers, which
    whole-stage code generation keeps in registers, which hold up to 9e18 units
    in all, and which can be added up further."""
    amount = (F.col(column) if isinstance(column, str) else column).cast("double")
    whole = F.floor(amount)
    fraction = F.round((amount - whole) * 10**scale).cast("bigint")
    return F.sum(whole.cast("bigint")), F.sum(fraction)


def total_of_parts(whole: Column, fraction: Column, scale: int = MONEY_SCALE) -> Column:
    """The exact decimal that two sums of ``money_parts`` stand for."""
    unit = F.lit(10**scale).cast("decimal(7,0)")
    total = whole.cast("decimal(19,0)") * unit + fraction.cast("decimal(19,0)")
    return (total / unit).cast(f"decimal(28,{scale})")


def exact_total(column: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Sum of money as a decimal, whatever the order of the additions. Each
    amount counts to ``scale`` decimals."""
    return total_of_parts(*money_parts(column, scale), scale)


def money_total(column: str | Column, scale: int = MONEY_SCALE) -> Column:
    """``exact_total`` as a double, rounded once at the end."""
    return _as_double(exact_total(column, scale))


def money_of_parts(name: str, scale: int = MONEY_SCALE) -> Column:
    """``money_total`` from stored parts, the columns ``name_whole`` and
    ``name_fraction``."""
    return _as_double(total_of_parts(F.sum(f"{name}_whole"), F.sum(f"{name}_fraction"), scale))


def _as_double(total: Column) -> Column:
    return F.round(total, MONEY_SCALE).cast("double")


def distinct_total(column: str, exact: bool) -> Column:
    """Exact distinct count, or the fixed-size sketch."""
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def pearson(x: str, y: str) -> Column:
    """Pearson correlation, NULL for a group without variance.

    ``corr`` divides by zero there, which ANSI mode turns into an error.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)
