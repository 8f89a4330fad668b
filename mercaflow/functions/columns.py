"""Projection helpers: name lookup, tolerant casts, typed NULL columns."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def named(column: str) -> Column:
    """Column by its literal name, also when the name holds dots or spaces."""
    return F.col("`" + column.replace("`", "``") + "`")


def first_existing_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def ensure_columns(df: DataFrame, fields: Iterable[T.StructField]) -> DataFrame:
    """Add each missing field as a typed NULL, in one projection."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def decimal_column(column: Column, precision: int = 18, scale: int = 2) -> Column:
    return column.try_cast(T.DecimalType(precision, scale))


def typed(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields NULL for malformed values.

    Fractional text such as ``2.0`` counts as a whole number, which a direct
    ANSI cast to integer would refuse, hence the step through double.
    """
    if isinstance(target, T.IntegerType) and not isinstance(source, T.IntegralType):
        column = column.try_cast(T.DoubleType())
    return column.try_cast(target)


def coalesce_aliases(
    df: DataFrame, aliases: dict[str, tuple[str, ...]], schema: T.StructType
) -> DataFrame:
    """Project ``df`` onto ``schema``, filling each field from its aliases.

    A name matches exactly or after lower-casing. Where several columns match
    one field, the first valid value in alias order wins.
    """
    positions = [f"c{i}" for i in range(len(df.columns))]
    inputs = list(zip(positions, df.schema.fields))

    def values(field: T.StructField) -> list[Column]:
        names = aliases[field.name]
        found = []
        for alias in names:
            exact = [(p, f) for p, f in inputs if f.name == alias]
            folded = [(p, f) for p, f in inputs if f.name != alias and f.name.lower() == alias]
            found += [typed(F.col(p), f.dataType, field.dataType) for p, f in exact + folded]
        return found or [F.lit(None).cast(field.dataType)]

    return df.toDF(*positions).select(
        *[F.coalesce(*values(field)).alias(field.name) for field in schema.fields]
    )
