"""Catalog registration of stored tables."""
from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from mercaflow.sinks.swap import folder_names, owned_path

logger = logging.getLogger(__name__)
# Partitions that one statement adds or drops.
ADDED_AT_ONCE = 500
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def register_table(
    spark: SparkSession, name: str, location: str, database: str, owned: Mapping[str, str] | None = None
) -> bool:
    """Create an external table over ``location``, or bring it up to date.

    A table that exists gets the columns that the run's files have and it lacks,
    and the partitions below the run's ``owned`` folder in place of those that it
    had there; folders of other dates are not listed. Without ``owned``, or for a
    new table, all partitions are recovered. A catalog is optional: a failure is
    logged, and the stored data stays readable by path.
    """
    table = f"{_quoted(database)}.{_quoted(name)}"
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
        known = spark.catalog.tableExists(table)
        if not known:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING PARQUET LOCATION {_literal(location)}")
        if known and owned:
            _add_columns(spark, table, location, owned)
            _replace_partitions(spark, table, location, owned)
        else:
            _recover_partitions(spark, table)
        spark.sql(f"REFRESH TABLE {table}")
        return True
    except PySparkException as error:
        logger.warning("table %s not registered: %s", table, error)
        return False


def _add_columns(spark: SparkSession, table: str, location: str, owned: Mapping[str, str]) -> None:
    """Columns of the run's files that the table lacks; those of another type are
    reported, since files of both types remain."""
    folder = owned_path(location, owned)
    if not folder_names(spark, location, folder, files=True):
        return
    stored = spark.read.options(basePath=location, mergeSchema=True).parquet(folder).schema
    types = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
    new = [f for f in stored.fields if f.name.lower() not in types]
    if new:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    for field in stored.fields:
        known = types.get(field.name.lower(), field.dataType)
        if known != field.dataType and field.name not in owned:
            logger.warning("%s.%s is %s there and %s in new files", table, field.name, known, field.dataType)


def _replace_partitions(spark: SparkSession, table: str, location: str, owned: Mapping[str, str]) -> None:
    columns = _partition_columns(spark, table)
    if not columns or not set(owned) <= set(columns):
        return
    own = list(owned.items())
    found = {tuple(own + below) for below in _partitions_below(spark, location, owned_path(location, owned), len(columns) - len(owned))}
    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(own)})").collect()
    known = {tuple(_named(folder) for folder in row[0].split("/")) for row in listed}
    _each(spark, f"ALTER TABLE {table} DROP IF EXISTS", known - found, ", ")
    _each(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS", found - known, " ")


def _each(spark: SparkSession, statement: str, partitions: set[tuple], separator: str) -> None:
    specs = [f"PARTITION ({_spec(values)})" for values in partitions]
    for first in range(0, len(specs), ADDED_AT_ONCE):
        spark.sql(f"{statement} {separator.join(specs[first : first + ADDED_AT_ONCE])}")


def _named(folder: str) -> tuple[str, str | None]:
    """Column and value of a partition's folder."""
    column, _, value = folder.partition("=")
    return column, None if value == NULL_PARTITION else unquote(value)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _partitions_below(
    spark: SparkSession, location: str, folder: str, depth: int
) -> Iterator[list[tuple[str, str | None]]]:
    """Column and value of the partition folders ``depth`` levels below ``folder``."""
    if not depth:
        if folder_names(spark, location, folder, files=True):
            yield []
        return
    for name in folder_names(spark, location, folder):
        if "=" in name:
            for rest in _partitions_below(spark, location, f"{folder}/{name}", depth - 1):
                yield [_named(name), *rest]


def _spec(values: Sequence[tuple[str, str | None]]) -> str:
    return ", ".join(f"{_quoted(c)} = {'null' if v is None else _literal(v)}" for c, v in values)


def _recover_partitions(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    except PySparkException as error:
        logger.warning("partitions of %s not recovered: %s", table, error)


def _quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
