"""Raw feeds: JSON and parquet, with provenance columns."""
from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from mercaflow.schemas import CORRUPT_COLUMN
from mercaflow.sources import borders

logger = logging.getLogger(__name__)
PATH_COLUMN = "_source_path"
MISSING_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
# How parquet files begin, and what Spark says of files that don't.
PARQUET_MAGIC = b"PAR1"
NOT_PARQUET = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")


def add_metadata_columns(
    df: DataFrame, source: str, ingestion_date: str, file_name: Column | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "source": F.lit(source),
            "ingestion_date": F.lit(ingestion_date),
            "load_ts": F.current_timestamp(),
            "file_name": F.input_file_name() if file_name is None else file_name,
        }
    )


def read_json_source(
    spark: SparkSession,
    path: str | list[str],
    source: str,
    ingestion_date: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """JSON feed with its provenance; unreadable records keep their raw text in
    the corrupt column.

    ``multiline`` reads files of one document or of one array of them. What else
    a file holds (documents one after another, one a line, printed over several
    lines, or mixed with what is no document) is found by one scan of the feed by
    line, whose result is stored; such files are cut at the borders of their
    documents, and all of it is read or set apart, whatever the length of a file.
    Files are read twice, and once more where their schema is inferred. Without
    ``multiline`` there is one document per line, and no scan. A given ``schema``
    saves the inference pass over the files.
    """
    raw = _read_documents(spark, path, schema) if multiline else _read_json(spark, path, schema, False)
    return add_metadata_columns(raw, source, ingestion_date, F.col(PATH_COLUMN)).drop(PATH_COLUMN)


def _read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None) -> DataFrame:
    """The records of ``path``, each file by its kind."""
    blocks = borders.scan(spark, path)
    kinds = borders.kinds(blocks) or {borders.ONE: []}
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    where = {
        kind: path if len(kinds) == 1 else [borders.as_path(file) for file in files]
        for kind, files in kinds.items()
        if kind != borders.CUT
    }
    cut = None
    if borders.CUT in kinds:
        cut = borders.stored(_records(borders.documents(spark, kinds[borders.CUT], blocks)), "records")
    if schema is None:
        inferred = [_json_reader(spark, kind == borders.ONE).json(paths).schema for kind, paths in where.items()]
        if cut is not None:
            inferred.append(spark.read.json(cut.rdd.map(lambda row: row.record)).schema)
        schema = reduce(merged_schema, inferred)
    parts = [_read_json(spark, paths, schema, kind == borders.ONE) for kind, paths in where.items()]
    if cut is not None:
        parts.append(_parsed(cut, schema))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _records(documents: DataFrame) -> DataFrame:
    """Each document, or the elements of an array of them."""
    listed = F.coalesce(F.from_json("document", "array<string>"), F.array("document"))
    each = F.when(F.col("document").startswith("["), listed).otherwise(F.array("document"))
    return documents.select(F.col("file").alias(PATH_COLUMN), F.explode(each).alias("record"))


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    fields = [f for f in schema.fields if f.name != CORRUPT_COLUMN]
    full = T.StructType([*fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    if not fields:
        return records.select(F.col("record").alias(CORRUPT_COLUMN), PATH_COLUMN)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    return records.withColumn("record", F.from_json("record", full, options)).select("record.*", PATH_COLUMN)


def merged_schema(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: fields of either, the wider number,
    or else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        types = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            types[f.name] = merged_schema(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(name, kind) for name, kind in types.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_schema(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _json_reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    return spark.read.options(multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_COLUMN)


def _read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None, multiline: bool
) -> DataFrame:
    """The records of ``path`` with the corrupt column and their file."""
    reader = _json_reader(spark, multiline)
    if schema is None:
        schema = reader.json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    data_fields = [f for f in schema.fields if f.name != CORRUPT_COLUMN]
    corrupt = T.StructField(CORRUPT_COLUMN, T.StringType())
    if data_fields:
        raw = reader.schema(T.StructType([*data_fields, corrupt])).json(path)
    else:
        # Not one readable record, so there is nothing to parse for.
        raw = spark.read.text(path, wholetext=multiline).withColumnRenamed("value", CORRUPT_COLUMN)
        raw = raw.filter(F.trim(CORRUPT_COLUMN) != "")
    return raw.withColumn(PATH_COLUMN, F.col("_metadata.file_path"))


def read_parquet_source(
    spark: SparkSession, path: str, source: str, ingestion_date: str
) -> DataFrame:
    raw = spark.read.parquet(path)
    return add_metadata_columns(raw, source, ingestion_date, F.col("_metadata.file_path"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``length`` and ``modified`` of the files of ``path``; none is opened."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )


def read_files(
    spark: SparkSession,
    files: Sequence[str],
    source: str,
    ingestion_date: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Parquet and JSON files in one frame with their provenance.

    Files named ``*.parquet`` are read as such, all others as JSON. Where one of
    the former is none, the first bytes of each tell. Columns that both formats
    have get a type that holds either's values.
    """

    def json(names: Sequence[str]) -> DataFrame:
        return read_json_source(spark, [borders.as_path(f) for f in names], source, ingestion_date, schema, multiline)

    columnar = [f for f in files if f.lower().endswith(".parquet")]
    frames = []
    if columnar:
        def read(names: Sequence[str]) -> DataFrame:
            reader = spark.read.option("mergeSchema", True)
            raw = reader.parquet(*[borders.as_path(f) for f in names])
            return add_metadata_columns(raw, source, ingestion_date, F.col("_metadata.file_path"))

        try:
            frames.append(read(columnar))
        except (PySparkException, Py4JJavaError) as error:
            if not any(reason in str(error) for reason in NOT_PARQUET):
                raise
            logger.info("not all files named as parquet are: %s", str(error).splitlines()[0])
            columnar = [f for f in columnar if _is_parquet(spark, f)]
            frames += [read(columnar)] if columnar else []
    if rest := [f for f in files if f not in set(columnar)]:
        frames.append(json(rest))
    return reduce(union_of_types, frames)


def _is_parquet(spark: SparkSession, file: str) -> bool:
    """Whether a file begins as parquet files do; four bytes of it are read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(unquote(file))
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(max(0, stream.read()) for _ in range(len(PARQUET_MAGIC))) == PARQUET_MAGIC
    finally:
        stream.close()


def union_of_types(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by name; a column of different types gets one for both."""
    kinds = {f.name: f.dataType for f in merged_schema(a.schema, b.schema).fields}

    def cast(df: DataFrame) -> DataFrame:
        return df.select(
            *(F.col(f"`{f.name}`").cast(kinds[f.name]).alias(f.name) if f.dataType != kinds[f.name] else F.col(f"`{f.name}`")
              for f in df.schema.fields)
        )

    return cast(a).unionByName(cast(b), allowMissingColumns=True)


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in MISSING_CONDITIONS


def try_read(read: Callable[[], DataFrame]) -> DataFrame | None:
    """Frame of ``read``, or None when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def read_first_available(readers: Sequence[Callable[[], DataFrame]]) -> DataFrame | None:
    """Frame of the first reader whose files exist and have its format."""
    for read in readers:
        try:
            return read()
        except (PySparkException, Py4JJavaError) as error:
            missing = isinstance(error, AnalysisException) and is_missing(error)
            if not missing and "FAILED_READ_FILE" not in str(error):
                raise
            logger.info("falling back to the next format: %s", str(error).splitlines()[0])
    return None
