"""Batch sources.

Readers never infer types unless asked (inference costs a full extra pass over
the input); delimited files are read as all-string tables and typed later with
the ``try_`` helpers of :mod:`medallion.functions.columns`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PROVENANCE_COL = "source_file"


def read_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = ";",
                   header: bool = True, enforce_schema: bool = False,
                   with_provenance: bool = False, schema: StructType | str | None = None,
                   **options: str) -> DataFrame:
    """Delimited text as an all-string table (S1), glob paths allowed.

    The schema comes from the header of one file. With ``enforce_schema=False``
    every other file's header is checked against it by name, so a file whose
    columns were reordered fails the read instead of being matched by position.
    ``with_provenance`` adds the file each row came from, read from the hidden
    ``_metadata`` column (no extra pass). A ``schema`` states the expected
    columns up front (with ``enforce_schema=False`` every header is still
    checked against its names) and saves the job that reads the first header.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    reader = (reader.option("header", str(header).lower())
              .option("sep", sep)
              .option("enforceSchema", str(enforce_schema).lower()))
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if with_provenance:
        df = df.withColumn(PROVENANCE_COL, F.col("_metadata.file_path"))
    return df


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0,
                      sep: str = ",") -> DataFrame:
    """CSV with a header and inferred column types (S3).

    Inference reads the input once more before the query runs; lower
    ``sampling_ratio`` on large inputs, or pass a schema to
    :func:`read_delimited` instead.
    """
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("samplingRatio", str(sampling_ratio)).option("sep", sep).csv(path))


def read_headerless(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV without a header option: columns ``_c0 … _cN``; a header line is data."""
    return spark.read.option("sep", sep).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON lines (or whole-file arrays with ``multi_line``) with nested types."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Columnar scan (S6); projections and filters reach the file reader."""
    return spark.read.parquet(*paths)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """Rows held by the caller with an explicit schema.

    Only for small, bounded inputs: the rows travel from the driver.
    """
    return spark.createDataFrame(list(rows), schema)


def read_text(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Text lines (S10): one row per line in column ``value``, or one per file."""
    # text() has its own ``wholetext`` argument, which would override an option
    return spark.read.text(path, wholetext=whole_file)


def all_strings(columns: Sequence[str]) -> StructType:
    """An all-text schema for the given column names."""
    return StructType([StructField(c, StringType(), True) for c in columns])


# Schemas of Parquet inputs that never change once written (the driver's
# read-only tables, published derived sets), kept per process: Spark infers a
# Parquet schema with a small job on every read, which dominates short queries.
_IMMUTABLE_SCHEMAS: dict[str, StructType] = {}


def read_immutable_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read that infers the schema once per process and path.

    Only for folders that are never rewritten; anything else must use
    :func:`read_parquet`.
    """
    schema = _IMMUTABLE_SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _IMMUTABLE_SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables (read-only, so its schema is kept)."""
    return read_immutable_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
