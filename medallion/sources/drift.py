"""JSON lines whose fields change type from file to file (S5), read through VARIANT.

A schema can't fit them: inference widens a field that is a number here and text there to text, and a declared type
makes NULL of the rest. Each line is parsed once into a VARIANT value, and each field is then asked for by its
paths, in order, as the wanted type; what a path does not hold, or cannot be cast, gives way to the next.
:func:`drift_report` says which types a field has been seen with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.sources.readers import PROVENANCE_COL

VALUE = "__variant"


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value`` (the line), ``__variant`` (NULL where it is no JSON), ``source_file``."""
    return (spark.read.text(path).withColumn(PROVENANCE_COL, F.col("_metadata.file_path"))
            .filter(F.trim("value") != "").withColumn(VALUE, F.try_parse_json("value")))


def fields(df: DataFrame, wanted: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Typed columns of the parsed lines. ``wanted``: name -> (type, paths), such as ``{"price": ("double", ["$.price",
    "$.price.amount"])}``. Lines that are no JSON have NULL in all, and ``is_json`` false."""
    cols = [F.coalesce(*[F.try_variant_get(VALUE, p, kind) for p in paths]).alias(name) for name, (kind, paths) in wanted.items()]
    return df.select(*cols, F.col(VALUE).isNotNull().alias("is_json"), PROVENANCE_COL)


def drift_report(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """(path, type, rows): the types each path has been seen with (``VOID`` for JSON null, NULL where it is absent)."""
    each = F.array(*[F.struct(F.lit(p).alias("path"), F.schema_of_variant(F.try_variant_get(VALUE, p, "variant")).alias("type"))
                     for p in paths])
    return (df.select(F.explode(each).alias("e")).select("e.*").groupBy("path", "type")
            .agg(F.count(F.lit(1)).alias("rows")))
