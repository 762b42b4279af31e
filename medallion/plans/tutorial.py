"""Tutorial plans: harmonise two restaurant sources and union them (Q7);
replicate a table, rename and derive an average (Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from medallion.functions.columns import element, split_get, strict_concat
from medallion.operators.names import add_if_missing, rename
from medallion.operators.shape import replicate, union_by_name

# The columns of the unified shape and the nested fields its address block comes from.
UNIFIED = ("datasetId", "name", "address1", "address2", "city", "state", "zip", "tel", "dateStart", "dateEnd",
           "type", "geoX", "geoY", "county", "id")
NESTED_FIELDS = {
    "address1": "premise_address1",
    "address2": "premise_address2",
    "city": "premise_city",
    "zip": "premise_zip",
    "tel": "premise_phone",
    "dateStart": "opening_date",
    "dateEnd": "closing_date",
}


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", strict_concat("state", F.lit("_"), "county", F.lit("_"), "datasetId"))


def harmonise_flat(df: DataFrame, county: str, mapping: dict[str, str], state: str | None = None,
                   drop: tuple[str, ...] = (), constants: dict[str, str | None] | None = None) -> DataFrame:
    """A flat source (CSV) into the unified shape: constant, renames, drops.
    ``constants`` gives text columns that the source lacks."""
    out = rename(df.withColumn("county", F.lit(county)), mapping)
    out = out.withColumns({c: F.lit(v).cast("string") for c, v in (constants or {}).items()})
    if state is not None:
        out = out.withColumn("state", F.lit(state))
    out = out.withColumn("dateEnd", F.lit(None)).drop(*drop)
    return _with_id(out)


def harmonise_nested(df: DataFrame, county: str) -> DataFrame:
    """A nested JSON source into the unified shape: struct fields (P9), the
    text after " - " (X5) and array elements (X6), each NULL when absent."""
    fields = [f.name for f in df.schema["fields"].dataType.fields]
    out = (df.withColumn("county", F.lit(county))
           .withColumns({
               "datasetId": F.col("fields.id"),
               "name": F.col("fields.premise_name"),
               "state": F.col("fields.premise_state"),
               "type": split_get("fields.type_description", " - ", 1),
               "geoX": element("fields.geolocation", 0),
               "geoY": element("fields.geolocation", 1),
               **{c: F.col(f"fields.{f}") if f in fields else F.lit(None).cast("string")
                  for c, f in NESTED_FIELDS.items()},
           })
           .drop("fields", "geometry", "record_timestamp", "recordid"))
    return _with_id(out)


def union_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name (U1). The address block and the dates are text, NULL where a source lacks them."""
    def unified(df: DataFrame) -> DataFrame:
        df = add_if_missing(df, {c: StringType() for c in NESTED_FIELDS})
        return df.select(*(F.col(c).cast("string").alias(c) if c in NESTED_FIELDS else c for c in UNIFIED))

    return union_by_name(unified(a), unified(b))


def replicate_average(df: DataFrame, copies: int = 61, lcl: str = "Lower Confidence Limit",
                      ucl: str = "Upper Confidence Limit", keep_derived: bool = True) -> DataFrame:
    """``copies`` x the rows, limits renamed, ``avg`` by SQL expression."""
    out = rename(replicate(df, copies), {lcl: "lcl", ucl: "ucl"})
    out = out.withColumns({"avg": F.expr("(lcl + ucl) / 2"), "lcl2": F.col("lcl"), "ucl2": F.col("ucl")})
    return out if keep_derived else out.drop("avg", "lcl2", "ucl2")
