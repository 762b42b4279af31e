"""SQL surface (H1-H5, L1): databases, external text tables, queries, plans.

Spark SQL over the session catalog stands in for the HiveQL typed at a
command-line client; no server is started.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from medallion import fs
from medallion.operators.names import quoted_name, sql_text

def show_databases(spark: SparkSession) -> DataFrame:
    """``SHOW DATABASES`` (H1)."""
    return spark.sql("SHOW DATABASES")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (H2), optionally at a shared location."""
    loc = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(name)}{loc}")


def create_external_text_table(spark: SparkSession, db: str, table: str, columns_ddl: str,
                               location: str, sep: str = ",") -> str:
    """External delimited-text table over an existing folder.

    Dropping the table leaves the files. ``CHAR(n)`` columns are padded to
    ``n`` when read; a header line in the files is data, so numeric columns
    are NULL on it. A table of that name over another folder is declared anew.
    """
    name = quoted_name(f"{db}.{table}")
    StructType.fromDDL(columns_ddl)  # columns and nothing else
    if spark.catalog.tableExists(name):
        at = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location"]
        if at and fs.qualify(spark, at[0]) != fs.qualify(spark, location):
            spark.sql(f"DROP TABLE {name}")  # external: its files stay
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING CSV "
              f"OPTIONS (sep {sql_text(sep)}, header 'false') LOCATION {sql_text(location)}")
    return name


def register_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> list[str]:
    """Expose the Parquet tables under ``root`` (``<name>.parquet`` folders) as
    temporary views named after them, cleaned to SQL identifiers, so they can
    be queried with ``spark.sql``. Returns the view names."""
    paths = fs.glob(spark, f"{root.rstrip('/')}/*.parquet")
    views = []
    for p in paths:
        name = p.rstrip("/").split("/")[-1][: -len(".parquet")]
        if names is not None and name not in names:
            continue
        view = re.sub(r"[^A-Za-z0-9_]", "_", name)
        spark.read.parquet(p).createOrReplaceTempView(view)
        views.append(view)
    return views


def query(spark: SparkSession, text: str) -> DataFrame:
    """Any SQL text (H4)."""
    return spark.sql(text)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints (H5), returned as a string."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
