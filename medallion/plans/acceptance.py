"""Acceptance queries over the driver tables and their SQL oracles.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows
with the driver tables: the derived input sets of :mod:`medallion.sources.fixtures`
are written by Spark from those tables. Each oracle states the same result in
DuckDB SQL directly over the driver tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from medallion.functions.columns import (decimal_comma_to_double, element, full_address, parse_date,
                                         split_get, strict_concat, to_double)
from medallion.operators import geo
from medallion.operators.filters import incomplete, place_filter, require, year_between
from medallion.operators.names import add_if_missing, clean_column_names, rename
from medallion.operators.shape import partition_count, partition_sizes, repartition_to, union_positional
from medallion.operators.text import word_count
from medallion.plans.jobs import BRONZE_TRANSACTIONS, gold_job, silver_job
from medallion.plans.marts import PRICE_MART, build_mart, poi_source, price_mart, run_marts
from medallion.plans.refine import refine_transactions, run_refine_batch, run_refine_transactions
from medallion.plans.sqlsurface import create_database, create_external_text_table
from medallion.plans.sqlsurface import query as sql_query
from medallion.plans.tutorial import harmonise_flat, harmonise_nested, replicate_average, union_sources
from medallion.session import scratch
from medallion.sinks.writers import write_text
from medallion.sources import fixtures as fx
from medallion.sources.readers import (all_strings, literal_rows, read_csv_inferred, read_delimited,
                                       read_headerless, read_immutable_parquet, read_json, read_text, table)
from medallion.streaming.landing import land

Query = Callable[[SparkSession, str], DataFrame]

YEARS = (1996, 1998)
PLACE = "75"


def transactions_raw(spark: SparkSession, sf_dir: str, with_coords: bool = True,
                     declared: bool = True) -> DataFrame:
    """The transaction CSV set. ``declared`` states its columns up front (each
    file's header is still checked against them); ``False`` takes them from
    the header, as an unknown source would be read."""
    root = fx.transactions(spark, sf_dir, with_coords)
    cols = fx.TRANSACTION_COLUMNS + (("latitude", "longitude") if with_coords else ())
    return read_delimited(spark, f"{root}/{fx.TRANSACTION_GLOB}", sep=";",
                          schema=all_strings(cols) if declared else None)


def best_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared one-row-per-address table (J2 output, stored once per input)."""
    return read_immutable_parquet(spark, fx.gazetteer_best(spark, sf_dir))


def q_price_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = refine_transactions(transactions_raw(spark, sf_dir), best_gazetteer(spark, sf_dir),
                                 code=PLACE, years=YEARS)
    return price_mart(silver)


# --- oracle building blocks (DuckDB SQL over the driver tables) ----------------

SQL_TX = """
tx AS (
  SELECT o_orderkey AS k, o_orderkey % 10 AS m, o_custkey AS c,
    CAST(o_orderkey AS VARCHAR) AS doc_id,
    CASE WHEN o_orderkey % 10 = 2 THEN '31/13/1997' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_s,
    CASE WHEN o_orderkey % 10 = 3 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         WHEN o_orderkey % 10 = 4 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_s,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(60 + o_custkey % 20 AS VARCHAR) END AS dept,
    CASE WHEN o_orderkey % 10 = 1 THEN NULL ELSE CAST(60 + o_custkey % 20 AS VARCHAR) || '001' END AS postcode,
    CASE WHEN o_orderkey % 10 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d,
    CASE WHEN o_orderkey % 10 = 4 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS prix,
    CASE WHEN o_orderkey % 10 IN (3, 4) THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS prix_strict,
    CAST(o_orderkey % 200 AS DOUBLE) AS surface,
    o_orderpriority AS type_bien,
    CASE WHEN o_orderkey % 3 = 0 THEN 48.5 + (o_custkey % 32) / 64 END AS lat0,
    CASE WHEN o_orderkey % 3 = 0 THEN 2.5 + (o_orderkey % 16) / 64 END AS lon0,
    CASE WHEN o_orderkey % 10 = 5 THEN NULL ELSE CAST(o_orderkey % 5 AS VARCHAR) END AS num,
    'NATION_' || CAST(o_custkey % 25 AS VARCHAR) AS voie,
    year(o_orderdate) AS folder_year
  FROM orders
)"""

SQL_GAZ = """
nat AS (SELECT n_nationkey, n_name, unnest(range(5)) AS num FROM nation WHERE n_nationkey % 7 <> 3),
gaz AS (
  SELECT CAST(num AS VARCHAR) || ' RUE ' || n_name || ' 75001 PARIS' AS akey,
         48 + n_nationkey / 64 AS latitude, 2 + num / 64 AS longitude, 1.0 AS score FROM nat
  UNION ALL
  SELECT CAST(num AS VARCHAR) || ' RUE ' || n_name || ' 75001 PARIS',
         48 + n_nationkey / 64 + 1 / 64, 2 + num / 64,
         CASE WHEN n_nationkey % 5 = 0 THEN 0.5 ELSE 1.0 END FROM nat WHERE n_nationkey % 5 <= 1
  UNION ALL
  SELECT CAST(s_suppkey % 5 AS VARCHAR) || ' RUE NATION_' || CAST(s_nationkey AS VARCHAR) || ' 75001 PARIS',
         48 + s_nationkey / 64 + (s_suppkey % 3) / 128, 2 + (s_suppkey % 5) / 64,
         CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE floor(s_acctbal / 2000) / 4 END
  FROM supplier WHERE s_nationkey % 7 <> 3
),
best AS (
  SELECT akey, latitude, longitude, score FROM (
    SELECT *, row_number() OVER (PARTITION BY akey
                                 ORDER BY score DESC NULLS LAST, latitude, longitude) AS rn
    FROM gaz) WHERE rn = 1
)"""

SQL_PLACE = "(dept = '75' OR starts_with(postcode, '75'))"
SQL_YEARS = "year(d) BETWEEN 1996 AND 1998"
SQL_AKEY = "concat_ws(' ', num, 'RUE', voie, postcode, 'PARIS')"

ORACLE_PRICE_MART = f"""
WITH {SQL_TX}, {SQL_GAZ},
f AS (SELECT * FROM tx WHERE {SQL_PLACE} AND {SQL_YEARS}),
j AS (
  SELECT f.prix, f.surface, f.type_bien,
         coalesce(f.lat0, b.latitude) AS latitude, coalesce(f.lon0, b.longitude) AS longitude
  FROM f LEFT JOIN best b ON b.akey = {SQL_AKEY}
)
SELECT prix, surface, type_bien, latitude, longitude FROM j
WHERE latitude IS NOT NULL AND prix IS NOT NULL
"""



# --- scans (S1-S7) -------------------------------------------------------------

TX_ID = "Identifiant de document"


def q_scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir, declared=False)  # schema from the header (S1)


ORACLE_SCAN_CSV_STRINGS = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document", date_s AS "Date mutation", price_s AS "Valeur fonciere",
       num AS "No voie", 'RUE' AS "Type de voie", voie AS "Voie", postcode AS "Code postal",
       dept AS "Code departement", CAST(k % 200 AS VARCHAR) AS "Surface reelle bati",
       type_bien AS "Type local", CAST(lat0 AS VARCHAR) AS latitude, CAST(lon0 AS VARCHAR) AS longitude
FROM tx
"""


def q_scan_csv_glob_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.transactions(spark, sf_dir)
    raw = read_delimited(spark, f"{root}/{fx.TRANSACTION_GLOB}", sep=";", with_provenance=True)
    d = parse_date("Date mutation")
    return (raw.select(F.regexp_extract("source_file", r"Orders-(\d{4})/", 1).cast("int").alias("folder_year"),
                       d.alias("d"))
            .groupBy("folder_year")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("d").alias("n_dated"),
                 F.count_if(year_between("d", *YEARS)).alias("n_in_years")))


ORACLE_SCAN_CSV_GLOB_YEARS = f"""
WITH {SQL_TX}
SELECT CAST(folder_year AS INTEGER) AS folder_year, count(*) AS n_rows, count(d) AS n_dated,
       count(*) FILTER (WHERE {SQL_YEARS}) AS n_in_years
FROM tx GROUP BY folder_year
"""


def q_scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_inferred(spark, fx.customer_csv(spark, sf_dir))


ORACLE_SCAN_CSV_INFERRED = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""


def q_scan_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_headerless(spark, fx.headerless_csv(spark, sf_dir))


ORACLE_SCAN_CSV_HEADERLESS = """
SELECT 'num' AS _c0, 'name' AS _c1, 'segment' AS _c2, 'balance' AS _c3, 'id' AS _c4
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), CAST(c_nationkey AS VARCHAR)
FROM customer
"""


def q_scan_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_json(spark, fx.nested_json(spark, sf_dir))
    return df.select(F.col("fields.id").alias("datasetId"),
                     F.col("fields.premise_name").alias("name"),
                     split_get("fields.type_description", " - ", 1).alias("type"),
                     element("fields.geolocation", 0).alias("geoX"),
                     element("fields.geolocation", 1).alias("geoY"),
                     F.col("recordid"))


SQL_DURHAM = """
  SELECT event_id AS datasetId, 'user_' || CAST(user_id AS VARCHAR) AS name,
         CASE WHEN event_id % 10 = 1 THEN NULL ELSE event_type END AS type,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS geoX,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS geoY,
         CAST(event_id AS VARCHAR) AS recordid
  FROM events"""

ORACLE_SCAN_JSON_NESTED = f"SELECT * FROM ({SQL_DURHAM})"


def q_scan_parquet_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("name"), to_double("p_size").alias("size"),
        F.col("p_retailprice").alias("price"))


ORACLE_SCAN_PARQUET_PROJECT = """
SELECT p_partkey, p_name AS name, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part
"""

# Fixed values for the literal-rows query: market segment display labels.
SEGMENT_LABELS = [
    ("AUTOMOBILE", "Automobile"),
    ("BUILDING", "Building"),
    ("FURNITURE", "Furniture"),
    ("HOUSEHOLD", "Household"),
    ("MACHINERY", "Machinery"),
]


def q_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = literal_rows(spark, SEGMENT_LABELS,
                          StructType([StructField("segment", StringType(), False),
                                      StructField("label", StringType(), True)]))
    counts = (table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment"))
              .agg(F.count(F.lit(1)).alias("n_customers"), F.max("c_acctbal").alias("max_balance")))
    # The literal side is bounded by its row list, so broadcasting it is safe.
    return counts.join(F.broadcast(labels), "segment", "left")


ORACLE_LITERAL_ROWS = f"""
WITH labels(segment, label) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SEGMENT_LABELS)})
SELECT c.segment, l.label, c.n_customers, c.max_balance
FROM (SELECT c_mktsegment AS segment, count(*) AS n_customers, max(c_acctbal) AS max_balance
      FROM customer GROUP BY c_mktsegment) c
LEFT JOIN labels l ON l.segment = c.segment
"""


# --- filters (F1-F4) -------------------------------------------------------------

def q_place_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (place_filter(transactions_raw(spark, sf_dir), PLACE)
            .select(TX_ID, "Code departement", "Code postal"))


ORACLE_PLACE_FILTER = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document", dept AS "Code departement", postcode AS "Code postal"
FROM tx WHERE {SQL_PLACE}
"""


def q_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = transactions_raw(spark, sf_dir).withColumn("date", parse_date("Date mutation"))
    return (df.filter(year_between("date", *YEARS))
            .select(TX_ID, "date", F.year("date").alias("year")))


ORACLE_YEAR_RANGE = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document", d AS date, CAST(year(d) AS INTEGER) AS year
FROM tx WHERE {SQL_YEARS}
"""


def q_null_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for variant, with_coords in (("with_coords", True), ("without_coords", False)):
        df = add_if_missing(transactions_raw(spark, sf_dir, with_coords),
                            {"latitude": DoubleType(), "longitude": DoubleType()})
        df = df.withColumns({"latitude": to_double("latitude"), "longitude": to_double("longitude")})
        branch = F.when(incomplete(["latitude", "longitude"]), F.lit("incomplete")).otherwise(F.lit("complete"))
        out.append(df.select(TX_ID, F.lit(variant).alias("variant"), branch.alias("branch"),
                             "latitude", "longitude"))
    return out[0].unionByName(out[1])


ORACLE_NULL_SPLIT = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document", 'with_coords' AS variant,
       CASE WHEN lat0 IS NULL OR lon0 IS NULL THEN 'incomplete' ELSE 'complete' END AS branch,
       lat0 AS latitude, lon0 AS longitude FROM tx
UNION ALL
SELECT doc_id, 'without_coords', 'incomplete', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM tx
"""


def _poi(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_immutable_parquet(spark, f"{fx.poi_sources(spark, sf_dir)}/{name}.parquet")


def q_require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _poi(spark, sf_dir, "customer_points")
    lat, lon, _ = geo.point_columns(df)
    return require(df.select("c_custkey", lat.alias("latitude"), lon.alias("longitude")),
                   "latitude", "longitude")


SQL_CUSTOMER_POINTS = """
  SELECT c_custkey, 48 + (c_custkey % 128) / 128 AS latitude, 2 + c_nationkey / 64 AS longitude
  FROM customer WHERE c_custkey % 10 >= 3"""

ORACLE_REQUIRE_COLUMNS = f"SELECT * FROM ({SQL_CUSTOMER_POINTS})"


# --- projections and names (P2-P5) ------------------------------------------------

def q_rename_drop_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").withColumn("county", F.lit("Wake"))
    df = rename(df, {"c_custkey": "datasetId", "c_name": "name", "c_mktsegment": "type",
                     "c_acctbal": "balance"}).drop("c_nationkey")
    return df.withColumn("id", strict_concat(F.lit("NC"), F.lit("_"), "county", F.lit("_"), "datasetId"))


ORACLE_RENAME_DROP_CONSTANT = """
SELECT c_custkey AS datasetId, c_name AS name, c_acctbal AS balance, c_mktsegment AS type,
       'Wake' AS county, 'NC_Wake_' || CAST(c_custkey AS VARCHAR) AS id
FROM customer
"""


def q_clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_immutable_parquet(spark, f"{fx.messy_names(spark, sf_dir)}/part_names.parquet")
    return clean_column_names(df)


ORACLE_CLEAN_NAMES = "SELECT p_partkey, p_name AS x_y, p_brand AS x_z FROM part"


# --- scalar functions (X1, X2, X9, X10) --------------------------------------------

def q_concat_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["No voie", "Type de voie", "Voie", "Code postal"]
    strict = []
    for p in parts:
        strict += [F.col(p), F.lit(" ")]
    return transactions_raw(spark, sf_dir).select(
        TX_ID, full_address(parts, "PARIS").alias("address"),
        strict_concat(*strict, F.lit("PARIS")).alias("address_strict"))


ORACLE_CONCAT_PAIR = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document",
       concat_ws(' ', num, 'RUE', voie, postcode, 'PARIS') AS address,
       num || ' ' || 'RUE' || ' ' || voie || ' ' || postcode || ' ' || 'PARIS' AS address_strict
FROM tx
"""


def q_parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).select(
        TX_ID, to_double("Valeur fonciere").alias("prix_strict"),
        decimal_comma_to_double("Valeur fonciere").alias("prix"),
        to_double("Surface reelle bati").alias("surface"))


ORACLE_PARSE_NUMBERS = f"""
WITH {SQL_TX}
SELECT doc_id AS "Identifiant de document", prix_strict, prix, surface FROM tx
"""


# --- points of interest and marts (Q4, Q6) -----------------------------------------

# Catalogue of the test marts over the derived point sources (same shape as
# the Paris catalogue in ``medallion.plans.marts``).
TEST_MARTS = {
    "dm_points": (
        ("customer_points", "Client"),
        ("supplier_points", "Fournisseur"),
        ("nation_points", "Pays"),
        ("part_points", "Pièce"),
        ("region_nocoords", "Région"),
        ("events_struct", "Evénement"),
        ("events_binary", "Evénement binaire"),
        ("absent_source", "Absent"),
    ),
    "dm_without_points": (
        ("region_nocoords", "Région"),
    ),
}


def q_poi_text_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poi_source(spark, f"{fx.poi_sources(spark, sf_dir)}/customer_points.parquet", "Client",
                      read_immutable_parquet)


ORACLE_POI_TEXT_POINT = f"SELECT latitude, longitude, 'Client' AS categorie FROM ({SQL_CUSTOMER_POINTS})"


def q_poi_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poi_source(spark, f"{fx.poi_sources(spark, sf_dir)}/part_points.parquet", "Pièce",
                      read_immutable_parquet)


SQL_PART_POINTS = """
  SELECT 48 + p_size / 64 AS latitude, 2 + (p_partkey % 64) / 64 AS longitude, 'Pièce' AS categorie
  FROM part WHERE p_partkey % 10 >= 2"""

ORACLE_POI_TWO_COLUMNS = f"SELECT * FROM ({SQL_PART_POINTS})"


def _poi_path_of(spark: SparkSession, sf_dir: str):
    root = fx.poi_sources(spark, sf_dir)
    return lambda dataset: f"{root}/{dataset}.parquet"


def q_poi_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _, _ = build_mart(spark, "dm_points", TEST_MARTS["dm_points"], _poi_path_of(spark, sf_dir),
                          read_immutable_parquet)
    return df


ORACLE_POI_MART = f"""
SELECT latitude, longitude, 'Client' AS categorie FROM ({SQL_CUSTOMER_POINTS})
UNION ALL
SELECT 48 + (s_suppkey % 64) / 64, 2 + s_nationkey / 32, 'Fournisseur' FROM supplier
UNION ALL
SELECT 48 + n_nationkey / 64, 2 + n_regionkey / 8, 'Pays' FROM nation
UNION ALL
SELECT * FROM ({SQL_PART_POINTS})
"""


def q_mart_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "gold")
    return run_marts(spark, TEST_MARTS, _poi_path_of(spark, sf_dir), out, read_immutable_parquet).drop("message")


ORACLE_MART_STATUS = """
SELECT 'dm_points' AS mart, 'customer_points' AS dataset, 'Client' AS categorie, 'ok' AS status,
       (SELECT count(*) FROM customer WHERE c_custkey % 10 >= 3) AS n_rows
UNION ALL SELECT 'dm_points', 'supplier_points', 'Fournisseur', 'ok', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'dm_points', 'nation_points', 'Pays', 'ok', (SELECT count(*) FROM nation)
UNION ALL SELECT 'dm_points', 'part_points', 'Pièce', 'ok', (SELECT count(*) FROM part WHERE p_partkey % 10 >= 2)
UNION ALL SELECT 'dm_points', 'region_nocoords', 'Région', 'no_coordinates', CAST(NULL AS BIGINT)
UNION ALL SELECT 'dm_points', 'events_struct', 'Evénement', 'unsupported_type', CAST(NULL AS BIGINT)
UNION ALL SELECT 'dm_points', 'events_binary', 'Evénement binaire', 'unsupported_type', CAST(NULL AS BIGINT)
UNION ALL SELECT 'dm_points', 'absent_source', 'Absent', 'missing', CAST(NULL AS BIGINT)
UNION ALL SELECT 'dm_without_points', 'region_nocoords', 'Région', 'no_coordinates', CAST(NULL AS BIGINT)
"""


# --- silver batch (Q2, Q3, K1) --------------------------------------------------------

def q_refine_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fx.messy_names(spark, sf_dir)
    out = scratch(spark, "silver")
    sources = [(ds, f"{names}/{ds}.parquet", "parquet")
               for ds in ("part_names", "part_collision", "region", "absent")]
    sources.append(("stations", fx.stations_csv(spark, sf_dir), "csv"))
    return run_refine_batch(spark, sources, out).select("dataset", "status", "columns", "n_rows")


ORACLE_REFINE_BATCH = """
SELECT 'part_names' AS dataset, 'ok' AS status, 'p_partkey,x_y,x_z' AS columns, count(*) AS n_rows FROM part
UNION ALL SELECT 'part_collision', 'name_collision', NULL, CAST(NULL AS BIGINT)
UNION ALL SELECT 'region', 'ok', 'r_regionkey,r_name', count(*) FROM region
UNION ALL SELECT 'absent', 'missing', NULL, CAST(NULL AS BIGINT)
UNION ALL SELECT 'stations', 'ok', 'Nom_gare,Code__UIC_,geo_point_2d,Code_Region', count(*) FROM supplier
"""


# --- joins (J1, J2, D1) and counts (A1, A2) ---------------------------------------------

def _fill_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = transactions_raw(spark, sf_dir)
    return df.withColumns({"latitude": to_double("latitude"), "longitude": to_double("longitude"),
                           "address": full_address(["No voie", "Type de voie", "Voie", "Code postal"],
                                                   "PARIS")})


def q_fill_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = geo.fill_coordinates(_fill_input(spark, sf_dir), best_gazetteer(spark, sf_dir), "address")
    return filled.select(TX_ID, "address", "latitude", "longitude")


ORACLE_FILL_COORDINATES = f"""
WITH {SQL_TX}, {SQL_GAZ}
SELECT doc_id AS "Identifiant de document", {SQL_AKEY} AS address,
       coalesce(lat0, b.latitude) AS latitude, coalesce(lon0, b.longitude) AS longitude
FROM tx LEFT JOIN best b ON b.akey = {SQL_AKEY}
"""


def q_fill_coordinates_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with explicit salting of every address seen at least 5 times."""
    df = _fill_input(spark, sf_dir)
    hot = geo.hot_keys(df, "address", min_rows=5)
    filled = geo.fill_coordinates(df, best_gazetteer(spark, sf_dir), "address", hot=hot, salt_buckets=8,
                                  salt_by=[TX_ID], join_hint="merge")
    return filled.select(TX_ID, "address", "latitude", "longitude")


def q_fill_coordinates_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 joining only the rows that lack a coordinate, complete rows by union."""
    filled = geo.fill_coordinates(_fill_input(spark, sf_dir), best_gazetteer(spark, sf_dir), "address",
                                  split_complete=True, join_hint="merge")
    return filled.select(TX_ID, "address", "latitude", "longitude")


def q_best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.best_candidates(read_immutable_parquet(spark, fx.gazetteer(spark, sf_dir)))


ORACLE_BEST_CANDIDATE = f"""
WITH {SQL_GAZ}
SELECT akey AS address_key, latitude, longitude, score FROM best
"""


def geocode_provider(addresses: pd.Series) -> pd.DataFrame:
    """Deterministic stand-in for a geocoding service, one call per batch.

    Knows ``<n> RUE NATION_<k> 75xxx PARIS`` for nations with k % 7 != 3
    (latitude 48 + k/64, longitude 2 + n/64) and fails outright on
    ``4 RUE NATION_13 …``, so that one bad address exercises the per-address
    retry: that address alone resolves to NULL.
    """
    parts = addresses.str.extract(r"^(\d+) RUE NATION_(\d+) 75\d{3} PARIS$")
    num = pd.to_numeric(parts[0], errors="coerce")
    nation = pd.to_numeric(parts[1], errors="coerce")
    if ((num == 4) & (nation == 13)).any():
        raise RuntimeError("provider failure")
    known = nation.notna() & (nation % 7 != 3)
    return pd.DataFrame({"latitude": (48 + nation / 64).where(known),
                         "longitude": (2 + num / 64).where(known)})


def q_fill_by_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = add_if_missing(transactions_raw(spark, sf_dir, with_coords=False),
                        {"latitude": DoubleType(), "longitude": DoubleType()})
    df = df.withColumn("address", full_address(["No voie", "Type de voie", "Voie", "Code postal"], "PARIS"))
    return geo.fill_by_provider(df, geocode_provider, "address").select(TX_ID, "latitude", "longitude")


ORACLE_FILL_BY_PROVIDER = f"""
WITH {SQL_TX},
p AS (SELECT doc_id, num, c % 25 AS nation, postcode FROM tx),
ok AS (SELECT *, num IS NOT NULL AND starts_with(postcode, '75') AND nation % 7 <> 3
                 AND NOT (num = '4' AND nation = 13) AS known FROM p)
SELECT doc_id AS "Identifiant de document",
       CASE WHEN known THEN 48 + nation / 64 END AS latitude,
       CASE WHEN known THEN 2 + CAST(num AS INTEGER) / 64 END AS longitude
FROM ok
"""


def q_missing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.transactions(spark, sf_dir)
    report = run_refine_transactions(spark, f"{root}/{fx.TRANSACTION_GLOB}",
                                     best_gazetteer(spark, sf_dir), scratch(spark, "silver-tx"),
                                     code=PLACE, years=YEARS,
                                     schema=all_strings(fx.TRANSACTION_COLUMNS + ("latitude", "longitude")))
    return spark.createDataFrame([(report.rows, report.missing_coordinates, report.unresolved)],
                                 "n_rows bigint, n_missing bigint, n_unresolved bigint")


ORACLE_MISSING_COUNT = f"""
WITH {SQL_TX}, {SQL_GAZ},
f AS (SELECT * FROM tx WHERE {SQL_PLACE} AND {SQL_YEARS}),
j AS (SELECT f.lat0, f.lon0, coalesce(f.lat0, b.latitude) AS lat, coalesce(f.lon0, b.longitude) AS lon
      FROM f LEFT JOIN best b ON b.akey = {SQL_AKEY})
SELECT count(*) AS n_rows, count(*) FILTER (WHERE lat0 IS NULL OR lon0 IS NULL) AS n_missing,
       count(*) FILTER (WHERE lat IS NULL OR lon IS NULL) AS n_unresolved
FROM j
"""


def q_silver_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table as written (K1, Q1): every column of its files."""
    out = scratch(spark, "silver-tx")
    root = fx.transactions(spark, sf_dir)
    run_refine_transactions(spark, f"{root}/{fx.TRANSACTION_GLOB}", best_gazetteer(spark, sf_dir), out,
                            code=PLACE, years=YEARS,
                            schema=all_strings(fx.TRANSACTION_COLUMNS + ("latitude", "longitude")))
    return spark.read.parquet(out)


ORACLE_SILVER_READBACK = f"""
WITH {SQL_TX}, {SQL_GAZ},
f AS (SELECT * FROM tx WHERE {SQL_PLACE} AND {SQL_YEARS})
SELECT f.doc_id AS "Identifiant_de_document", f.date_s AS "Date_mutation", f.price_s AS "Valeur_fonciere",
       f.num AS "No_voie", 'RUE' AS "Type_de_voie", f.voie AS "Voie", f.postcode AS "Code_postal",
       f.dept AS "Code_departement", CAST(f.k % 200 AS VARCHAR) AS "Surface_reelle_bati",
       f.type_bien AS "Type_local", f.d AS "Date_mutation_formatee",
       coalesce(f.lat0, b.latitude) AS latitude, coalesce(f.lon0, b.longitude) AS longitude
FROM f LEFT JOIN best b ON b.akey = {SQL_AKEY}
"""


def q_best_then_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on the raw gazetteer, stored, then J1 as a shuffled join."""
    raw = read_immutable_parquet(spark, fx.gazetteer(spark, sf_dir))
    best = geo.prepare_best_candidates(raw, scratch(spark, "gazetteer-best"))
    filled = geo.fill_coordinates(_fill_input(spark, sf_dir), best.hint("merge"), "address")
    return filled.select(TX_ID, "address", "latitude", "longitude")


# --- text (A3, S10) ------------------------------------------------------------------

def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(read_text(spark, fx.documents_text(spark, sf_dir)), "value")


ORACLE_WORD_COUNT = r"""
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
"""


def q_word_count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count written by the text sink (K2) and read back line by line."""
    out = scratch(spark, "word-count-text")
    write_text(q_word_count(spark, sf_dir), out)
    return read_text(spark, out).select(F.col("value").alias("line"))


ORACLE_WORD_COUNT_TEXT = f"""
SELECT replace(word, chr(92), chr(92) || chr(92)) || chr(9) || CAST(count AS VARCHAR) AS line
FROM ({ORACLE_WORD_COUNT})
"""


# --- tutorial plans and set operations (Q7, Q8, U1-U6) -----------------------------------

# The customer file has no address columns; the flat source gets these as constants.
FLAT_CONSTANTS = {"address1": "1 Main St", "address2": None, "city": "Raleigh", "zip": "27601", "tel": None,
                  "dateStart": "2000-01-01"}


def q_union_harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    wake = harmonise_flat(read_csv_inferred(spark, fx.customer_csv(spark, sf_dir)), "Wake",
                          {"c_custkey": "datasetId", "c_name": "name", "c_mktsegment": "type",
                           "c_acctbal": "geoX", "c_nationkey": "geoY"}, state="NC",
                          constants=FLAT_CONSTANTS)
    durham = harmonise_nested(read_json(spark, fx.nested_json(spark, sf_dir)), "Durham")
    return union_sources(wake, durham)


ORACLE_UNION_HARMONISED = f"""
SELECT CAST(c_custkey AS BIGINT) AS datasetId, c_name AS name, c_mktsegment AS type, c_acctbal AS geoX,
       CAST(c_nationkey AS DOUBLE) AS geoY, 'Wake' AS county, 'NC' AS state,
       CAST(NULL AS VARCHAR) AS dateEnd, 'NC_Wake_' || CAST(c_custkey AS VARCHAR) AS id,
       '1 Main St' AS address1, CAST(NULL AS VARCHAR) AS address2, 'Raleigh' AS city, '27601' AS zip,
       CAST(NULL AS VARCHAR) AS tel, '2000-01-01' AS dateStart
FROM customer
UNION ALL
SELECT datasetId, name, type, geoX, geoY, 'Durham', 'NC', CAST(NULL AS VARCHAR),
       'NC_Durham_' || CAST(datasetId AS VARCHAR), CAST(user_id % 100 AS VARCHAR) || ' Oak Ave',
       CASE WHEN datasetId % 4 = 0 THEN 'Suite ' || CAST(datasetId % 7 AS VARCHAR) END, 'Durham',
       CAST(27700 + user_id % 10 AS VARCHAR), CASE WHEN datasetId % 3 > 0 THEN '919-' || CAST(datasetId AS VARCHAR) END,
       strftime(ts, '%Y-%m-%d')
FROM (SELECT d.*, e.user_id, e.ts FROM ({SQL_DURHAM}) d JOIN events e ON e.event_id = d.datasetId)
"""


def q_union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_positional(table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
                            table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


ORACLE_UNION_POSITIONAL = """
SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
"""

REPLICAS = 61


def q_replicate_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate_average(read_csv_inferred(spark, fx.rates_csv(spark, sf_dir)), REPLICAS)


ORACLE_REPLICATE_AVERAGE = f"""
SELECT "Year", "State", lcl, ucl, (lcl + ucl) / 2 AS avg, lcl AS lcl2, ucl AS ucl2
FROM (SELECT CAST(p_partkey AS INTEGER) AS "Year", p_brand AS "State",
             p_retailprice - p_size AS lcl, p_retailprice + p_size AS ucl,
             unnest(range({REPLICAS})) AS copy
      FROM part)
"""


def q_repartition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = repartition_to(table(spark, sf_dir, "orders"), 4)
    declared = partition_count(df)
    # keys and dates travel with the rows, as they would ahead of any per-partition work
    return (partition_sizes(df, F.sum("o_orderkey").alias("keys"), F.max("o_orderdate").alias("last"))
            .agg(F.count(F.lit(1)).alias("n_nonempty"), F.sum("rows").alias("n_rows"),
                 F.sum("keys").alias("key_sum"), F.max("last").cast("date").alias("last_date"))
            .select(F.lit(declared).alias("n_partitions"), "n_nonempty", "n_rows", "key_sum", "last_date"))


ORACLE_REPARTITION_COUNT = """
SELECT 4 AS n_partitions, CAST(4 AS BIGINT) AS n_nonempty, count(*) AS n_rows,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(max(o_orderdate) AS DATE) AS last_date
FROM orders
"""


# --- landing (S9) ------------------------------------------------------------------------

def q_land_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "landing")
    bronze, checkpoint = f"{root}/bronze", f"{root}/checkpoint"
    fx.landing_stage(spark, sf_dir, root)
    for run in (1, 2, 3):
        source = fx.landing_drop(spark, root, run)
        land(spark, source, bronze, checkpoint, fmt="json", schema="doc_id bigint, text string")
    return spark.read.parquet(bronze).select("doc_id", "text")


ORACLE_LAND_ONCE = "SELECT doc_id, text FROM documents"


STACK_MARTS = {"dm_points": (("customer_points", "Client"), ("stations", "Gare / Station"))}


def q_land_refine_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, silver job and gold job over orders, supplier and customer; the gold files as written."""
    root = scratch(spark, "stack")
    bronze, points = f"{root}/bronze", f"{fx.poi_sources(spark, sf_dir)}/customer_points.parquet"
    stations = fx.stations_csv(spark, sf_dir)
    text = {"header": "true", "sep": ";", "enforceSchema": "false"}
    for name, source, fmt, schema, options in (
            (BRONZE_TRANSACTIONS, f"{fx.transactions(spark, sf_dir)}/{fx.TRANSACTION_GLOB}", "csv",
             all_strings(fx.TRANSACTION_COLUMNS + ("latitude", "longitude")), text),
            ("stations", stations, "csv", read_delimited(spark, stations, sep=";").schema, text),
            ("customer_points", points, "parquet", read_immutable_parquet(spark, points).schema, {})):
        land(spark, source, f"{bronze}/{name}", f"{root}/checkpoint/{name}", fmt=fmt, schema=schema, options=options)
    silver_job(spark, root, gazetteer=read_immutable_parquet(spark, fx.gazetteer(spark, sf_dir)), code=PLACE,
               years=YEARS, datasets=("customer_points",), stations="stations", bronze=bronze)
    gold_job(spark, root, catalogue=STACK_MARTS)
    none = F.lit(None).cast("double")
    prices = spark.read.parquet(f"{root}/gold/{PRICE_MART}.parquet")
    return (prices.select(F.lit(PRICE_MART).alias("mart"), F.col("type_bien").alias("kind"), "prix", "surface",
                          "latitude", "longitude")
            .unionByName(spark.read.parquet(f"{root}/gold/dm_points.parquet").select(
                F.lit("dm_points").alias("mart"), F.col("categorie").alias("kind"), none.alias("prix"),
                none.alias("surface"), "latitude", "longitude")))


ORACLE_LAND_REFINE_MART = f"""
WITH {SQL_TX}, {SQL_GAZ},
f AS (SELECT * FROM tx WHERE {SQL_PLACE} AND {SQL_YEARS}),
j AS (
  SELECT f.prix, f.surface, f.type_bien,
         coalesce(f.lat0, b.latitude) AS latitude, coalesce(f.lon0, b.longitude) AS longitude
  FROM f LEFT JOIN best b ON b.akey = {SQL_AKEY}
)
SELECT '{PRICE_MART}' AS mart, type_bien AS kind, prix, surface, latitude, longitude FROM j
WHERE latitude IS NOT NULL AND prix IS NOT NULL
UNION ALL
SELECT 'dm_points', 'Client', NULL, NULL, latitude, longitude FROM ({SQL_CUSTOMER_POINTS})
UNION ALL
SELECT 'dm_points', 'Gare / Station', NULL, NULL, 48 + (s_suppkey % 64) / 64, 2 + s_nationkey / 32 FROM supplier
"""


# --- SQL surface (S8, H2-H4, L1) ----------------------------------------------------------

EXT_COLUMNS = "num INT, name CHAR(100), segment CHAR(100), balance DOUBLE, id INT"


def external_customers(spark: SparkSession, sf_dir: str) -> str:
    location = fx.headerless_csv(spark, sf_dir)
    db = "medallion_open"
    create_database(spark, db, f"{fx.fixture_root(spark, sf_dir)}/catalog/{db}.db")
    suffix = re.sub(r"[^A-Za-z0-9]", "_", fx.fixture_root(spark, sf_dir).split("/")[-1])
    return create_external_text_table(spark, db, f"customers_{suffix}", EXT_COLUMNS, location)


def q_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = external_customers(spark, sf_dir)
    return sql_query(spark, f"SELECT num, name, segment, balance, id FROM {name}")


SQL_EXTERNAL = """
  SELECT CAST(NULL AS INTEGER) AS num, rpad('name', 100, ' ') AS name, rpad('segment', 100, ' ') AS segment,
         CAST(NULL AS DOUBLE) AS balance, CAST(NULL AS INTEGER) AS id
  UNION ALL
  SELECT CAST(c_custkey AS INTEGER), rpad(c_name, 100, ' '), rpad(c_mktsegment, 100, ' '),
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE), c_nationkey
  FROM customer"""

ORACLE_EXTERNAL_TABLE = f"SELECT * FROM ({SQL_EXTERNAL})"


def q_sql_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = external_customers(spark, sf_dir)
    return sql_query(spark, f"SELECT name FROM {name} ORDER BY num NULLS FIRST LIMIT 10")


ORACLE_SQL_LIMIT = f"SELECT name FROM ({SQL_EXTERNAL}) ORDER BY num NULLS FIRST LIMIT 10"


QUERIES: dict[str, Query] = {
    "price_mart": q_price_mart,
    "scan_csv_strings": q_scan_csv_strings,
    "scan_csv_glob_years": q_scan_csv_glob_years,
    "scan_csv_inferred": q_scan_csv_inferred,
    "scan_csv_headerless": q_scan_csv_headerless,
    "scan_json_nested": q_scan_json_nested,
    "scan_parquet_project": q_scan_parquet_project,
    "literal_rows": q_literal_rows,
    "place_filter": q_place_filter,
    "year_range": q_year_range,
    "null_split": q_null_split,
    "require_columns": q_require_columns,
    "rename_drop_constant": q_rename_drop_constant,
    "clean_names": q_clean_names,
    "concat_pair": q_concat_pair,
    "parse_numbers": q_parse_numbers,
    "poi_text_point": q_poi_text_point,
    "poi_two_columns": q_poi_two_columns,
    "poi_mart": q_poi_mart,
    "mart_status": q_mart_status,
    "refine_batch": q_refine_batch,
    "fill_coordinates": q_fill_coordinates,
    "fill_coordinates_salted": q_fill_coordinates_salted,
    "fill_coordinates_split": q_fill_coordinates_split,
    "best_candidate": q_best_candidate,
    "fill_by_provider": q_fill_by_provider,
    "missing_count": q_missing_count,
    "silver_readback": q_silver_readback,
    "best_then_fill": q_best_then_fill,
    "word_count": q_word_count,
    "word_count_text": q_word_count_text,
    "union_harmonised": q_union_harmonised,
    "union_positional": q_union_positional,
    "replicate_average": q_replicate_average,
    "repartition_count": q_repartition_count,
    "land_once": q_land_once,
    "land_refine_mart": q_land_refine_mart,
    "external_table": q_external_table,
    "sql_limit": q_sql_limit,
}

ORACLES: dict[str, str] = {
    "price_mart": ORACLE_PRICE_MART,
    "scan_csv_strings": ORACLE_SCAN_CSV_STRINGS,
    "scan_csv_glob_years": ORACLE_SCAN_CSV_GLOB_YEARS,
    "scan_csv_inferred": ORACLE_SCAN_CSV_INFERRED,
    "scan_csv_headerless": ORACLE_SCAN_CSV_HEADERLESS,
    "scan_json_nested": ORACLE_SCAN_JSON_NESTED,
    "scan_parquet_project": ORACLE_SCAN_PARQUET_PROJECT,
    "literal_rows": ORACLE_LITERAL_ROWS,
    "place_filter": ORACLE_PLACE_FILTER,
    "year_range": ORACLE_YEAR_RANGE,
    "null_split": ORACLE_NULL_SPLIT,
    "require_columns": ORACLE_REQUIRE_COLUMNS,
    "rename_drop_constant": ORACLE_RENAME_DROP_CONSTANT,
    "clean_names": ORACLE_CLEAN_NAMES,
    "concat_pair": ORACLE_CONCAT_PAIR,
    "parse_numbers": ORACLE_PARSE_NUMBERS,
    "poi_text_point": ORACLE_POI_TEXT_POINT,
    "poi_two_columns": ORACLE_POI_TWO_COLUMNS,
    "poi_mart": ORACLE_POI_MART,
    "mart_status": ORACLE_MART_STATUS,
    "refine_batch": ORACLE_REFINE_BATCH,
    "fill_coordinates": ORACLE_FILL_COORDINATES,
    "fill_coordinates_salted": ORACLE_FILL_COORDINATES,
    "fill_coordinates_split": ORACLE_FILL_COORDINATES,
    "best_candidate": ORACLE_BEST_CANDIDATE,
    "fill_by_provider": ORACLE_FILL_BY_PROVIDER,
    "missing_count": ORACLE_MISSING_COUNT,
    "silver_readback": ORACLE_SILVER_READBACK,
    "best_then_fill": ORACLE_FILL_COORDINATES,
    "word_count": ORACLE_WORD_COUNT,
    "word_count_text": ORACLE_WORD_COUNT_TEXT,
    "union_harmonised": ORACLE_UNION_HARMONISED,
    "union_positional": ORACLE_UNION_POSITIONAL,
    "replicate_average": ORACLE_REPLICATE_AVERAGE,
    "repartition_count": ORACLE_REPARTITION_COUNT,
    "land_once": ORACLE_LAND_ONCE,
    "land_refine_mart": ORACLE_LAND_REFINE_MART,
    "external_table": ORACLE_EXTERNAL_TABLE,
    "sql_limit": ORACLE_SQL_LIMIT,
}
