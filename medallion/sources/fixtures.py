"""Derived input sets (FIXTURES.md part C) written by Spark from the driver tables.

The reference reads open-data files that are not shipped; these sets stand in
for them. Each is a deterministic function of one driver table, so an SQL
engine can state the expected result directly over that table. Every set is
written by a Spark job (no row passes through the driver) into the shared
workspace, once per scale-factor folder and fixture version, then reused.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import fs
from medallion.session import workspace
from medallion.sources.readers import table

# Bump when a builder changes so stale copies are not reused.
FIXTURE_VERSION = "v5"


def fixture_root(spark: SparkSession, sf_dir: str) -> str:
    tag = re.sub(r"[^A-Za-z0-9.]+", "_", sf_dir.rstrip("/").split("/")[-1])
    digest = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:8]
    return f"{workspace(spark)}/medallion/fixtures/{FIXTURE_VERSION}/{tag}-{digest}"


def _ensure(spark: SparkSession, sf_dir: str, name: str,
            build: Callable[[str], None]) -> str:
    """Build ``name`` once into a private folder, then publish it by rename."""
    final = f"{fixture_root(spark, sf_dir)}/{name}"
    if fs.exists(spark, f"{final}/_READY"):
        return final
    staging = f"{fixture_root(spark, sf_dir)}/_staging/{name}-{uuid.uuid4().hex[:10]}"
    build(staging)
    fs.touch(spark, f"{staging}/_READY")
    try:
        fs.rename(spark, staging, final)
    except OSError:
        # Another job published the same set first; theirs is identical.
        if not fs.exists(spark, f"{final}/_READY"):
            raise
    return final


def _write_by_folder(spark: SparkSession, df: DataFrame, folder_col: str, staging: str,
                     final_root: str, ext: str, **csv_options: str) -> None:
    """Write ``df`` split by ``folder_col`` as ``<folder>/<folder>-NNNNN.<ext>``.

    One partitioned write (a single pass over the input); the per-folder file
    names are then set by metadata-only renames.
    """
    writer = df.write.partitionBy(folder_col)
    for k, v in csv_options.items():
        writer = writer.option(k, v)
    writer.csv(staging)
    for path in fs.glob(spark, f"{staging}/{folder_col}=*/part-*"):
        folder = path.split(f"{folder_col}=")[-1].split("/")[0]
        part = re.search(r"part-(\d+)", path.split("/")[-1]).group(1)
        fs.rename(spark, path, f"{final_root}/{folder}/{folder}-{part}.{ext}")


# --- C1: transactions, `;` CSV by year ------------------------------------

def transactions_frame(spark: SparkSession, sf_dir: str, with_coords: bool = True) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m = k % 10
    dept = (F.lit(60) + F.col("o_custkey") % 20).cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    cols = [
        k.cast("string").alias("Identifiant de document"),
        F.when(m == 2, F.lit("31/13/1997"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Date mutation"),
        F.when(m == 3, F.regexp_replace(price, r"\.", ","))
         .when(m == 4, F.lit(None).cast("string"))
         .otherwise(price).alias("Valeur fonciere"),
        F.when(m == 5, F.lit(None).cast("string"))
         .otherwise((k % 5).cast("string")).alias("No voie"),
        F.lit("RUE").alias("Type de voie"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("Voie"),
        F.when(m == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(dept, F.lit("001"))).alias("Code postal"),
        F.when(m == 0, F.lit(None).cast("string")).otherwise(dept).alias("Code departement"),
        (k % 200).cast("string").alias("Surface reelle bati"),
        F.col("o_orderpriority").alias("Type local"),
    ]
    if with_coords:
        has = k % 3 == 0
        cols += [
            F.when(has, (F.lit(48.5) + (F.col("o_custkey") % 32) / 64).cast("string")).alias("latitude"),
            F.when(has, (F.lit(2.5) + (k % 16) / 64).cast("string")).alias("longitude"),
        ]
    cols.append(F.concat(F.lit("Orders-"), F.year("o_orderdate").cast("string")).alias("_folder"))
    return o.select(*cols)


def transactions(spark: SparkSession, sf_dir: str, with_coords: bool = True) -> str:
    """Root of ``Orders-YYYY/Orders-YYYY-NNNNN.csv``; glob it with :data:`TRANSACTION_GLOB`."""
    name = "transactions" if with_coords else "transactions_nocoords"

    def build(staging: str) -> None:
        df = transactions_frame(spark, sf_dir, with_coords)
        _write_by_folder(spark, df, "_folder", staging + "/_parts", staging, "csv",
                         header="true", sep=";")

    return _ensure(spark, sf_dir, name, build)


TRANSACTION_GLOB = "Orders-*/Orders-*.csv"
# The column names of the transaction files.
TRANSACTION_COLUMNS = (
    "Identifiant de document", "Date mutation", "Valeur fonciere", "No voie", "Type de voie", "Voie",
    "Code postal", "Code departement", "Surface reelle bati", "Type local",
)


# --- C2: gazetteer -----------------------------------------------------------

def gazetteer_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address candidates from two providers: a base list and a survey list.

    Base: nation x house numbers 0..4, one row per address, nations with
    key % 7 = 3 left out; key % 5 = 0 adds a lower-scored second row, key % 5 = 1
    an equal-scored one, both 1/64 further north. Survey: one candidate per
    supplier, written with irregular spacing and case, so that keys must be
    normalised; every tenth has no score. The survey grows with the data.
    """
    n = (table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 7 != 3)
         .withColumn("num", F.explode(F.sequence(F.lit(0), F.lit(4)))))
    addr = F.concat_ws(" ", F.col("num").cast("string"), F.lit("RUE"), F.col("n_name"),
                       F.lit("75001"), F.lit("PARIS"))
    base = n.select(addr.alias("address"),
                    (F.lit(48.0) + F.col("n_nationkey") / 64).alias("latitude"),
                    (F.lit(2.0) + F.col("num") / 64).alias("longitude"),
                    F.lit(1.0).alias("score"), F.lit("base").alias("provider"))
    second = (n.filter(F.col("n_nationkey") % 5 <= 1)
              .select(addr.alias("address"),
                      (F.lit(48.0) + F.col("n_nationkey") / 64 + F.lit(1 / 64)).alias("latitude"),
                      (F.lit(2.0) + F.col("num") / 64).alias("longitude"),
                      F.when(F.col("n_nationkey") % 5 == 0, F.lit(0.5)).otherwise(F.lit(1.0)).alias("score"),
                      F.lit("base").alias("provider")))
    s = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") % 7 != 3)
    survey = s.select(
        F.concat((F.col("s_suppkey") % 5).cast("string"), F.lit("  rue nation_"),
                 F.col("s_nationkey").cast("string"), F.lit(" 75001 paris ")).alias("address"),
        (F.lit(48.0) + F.col("s_nationkey") / 64 + (F.col("s_suppkey") % 3) / 128).alias("latitude"),
        (F.lit(2.0) + (F.col("s_suppkey") % 5) / 64).alias("longitude"),
        F.when(F.col("s_suppkey") % 10 == 9, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("s_acctbal") / 2000) / 4).alias("score"),
        F.lit("survey").alias("provider"))
    return base.unionByName(second).unionByName(survey)


def gazetteer(spark: SparkSession, sf_dir: str) -> str:
    return _ensure(spark, sf_dir, "gazetteer",
                   lambda p: gazetteer_frame(spark, sf_dir).write.parquet(p))


def gazetteer_best(spark: SparkSession, sf_dir: str) -> str:
    """The gazetteer reduced to one candidate per address, stored (J2 output)."""
    from medallion.operators.geo import best_candidates

    return _ensure(spark, sf_dir, "gazetteer_best",
                   lambda p: best_candidates(spark.read.parquet(gazetteer(spark, sf_dir))).write.parquet(p))


# --- C3-C8: point-of-interest sources (Parquet) ------------------------------

def _num(c) -> F.Column:
    return c.cast("string")


def poi_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = table(spark, sf_dir, "customer")
    m = F.col("c_custkey") % 10
    lat = F.lit(48.0) + (F.col("c_custkey") % 128) / 128
    lon = F.lit(2.0) + F.col("c_nationkey") / 64
    customer_points = c.select(
        "c_custkey", "c_name",
        F.when(m == 0, F.lit(None).cast("string"))
         .when(m == 1, _num(lat))
         .when(m == 2, F.lit("n/a, n/a"))
         .otherwise(F.concat(_num(lat), F.lit(", "), _num(lon))).alias("Geo_Point"))
    s = table(spark, sf_dir, "supplier")
    supplier_points = s.select(
        "s_suppkey", "s_name",
        F.concat(_num(F.lit(48.0) + (F.col("s_suppkey") % 64) / 64), F.lit(", "),
                 _num(F.lit(2.0) + F.col("s_nationkey") / 32)).alias("geo_point_2d"))
    n = table(spark, sf_dir, "nation")
    nation_points = n.select(
        "n_nationkey", "n_name",
        F.concat(_num(F.lit(48.0) + F.col("n_nationkey") / 64), F.lit(","),
                 _num(F.lit(2.0) + F.col("n_regionkey") / 8)).alias("coordonnees"))
    p = table(spark, sf_dir, "part")
    pm = F.col("p_partkey") % 10
    part_points = p.select(
        "p_partkey", "p_name",
        F.when(pm == 0, F.lit(None).cast("string"))
         .otherwise(_num(F.lit(48.0) + F.col("p_size") / 64)).alias("Latitude"),
        F.when(pm == 1, F.lit(None).cast("string"))
         .otherwise(_num(F.lit(2.0) + (F.col("p_partkey") % 64) / 64)).alias("Longitude"))
    region_nocoords = table(spark, sf_dir, "region")
    e = table(spark, sf_dir, "events")
    events_struct = e.select("event_id", F.struct(
        (F.lit(48.0) + F.col("value") / 1000).alias("lat"),
        (F.lit(2.0) + (F.col("user_id") % 64) / 64).alias("lon")).alias("geo_point_2d"))
    events_binary = e.select("event_id", F.concat(
        _num(F.lit(48.0) + F.col("value") / 1000), F.lit(", "),
        _num(F.lit(2.0) + (F.col("user_id") % 64) / 64)).cast("binary").alias("geo_point_2d"))
    return {
        "customer_points": customer_points,
        "supplier_points": supplier_points,
        "nation_points": nation_points,
        "part_points": part_points,
        "region_nocoords": region_nocoords,
        "events_struct": events_struct,
        "events_binary": events_binary,
    }


def poi_sources(spark: SparkSession, sf_dir: str) -> str:
    """Folder holding one ``<name>.parquet`` set per point source."""
    def build(staging: str) -> None:
        for name, df in poi_frames(spark, sf_dir).items():
            df.write.parquet(f"{staging}/{name}.parquet")

    return _ensure(spark, sf_dir, "poi_sources", build)


# --- C9: nested JSON ---------------------------------------------------------

def nested_json(spark: SparkSession, sf_dir: str) -> str:
    def build(staging: str) -> None:
        e = table(spark, sf_dir, "events")
        m = F.col("event_id") % 10
        fields = F.struct(
            F.col("event_id").alias("id"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("premise_name"),
            F.lit("NC").alias("premise_state"),
            F.concat((F.col("user_id") % 100).cast("string"), F.lit(" Oak Ave")).alias("premise_address1"),
            F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("Suite "), (F.col("event_id") % 7).cast("string")))
             .alias("premise_address2"),
            F.lit("Durham").alias("premise_city"),
            (F.lit(27700) + F.col("user_id") % 10).cast("string").alias("premise_zip"),
            F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("919-"), F.col("event_id").cast("string")))
             .alias("premise_phone"),
            F.date_format("ts", "yyyy-MM-dd").alias("opening_date"),
            F.when(m == 1, F.col("event_type"))
             .otherwise(F.concat((F.col("user_id") % 10).cast("string"), F.lit(" - "),
                                 F.col("event_type"))).alias("type_description"),
            F.when(m == 0, F.lit(None).cast("array<double>"))
             .otherwise(F.array(F.col("value"), F.col("user_id").cast("double"))).alias("geolocation"))
        (e.select(fields.alias("fields"),
                  F.struct(F.lit("Point").alias("type")).alias("geometry"),
                  F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("record_timestamp"),
                  F.col("event_id").cast("string").alias("recordid"))
          .write.json(staging + "/data"))

    return _ensure(spark, sf_dir, "nested_json", build) + "/data"


# --- C10: comma text with the header line as data ----------------------------

BREWERY_STYLE_HEADER = "num,name,segment,balance,id"


def headerless_csv(spark: SparkSession, sf_dir: str) -> str:
    """Customer as comma text with exactly one header line stored as data.

    The data files are written without headers by a parallel write; the single
    header line is its own small file, so the set has one header row however
    many part files there are.
    """
    def build(staging: str) -> None:
        c = table(spark, sf_dir, "customer")
        (c.select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment",
                  F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
                  F.col("c_nationkey").cast("string"))
          .write.option("header", "false").csv(staging + "/data"))
        fs.touch(spark, staging + "/data/000-header.csv", BREWERY_STYLE_HEADER + "\n")

    return _ensure(spark, sf_dir, "headerless_csv", build) + "/data"


# --- customer and part as CSV with headers (S3, Q7, Q8) ----------------------

def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    return _ensure(spark, sf_dir, "customer_csv",
                   lambda p: table(spark, sf_dir, "customer").write.option("header", "true").csv(p))


def rates_csv(spark: SparkSession, sf_dir: str) -> str:
    """Confidence-limit table derived from part, with blank-separated names."""
    def build(staging: str) -> None:
        p = table(spark, sf_dir, "part")
        (p.select(F.col("p_partkey").alias("Year"), F.col("p_brand").alias("State"),
                  (F.col("p_retailprice") - F.col("p_size")).alias("Lower Confidence Limit"),
                  (F.col("p_retailprice") + F.col("p_size")).alias("Upper Confidence Limit"))
          .write.option("header", "true").csv(staging))

    return _ensure(spark, sf_dir, "rates_csv", build)


# --- C11: names that need cleaning; stations CSV ------------------------------

def messy_names(spark: SparkSession, sf_dir: str) -> str:
    """Parquet sets with names holding blanks and hyphens, and a colliding pair."""
    def build(staging: str) -> None:
        p = table(spark, sf_dir, "part")
        p.select("p_partkey", F.col("p_name").alias("x y"), F.col("p_brand").alias("x-z")) \
            .write.parquet(f"{staging}/part_names.parquet")
        p.select("p_partkey", F.col("p_type").alias("a b"), F.col("p_size").alias("a_b")) \
            .write.parquet(f"{staging}/part_collision.parquet")
        table(spark, sf_dir, "region").write.parquet(f"{staging}/region.parquet")

    return _ensure(spark, sf_dir, "messy_names", build)


def stations_csv(spark: SparkSession, sf_dir: str) -> str:
    """Supplier as a `;` CSV station list with a point column and hyphenated names."""
    def build(staging: str) -> None:
        s = table(spark, sf_dir, "supplier")
        (s.select(F.col("s_name").alias("Nom gare"),
                  F.col("s_suppkey").cast("string").alias("Code (UIC)"),
                  F.concat(_num(F.lit(48.0) + (F.col("s_suppkey") % 64) / 64), F.lit(", "),
                           _num(F.lit(2.0) + F.col("s_nationkey") / 32)).alias("geo_point_2d"),
                  F.col("s_nationkey").cast("string").alias("Code-Region"))
          .write.option("header", "true").option("sep", ";").csv(staging))

    return _ensure(spark, sf_dir, "stations_csv", build)


# --- text lines (S10, A3) -------------------------------------------------------

def documents_text(spark: SparkSession, sf_dir: str) -> str:
    """The ``documents`` texts as plain text files, written in parallel."""
    return _ensure(spark, sf_dir, "documents_text",
                   lambda p: table(spark, sf_dir, "documents").select("text").write.text(p))


# --- C12: files arriving over several runs ---------------------------------------

def landing_stage(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the files of all landing runs in one partitioned job.

    Run r holds the documents with doc_id % 3 = r - 1 as JSON; part ``rewrite``
    holds altered texts of run 1's documents, used to rewrite a run-1 file
    under its own name. :func:`landing_drop` then only moves files.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = docs.withColumn("_run", (F.col("doc_id") % 3 + 1).cast("string"))
    rewrite = (docs.filter(F.col("doc_id") % 3 == 0)
               .select("doc_id", F.upper("text").alias("text"), F.lit("rewrite").alias("_run")))
    staging = f"{root}/_staging"
    runs.unionByName(rewrite).write.partitionBy("_run").json(staging)
    return staging


def landing_drop(spark: SparkSession, root: str, run: int) -> str:
    """Move the files of landing run ``run`` (1, 2, 3) into ``<root>/source``.

    Files are named ``run<r>-NNNNN.json``. Run 2 also rewrites the first file
    of run 1 under the same name with altered texts, which landing must ignore.
    """
    source_dir = f"{root}/source"
    staging = f"{root}/_staging"
    for path in fs.glob(spark, f"{staging}/_run={run}/part-*.json"):
        part = re.search(r"part-(\d+)", path.split("/")[-1]).group(1)
        fs.rename(spark, path, f"{source_dir}/run{run}-{part}.json")
    if run == 2:
        first = fs.glob(spark, f"{source_dir}/run1-*.json")[0]
        src = fs.glob(spark, f"{staging}/_run=rewrite/part-*.json")[0]
        fs.rename(spark, src, first, overwrite=True)
    return source_dir
