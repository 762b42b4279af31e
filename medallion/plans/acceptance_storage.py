"""Acceptance queries of the storage and lookup features, with their SQL oracles (see :mod:`medallion.plans.acceptance`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import fs
from medallion.operators import geo
from medallion.operators.fuzzy import widened
from medallion.operators.lookup_tables import build_best, fill_stored, merge_best, read_best, store_best, store_transactions
from medallion.plans.acceptance import (ORACLE_BEST_CANDIDATE, ORACLE_FILL_COORDINATES, ORACLE_POI_MART, SQL_AKEY, SQL_GAZ,
                                        SQL_TX, TEST_MARTS, TX_ID, Query, _fill_input, _poi_path_of, best_gazetteer,
                                        geocode_provider, transactions_raw)
from medallion.plans.marts import build_mart
from medallion.plans.sqlsurface import create_database
from medallion.functions.columns import full_address
from medallion.session import scratch
from medallion.sinks.map_layout import read_box, write_map
from medallion.sinks.text_files import write_text_files
from medallion.sinks.writers import write_parquet
from medallion.sources.quarantine import read_checked
from medallion.sources import fixtures as fx
from medallion.sources.drift import fields, read_variant
from medallion.sources.readers import read_immutable_parquet, table
from medallion.streaming.landing import (BATCH, file_checksums, land, land_ranges, landing_report, ledger,
                                         reassembled_digests)
from medallion.streaming.provider import answers, latest

# --- K1: replacement that fails half-way ------------------------------------------------


def q_replace_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of customers. One is then overwritten by a plan that fails on a row, the other by suppliers."""
    root = scratch(spark, "replace")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    other = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    for name in ("kept", "replaced"):
        write_parquet(rows, f"{root}/{name}")
    bad = rows.withColumn("name", F.when(F.col("key") == 77, F.raise_error(F.lit("row 77"))).otherwise(F.col("name")))
    try:
        write_parquet(bad, f"{root}/kept")
        raise AssertionError("the failing plan was written")
    except Exception as e:  # noqa: BLE001 - the failure is the case
        if "row 77" not in str(e):
            raise
    write_parquet(other, f"{root}/replaced")
    return (spark.read.parquet(f"{root}/kept").withColumn("what", F.lit("kept"))
            .unionByName(spark.read.parquet(f"{root}/replaced").withColumn("what", F.lit("replaced"))))


ORACLE_REPLACE_AFTER_FAILURE = """
SELECT c_custkey AS key, c_name AS name, 'kept' AS what FROM customer
UNION ALL SELECT s_suppkey, s_name, 'replaced' FROM supplier
"""


# --- S9: ledger ---------------------------------------------------------------------------

def q_land_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landing runs with an old file, a rewritten one, a run that died before its commit and one that
    died after it; the landed rows, beside what the ledger reports."""
    root = scratch(spark, "ledger")
    bronze, checkpoint = f"{root}/bronze", f"{root}/checkpoint"
    fx.landing_stage(spark, sf_dir, root)
    schema = "doc_id bigint, text string"

    def run() -> None:
        land(spark, f"{root}/source", bronze, checkpoint, fmt="json", schema=schema)

    source = fx.landing_drop(spark, root, 1)
    fs.set_time(spark, fs.glob(spark, f"{source}/run1-*.json")[0], 0)  # as old as can be
    table(spark, sf_dir, "documents").select("doc_id", "text").write.parquet(f"{bronze}/_staged-0")  # died before its commit
    run()
    fx.landing_drop(spark, root, 2)  # with a rewritten file of run 1
    run()
    fs.rename(spark, f"{bronze}/{BATCH}=1", f"{bronze}/_staged-1")  # died after its commit
    fx.landing_drop(spark, root, 3)
    run()
    run()  # nothing new
    total = landing_report(spark, checkpoint).agg(F.sum("rows"), F.count(F.lit(1))).first()
    twice = ledger(spark, checkpoint).agg(F.count(F.lit(1)) - F.count_distinct("path")).first()
    return (spark.read.parquet(bronze).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
            .select("doc_id", "text", "copies", F.lit(total[0]).cast("long").alias("ledger_rows"),
                    F.lit(total[1]).cast("long").alias("n_batches"), F.lit(twice[0]).cast("long").alias("landed_twice")))


ORACLE_LAND_LEDGER = """
SELECT doc_id, text, CAST(1 AS BIGINT) AS copies, (SELECT count(*) FROM documents) AS ledger_rows,
       CAST(3 AS BIGINT) AS n_batches, CAST(0 AS BIGINT) AS landed_twice
FROM documents
"""


def q_land_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per language, landed as ranges of 64 KB by several tasks, checked and put together again."""
    root = scratch(spark, "ranges")
    write_text_files(table(spark, sf_dir, "documents"), "lang", ["doc_id"], "text", f"{root}/source")
    land_ranges(spark, f"{root}/source", f"{root}/bronze", f"{root}/checkpoint", range_bytes=1 << 16)
    bronze = spark.read.parquet(f"{root}/bronze")
    sums = file_checksums(bronze)
    whole = reassembled_digests(bronze).select("source_file", "sha256", F.col("crc32").alias("read_crc32"))
    name = F.regexp_extract("source_file", r"([^/]*)\.txt$", 1)
    return (sums.join(whole, "source_file")
            .select(name.alias("lang"), "n_bytes", "n_ranges", "complete", "sha256",
                    (F.col("crc32") == F.col("read_crc32")).alias("crc_agrees")))


ORACLE_LAND_RANGES = """
WITH f AS (SELECT lang, string_agg(text || chr(10), '' ORDER BY doc_id) AS t FROM documents GROUP BY lang)
SELECT lang, CAST(strlen(t) AS BIGINT) AS n_bytes, CAST((strlen(t) + 65535) // 65536 AS BIGINT) AS n_ranges, true AS complete,
       sha256(t) AS sha256, true AS crc_agrees FROM f
"""


# --- J1/J2: misspelt addresses ---------------------------------------------------------------

def q_fuzzy_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose addresses are misspelt in three ways out of four, filled from the nearest entry."""
    df = _fill_input(spark, sf_dir)
    k = F.col(TX_ID).cast("long") % 4
    a = F.col("address")
    typed = (F.when(k == 1, F.concat(F.substring(a, 1, 3), F.substr(a, F.lit(5))))
             .when(k == 2, F.replace(a, F.lit("RUE"), F.lit("RVE")))
             .when(k == 3, F.substr(F.replace(a, F.lit("RUE"), F.lit("RRUE")), F.lit(1), F.length(a)))
             .otherwise(a))
    df = df.withColumn("address", typed)
    filled = geo.fill_coordinates(df, widened(df, best_gazetteer(spark, sf_dir), "address"), "address")
    return filled.select(TX_ID, "address", "latitude", "longitude")


ORACLE_FUZZY_FILL = f"""
WITH {SQL_TX}, {SQL_GAZ},
a AS (SELECT *, {SQL_AKEY} AS akey0 FROM tx),
t AS (SELECT doc_id, lat0, lon0, CASE k % 4 WHEN 1 THEN left(akey0, 3) || substr(akey0, 5) WHEN 2 THEN replace(akey0, 'RUE', 'RVE')
        WHEN 3 THEN left(replace(akey0, 'RUE', 'RRUE'), length(akey0)) ELSE akey0 END AS address FROM a),
u AS (SELECT DISTINCT address FROM t WHERE lat0 IS NULL),
m AS (SELECT address, latitude, longitude FROM (
  SELECT u.address, b.latitude, b.longitude, row_number() OVER (PARTITION BY u.address
           ORDER BY levenshtein(u.address, b.akey), b.score IS NULL, b.score DESC, b.latitude, b.longitude, b.akey) AS rn
  FROM u JOIN best b ON abs(length(u.address) - length(b.akey)) <= 2 AND levenshtein(u.address, b.akey) <= 2) WHERE rn = 1)
SELECT doc_id AS "Identifiant de document", t.address, coalesce(lat0, m.latitude) AS latitude, coalesce(lon0, m.longitude) AS longitude
FROM t LEFT JOIN m ON m.address = t.address
"""

# --- S1, S2: bad lines and files -----------------------------------------------------------------

SALES = ("order", "customer", "price")


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four order files, one with another header; every tenth line has a field too many, every tenth one too few."""
    root = scratch(spark, "quarantine")
    key = F.col("o_orderkey")
    cells = [key.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    line = (F.when(key % 10 == 7, F.concat_ws(";", *cells, F.lit("more"))).when(key % 10 == 8, F.concat_ws(";", *cells[:2]))
            .otherwise(F.concat_ws(";", *cells)))
    rows = table(spark, sf_dir, "orders").select((key % 4).alias("part"), key.alias("at"), line.alias("value"))
    heads = spark.createDataFrame([(p, -1, ";".join(SALES if p < 3 else SALES[::-1])) for p in range(4)], "part bigint, at bigint, value string")
    write_text_files(rows.unionByName(heads), "part", ["at"], "value", f"{root}/in")
    got = read_checked(spark, f"{root}/in/*.txt", SALES)
    write_parquet(got.good, f"{root}/good")
    write_parquet(got.bad, f"{root}/bad")
    part = F.regexp_extract("source_file", r"/(\d)\.txt$", 1).cast("int").alias("part")
    none = F.lit(None).cast("string")
    return (spark.read.parquet(f"{root}/good").select(part, *SALES, F.lit(None).cast("long").alias("line"), none.alias("reason"), none.alias("text"))
            .unionByName(spark.read.parquet(f"{root}/bad").select(part, *[none.alias(c) for c in SALES], "line", "reason", "text")))


ORACLE_CSV_QUARANTINE = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(o_orderkey % 4 AS INTEGER) AS part,
             1 + row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) AS line FROM orders)
SELECT part, CAST(k AS VARCHAR) AS "order", CAST(c AS VARCHAR) AS customer, s AS price, CAST(NULL AS BIGINT) AS line,
       CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS text FROM o WHERE part < 3 AND k % 10 NOT IN (7, 8)
UNION ALL
SELECT part, NULL, NULL, NULL, line, 'fields', k || ';' || c || CASE WHEN k % 10 = 7 THEN ';' || s || ';more' ELSE '' END
FROM o WHERE part < 3 AND k % 10 IN (7, 8)
UNION ALL
SELECT DISTINCT part, NULL, NULL, NULL, 1, 'header', 'price;customer;order' FROM o WHERE part = 3
"""

# --- J1, J2: stored lookup tables -----------------------------------------------------------------

def q_best_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base list's best candidates, then the survey's in two deltas: the table as it stands after them."""
    gaz = read_immutable_parquet(spark, fx.gazetteer(spark, sf_dir))
    path = f"{scratch(spark, 'best-merge')}/best"
    build_best(gaz.filter("provider = 'base'"), path, parts=16)
    survey = gaz.filter("provider <> 'base'")
    half = F.pmod(F.xxhash64("address", "latitude"), F.lit(2))
    for k in (0, 1):
        merge_best(survey.filter(half == k), path)
    return read_best(spark, path)


def q_fill_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 between two stored, bucketed tables: no exchange when it is read."""
    root = scratch(spark, "bucketed")
    db = f"medallion_{root.rsplit('-', 1)[1]}"
    create_database(spark, db, f"{root}/db")
    df = _fill_input(spark, sf_dir).select(F.col(TX_ID).alias("doc_id"), "address", "latitude", "longitude")
    store_transactions(df, f"{db}.transactions", f"{root}/transactions", "address", 8, spread_by=["doc_id"])
    store_best(best_gazetteer(spark, sf_dir), f"{db}.best", f"{root}/best", 8)
    return (fill_stored(spark, f"{db}.transactions", f"{db}.best")
            .select(F.col("doc_id").alias(TX_ID), "address", "latitude", "longitude"))


# --- Q6: points for a map --------------------------------------------------------------------------

BOX = (48.25, 2.1, 48.5, 2.4)  # south, west, north, east


def q_mart_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points mart written along a space-filling curve, and a bounding box read from it."""
    mart, _, _ = build_mart(spark, "dm_points", TEST_MARTS["dm_points"], _poi_path_of(spark, sf_dir), read_immutable_parquet)
    path = f"{scratch(spark, 'map')}/dm_points"
    write_map(mart, path, files=32)
    return read_box(spark, path, *BOX)


ORACLE_MART_BBOX = f"""
SELECT * FROM ({ORACLE_POI_MART}) WHERE latitude BETWEEN {BOX[0]} AND {BOX[2]} AND longitude BETWEEN {BOX[1]} AND {BOX[3]}
"""


# --- S5: fields that change type ---------------------------------------------------------------------

def q_json_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines whose value is a number, a text, an object or absent by turns, with lines that are no JSON."""
    path = f"{scratch(spark, 'drift')}/events"
    k, v = F.col("event_id"), F.col("value").cast("string")
    body = (F.when(k % 4 == 0, F.concat(F.lit('"value": '), v)).when(k % 4 == 1, F.concat(F.lit('"value": "'), v, F.lit('"')))
            .when(k % 4 == 2, F.concat(F.lit('"value": {"amount": '), v, F.lit("}"))).otherwise(F.lit('"other": null')))
    line = F.when(k % 97 == 5, F.lit("{not json")).otherwise(
        F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "kind": "'), F.col("event_type"), F.lit('", '), body, F.lit("}")))
    table(spark, sf_dir, "events").select((k % 4).alias("part"), line.alias("text")).write.partitionBy("part").text(path)
    return fields(read_variant(spark, path), {"id": ("bigint", ["$.id"]), "kind": ("string", ["$.kind"]),
                                              "amount": ("double", ["$.value", "$.value.amount"])}).drop("source_file")


ORACLE_JSON_DRIFT = """
SELECT CASE WHEN event_id % 97 <> 5 THEN event_id END AS id, CASE WHEN event_id % 97 <> 5 THEN event_type END AS kind,
       CASE WHEN event_id % 97 <> 5 AND event_id % 4 < 3 THEN value END AS amount, event_id % 97 <> 5 AS is_json
FROM events
"""


# --- D1: answers kept across micro-batches -------------------------------------------------------------

def q_provider_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without coordinates in three files, streamed one a batch: each address is asked once."""
    root = scratch(spark, "provider-stream")
    tx = transactions_raw(spark, sf_dir, with_coords=False)
    address = full_address(["No voie", "Type de voie", "Voie", "Code postal"], "PARIS")
    rows = tx.select(address.alias("address"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    write_parquet(rows.repartition(3), f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    asked = answers(stream, geocode_provider, "address")
    q = (asked.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .outputMode("append").start(f"{root}/answers"))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    got = spark.read.parquet(f"{root}/answers")
    calls = got.groupBy("address_key").agg(F.count(F.lit(1)).alias("calls"))
    return latest(got).drop("asked_at").join(calls, "address_key")


ORACLE_PROVIDER_STREAM = f"""
WITH {SQL_TX},
a AS (SELECT DISTINCT {SQL_AKEY} AS address_key, num, c % 25 AS nation, postcode FROM tx),
k AS (SELECT *, num IS NOT NULL AND starts_with(postcode, '75') AND nation % 7 <> 3 AND NOT (num = '4' AND nation = 13) AS known FROM a)
SELECT address_key, CASE WHEN known THEN 48 + nation / 64 END AS latitude, CASE WHEN known THEN 2 + CAST(num AS INTEGER) / 64 END AS longitude,
       CASE WHEN known THEN 'found' WHEN num = '4' AND nation = 13 AND starts_with(postcode, '75') THEN 'failed' ELSE 'unknown' END AS outcome,
       CAST(1 AS BIGINT) AS calls FROM k
"""

QUERIES: dict[str, Query] = {
    "replace_after_failure": q_replace_after_failure,
    "land_ledger": q_land_ledger,
    "land_ranges": q_land_ranges,
    "fuzzy_fill": q_fuzzy_fill,
    "csv_quarantine": q_csv_quarantine,
    "best_merge": q_best_merge,
    "fill_bucketed": q_fill_bucketed,
    "mart_bbox": q_mart_bbox,
    "json_drift": q_json_drift,
    "provider_stream": q_provider_stream,
}

ORACLES: dict[str, str] = {
    "replace_after_failure": ORACLE_REPLACE_AFTER_FAILURE,
    "land_ledger": ORACLE_LAND_LEDGER,
    "land_ranges": ORACLE_LAND_RANGES,
    "fuzzy_fill": ORACLE_FUZZY_FILL,
    "csv_quarantine": ORACLE_CSV_QUARANTINE,
    "best_merge": ORACLE_BEST_CANDIDATE,
    "fill_bucketed": ORACLE_FILL_COORDINATES,
    "mart_bbox": ORACLE_MART_BBOX,
    "json_drift": ORACLE_JSON_DRIFT,
    "provider_stream": ORACLE_PROVIDER_STREAM,
}
