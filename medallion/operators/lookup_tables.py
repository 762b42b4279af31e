"""Stored forms of the lookup (J1, J2): a best-candidate table that takes deltas, and bucketed tables that join in place.

*Kept up to date.* :func:`build_best` writes one row per address in folders by a hash of the key; :func:`merge_best` takes new
candidates. The best of old and new candidates is the best of the old best and the new ones, so a merge reads and rewrites
only the folders that the delta's keys fall into, each by one crash-safe replacement. A merge that dies half-way has updated some
folders; running it again gives the same table, since merging is idempotent.

*Joined in place.* :func:`store_transactions` and :func:`store_best` write tables bucketed and sorted by the lookup key.
:func:`fill_stored` then joins bucket by bucket without moving a row: for tables that are filled again and again,
the shuffle is paid once, when they are written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import fs
from medallion.functions.columns import address_key
from medallion.operators.geo import KEY, best_candidates, lookup_key
from medallion.operators.names import quoted_name
from medallion.sinks.replace import replace, settle

PART = "key_part"
_ROW = f"{KEY} string, latitude double, longitude double, score double"


def _parted(best: DataFrame, parts: int) -> DataFrame:
    typed = best.select(KEY, *(F.col(c).cast("double").alias(c) for c in ("latitude", "longitude", "score")))
    return typed.withColumn(PART, F.pmod(F.xxhash64(KEY), F.lit(parts)).cast("int"))


def _folder(path: str, part: int) -> str:
    return f"{path.rstrip('/')}/{PART}={part}"


def build_best(gazetteer: DataFrame, path: str, parts: int = 256, **cols: str) -> None:
    """Writes the best candidates of ``gazetteer`` (see ``geo.best_candidates``) into ``parts`` folders."""
    rows = _parted(best_candidates(gazetteer, **cols), parts).repartition(PART)

    def write(folder: str) -> None:
        rows.write.partitionBy(PART).parquet(folder)
        fs.touch(gazetteer.sparkSession, f"{folder}/_parts", str(parts))

    replace(gazetteer.sparkSession, path, write)


def read_best(spark: SparkSession, path: str) -> DataFrame:
    """The table: address_key, latitude, longitude, score."""
    settle(spark, path)
    for left in fs.glob(spark, f"{path.rstrip('/')}/.{PART}=*.commit"):
        settle(spark, _folder(path, int(left.split(f"{PART}=")[-1].split(".")[0])))
    return spark.read.schema(f"{_ROW}, {PART} int").parquet(path).drop(PART)


def merge_best(delta: DataFrame, path: str, **cols: str) -> list[int]:
    """Takes the candidates of ``delta`` into the table; returns the folders that were rewritten."""
    spark = delta.sparkSession
    path = path.rstrip("/")
    parts = int(fs.read_text(spark, f"{path}/_parts") or 0)
    if not parts:
        raise FileNotFoundError(f"{path} is not a table of build_best")
    read_best(spark, path)  # settles what a dead merge left
    new = f"{path}/_delta-{uuid.uuid4().hex[:12]}"
    try:
        _parted(best_candidates(delta, **cols), parts).write.partitionBy(PART).parquet(f"{new}/candidates")
        fresh = spark.read.schema(f"{_ROW}, {PART} int").parquet(f"{new}/candidates")
        touched = sorted(int(p.rsplit("=", 1)[1]) for p in fs.glob(spark, f"{new}/candidates/{PART}=*"))
        old = spark.read.schema(f"{_ROW}, {PART} int").parquet(path).filter(F.col(PART).isin(touched))  # only these folders are read
        both = best_candidates(old.drop(PART).unionByName(fresh.drop(PART)), address_col=KEY)
        _parted(both, parts).repartition(PART).write.partitionBy(PART).parquet(f"{new}/merged")
        def publish(part: int) -> None:
            replace(spark, _folder(path, part), lambda folder: fs.rename(spark, f"{new}/merged/{PART}={part}", folder))

        with ThreadPoolExecutor(max_workers=8) as pool:  # metadata calls only
            list(pool.map(publish, touched))
    finally:
        fs.delete(spark, new)
    return touched


# --- bucketed tables ---------------------------------------------------------------------

LOOKUP = "lookup_key"


def _bucketed(df: DataFrame, table: str, path: str, buckets: int, mode: str) -> None:
    (df.repartition(buckets, LOOKUP).write.mode(mode).bucketBy(buckets, LOOKUP).sortBy(LOOKUP)
     .option("path", path).saveAsTable(quoted_name(table)))


def store_transactions(df: DataFrame, table: str, path: str, address: str | Column, buckets: int,
                       lat_col: str = "latitude", lon_col: str = "longitude", spread_by: Sequence[str] | None = None) -> None:
    """Writes ``df`` as the table ``db.table`` at ``path``, bucketed by the key under which it will be looked up. Rows that
    need no lookup, or have no address, are spread over the buckets (``spread_by``: a record id)."""
    addr = F.col(address) if isinstance(address, str) else address
    _bucketed(df.withColumn(LOOKUP, lookup_key(address_key(addr), lat_col, lon_col, spread_by)), table, path, buckets, "overwrite")


def store_best(best: DataFrame, table: str, path: str, buckets: int) -> None:
    """Writes a one-row-per-address table with the same buckets."""
    _bucketed(best.withColumn(LOOKUP, F.col(KEY)), table, path, buckets, "overwrite")


def fill_stored(spark: SparkSession, transactions: str, best: str, lat_col: str = "latitude",
                lon_col: str = "longitude") -> DataFrame:
    """Missing coordinates filled by joining the two stored tables, bucket by bucket, without an exchange."""
    left = spark.table(quoted_name(transactions))
    right = spark.table(quoted_name(best)).select(LOOKUP, F.col("latitude").alias("_g_lat"), F.col("longitude").alias("_g_lon"))
    return (left.join(right.hint("merge"), LOOKUP, "left")
            .withColumns({lat_col: F.coalesce(F.col(lat_col), F.col("_g_lat")), lon_col: F.coalesce(F.col(lon_col), F.col("_g_lon"))})
            .drop("_g_lat", "_g_lon", LOOKUP))
