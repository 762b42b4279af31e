"""The data jobs of the open-data map stack, end to end.

``silver_job``: transactions CSV set, station CSV and the Parquet sets to
silver Parquet. ``gold_job``: price mart and the four labelled point marts.
Folder layout under ``data_root``:
``<dataset>/<dataset>.<ext>`` for sources, or landed tables ``<bronze>/<dataset>``; ``silver/`` and ``gold/`` for outputs.
Both return status tables instead of printing and going on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion import fs
from medallion.functions.columns import full_address
from medallion.operators import geo
from medallion.operators.fuzzy import widened
from medallion.operators.metrics import observed
from medallion.plans.marts import (PARIS_MARTS, PARIS_SILVER_PARQUET, PARIS_STATIONS_CSV, PRICE_MART,
                                   paris_path_of, price_mart, run_marts)
from medallion.plans.refine import (ADDRESS_PARTS, CITY_SUFFIX, RefineReport, error_text, run_refine_batch,
                                    run_refine_transactions, stage_transactions, transactions_needing_fill)
from medallion.sinks.replace import settle
from medallion.sinks.writers import write_parquet
from medallion.sources.readers import read_delimited
from medallion.streaming.landing import PROVENANCE

# Where the transaction files sit and what the silver set is called.
TRANSACTIONS_GLOB = "ValeursFoncieres-*/ValeursFoncieres-*.csv"
TRANSACTIONS_SILVER = "dvf_paris_2021_2025"
BRONZE_TRANSACTIONS = "transactions"  # the landed transactions' table under a bronze folder


@dataclass
class SilverResult:
    transactions: RefineReport | None
    status: DataFrame


def silver_job(spark: SparkSession, data_root: str, gazetteer: DataFrame | None = None,
               provider=None, code: str = "75", years: tuple[int, int] = (2021, 2025),
               datasets: Sequence[str] = PARIS_SILVER_PARQUET,
               stations: str | None = PARIS_STATIONS_CSV,
               transactions_glob: str = TRANSACTIONS_GLOB,
               transactions: DataFrame | None = None, max_parallel: int = 4,
               provider_cache: str | None = None, bronze: str | None = None,
               max_calls: int | None = None, transaction_schema: StructType | None = None,
               quarantine: bool = False, fuzzy_edits: int = 0) -> SilverResult:
    """All silver refinements. ``gazetteer`` (address, latitude, longitude,
    score) fills missing coordinates by join; ``provider`` (a batch function,
    see ``geo.resolve_with_provider``) is the alternative for an external
    service. Without either, rows keep the coordinates they came with.
    ``transactions`` replaces the CSV glob with an already landed table (the
    bronze Parquet written by ``streaming.landing.land`` with ``fmt="csv"``).
    ``bronze`` is a folder of landed tables, one per dataset: where
    ``<bronze>/<dataset>`` exists it is read instead of the files under
    ``data_root``; the transactions' is ``<bronze>/BRONZE_TRANSACTIONS``.
    ``quarantine`` (with ``transaction_schema``, for the CSV files) puts lines and files that don't fit into
    ``silver/_quarantine_transactions.parquet``. ``fuzzy_edits`` lets an address that the gazetteer lacks take
    the entry within so many edits (``operators.fuzzy``)."""
    root = data_root.rstrip("/")
    landed = bronze.rstrip("/") if bronze else None
    if landed and transactions is None and fs.exists(spark, f"{landed}/{BRONZE_TRANSACTIONS}"):
        transactions = spark.read.parquet(f"{landed}/{BRONZE_TRANSACTIONS}")
    best = (geo.prepare_best_candidates(gazetteer, f"{root}/silver/gazetteer_best.parquet")
            if gazetteer is not None else None)
    report = answers = failed = None
    glob = f"{root}/{transactions_glob}"
    source = transactions if transactions is not None else (glob if fs.glob(spark, glob) else None)
    if source is not None:
        if best is None and provider is not None:
            raw = transactions if transactions is not None else read_delimited(spark, glob, sep=";")
            # one scan of the full input; both steps below read the filtered slice
            source = stage_transactions(raw.drop(*PROVENANCE),
                                        f"{root}/silver/_staged_transactions.parquet", code, years)
            need = transactions_needing_fill(source, code, years)
            need = need.withColumn("_addr", full_address(list(ADDRESS_PARTS), CITY_SUFFIX))
            answers = geo.ask_provider(need, provider, "_addr",
                                       resolved_path=f"{root}/silver/_resolved_addresses.parquet",
                                       cache_path=provider_cache, max_calls=max_calls)
            best = answers.table
        try:
            if fuzzy_edits and gazetteer is not None:
                raw = source if isinstance(source, DataFrame) else read_delimited(spark, source, sep=";", schema=transaction_schema)
                need = transactions_needing_fill(raw.drop(*PROVENANCE), code, years)
                best = widened(need, best, full_address(list(ADDRESS_PARTS), CITY_SUFFIX), fuzzy_edits)
            report = run_refine_transactions(
                spark, source, best, f"{root}/silver/{TRANSACTIONS_SILVER}.parquet", code=code, years=years, schema=transaction_schema,
                quarantine=f"{root}/silver/_quarantine_transactions.parquet" if quarantine else None)
            if answers is not None:
                report.failed_addresses = answers.failed
        except Exception as e:  # noqa: BLE001 - the other sets are independent; the status says what failed
            failed = error_text(e)
    sources = [(stations, f"{root}/{stations}/{stations}.csv", "csv")] if stations else []
    sources += [(ds, f"{root}/{ds}/{ds}.parquet", "parquet") for ds in datasets]
    if landed:
        sources = [(ds, f"{landed}/{ds}", "bronze") if fs.exists(spark, f"{landed}/{ds}") else (ds, path, fmt)
                   for ds, path, fmt in sources]
    status = run_refine_batch(spark, sources, f"{root}/silver", max_parallel=max_parallel)
    if failed is not None:
        status = status.unionByName(spark.createDataFrame([(TRANSACTIONS_SILVER, "error", failed, None, None)], status.schema))
    return SilverResult(report, status)


def gold_job(spark: SparkSession, data_root: str,
             catalogue: Mapping[str, Sequence[tuple[str, str]]] = PARIS_MARTS,
             decimal_sep: str | None = ",", map_files: int | None = None) -> DataFrame:
    """Price mart plus the point marts; one status row per source. ``map_files`` lays the point marts out for a map.

    The price mart's row count is reported under dataset ``TRANSACTIONS_SILVER``.
    """
    root = data_root.rstrip("/")
    silver = f"{root}/silver"
    status = run_marts(spark, catalogue, paris_path_of(silver), f"{root}/gold", map_files=map_files)
    src = f"{silver}/{TRANSACTIONS_SILVER}.parquet"
    settle(spark, src)
    if fs.exists(spark, src):
        try:
            mart, obs = observed(price_mart(spark.read.parquet(src), decimal_sep), "price_mart",
                                 rows=F.count(F.lit(1)))
            write_parquet(mart, f"{root}/gold/{PRICE_MART}.parquet", sources=[src])
            row = (PRICE_MART, TRANSACTIONS_SILVER, None, "ok", None, int(obs.get["rows"]))
        except Exception as e:  # noqa: BLE001 - the point marts' status must not be lost
            row = (PRICE_MART, TRANSACTIONS_SILVER, None, "error", error_text(e), None)
    else:
        row = (PRICE_MART, TRANSACTIONS_SILVER, None, "missing", f"path not found: {src}", None)
    return status.unionByName(spark.createDataFrame([row], status.schema))
