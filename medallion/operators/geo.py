"""Coordinates: best gazetteer candidate (J2), coordinate fill by join (J1),
fill through a caller-supplied provider (D1) and point extraction (Q4 core).

The original pipeline called a web geocoder once per row from a Python UDF.
Here the lookup is a join against a gazetteer table: one shuffle at most, or
none when Spark finds the reduced gazetteer small enough to broadcast (the
planner's size estimate, re-checked by AQE on the real shuffle output).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from medallion import fs
from medallion.functions.columns import address_key, split_get, to_double
from medallion.operators.filters import complete
from medallion.operators.names import find_column
from medallion.session import scratch, ship_package
from medallion.sinks.writers import write_parquet

KEY = "address_key"


def best_candidates(gazetteer: DataFrame, address_col: str = "address",
                    score_col: str = "score", lat_col: str = "latitude",
                    lon_col: str = "longitude") -> DataFrame:
    """One row per normalised address: highest score, then lowest latitude,
    then lowest longitude (J2). Candidates without coordinates are ignored and a
    NULL score ranks below every score.

    Written as a grouped ``min`` over an ordering struct rather than a ranking
    window: the aggregate combines map-side, so an address with millions of
    candidates is reduced inside each input task before the shuffle instead
    of being sorted in a single task.
    """
    score = F.col(score_col)
    g = (gazetteer
         .select(address_key(address_col).alias(KEY), F.col(lat_col).alias("latitude"),
                 F.col(lon_col).alias("longitude"), score.alias("score"))
         .filter(F.col(KEY).isNotNull() & complete(["latitude", "longitude"])))
    order = F.struct(F.col("score").isNull().alias("no_score"), (-F.col("score")).alias("neg_score"),
                     F.col("latitude"), F.col("longitude"), F.col("score"))
    return (g.groupBy(KEY).agg(F.min(order).alias("best"))
            .select(KEY, F.col("best.latitude").alias("latitude"),
                    F.col("best.longitude").alias("longitude"), F.col("best.score").alias("score")))


def prepare_best_candidates(gazetteer: DataFrame, path: str, **cols: str) -> DataFrame:
    """Write :func:`best_candidates` as a reference table and read it back.

    Preparing the gazetteer once is the intended use at scale. Besides
    reuse across runs, a stored table gives the lookup join its own
    ``ENSURE_REQUIREMENTS`` shuffle, which is the shape AQE needs to split
    a hot address over several tasks (``SortMergeJoin(skew=true)``); a lazy
    ``best_candidates`` plan would hand the join its aggregate's shuffle,
    which AQE does not split. When the table is small, its file size lets the
    planner broadcast it instead, with no shuffle of the transactions at all.
    """
    write_parquet(best_candidates(gazetteer, **cols), path)
    return gazetteer.sparkSession.read.parquet(path)


def _to_bytes(text: str) -> int:
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
    t = text.strip().lower()
    num = t.rstrip("kmgtb")
    return int(float(num) * units.get(t[len(num):] or "b", 1))


def broadcastable(best: DataFrame) -> bool:
    """Whether a stored table is under the session's broadcast limit.

    Measured from the sizes of its folders (one metadata call each), the same bound the
    planner applies; a limit of -1 means never.
    """
    spark = best.sparkSession
    limit = _to_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    if limit < 0:
        return False
    folders = {f.rsplit("/", 1)[0] for f in best.inputFiles()}
    return bool(folders) and fs.total_bytes(spark, sorted(unquote(f) for f in folders)) <= limit


def lookup_key(address: Column, lat_col: str, lon_col: str, spread_by: Sequence[str] | None = None) -> Column:
    """Join key: the normalised address for rows that need a lookup.

    Rows that already have both coordinates get a non-matching key spread by
    a hash of the address and coordinates instead of NULL: in a shuffled join
    every NULL key hashes to one reducer, which would put all complete rows
    into a single task. The hash uses only columns the join needs anyway, so
    column pruning still reaches the scan, and it is deterministic, so a
    re-run task sends each row to the same reducer. Rows without a usable
    address get such a key too; ``spread_by`` (a record id, say) tells apart
    those that are equal in address and coordinates.
    """
    need = F.col(lat_col).isNull() | F.col(lon_col).isNull()
    spread = F.concat(F.lit("\u0000#"),
                      F.xxhash64(address, F.col(lat_col), F.col(lon_col),
                                 *[F.col(c) for c in spread_by or ()]).cast("string"))
    return F.coalesce(F.when(need, address), spread)


def fill_coordinates(df: DataFrame, best: DataFrame, address: str | Column,
                     lat_col: str = "latitude", lon_col: str = "longitude",
                     key_min_length: int = 5, hot: DataFrame | None = None,
                     salt_buckets: int = 16, split_complete: bool = False,
                     salt_by: Sequence[str] | None = None, join_hint: str | None = None) -> DataFrame:
    """Fill missing coordinates from a one-row-per-key table.

    Existing values are kept; each coordinate is filled on its own with
    ``coalesce``; rows without a match keep NULL. ``best`` must be unique on
    ``address_key`` (see :func:`best_candidates`), so the row count never
    changes. Pass a stored table as ``best`` (see
    :func:`prepare_best_candidates`): then a hot address is split across
    tasks by AQE's skew-join handling when the join is shuffled.

    ``hot`` (one column ``address_key``, a deterministic list such as
    :func:`hot_keys` returns or a stored table) salts explicitly, without relying on AQE: the
    rows of a hot key are spread over ``salt_buckets`` join keys and only that
    key's reference row is repeated ``salt_buckets`` times. Results are
    the same with or without salting. The salt is a hash of the row (or of
    the ``salt_by`` columns, e.g. a record id, which keeps column pruning), so
    a re-run task sends every row to the same bucket again; rows that are
    identical in those columns share a bucket. ``salt_by`` also spreads the
    rows that cannot match. The list of hot keys is used whole; the planner
    chooses how to join it.

    ``split_complete`` joins only the rows that lack a coordinate and have a
    usable address and adds the others back by union: a shuffled join then
    moves neither complete nor keyless rows, at the price of reading the input
    twice (worth it for a columnar input where most rows are complete).
    ``join_hint`` (``"merge"``, say) goes to the lookup join.
    """
    addr = F.col(address) if isinstance(address, str) else address
    if split_complete:
        need = ((F.col(lat_col).isNull() | F.col(lon_col).isNull())
                & address_key(addr, key_min_length).isNotNull())
        todo = fill_coordinates(df.filter(need), best, address, lat_col, lon_col, key_min_length,
                                hot, salt_buckets, salt_by=salt_by, join_hint=join_hint)
        return todo.unionByName(df.filter(~need))
    key = lookup_key(address_key(addr, key_min_length), lat_col, lon_col, salt_by)
    right = (best.filter(~F.col(KEY).startswith("\u0000"))
             .select(F.col(KEY).alias("_k"), F.col("latitude").alias("_g_lat"),
                     F.col("longitude").alias("_g_lon")))
    left = df.withColumn("_k", key)
    on = ["_k"]
    if hot is not None:
        flags = hot.select(F.col(KEY).alias("_k")).distinct().withColumn("_hot", F.lit(True))
        left = left.join(flags, "_k", "left")
        salt_cols = [F.col(c) for c in (salt_by or df.columns)]
        left = left.withColumn("_salt", F.when(
            F.col("_hot"), F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
            .otherwise(F.lit(0)).cast("int")).drop("_hot")
        right = (right.join(flags, "_k", "left")
                 .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                                                .otherwise(F.array(F.lit(0)))))
                 .drop("_hot"))
        on = ["_k", "_salt"]
    joined = left.join(right.hint(join_hint) if join_hint else right, on=on, how="left")
    return (joined.withColumns({lat_col: F.coalesce(F.col(lat_col), F.col("_g_lat")),
                                lon_col: F.coalesce(F.col(lon_col), F.col("_g_lon"))})
            .drop("_k", "_salt", "_g_lat", "_g_lon"))


def hot_keys(df: DataFrame, address: str | Column, min_rows: int,
             lat_col: str = "latitude", lon_col: str = "longitude", key_min_length: int = 5) -> DataFrame:
    """Addresses needing a lookup that occur at least ``min_rows`` times.

    A grouped count that combines map-side. The list has at most rows /
    ``min_rows`` keys, so a threshold that grows with the input keeps it short.
    """
    addr = F.col(address) if isinstance(address, str) else address
    need = F.col(lat_col).isNull() | F.col(lon_col).isNull()
    return (df.filter(need).select(address_key(addr, key_min_length).alias(KEY))
            .filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") >= F.lit(min_rows)).select(KEY))


Provider = Callable[[pd.Series], pd.DataFrame]


# Outcomes of one address: coordinates given, none known, or the call failed.
FOUND, UNKNOWN, FAILED = "found", "unknown", "failed"


class ProviderFailed(RuntimeError):
    pass


@dataclass
class ProviderAnswers:
    """The stored answers, and how the addresses asked in this run came out."""

    table: DataFrame
    found: int
    unknown: int
    failed: int


def _ask(provider: Provider, keys: list[str]) -> list[tuple]:
    """``(latitude, longitude, outcome)`` per key. A call that raises, or whose answers can't be told
    apart because their number differs, is asked again in halves, down to single addresses; there no
    answer means unknown."""
    try:
        got = provider(pd.Series(keys))
        if len(got) == len(keys):
            lat = pd.to_numeric(got["latitude"], errors="coerce").tolist()
            lon = pd.to_numeric(got["longitude"], errors="coerce").tolist()
            return [(y, x, FOUND if pd.notna(y) and pd.notna(x) else UNKNOWN) for y, x in zip(lat, lon)]
        if len(keys) == 1:
            return [(None, None, FAILED if len(got) else UNKNOWN)]
    except Exception:  # noqa: BLE001 - one bad address must not void the batch; counted as failed
        if len(keys) == 1:
            return [(None, None, FAILED)]
    half = len(keys) // 2
    return _ask(provider, keys[:half]) + _ask(provider, keys[half:])


def _resolve_batches(provider: Provider) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[KEY].tolist()
            out = pd.DataFrame(_ask(provider, keys) if keys else [], columns=["latitude", "longitude", "outcome"])
            yield pd.DataFrame({KEY: keys, "latitude": out["latitude"].astype("float64"),
                                "longitude": out["longitude"].astype("float64"), "outcome": out["outcome"]})
    return run


def resolve_with_provider(df: DataFrame, provider: Provider, address: str | Column,
                          lat_col: str = "latitude", lon_col: str = "longitude",
                          known: DataFrame | None = None, max_calls: int | None = None) -> DataFrame:
    """Ask ``provider`` once per *distinct* address that needs coordinates.

    The distinct step combines map-side, so a repeated address costs one call;
    calls are made batch-wise on the executors through Arrow. Addresses in
    ``known`` (a table with ``address_key``) are not asked again. ``max_calls``
    bounds the tasks, and so the calls, that run at a time. ``outcome`` says
    ``found``, ``unknown`` or ``failed`` for each address.
    """
    ship_package(df.sparkSession)
    addr = F.col(address) if isinstance(address, str) else address
    need = F.col(lat_col).isNull() | F.col(lon_col).isNull()
    keys = (df.filter(need).select(address_key(addr).alias(KEY))
            .filter(F.col(KEY).isNotNull()).distinct())
    if known is not None:
        keys = keys.join(known.select(KEY), KEY, "left_anti")
    if max_calls:
        keys = keys.repartition(max_calls, KEY)
    return keys.mapInPandas(_resolve_batches(provider),
                            schema=f"{KEY} string, latitude double, longitude double, outcome string")


def ask_provider(df: DataFrame, provider: Provider, address: str | Column,
                 lat_col: str = "latitude", lon_col: str = "longitude",
                 resolved_path: str | None = None, cache_path: str | None = None,
                 max_calls: int | None = None) -> ProviderAnswers:
    """Provider answers for the addresses of ``df`` as a stored table, with outcome counts.

    Written once (``resolved_path``, by default a fresh folder in the shared
    workspace): a later stage does not call the provider again (a re-run task
    of this step does), and a lookup join against it has the stored-table
    shape that AQE can split on a hot address. At most ``max_calls`` calls run
    at a time where given.

    With ``cache_path`` the answers persist across runs: addresses found there
    are not asked again, and new answers with both coordinates are appended
    (an address the provider could not place is asked again next run).

    Raises :class:`ProviderFailed` when every address asked in this run failed.
    """
    spark = df.sparkSession
    known = (spark.read.schema(f"{KEY} string, latitude double, longitude double").parquet(cache_path)
             if cache_path is not None and fs.exists(spark, cache_path) else None)
    path = resolved_path or scratch(spark, "resolved-addresses")
    write_parquet(resolve_with_provider(df, provider, address, lat_col, lon_col, known, max_calls), path)
    asked = spark.read.parquet(path)
    count = {r["outcome"]: r["count"] for r in asked.groupBy("outcome").count().collect()}
    found, unknown, failed = (count.get(o, 0) for o in (FOUND, UNKNOWN, FAILED))
    if failed and not found and not unknown:
        raise ProviderFailed(f"the provider failed for all {failed} addresses asked")
    if cache_path is None:
        return ProviderAnswers(asked, found, unknown, failed)
    asked.filter(F.col("outcome") == FOUND).drop("outcome").write.mode("append").parquet(cache_path)
    # one row per address, whatever concurrent or repeated runs have appended
    return ProviderAnswers(spark.read.parquet(cache_path).dropDuplicates([KEY]), found, unknown, failed)


def provider_table(df: DataFrame, provider: Provider, address: str | Column, **options) -> DataFrame:
    """The table of :func:`ask_provider`, which takes the same options."""
    return ask_provider(df, provider, address, **options).table


def fill_by_provider(df: DataFrame, provider: Provider, address: str | Column,
                     lat_col: str = "latitude", lon_col: str = "longitude",
                     resolved_path: str | None = None, cache_path: str | None = None) -> DataFrame:
    """Fill missing coordinates through ``provider`` (D1 + J1); see :func:`provider_table`."""
    answers = provider_table(df, provider, address, lat_col=lat_col, lon_col=lon_col,
                             resolved_path=resolved_path, cache_path=cache_path)
    return fill_coordinates(df, answers, address, lat_col, lon_col)


# --- points of interest -------------------------------------------------------

# Point columns looked for, in priority order, compared
# case-insensitively; a "lat, lon" text is split on the comma.
POINT_COLUMNS = ("geo_point", "geo_point_2d", "coordonnees")


class NoCoordinates(LookupError):
    pass


class UnsupportedPointType(TypeError):
    pass


def point_columns(df: DataFrame, candidates: Sequence[str] = POINT_COLUMNS) -> tuple[Column, Column, str]:
    """Latitude and longitude expressions for a source, and how they were found.

    A text point column wins; otherwise a ``latitude``/``longitude`` pair is
    used. Any other layout raises :class:`NoCoordinates`; a point column that
    is not text (a struct, or WKB bytes) raises :class:`UnsupportedPointType`.
    """
    geo = find_column(df, candidates)
    if geo is not None:
        dtype = df.schema[geo].dataType
        if not isinstance(dtype, StringType):
            raise UnsupportedPointType(f"point column {geo!r} has type {dtype.simpleString()}")
        c = F.col(f"`{geo}`")
        return to_double(split_get(c, ",", 0)), to_double(split_get(c, ",", 1)), f"point:{geo}"
    lat = find_column(df, ["latitude"])
    lon = find_column(df, ["longitude"])
    if lat is not None and lon is not None:
        return to_double(F.col(f"`{lat}`")), to_double(F.col(f"`{lon}`")), "columns"
    raise NoCoordinates(f"no coordinate columns among {df.columns}")


def extract_points(df: DataFrame, label: str,
                   candidates: Sequence[str] = POINT_COLUMNS) -> DataFrame:
    """``(latitude, longitude, categorie)`` rows with both coordinates (Q4)."""
    lat, lon, _ = point_columns(df, candidates)
    return (df.select(lat.alias("latitude"), lon.alias("longitude"),
                      F.lit(label).alias("categorie"))
            .filter(complete(["latitude", "longitude"])))
