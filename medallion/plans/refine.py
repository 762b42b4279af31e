"""Silver refinement (Q1-Q3).

``refine_transactions`` is lazy and returns the silver DataFrame; the
``run_*`` functions are the edges that read and write folders and report
per-dataset status.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from medallion import fs
from medallion.functions.columns import full_address, parse_date, to_double
from medallion.operators import geo
from medallion.operators.filters import incomplete, place_predicate, year_between
from medallion.operators.metrics import observed
from medallion.operators.names import NameCollision, add_if_missing, clean_column_names, clean_name
from medallion.sinks.writers import write_parquet
from medallion.sources.quarantine import read_checked
from medallion.sources.readers import PROVENANCE_COL, read_delimited, read_parquet
from medallion.streaming.landing import PROVENANCE

# The transaction layout the refinement relies on.
DEPT_COL = "Code departement"
POSTCODE_COL = "Code postal"
DATE_COL = "Date mutation"
PARSED_DATE_COL = "Date mutation formatee"
ADDRESS_PARTS = ("No voie", "Type de voie", "Voie", "Code postal")
ADDRESS_COL = "Adresse_Complete"
CITY_SUFFIX = "PARIS"
DATE_FORMAT = "dd/MM/yyyy"


def refine_transactions(raw: DataFrame, best: DataFrame | None, code: str = "75",
                        years: tuple[int, int] = (2021, 2025),
                        address_min_length: int | None = None,
                        need_flag: str | None = None, split_complete: bool = False,
                        spread_by: Sequence[str] | None = None) -> DataFrame:
    """Place and year filters, address, coordinate fill, clean names (Q1).

    ``best`` is a one-row-per-address table (``geo.best_candidates``) or any
    table with ``address_key, latitude, longitude``; ``None`` skips the fill.
    ``need_flag`` names a boolean column marking rows that lacked a coordinate
    before the fill. ``split_complete`` is passed to ``geo.fill_coordinates``,
    ``spread_by`` as its ``salt_by``.
    """
    df = raw.filter(place_predicate(DEPT_COL, POSTCODE_COL, code))
    df = df.withColumn(PARSED_DATE_COL, parse_date(DATE_COL, DATE_FORMAT))
    df = df.filter(year_between(PARSED_DATE_COL, *years))
    df = df.withColumn(ADDRESS_COL, full_address(list(ADDRESS_PARTS), CITY_SUFFIX,
                                                 address_min_length))
    df = add_if_missing(df, {"latitude": DoubleType(), "longitude": DoubleType()})
    df = df.withColumns({"latitude": to_double("latitude"), "longitude": to_double("longitude")})
    if need_flag:
        df = df.withColumn(need_flag, incomplete(["latitude", "longitude"]))
    if best is not None:
        df = geo.fill_coordinates(df, best, ADDRESS_COL, split_complete=split_complete, salt_by=spread_by)
    df = df.drop(ADDRESS_COL)
    return clean_column_names(df, keep_hyphen=True)


def stage_transactions(raw: DataFrame, path: str, code: str = "75",
                       years: tuple[int, int] = (2021, 2025)) -> DataFrame:
    """Write the rows that pass the place and year filters, raw columns only,
    and read them back.

    Used when two steps need the same rows (provider answers first, then the
    refinement): the full input is scanned once, and the second step reads a
    slice that is typically a few percent of it. The refinement applies the
    same filters again, which keeps every staged row.
    """
    df = raw.filter(place_predicate(DEPT_COL, POSTCODE_COL, code))
    df = df.filter(year_between(parse_date(DATE_COL, DATE_FORMAT), *years))
    write_parquet(df, path)
    return raw.sparkSession.read.parquet(path)


def transactions_needing_fill(raw: DataFrame, code: str = "75",
                              years: tuple[int, int] = (2021, 2025)) -> DataFrame:
    """The rows a coordinate lookup is needed for (F3, first branch)."""
    df = raw.filter(place_predicate(DEPT_COL, POSTCODE_COL, code))
    df = df.withColumn(PARSED_DATE_COL, parse_date(DATE_COL, DATE_FORMAT))
    df = df.filter(year_between(PARSED_DATE_COL, *years))
    df = add_if_missing(df, {"latitude": DoubleType(), "longitude": DoubleType()})
    return df.filter(incomplete(["latitude", "longitude"]))


@dataclass
class RefineReport:
    rows: int
    missing_coordinates: int
    unresolved: int
    path: str
    split_complete: bool = False
    failed_addresses: int | None = None
    quarantined: int | None = None


def run_refine_transactions(spark: SparkSession, raw_glob: str | DataFrame, best: DataFrame | None,
                            out_path: str, code: str = "75",
                            years: tuple[int, int] = (2021, 2025),
                            partition_by_year: bool = False,
                            schema: StructType | None = None,
                            split_complete: bool | None = None, quarantine: str | None = None) -> RefineReport:
    """Read the CSV set, refine and write silver Parquet (Q1, A2, K1).

    The count of rows needing a fill is observed during the write: one pass
    over the input, where the original counted first and read again to write.
    All metrics are taken in the final (writing) stage, which Spark commits
    once per task, so a task re-run after an executor loss is not counted
    twice. ``partition_by_year`` lays the table out by sale year, so later
    year filters prune folders. ``schema`` declares the columns (headers are
    still checked against it) instead of reading them from a header.
    ``raw_glob`` may also be a DataFrame, e.g. the bronze Parquet table that
    landing wrote from the CSV files: the text is then parsed once, at
    landing, and the refinement reads columns with pushdown.
    ``split_complete`` (see ``geo.fill_coordinates``) is chosen when left as
    ``None``: rows that already have coordinates bypass the lookup join when
    the input is a table (cheap to read twice) and the reference table is too
    large to broadcast, so a shuffled join moves only the rows it needs; the
    report says which.
    With ``quarantine`` (a table's path; needs ``schema``) files with another header and lines that don't
    fit go there, with file, line and reason, instead of failing the run; the report counts them.
    """
    quarantined = None
    if isinstance(raw_glob, DataFrame):
        raw, sources = raw_glob.drop(*PROVENANCE), []
    elif quarantine is not None:
        if schema is None:
            raise ValueError("quarantine needs the expected columns: give a schema")
        checked = read_checked(spark, raw_glob, schema.names)
        raw, sources = checked.good.drop(PROVENANCE_COL), [raw_glob]
        write_parquet(checked.bad, quarantine, sources=sources)
        quarantined = spark.read.parquet(quarantine).count()
    else:
        raw, sources = read_delimited(spark, raw_glob, sep=";", schema=schema), [raw_glob]
    if split_complete is None:
        split_complete = (best is not None and isinstance(raw_glob, DataFrame)
                          and not geo.broadcastable(best))
    df = refine_transactions(raw, best, code, years, need_flag="_need_fill",
                             split_complete=split_complete, spread_by=raw.columns)  # whole rows are written anyway
    df, obs = observed(df, "refine_transactions", rows=F.count(F.lit(1)),
                       missing=F.count_if(F.col("_need_fill")),
                       unresolved=F.count_if(incomplete(["latitude", "longitude"])))
    df = df.drop("_need_fill")
    parts = ()
    if partition_by_year:
        df = df.withColumn("annee", F.year(clean_name(PARSED_DATE_COL, keep_hyphen=True)))
        parts = ("annee",)
    write_parquet(df, out_path, sources=sources, partition_by=parts)
    m = obs.get
    return RefineReport(int(m["rows"]), int(m["missing"]), int(m["unresolved"]), out_path, split_complete,
                        quarantined=quarantined)


# --- Q2 / Q3: many sources, one status row each --------------------------------

STATUS_SCHEMA = "dataset string, status string, message string, columns string, n_rows bigint"


def refine_one(spark: SparkSession, dataset: str, path: str, fmt: str, out_path: str,
               keep_hyphen: bool = False, sep: str = ";") -> tuple:
    """Read, clean names, write; never raises, returns a status row (Q2, Q3).

    ``fmt`` is ``csv``, ``parquet`` or ``bronze``, a table that ``land`` wrote
    (its provenance columns are left out).
    Analysis errors (missing input, colliding names) surface before the job;
    run-time errors surface during the write; both end up in the status.
    """
    try:
        if "*" not in path and not fs.exists(spark, path):
            return (dataset, "missing", f"path not found: {path}", None, None)
    except Exception as e:  # noqa: BLE001 - an unknown scheme, say
        return (dataset, "unreadable", error_text(e), None, None)
    try:
        df = read_delimited(spark, path, sep=sep) if fmt == "csv" else read_parquet(spark, path)
    except Exception as e:  # noqa: BLE001 - reported per dataset
        gone = "PATH_NOT_FOUND" in str(e)  # a glob that matches nothing, say
        return (dataset, "missing" if gone else "unreadable", error_text(e), None, None)
    if fmt == "bronze":
        df = df.drop(*PROVENANCE)
    try:
        df = clean_column_names(df, keep_hyphen=keep_hyphen)
    except NameCollision as e:
        return (dataset, "name_collision", str(e), None, None)
    df, obs = observed(df, f"refine_{dataset}", rows=F.count(F.lit(1)))
    try:
        write_parquet(df, out_path, sources=[path])
    except Exception as e:  # noqa: BLE001
        return (dataset, "error", error_text(e), ",".join(df.columns), None)
    return (dataset, "ok", None, ",".join(df.columns), int(obs.get["rows"]))


def run_refine_batch(spark: SparkSession, sources: Sequence[tuple[str, str, str]],
                     out_root: str, keep_hyphen: bool = False, max_parallel: int = 4) -> DataFrame:
    """Refine every ``(dataset, path, format)``; one failure does not stop the rest.

    Datasets are independent jobs, submitted from up to ``max_parallel``
    threads so that small ones do not leave executors idle. Returns the status
    table, one row per dataset, in input order.
    """
    def one(src: tuple[str, str, str]) -> tuple:
        ds, path, fmt = src
        return refine_one(spark, ds, path, fmt, f"{out_root.rstrip('/')}/{ds}.parquet", keep_hyphen)

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        rows = list(pool.map(one, sources))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def error_text(e: Exception) -> str:
    """The most specific message of an error: the root cause of a JVM error
    (for a header mismatch it names the file and both headers), else the
    first line of the Python message."""
    je = getattr(e, "java_exception", None)
    if je is not None:
        try:
            cause = je
            while cause.getCause() is not None:
                cause = cause.getCause()
            text = cause.getMessage() or cause.toString()
            return " ".join(str(text).split())
        except Exception:  # noqa: BLE001 - fall back to the Python text
            pass
    text = str(e).strip()
    return text.splitlines()[0] if text else type(e).__name__
