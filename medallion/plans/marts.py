"""Gold marts (Q4-Q6) driven by a catalogue held as data.

A mart is the bag union (duplicates kept) of labelled point sources. A source
that cannot give points is reported and skipped; it never stops the mart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import fs
from medallion.functions.columns import decimal_comma_to_double, to_double
from medallion.operators.filters import complete
from medallion.operators.geo import NoCoordinates, UnsupportedPointType, extract_points
from medallion.operators.metrics import observed
from medallion.operators.shape import union_all_by_name
from medallion.plans.refine import error_text
from medallion.sinks.map_layout import write_map
from medallion.sinks.replace import settle
from medallion.sinks.writers import check_overwrite, run_noop, write_parquet

# The silver Parquet datasets and the gold marts of the Paris
# open-data map, with their labels (output data, kept verbatim, UTF-8).
PARIS_SILVER_PARQUET = (
    "iris",
    "hopitaux",
    "etablissements-scolaires-ecoles-elementaires",
    "secteurs-scolaires-colleges",
    "secteurs-scolaires-maternelles",
    "les-arbres",
    "ilots-de-fraicheur-espaces-verts-frais",
    "ilots-de-fraicheur-equipements-activites",
    "dans-ma-rue",
    "chantiers-a-paris",
    "que-faire-a-paris-",
    "lieux-de-tournage-a-paris",
    "terrasses-autorisations",
    "comptages-routiers-permanents",
    "comptage-multimodal-comptages",
    "eclairage-public",
    "les_bureaux_de_poste_et_agences_postales_en_idf",
    "liste_des_associations_parisiennes",
    "postes-publics-des-bibliotheques",
    "sanisettesparis",
    "zones-de-caves-inondees-1910",
    "zones-touristiques-internationales",
    "amenagements-cyclables",
    "velib-emplacement-des-stations",
)
PARIS_STATIONS_CSV = "emplacement-des-gares-idf"

PARIS_MARTS: Mapping[str, Sequence[tuple[str, str]]] = {
    "dm_qualite_vie": (
        ("ilots-de-fraicheur-espaces-verts-frais", "Espace vert & Frais"),
        ("les-arbres", "Arbre"),
        ("ilots-de-fraicheur-equipements-activites", "Equipement Fraicheur"),
        ("eclairage-public", "Eclairage Public"),
        ("sanisettesparis", "Toilettes"),
        ("comptages-routiers-permanents", "Trafic Routier"),
        ("chantiers-a-paris", "Chantier en cours"),
        ("dans-ma-rue", "Anomalie/Incivilité signalée"),
        ("zones-touristiques-internationales", "Zone Touristique"),
        ("terrasses-autorisations", "Terrasse Commerciale"),
        ("zones-de-caves-inondees-1910", "Risque Inondation"),
    ),
    "dm_culture_loisir": (
        ("que-faire-a-paris-", "Activité & Evénement"),
        ("liste_des_associations_parisiennes", "Association"),
        ("lieux-de-tournage-a-paris", "Lieu de tournage"),
        ("ilots-de-fraicheur-espaces-verts-frais", "Espace vert & Parc"),
    ),
    "dm_services_commerces": (
        ("secteurs-scolaires-colleges", "Collège"),
        ("etablissements-scolaires-ecoles-elementaires", "Ecole Elémentaire"),
        ("secteurs-scolaires-maternelles", "Ecole Maternelle"),
        ("postes-publics-des-bibliotheques", "Bibliothèque"),
        ("hopitaux", "Hôpital"),
        ("les_bureaux_de_poste_et_agences_postales_en_idf", "Bureau de Poste"),
    ),
    "dm_transport": (
        ("velib-emplacement-des-stations", "Station Vélib"),
        ("amenagements-cyclables", "Aménagement Cyclable"),
        ("emplacement-des-gares-idf", "Gare / Station"),
    ),
}
PRICE_MART = "dm_immobilier"


# --- Q5: price mart -------------------------------------------------------------

def price_mart(silver: DataFrame, decimal_sep: str | None = ",") -> DataFrame:
    """Priced, located transactions (Q5).

    The price accepts a decimal comma (``decimal_sep=None`` gives the old
    result, where such prices are NULL and the row is dropped). As in the
    original, only latitude and price are required.
    """
    return (silver.select(
        decimal_comma_to_double("Valeur_fonciere", decimal_sep).alias("prix"),
        to_double("Surface_reelle_bati").alias("surface"),
        F.col("Type_local").alias("type_bien"),
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"))
        .filter(complete(["latitude", "prix"])))


# --- Q4 / Q6: point marts ---------------------------------------------------------

@dataclass
class SourceStatus:
    mart: str
    dataset: str
    categorie: str
    status: str
    message: str | None = None


def poi_source(spark: SparkSession, path: str, label: str, read=None) -> DataFrame:
    """Points of one source; raises ``NoCoordinates`` / ``UnsupportedPointType``."""
    df = read(spark, path) if read else spark.read.parquet(path)
    return extract_points(df, label)


def build_mart(spark: SparkSession, mart: str, entries: Sequence[tuple[str, str]],
               path_of, read=None) -> tuple[DataFrame | None, list[SourceStatus], list]:
    """Union of every usable source of ``mart``.

    Returns the lazy mart (``None`` when no source is usable), a status per
    source and, per usable source, an observation counting its rows at the
    next action (no extra scan).
    """
    frames, statuses, observations = [], [], []
    for dataset, label in entries:
        try:
            settle(spark, path_of(dataset))
            if not fs.exists(spark, path_of(dataset)):
                statuses.append(SourceStatus(mart, dataset, label, "missing", f"path not found: {path_of(dataset)}"))
                continue
            pts = poi_source(spark, path_of(dataset), label, read)
        except NoCoordinates as e:
            statuses.append(SourceStatus(mart, dataset, label, "no_coordinates", str(e)))
            continue
        except UnsupportedPointType as e:
            statuses.append(SourceStatus(mart, dataset, label, "unsupported_type", str(e)))
            continue
        except Exception as e:  # noqa: BLE001 - unreadable footer, bad files
            statuses.append(SourceStatus(mart, dataset, label, "unreadable", error_text(e)))
            continue
        pts, obs = observed(pts, f"{mart}:{dataset}:{label}", rows=F.count(F.lit(1)))
        frames.append(pts)
        statuses.append(SourceStatus(mart, dataset, label, "ok"))
        observations.append((len(statuses) - 1, obs))
    return union_all_by_name(frames), statuses, observations


MART_STATUS_SCHEMA = "mart string, dataset string, categorie string, status string, message string, n_rows bigint"


def run_marts(spark: SparkSession, catalogue: Mapping[str, Sequence[tuple[str, str]]],
              path_of, out_root: str, read=None, max_parallel: int = 4, map_files: int | None = None) -> DataFrame:
    """Build and write every mart of ``catalogue``; return one status row per source.

    A mart with no usable source is not written; a mart whose sources are all
    empty is still written (empty), as before. Where the write fails, the mart that was
    there stays; each source is read through on its own and the mart is built again without
    those that fail. Marts are independent jobs, submitted from up to
    ``max_parallel`` threads. With ``map_files`` a mart is laid out for a map in about so many files
    (``sinks.map_layout``), from a staged copy, so that each source is read once.
    """
    def write(mart: str, df: DataFrame, sources: list[str]) -> None:
        path = f"{out_root.rstrip('/')}/{mart}.parquet"
        if not map_files:
            write_parquet(df, path, sources=sources)
            return
        staged = f"{out_root.rstrip('/')}/_staged_{mart}.parquet"
        check_overwrite(df, path, sources)
        write_parquet(df, staged, sources=sources)
        write_map(spark.read.parquet(staged), path, map_files)
        fs.delete(spark, staged)

    def failing(mart: str, entries) -> dict[tuple[str, str], str]:
        bad = {}
        for dataset, label in entries:
            try:
                run_noop(poi_source(spark, path_of(dataset), label, read))
            except Exception as e:  # noqa: BLE001 - a corrupt data file, say
                bad[dataset, label] = error_text(e)
        return bad

    def one(item, without: Mapping[tuple[str, str], str] | None = None) -> list[tuple]:
        mart, entries = item
        used = [e for e in entries if not without or tuple(e) not in without]
        df, statuses, observations = build_mart(spark, mart, used, path_of, read)
        counts: dict[int, int] = {}
        if df is not None:
            try:
                write(mart, df, [path_of(d) for d, _ in entries])
                counts = {i: int(o.get["rows"]) for i, o in observations}
            except Exception as e:  # noqa: BLE001 - run-time failure of the mart job
                bad = failing(mart, [used[i] for i, _ in observations]) if without is None else {}
                if bad:
                    return one(item, bad)
                for i, _ in observations:
                    statuses[i].status, statuses[i].message = "error", error_text(e)
        found = {(s.dataset, s.categorie): (s.mart, s.dataset, s.categorie, s.status, s.message, counts.get(i))
                 for i, s in enumerate(statuses)}
        found |= {k: (mart, *k, "error", text, None) for k, text in (without or {}).items()}
        return [found[tuple(e)] for e in entries]

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        rows = [r for part in pool.map(one, catalogue.items()) for r in part]
    return spark.createDataFrame(rows, MART_STATUS_SCHEMA)


def paris_path_of(silver_root: str):
    return lambda dataset: f"{silver_root.rstrip('/')}/{dataset}.parquet"
