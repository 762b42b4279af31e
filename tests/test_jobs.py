"""The silver and gold jobs over a landed folder layout built from the driver tables."""

from pyspark.sql import functions as F

from medallion.plans.jobs import gold_job, silver_job
from medallion.sources import fixtures as fx


def lay_out(spark, sf, root):
    tx = fx.transactions_frame(spark, sf).withColumn(
        "_folder", F.regexp_replace("_folder", "Orders", "ValeursFoncieres"))
    fx._write_by_folder(spark, tx, "_folder", f"{root}/_parts", root, "csv", header="true", sep=";")
    stations = spark.read.option("header", "true").option("sep", ";").csv(fx.stations_csv(spark, sf))
    stations.write.option("header", "true").option("sep", ";").csv(
        f"{root}/emplacement-des-gares-idf/emplacement-des-gares-idf.csv")
    frames = fx.poi_frames(spark, sf)
    for ds, src in [("hopitaux", "customer_points"), ("les-arbres", "supplier_points"),
                    ("velib-emplacement-des-stations", "part_points"), ("iris", "region_nocoords"),
                    ("dans-ma-rue", "events_struct")]:
        frames[src].write.parquet(f"{root}/{ds}/{ds}.parquet")
    return frames


def test_silver_then_gold(spark, sf, tmp_ws):
    root = f"{tmp_ws}/data"
    frames = lay_out(spark, sf, root)
    gaz = spark.read.parquet(fx.gazetteer(spark, sf))
    res = silver_job(spark, root, gazetteer=gaz, years=(1996, 1998))
    assert res.transactions.rows == 27
    st = {r.dataset: r.status for r in res.status.collect()}
    assert st["emplacement-des-gares-idf"] == "ok" and st["hopitaux"] == "ok"
    assert st["les-arbres"] == "ok" and st["iris"] == "ok" and st["eclairage-public"] == "missing"
    silver_cols = spark.read.parquet(f"{root}/silver/emplacement-des-gares-idf.parquet").columns
    assert silver_cols == ["Nom_gare", "Code__UIC_", "geo_point_2d", "Code_Region"]

    gold = {(r.mart, r.dataset): (r.status, r.n_rows) for r in gold_job(spark, root).collect()}
    n_customers = frames["customer_points"].filter("c_custkey % 10 >= 3").count()
    assert gold[("dm_services_commerces", "hopitaux")] == ("ok", n_customers)
    assert gold[("dm_qualite_vie", "dans-ma-rue")][0] == "unsupported_type"
    assert gold[("dm_transport", "emplacement-des-gares-idf")] == ("ok", frames["supplier_points"].count())
    assert gold[("dm_immobilier", "dvf_paris_2021_2025")][0] == "ok"
    transport = spark.read.parquet(f"{root}/gold/dm_transport.parquet")
    assert set(r.categorie for r in transport.select("categorie").distinct().collect()) == {
        "Station Vélib", "Gare / Station"}
    assert not spark.catalog.tableExists("dm_culture_loisir")


def test_silver_with_provider_from_cli(spark, sf, tmp_ws, capsys):
    from medallion.__main__ import main
    root = f"{tmp_ws}/data"
    lay_out(spark, sf, root)
    rc = main(["silver", "--data-root", root, "--years", "1996-1998",
               "--provider", "medallion.plans.acceptance:geocode_provider",
               "--provider-cache", f"{tmp_ws}/cache"], spark=spark)
    assert rc == 0
    out = capsys.readouterr().out
    assert '"rows": 27' in out
    assert spark.read.parquet(f"{tmp_ws}/cache").count() > 0
    silver = spark.read.parquet(f"{root}/silver/dvf_paris_2021_2025.parquet")
    assert silver.count() == 27 and silver.filter("latitude IS NOT NULL").count() > 9


def test_jobs_with_odd_files_misspelt_addresses_and_map_layout(spark, sf, tmp_ws):
    from medallion import fs
    from medallion.plans.marts import PARIS_MARTS
    from medallion.sinks.map_layout import read_box
    from medallion.sources.readers import all_strings

    root = f"{tmp_ws}/data"
    frames = lay_out(spark, sf, root)
    cols = all_strings(fx.TRANSACTION_COLUMNS + ("latitude", "longitude"))
    gaz = spark.read.parquet(fx.gazetteer(spark, sf)).withColumn("address", F.regexp_replace("address", "(?i)rue", "RUEE"))
    fs.touch(spark, f"{root}/ValeursFoncieres-2050/ValeursFoncieres-2050.csv", "not;the;header\n1;2;3\n")
    # without quarantine the odd file stops the transactions, and only them
    plain = silver_job(spark, root, gazetteer=gaz, years=(1996, 1998), transaction_schema=cols)
    st = {r.dataset: r.status for r in plain.status.collect()}
    assert plain.transactions is None and st["dvf_paris_2021_2025"] == "error" and st["hopitaux"] == "ok"
    exact = silver_job(spark, root, gazetteer=gaz, years=(1996, 1998), transaction_schema=cols, quarantine=True).transactions
    assert (exact.rows, exact.quarantined) == (27, 1)
    for p in fs.glob(spark, f"{root}/ValeursFoncieres-2050"):
        fs.delete(spark, p)
    near = silver_job(spark, root, gazetteer=gaz, years=(1996, 1998), transaction_schema=cols, fuzzy_edits=1).transactions
    assert near.rows == 27 and near.unresolved < exact.unresolved
    gold = gold_job(spark, root, catalogue={"dm_transport": PARIS_MARTS["dm_transport"]}, map_files=8)
    n = {r.dataset: r.n_rows for r in gold.collect() if r.status == "ok"}
    path = f"{root}/gold/dm_transport.parquet"
    assert n["emplacement-des-gares-idf"] == frames["supplier_points"].count()
    total = n["emplacement-des-gares-idf"] + n["velib-emplacement-des-stations"]
    assert spark.read.parquet(path).count() == total == read_box(spark, path, -90, -180, 90, 180).count()
    assert not fs.exists(spark, f"{root}/gold/_staged_dm_transport.parquet")
