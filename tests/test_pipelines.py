import pytest
from pyspark.sql import functions as F

from medallion import fs
from medallion.operators import geo
from medallion.plans import acceptance as A
from medallion.plans.marts import build_mart, price_mart, run_marts
from medallion.plans.refine import refine_transactions, run_refine_batch, run_refine_transactions
from medallion.sources import fixtures as fx
from medallion.sources.readers import read_delimited
from medallion.streaming.landing import land, landing_report


def test_refine_counts_match_fixture_sanity_numbers(spark, sf, tmp_ws):
    # FIXTURES.md: at sf0.001, 27 rows pass the filters, 20 have coordinates, 16 reach the mart.
    glob = f"{fx.transactions(spark, sf)}/{fx.TRANSACTION_GLOB}"
    base = spark.read.parquet(fx.gazetteer(spark, sf)).filter(F.col("provider") == "base")
    report = run_refine_transactions(spark, glob, geo.best_candidates(base), f"{tmp_ws}/silver",
                                     years=A.YEARS)
    assert (report.rows, report.rows - report.unresolved) == (27, 20)
    assert 0 < report.missing_coordinates < 27  # a third of the rows carry coordinates
    silver = spark.read.parquet(f"{tmp_ws}/silver")
    assert price_mart(silver).count() == 16
    assert "Date_mutation_formatee" in silver.columns and "Adresse_Complete" not in silver.columns


def test_refine_is_lazy_and_keeps_row_count(spark, sf):
    raw = A.transactions_raw(spark, sf)
    no_fill = refine_transactions(raw, None, years=A.YEARS)
    filled = refine_transactions(raw, A.best_gazetteer(spark, sf), years=A.YEARS)
    assert no_fill.count() == filled.count()
    assert filled.filter("latitude IS NULL").count() < no_fill.filter("latitude IS NULL").count()


def test_decimal_comma_is_a_deliberate_change(spark, sf):
    silver = refine_transactions(A.transactions_raw(spark, sf), A.best_gazetteer(spark, sf), years=A.YEARS)
    assert price_mart(silver, decimal_sep=None).count() < price_mart(silver).count()


def test_header_drift_fails_instead_of_misaligning(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/a/f1.csv", "x;y\n1;2\n")
    fs.touch(spark, f"{tmp_ws}/a/f2.csv", "y;x\n3;4\n")
    with pytest.raises(Exception, match="(?i)header|schema|CSV"):
        read_delimited(spark, f"{tmp_ws}/a/*.csv", sep=";").collect()
    loose = read_delimited(spark, f"{tmp_ws}/a/*.csv", sep=";", enforce_schema=True).collect()
    assert len(loose) == 2


def test_mart_count_is_sum_of_sources_and_statuses(spark, sf, tmp_ws):
    path_of = A._poi_path_of(spark, sf)
    df, statuses, _ = build_mart(spark, "dm_points", A.TEST_MARTS["dm_points"], path_of)
    per_source = sum(A.poi_source(spark, path_of(d), lab).count()
                     for d, lab in A.TEST_MARTS["dm_points"] if d in
                     ("customer_points", "supplier_points", "nation_points", "part_points"))
    assert df.count() == per_source
    assert {s.dataset: s.status for s in statuses} == {
        "customer_points": "ok", "supplier_points": "ok", "nation_points": "ok", "part_points": "ok",
        "region_nocoords": "no_coordinates", "events_struct": "unsupported_type",
        "events_binary": "unsupported_type", "absent_source": "missing"}
    status = run_marts(spark, A.TEST_MARTS, path_of, f"{tmp_ws}/gold")
    assert fs.exists(spark, f"{tmp_ws}/gold/dm_points.parquet")
    assert not fs.exists(spark, f"{tmp_ws}/gold/dm_without_points.parquet")
    n = status.filter("status = 'ok'").agg(F.sum("n_rows")).first()[0]
    assert n == spark.read.parquet(f"{tmp_ws}/gold/dm_points.parquet").count()


def test_refine_batch_statuses_and_idempotent_names(spark, sf, tmp_ws):
    names = fx.messy_names(spark, sf)
    st = run_refine_batch(spark, [(d, f"{names}/{d}.parquet", "parquet")
                                  for d in ("part_names", "part_collision", "absent")], f"{tmp_ws}/s")
    got = {r.dataset: r.status for r in st.collect()}
    assert got == {"part_names": "ok", "part_collision": "name_collision", "absent": "missing"}
    again = run_refine_batch(spark, [("again", f"{tmp_ws}/s/part_names.parquet", "parquet")], f"{tmp_ws}/s2")
    assert again.first().columns == "p_partkey,x_y,x_z"


def test_landing_once_per_name(spark, sf, tmp_ws):
    bronze, ckpt = f"{tmp_ws}/bronze", f"{tmp_ws}/ckpt"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    total = 0
    fx.landing_stage(spark, sf, tmp_ws)
    for run in (1, 2, 3):
        src = fx.landing_drop(spark, tmp_ws, run)
        total += land(spark, src, bronze, ckpt, fmt="json", schema="doc_id bigint, text string").rows
    assert total == docs.count()
    # a fourth run over the same folder, including the rewritten file, lands nothing
    assert land(spark, src, bronze, ckpt, fmt="json", schema="doc_id bigint, text string").rows == 0
    landed = spark.read.parquet(bronze)
    assert landed.count() == docs.count()
    assert landed.join(docs, ["doc_id", "text"], "left_anti").count() == 0
    assert "stem" in landed.columns and landed.select("stem").distinct().count() >= 3


def test_binary_landing_keeps_bytes(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/raw/a.txt", "hello")
    run = land(spark, f"{tmp_ws}/raw", f"{tmp_ws}/b", f"{tmp_ws}/c")
    assert run.rows == 1
    row = spark.read.parquet(f"{tmp_ws}/b").first()
    assert bytes(row.content) == b"hello" and row.stem == "a"


def test_landing_in_bounded_batches_reports_all_of_them(spark, tmp_ws):
    for i in range(6):
        fs.touch(spark, f"{tmp_ws}/many/f{i:03d}.txt", f"line {i}\n")
    run = land(spark, f"{tmp_ws}/many", f"{tmp_ws}/mb", f"{tmp_ws}/mc", fmt="text", max_files_per_trigger=1)
    assert run.batches == 6 and run.rows == 6
    report = {r.batch: (r.files, r.rows) for r in landing_report(spark, f"{tmp_ws}/mc").collect()}
    assert report == {n: (1, 1) for n in range(6)}


def test_refine_from_landed_bronze_equals_csv(spark, sf, tmp_ws):
    from medallion.sources.readers import all_strings
    root = fx.transactions(spark, sf)
    cols = fx.TRANSACTION_COLUMNS + ("latitude", "longitude")
    best = A.best_gazetteer(spark, sf)
    from_csv = run_refine_transactions(spark, f"{root}/{fx.TRANSACTION_GLOB}", best, f"{tmp_ws}/a",
                                       years=A.YEARS)
    land(spark, f"{root}/Orders-*/", f"{tmp_ws}/bronze", f"{tmp_ws}/ck", fmt="csv",
         schema=all_strings(cols), options={"header": "true", "sep": ";", "enforceSchema": "false"})
    bronze = spark.read.parquet(f"{tmp_ws}/bronze")
    from_bronze = run_refine_transactions(spark, bronze, best, f"{tmp_ws}/b", years=A.YEARS)
    assert (from_bronze.rows, from_bronze.missing_coordinates, from_bronze.unresolved) == \
           (from_csv.rows, from_csv.missing_coordinates, from_csv.unresolved)
    a, b = spark.read.parquet(f"{tmp_ws}/a"), spark.read.parquet(f"{tmp_ws}/b")
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.count() == a.count()


def test_unreadable_source_is_reported(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/bad.parquet/part-0.parquet", "not parquet at all")
    df, statuses, _ = build_mart(spark, "m", [("bad", "X")], lambda d: f"{tmp_ws}/{d}.parquet")
    assert df is None and statuses[0].status == "unreadable"


def test_staged_slice_refines_like_the_full_input(spark, sf, tmp_ws):
    from medallion.plans.refine import stage_transactions
    raw = A.transactions_raw(spark, sf)
    staged = stage_transactions(raw, f"{tmp_ws}/stage", years=A.YEARS)
    assert staged.count() == 27 and staged.columns == raw.columns
    best = A.best_gazetteer(spark, sf)
    a = refine_transactions(raw, best, years=A.YEARS)
    b = refine_transactions(staged, best, years=A.YEARS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
