"""Plan checks: pushdown, pruning, join strategy and no row-at-a-time Python."""

from medallion.plans import acceptance as A
from medallion.plans.sqlsurface import plan_text


def test_flagship_plan(spark, sf):
    txt = plan_text(A.q_price_mart(spark, sf))
    assert "BatchEvalPython" not in txt and "ArrowEvalPython" not in txt
    assert "StringStartsWith(Code postal,75)" in txt  # place filter reaches the CSV reader
    assert "Identifiant de document" not in txt.split("ReadSchema")[1].split("\n")[0]  # pruned
    assert "Window" not in txt and "BroadcastHashJoin" in txt  # small reference table


def test_best_candidate_plan(spark, sf):
    txt = plan_text(A.q_best_candidate(spark, sf))
    assert "partial_min" in txt and "Window" not in txt


def test_parquet_projection_is_pruned(spark, sf):
    txt = plan_text(A.q_scan_parquet_project(spark, sf))
    schema = [l for l in txt.splitlines() if "ReadSchema" in l][0]
    assert "p_brand" not in schema and "p_type" not in schema


def test_word_count_partial_aggregation(spark, sf):
    txt = plan_text(A.q_word_count(spark, sf))
    assert "partial_count" in txt and "Generate" in txt


def test_replicate_has_no_join(spark, sf):
    txt = plan_text(A.q_replicate_average(spark, sf))
    assert "Join" not in txt and "Generate" in txt


def test_refine_reads_the_csv_once(spark, sf):
    from medallion.plans.refine import refine_transactions
    df = refine_transactions(A.transactions_raw(spark, sf), A.best_gazetteer(spark, sf),
                             years=A.YEARS, need_flag="_need")
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert txt.count("FileScan csv") == 1


def test_provider_runs_on_distinct_addresses_only(spark, sf):
    from medallion.functions.columns import full_address
    from medallion.operators import geo
    df = A.transactions_raw(spark, sf, with_coords=False).selectExpr(
        "*", "CAST(NULL AS double) AS latitude", "CAST(NULL AS double) AS longitude")
    df = df.withColumn("address", full_address(["No voie", "Type de voie", "Voie", "Code postal"]))
    txt = plan_text(geo.resolve_with_provider(df, A.geocode_provider, "address"))
    assert "MapInPandas" in txt and "BatchEvalPython" not in txt
    assert "HashAggregate" in txt  # the distinct step, combined map-side, before the Python call
    filled = plan_text(A.q_fill_by_provider(spark, sf))
    assert "MapInPandas" not in filled  # joined against the stored resolved table


def test_salted_fill_keeps_pruning_with_a_record_id(spark, sf):
    txt = plan_text(A.q_fill_coordinates_salted(spark, sf))
    csv = [l for l in txt.splitlines() if l.startswith("ReadSchema") and "Voie" in l]
    assert csv and all("Valeur fonciere" not in l and "Date mutation" not in l for l in csv)
