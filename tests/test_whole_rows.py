"""The unified shape keeps its address block; the partition count runs no shuffle; marts name their causes."""

from medallion.operators import shape
from medallion.plans import acceptance as A
from medallion.plans.marts import run_marts
from medallion.plans.tutorial import UNIFIED, harmonise_flat, harmonise_nested, union_sources


def test_unified_shape_keeps_the_address_block(spark):
    flat = spark.createDataFrame([(1, "Bar", "Cafe", 1.0, 2.0, 27601)],
                                 "datasetId int, name string, type string, geoX double, geoY double, zip int")
    nested = spark.sql("""SELECT named_struct('id', 9L, 'premise_name', 'Inn', 'premise_state', 'NC',
                          'premise_address1', '3 Elm', 'premise_zip', 'A-1', 'type_description', '2 - Food',
                          'geolocation', array(1D, 2D), 'opening_date', '2001-02-03') AS fields""")
    u = union_sources(harmonise_flat(flat, "Wake", {}, state="NC"), harmonise_nested(nested, "Durham"))
    assert u.columns == list(UNIFIED)
    got = {r.county: r for r in u.collect()}
    assert got["Wake"].zip == "27601" and got["Wake"].address1 is None
    assert (got["Durham"].address1, got["Durham"].zip, got["Durham"].dateStart) == ("3 Elm", "A-1", "2001-02-03")
    assert got["Durham"].city is None


def test_partition_count_runs_no_job(spark):
    sc = spark.sparkContext
    df = spark.range(1000).repartition(7)
    sc.setJobGroup("partition-count", "")
    try:
        assert shape.partition_count(df) == 7
        assert list(sc.statusTracker().getJobIdsForGroup("partition-count")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_mart_status_names_the_cause(spark, tmp_path):
    status = run_marts(spark, {"m": (("absent", "Absent"),)}, lambda d: f"{tmp_path}/{d}", str(tmp_path / "gold")).collect()
    assert status[0].status == "missing" and "absent" in status[0].message


def test_new_read_backs_are_registered():
    assert {"silver_readback", "best_then_fill", "word_count_text"} <= set(A.QUERIES) & set(A.ORACLES)
