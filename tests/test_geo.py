import pandas as pd
import pytest

from medallion.operators import geo

GAZ = "address string, latitude double, longitude double, score double"


def best(spark, rows):
    return {r.address_key: (r.latitude, r.longitude, r.score)
            for r in geo.best_candidates(spark.createDataFrame(rows, GAZ)).collect()}


def test_best_candidate_ties_and_nulls(spark):
    got = best(spark, [
        ("1 RUE A 75001 PARIS", 48.5, 2.0, 1.0),
        ("1  rue a 75001 paris ", 48.0, 2.5, 1.0),   # equal score, lower latitude wins
        ("2 RUE B 75001 PARIS", 48.0, 2.0, 0.5),
        ("2 RUE B 75001 PARIS", 49.0, 2.0, 0.9),     # higher score wins
        ("3 RUE C 75001 PARIS", 47.0, 2.0, None),
        ("3 RUE C 75001 PARIS", 48.0, 2.0, 0.1),     # any score beats NULL
        ("4 RUE D 75001 PARIS", None, 2.0, 9.0),     # no coordinates: ignored
        ("abc", 48.0, 2.0, 1.0),                     # too short: no key
    ])
    assert got == {"1 RUE A 75001 PARIS": (48.0, 2.5, 1.0), "2 RUE B 75001 PARIS": (49.0, 2.0, 0.9),
                   "3 RUE C 75001 PARIS": (48.0, 2.0, 0.1)}


def test_best_candidate_plan_combines_map_side(spark):
    df = geo.best_candidates(spark.createDataFrame([("1 RUE A PARIS", 1.0, 2.0, 1.0)], GAZ))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_fill_keeps_existing_and_row_count(spark):
    rows = [("1 RUE A 75001 PARIS", None, None), ("1 RUE A 75001 PARIS", 40.0, None),
            ("9 RUE Z 75001 PARIS", None, None), ("1 RUE A 75001 PARIS", 41.0, 3.0), (None, None, None)]
    df = spark.createDataFrame(rows, "addr string, latitude double, longitude double")
    b = geo.best_candidates(spark.createDataFrame([("1 rue a 75001 paris", 48.0, 2.0, 1.0),
                                                   ("1 RUE A 75001 PARIS", 48.0, 2.0, 1.0)], GAZ))
    out = geo.fill_coordinates(df, b, "addr")
    got = sorted(((r.addr or "", r.latitude or 0, r.longitude or 0) for r in out.collect()))
    assert len(got) == len(rows)
    assert got == sorted([("1 RUE A 75001 PARIS", 48.0, 2.0), ("1 RUE A 75001 PARIS", 40.0, 2.0),
                          ("9 RUE Z 75001 PARIS", 0, 0), ("1 RUE A 75001 PARIS", 41.0, 3.0), ("", 0, 0)])
    assert out.columns == df.columns


def test_provider_once_per_distinct_address_and_failures_are_null(spark):
    def counting_provider(addresses: pd.Series) -> pd.DataFrame:
        # nested, so it is shipped by value to the Python workers
        if (addresses == "BAD ADDRESS").any():
            raise RuntimeError("boom")
        return pd.DataFrame({"latitude": [48.0] * len(addresses), "longitude": [2.0] * len(addresses)})

    rows = [("1 RUE A",)] * 50 + [("BAD ADDRESS",), ("2 RUE B",), ("ab",)]
    df = spark.createDataFrame(rows, "addr string").selectExpr(
        "addr", "CAST(NULL AS double) AS latitude", "CAST(NULL AS double) AS longitude")
    resolved = geo.resolve_with_provider(df, counting_provider, "addr")
    got = {r.address_key: r.latitude for r in resolved.collect()}
    assert got == {"1 RUE A": 48.0, "2 RUE B": 48.0, "BAD ADDRESS": None}  # one row per distinct key
    filled = geo.fill_by_provider(df, counting_provider, "addr")
    assert filled.count() == len(rows)
    assert filled.filter("latitude IS NOT NULL").count() == 51


def test_point_extraction_outcomes(spark):
    text = spark.createDataFrame([("48.5, 2.25",), ("48.5",), ("n/a, n/a",), (None,)], "Geo_Point string")
    assert [tuple(r) for r in geo.extract_points(text, "X").collect()] == [(48.5, 2.25, "X")]
    cols = spark.createDataFrame([("48.5", "2.5"), (None, "2.0")], "Latitude string, Longitude string")
    assert geo.extract_points(cols, "Y").count() == 1
    with pytest.raises(geo.NoCoordinates):
        geo.extract_points(spark.createDataFrame([(1,)], "id int"), "Z")
    struct = spark.sql("SELECT named_struct('lat', 1.0D, 'lon', 2.0D) AS geo_point_2d")
    with pytest.raises(geo.UnsupportedPointType):
        geo.extract_points(struct, "S")
    binary = spark.sql("SELECT CAST('48.1, 2.2' AS BINARY) AS geo_point_2d")
    with pytest.raises(geo.UnsupportedPointType):
        geo.extract_points(binary, "B")


def test_provider_cache_skips_known_addresses(spark, tmp_ws):
    from pyspark.sql import functions as F

    def provider(addresses: pd.Series) -> pd.DataFrame:
        # marks each answer with the batch size, so a second ask would be visible
        return pd.DataFrame({"latitude": [48.0] * len(addresses),
                             "longitude": [float(len(addresses))] * len(addresses)})

    def frame(addrs):
        return spark.createDataFrame([(a,) for a in addrs], "addr string").select(
            "addr", F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))

    cache = f"{tmp_ws}/cache"
    first = geo.fill_by_provider(frame(["1 RUE A", "2 RUE B"]), provider, "addr", cache_path=cache)
    assert first.filter("latitude IS NULL").count() == 0
    second = geo.fill_by_provider(frame(["1 RUE A", "3 RUE C", "3 RUE C"]), provider, "addr", cache_path=cache)
    got = {r.addr: r.longitude for r in second.collect()}
    assert got["3 RUE C"] == 1.0          # only the new address was asked, alone
    assert got["1 RUE A"] in (1.0, 2.0)   # answered from the first run
    assert spark.read.parquet(cache).count() == 3


def test_split_complete_gives_the_same_rows(spark):
    rows = [("1 RUE A 75001 PARIS", None, None), ("1 RUE A 75001 PARIS", 40.0, None),
            ("9 RUE Z 75001 PARIS", None, None), ("1 RUE A 75001 PARIS", 41.0, 3.0)]
    df = spark.createDataFrame(rows, "addr string, latitude double, longitude double")
    b = geo.best_candidates(spark.createDataFrame([("1 RUE A 75001 PARIS", 48.0, 2.0, 1.0)], GAZ))
    one = geo.fill_coordinates(df, b, "addr")
    two = geo.fill_coordinates(df, b, "addr", split_complete=True)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
