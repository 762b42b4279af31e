import math

from medallion.operators.filters import place_filter, require, year_between


def test_place_filter_three_valued_logic(spark):
    rows = [("75", "75001"), (None, "75002"), ("92", None), (None, None), ("92", "92100")]
    df = spark.createDataFrame(rows, "`Code departement` string, `Code postal` string")
    got = sorted(place_filter(df).collect(), key=str)
    assert len(got) == 2  # equal department, or NULL department with a matching postcode


def test_year_between_inclusive(spark):
    df = spark.sql("SELECT explode(array(date'1995-12-31', date'1996-01-01', date'1998-12-31', "
                   "date'1999-01-01', NULL)) AS d")
    assert df.filter(year_between("d", 1996, 1998)).count() == 2


def test_require_keeps_nan_unlike_dropna(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (None, 1.0), (1.0, 2.0)], "a double, b double")
    kept = require(df, "a", "b").collect()
    assert len(kept) == 2 and any(math.isnan(r.a) for r in kept)
    assert df.dropna().count() == 1
