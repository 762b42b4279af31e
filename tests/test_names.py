import pytest

from medallion.operators.names import (NameCollision, add_if_missing, clean_column_names,
                                       clean_name, find_column)


def test_two_patterns():
    assert clean_name("Code (UIC)") == "Code__UIC_"
    assert clean_name("x-z") == "x_z"
    assert clean_name("x-z", keep_hyphen=True) == "x-z"
    assert clean_name("a=b;c{d}\te\nf") == "a_b_c_d__e_f"


def test_clean_is_one_projection_and_idempotent(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`p key` int, `x y` string, `x-z` string")
    once = clean_column_names(df)
    assert once.columns == ["p_key", "x_y", "x_z"]
    assert clean_column_names(once).columns == once.columns


def test_collision_is_reported(spark):
    df = spark.createDataFrame([("a", 1)], "`a b` string, a_b int")
    with pytest.raises(NameCollision, match="a b"):
        clean_column_names(df)


def test_add_if_missing_tests_each_column(spark):
    df = spark.createDataFrame([("48.1",)], "latitude string")
    out = add_if_missing(df, {"latitude": "double", "longitude": "double"})
    assert out.columns == ["latitude", "longitude"]
    assert out.schema["latitude"].dataType.simpleString() == "string"  # kept as it was


def test_find_column_case_insensitive_priority(spark):
    df = spark.createDataFrame([("x", "y")], "Geo_Point_2D string, COORDONNEES string")
    assert find_column(df, ["geo_point", "geo_point_2d", "coordonnees"]) == "Geo_Point_2D"
    assert find_column(df, ["nothing"]) is None
