import datetime

from pyspark.sql import functions as F

from medallion.functions import columns as C


def one(spark, expr, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_to_double_bad_text_is_null(spark):
    got = one(spark, C.to_double("s"), [("1.5",), (" 2.35",), ("abc",), (None,), ("1,5",)])
    assert got == [1.5, 2.35, None, None, None]


def test_decimal_comma(spark):
    got = one(spark, C.decimal_comma_to_double("s"), [("1234,5",), ("10.25",), ("",), (None,)])
    assert got == [1234.5, 10.25, None, None]
    strict = one(spark, C.decimal_comma_to_double("s", decimal_sep=None), [("1234,5",)])
    assert strict == [None]


def test_parse_date_impossible_and_single_digit(spark):
    got = one(spark, C.parse_date("s"), [("05/01/2021",), ("31/13/2022",), ("5/1/2021",), (None,)])
    assert got == [datetime.date(2021, 1, 5), None, None, None]


def test_split_get_past_end_is_null(spark):
    got = one(spark, C.split_get("s", ",", 1), [("48.8, 2.3",), ("48.8",), (None,)])
    assert got == [" 2.3", None, None]
    got = one(spark, C.split_get("s", " - ", 1), [("1 - click",), ("click",)])
    assert got == ["click", None]


def test_element_past_end_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(C.element("a", 1)).collect()] == [2.0, None, None]


def test_address_key_normalises_and_guards_length(spark):
    got = one(spark, C.address_key("s"), [("  3  rue nation_7 75001 paris ",), ("ab",), ("  abcd  ",), (None,)])
    assert got == ["3 RUE NATION_7 75001 PARIS", None, None, None]


def test_full_address_skips_nulls_strict_concat_propagates(spark):
    df = spark.createDataFrame([("3", "RUE", None)], "a string, b string, c string")
    row = df.select(C.full_address(["a", "b", "c"], "PARIS").alias("x"),
                    C.strict_concat("a", F.lit(" "), "c").alias("y"),
                    C.full_address(["c"], "PARIS", min_body_length=5).alias("z")).first()
    assert row.x == "3 RUE PARIS" and row.y is None and row.z is None


def test_null_of_is_typed(spark):
    df = spark.range(1).select(C.null_of().alias("x"))
    assert df.schema["x"].dataType.simpleString() == "double"
