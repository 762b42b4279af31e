from medallion.operators import shape
from medallion.operators.text import word_count


def test_replicate_is_flat_and_exact(spark):
    df = spark.range(7)
    out = shape.replicate(df, 61)
    assert out.count() == 7 * 61
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" not in plan


def test_union_positional_takes_first_names(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k long").select("k", "v").toDF("kk", "vv")
    assert shape.union_positional(a, b).columns == ["k", "v"]


def test_union_all_by_name_skips_absent_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,)], "k int")
    assert shape.union_all_by_name([None, a, None, a]).count() == 2
    assert shape.union_all_by_name([None, None]) is None


def test_partition_count_and_sizes(spark):
    df = shape.repartition_to(spark.range(100), 4)
    assert shape.partition_count(df) == 4
    sizes = shape.partition_sizes(df).collect()
    assert sum(r.rows for r in sizes) == 100 and len(sizes) == 4


def test_word_count_default_delimiters(spark):
    df = spark.createDataFrame([(" a b\ta\n\nc\r\fa ",), ("",), (None,)], "value string")
    assert {r.word: r["count"] for r in word_count(df).collect()} == {"a": 3, "b": 1, "c": 1}
