from medallion.plans import sqlsurface as sq
from medallion.sinks import writers as W


def test_databases_and_external_char_table(spark, tmp_ws):
    from medallion import fs
    fs.touch(spark, f"{tmp_ws}/data/a.csv", "num,name,city\n1,Brew,Paris\n")
    sq.create_database(spark, "medallion_test", f"{tmp_ws}/db")
    assert "medallion_test" in [r[0] for r in sq.show_databases(spark).collect()]
    name = sq.create_external_text_table(spark, "medallion_test", "brew",
                                         "num INT, name CHAR(20), city CHAR(20)", f"{tmp_ws}/data")
    rows = sq.query(spark, f"SELECT num, name, length(name) AS n FROM {name} ORDER BY num NULLS FIRST").collect()
    assert rows[0].num is None and rows[0].name.rstrip() == "name" and rows[0].n == 20
    assert rows[1].num == 1 and rows[1].name == "Brew".ljust(20)
    assert "Scan" in sq.plan_text(sq.query(spark, f"SELECT * FROM {name} LIMIT 1"))


def test_schema_json_round_trip_and_show(spark):
    df = spark.createDataFrame([(1, [1.0], {"a": "b"})], "k int, v array<double>, m map<string,string>")
    assert W.schema_from_json(W.schema_json(df)) == df.schema
    assert "|  k|" in W.show_text(df, 5)
    assert W.schema_tree(df).startswith("root")


def test_text_sink_round_trip(spark, tmp_ws):
    df = spark.createDataFrame([("a b",), ("c",)], "value string")
    W.write_text(df, f"{tmp_ws}/out")
    assert sorted(r.value for r in spark.read.text(f"{tmp_ws}/out").collect()) == ["a b", "c"]


def test_overwrite_of_own_input_is_refused(spark, tmp_ws):
    import pytest
    spark.range(3).write.parquet(f"{tmp_ws}/t")
    df = spark.read.parquet(f"{tmp_ws}/t")
    with pytest.raises(W.UnsafeOverwrite):
        W.write_parquet(df, f"{tmp_ws}/t")
    with pytest.raises(W.UnsafeOverwrite):
        W.write_parquet(df, f"{tmp_ws}/t", sources=[f"{tmp_ws}/t"])
    W.write_parquet(df, f"{tmp_ws}/u")
    assert spark.read.parquet(f"{tmp_ws}/u").count() == 3


def test_register_tables_as_views(spark, tmp_ws):
    spark.range(5).write.parquet(f"{tmp_ws}/gold/dm-trans port.parquet")
    spark.range(2).write.parquet(f"{tmp_ws}/gold/other.parquet")
    assert sorted(sq.register_tables(spark, f"{tmp_ws}/gold")) == ["dm_trans_port", "other"]
    assert sq.query(spark, "SELECT count(*) AS n FROM dm_trans_port").first().n == 5


def test_delimited_with_declared_schema(spark, tmp_ws):
    import pytest
    from medallion import fs
    from medallion.sources.readers import all_strings, read_delimited
    fs.touch(spark, f"{tmp_ws}/d/a.csv", "x;y\n1;2\n")
    df = read_delimited(spark, f"{tmp_ws}/d", schema=all_strings(["x", "y"]))
    assert [tuple(r) for r in df.collect()] == [("1", "2")]
    with pytest.raises(Exception):
        read_delimited(spark, f"{tmp_ws}/d", schema=all_strings(["y", "x"])).collect()


def test_parquet_sink_file_count_and_partitions(spark, tmp_ws):
    import glob as g
    from medallion.session import local_path
    df = spark.range(1000).selectExpr("id", "id % 3 AS part")
    W.write_parquet(df, f"{tmp_ws}/few", files=2)
    assert len(g.glob(local_path(f"{tmp_ws}/few") + "/part-*.parquet")) == 2
    W.write_parquet(df, f"{tmp_ws}/byp", partition_by=["part"])
    back = spark.read.parquet(f"{tmp_ws}/byp")
    assert back.filter("part = 1").count() == 333
    assert "PartitionFilters" in back.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
