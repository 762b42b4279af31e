"""Edges: old and rewritten files, overwriting an input, text sink escapes, short providers, given settings."""

import os
import time

import pandas as pd
import pytest

from medallion.functions.columns import decimal_comma_to_double
from medallion.operators import geo
from medallion.plans.marts import run_marts
from medallion.session import build_session
from medallion.sinks.writers import UnsafeOverwrite, write_parquet, write_text
from medallion.streaming.landing import land


def test_old_files_land_and_rewritten_ones_do_not(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def put(name, text, days):
        p = src / name
        p.write_text(text)
        at = time.time() - days * 86400
        os.utime(p, (at, at))

    def run():
        land(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), fmt="text")

    put("a.txt", "a", 20)
    run()
    put("b file.txt", "b", 0)
    put("old.txt", "old", 30)
    run()
    put("a.txt", "again", 0)
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).select("value", "stem").collect()
    assert sorted((r.value, r.stem) for r in rows) == [("a", "a"), ("b", "b file"), ("old", "old")]


def test_reference_table_is_not_overwritten(spark, tmp_path):
    ref, src = str(tmp_path / "ref"), str(tmp_path / "src")
    spark.range(5).write.parquet(ref)
    spark.range(9).write.parquet(src)
    df = spark.read.parquet(src).join(spark.read.parquet(ref), "id")
    with pytest.raises(UnsafeOverwrite):
        write_parquet(df, ref, sources=[src])
    write_parquet(df, str(tmp_path / "new"), sources=[src])
    assert spark.read.parquet(ref).count() == 5


def test_text_sink_keeps_columns_apart(spark, tmp_path):
    out = str(tmp_path / "t")
    write_text(spark.createDataFrame([("a", None, "c\td\n\\")], "x string, y string, z string"), out)
    assert [r.value for r in spark.read.text(out).collect()] == ["a\t\\N\tc\\td\\n\\\\"]


def test_decimal_separator_is_literal(spark):
    df = spark.createDataFrame([("12.5",)], "x string")
    assert df.select(decimal_comma_to_double("x", ".")).first()[0] == 12.5


def test_short_provider_gives_nobody_elses_answer(spark, tmp_path):
    known = {"1 RUE A": 1.0, "3 RUE C": 3.0}

    def provider(a: pd.Series) -> pd.DataFrame:  # leaves unknown addresses out
        return pd.DataFrame([(known[x], known[x]) for x in a if x in known], columns=["latitude", "longitude"])

    df = spark.createDataFrame([("1 RUE A", None, None), ("2 RUE B", None, None), ("3 RUE C", None, None)],
                               "adr string, latitude double, longitude double").coalesce(1)
    for _ in range(2):  # also with a cache whose marker is gone
        got = geo.fill_by_provider(df, provider, "adr", cache_path=str(tmp_path / "c"))
        assert sorted((r.adr, r.latitude) for r in got.collect()) == [("1 RUE A", 1.0), ("2 RUE B", None), ("3 RUE C", 3.0)]
        (tmp_path / "c" / "_SUCCESS").unlink()


def test_given_settings_win_in_the_cluster_profile(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    other = "spark.sql.files.maxPartitionBytes"
    try:
        build_session(profile="cluster")
        assert spark.conf.get(key) == before
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        for k in (other, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"):
            spark.conf.unset(k)


def test_provider_that_always_fails_is_an_error_and_failures_are_counted(spark):
    df = spark.createDataFrame([("1 RUE A", None, None), ("2 RUE B", None, None), ("3 RUE C", None, None)],
                               "adr string, latitude double, longitude double").coalesce(1)

    def broken(a: pd.Series) -> pd.DataFrame:
        raise RuntimeError("down")

    def partly(a: pd.Series) -> pd.DataFrame:
        if (a == "2 RUE B").any():
            raise RuntimeError("bad address")
        return pd.DataFrame({"latitude": [1.0 if x == "1 RUE A" else None for x in a], "longitude": [1.0] * len(a)})

    with pytest.raises(geo.ProviderFailed):
        geo.fill_by_provider(df, broken, "adr")
    got = geo.ask_provider(df, partly, "adr", max_calls=2)
    assert (got.found, got.unknown, got.failed) == (1, 1, 1)
    assert geo.fill_coordinates(df, got.table, "adr").count() == 3


def test_one_corrupt_file_costs_one_source(spark, tmp_path):
    for name in ("good", "bad"):
        spark.range(20000).selectExpr("concat(48 + id / 64, ', ', 2 + id / 128) AS geo_point").coalesce(1) \
            .write.parquet(str(tmp_path / f"{name}.parquet"))
    part = next((tmp_path / "bad.parquet").glob("part-*"))
    data = bytearray(part.read_bytes())
    data[4:4000] = bytes(3996)  # pages, not the footer
    part.write_bytes(data)
    status = run_marts(spark, {"dm": (("bad", "B"), ("good", "G"))}, lambda d: str(tmp_path / f"{d}.parquet"),
                       str(tmp_path / "gold")).collect()
    assert [(r.dataset, r.status, r.n_rows) for r in status] == [("bad", "error", None), ("good", "ok", 20000)]
    assert status[0].message
    assert spark.read.parquet(str(tmp_path / "gold" / "dm.parquet")).count() == 20000
