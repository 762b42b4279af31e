"""Crash-safe replacement of tables (K1) and what rests on it (Q5, Q6)."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from medallion import fs
from medallion.plans.marts import run_marts
from medallion.sinks import replace as R
from medallion.sinks.writers import write_parquet


def keys(spark, path):
    return sorted(r.k for r in spark.read.parquet(path).collect())


def numbers(spark, lo, hi):
    return spark.range(lo, hi).withColumnRenamed("id", "k")


def beside(spark, path):
    parent, _, name = path.rpartition("/")
    return [p.split("/")[-1] for p in fs.glob(spark, f"{parent}/.{name}.*")]


def test_failing_run_keeps_the_table(spark, tmp_ws):
    path = f"{tmp_ws}/t"
    write_parquet(numbers(spark, 0, 100), path)
    bad = numbers(spark, 0, 100).withColumn("k", F.when(F.col("k") == 50, F.raise_error(F.lit("row 50"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="row 50"):
        write_parquet(bad, path)
    assert keys(spark, path) == list(range(100))
    assert beside(spark, path) == []


def committed(spark, path, lo, hi):
    """A replacement that is committed and goes no further."""
    new, old = R._beside(path, "new-x"), R._beside(path, "old-x")
    numbers(spark, lo, hi).write.parquet(new)
    fs.touch(spark, R._beside(path, "commit"), json.dumps({"new": new, "old": old}))
    return new, old


@pytest.mark.parametrize("died", ["at once", "old table moved", "new table moved", "before any table"])
def test_death_after_the_commit_is_completed(spark, tmp_ws, died):
    path = f"{tmp_ws}/t"
    if died != "before any table":
        write_parquet(numbers(spark, 0, 5), path)
    new, old = committed(spark, path, 5, 9)
    if died in ("old table moved", "new table moved"):
        fs.rename(spark, path, old)
    if died == "new table moved":
        fs.rename(spark, new, path)
    assert R.settle(spark, path) and not R.settle(spark, path)
    assert keys(spark, path) == [5, 6, 7, 8]
    assert beside(spark, path) == []


def test_next_writer_completes_a_dead_one_first(spark, tmp_ws):
    path = f"{tmp_ws}/t"
    write_parquet(numbers(spark, 0, 5), path)
    committed(spark, path, 5, 9)
    write_parquet(numbers(spark, 20, 22), path, mode="append")
    assert keys(spark, path) == [5, 6, 7, 8, 20, 21]
    write_parquet(numbers(spark, 30, 31), path)
    assert keys(spark, path) == [30] and beside(spark, path) == []


def test_concurrent_writers_leave_one_whole_table(spark, tmp_ws):
    path = f"{tmp_ws}/t"
    write_parquet(numbers(spark, 0, 3), path)
    ready, errors = threading.Barrier(4), []

    def writer(n):
        try:
            ready.wait()
            write_parquet(numbers(spark, 1000 * n, 1000 * n + 500).repartition(3), path)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=writer, args=(n,)) for n in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    got = keys(spark, path)
    assert got in [list(range(1000 * n, 1000 * n + 500)) for n in range(1, 5)]
    assert beside(spark, path) == []


def test_leftovers_of_killed_runs_are_swept_when_old(spark, tmp_ws):
    path = f"{tmp_ws}/t"
    numbers(spark, 0, 2).write.parquet(R._beside(path, "new-dead"))
    numbers(spark, 0, 2).write.parquet(R._beside(path, "new-live"))
    fs.set_time(spark, R._beside(path, "new-dead"), 1000)
    write_parquet(numbers(spark, 0, 3), path)
    assert beside(spark, path) == [".t.new-live"]


def test_mart_stays_when_every_rebuild_fails(spark, tmp_ws):
    points = spark.range(10).select(F.lit(48.0).alias("latitude"), F.col("id").cast("double").alias("longitude"))
    points.write.parquet(f"{tmp_ws}/src.parquet")
    catalogue = {"dm": (("src", "X"),)}
    run_marts(spark, catalogue, lambda d: f"{tmp_ws}/{d}.parquet", f"{tmp_ws}/gold")
    part = fs.glob(spark, f"{tmp_ws}/src.parquet/part-*")
    for p in part:  # good footers are gone: the source cannot be read any more
        fs.touch(spark, p, "PAR1 not a table")
    status = run_marts(spark, catalogue, lambda d: f"{tmp_ws}/{d}.parquet", f"{tmp_ws}/gold").collect()
    assert status[0].status in ("error", "unreadable")
    assert spark.read.parquet(f"{tmp_ws}/gold/dm.parquet").count() == 10
