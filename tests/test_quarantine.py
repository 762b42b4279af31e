"""Bad lines and files kept apart."""

import os
import shutil

import pytest

from medallion.plans import acceptance as A
from medallion.plans.refine import run_refine_transactions
from medallion.session import local_path
from medallion.sources import fixtures as fx
from medallion.sources.quarantine import read_checked
from medallion.sources.readers import all_strings


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_each_kind_of_bad_row(spark, tmp_ws):
    put(tmp_ws, "a.csv", 'x;y\n1;2\n3\n\n4;5;6\n"7;7";8\r\n;\n')
    put(tmp_ws, "b.csv", "y;x\n1;2\n3;4\n")
    put(tmp_ws, "c.csv", "﻿x;y\n9;é")
    put(tmp_ws, "d.csv", "x;y\n")
    put(tmp_ws, "e.csv", "")
    got = read_checked(spark, f"{tmp_ws}/*.csv", ("x", "y"))
    name = lambda r: r.source_file[-5:-4]
    assert sorted((name(r), r.x, r.y) for r in got.good.fillna("").collect()) == [
        ("a", "", ""), ("a", "1", "2"), ("a", "7;7", "8"), ("c", "9", "é")]
    assert sorted((name(r), r.line, r.reason, r.text) for r in got.bad.collect()) == [
        ("a", 3, "fields", "3"), ("a", 5, "fields", "4;5;6"), ("b", 1, "header", "y;x")]


def test_line_numbers_across_splits(spark, tmp_ws):
    bad = {7, 5000, 9999, 20001}
    lines = ["x;y"] + [f"{n};{n}" if n not in bad else f"{n}" for n in range(2, 20003)]
    put(tmp_ws, "big.csv", "\n".join(lines))
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = read_checked(spark, f"{tmp_ws}/big.csv", ("x", "y"))
        assert got.good.rdd.getNumPartitions() > 1
        assert sorted((r.line, r.text) for r in got.bad.collect()) == [(n, str(n)) for n in sorted(bad)]
        assert got.good.count() == 20001 - len(bad)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_refinement_survives_an_odd_file(spark, sf, tmp_ws):
    root = f"{tmp_ws}/tx"
    shutil.copytree(local_path(fx.transactions(spark, sf)), root)
    cols = all_strings(fx.TRANSACTION_COLUMNS + ("latitude", "longitude"))
    best = A.best_gazetteer(spark, sf)
    clean = run_refine_transactions(spark, f"{root}/{fx.TRANSACTION_GLOB}", best, f"{tmp_ws}/a", years=A.YEARS, schema=cols)
    put(f"{root}/Orders-2050", "Orders-2050.csv", "other;header\n1;2\n")
    both = f"{root}/{fx.TRANSACTION_GLOB}"
    with pytest.raises(Exception):
        run_refine_transactions(spark, both, best, f"{tmp_ws}/b", years=A.YEARS, schema=cols)
    kept = run_refine_transactions(spark, both, best, f"{tmp_ws}/b", years=A.YEARS, schema=cols, quarantine=f"{tmp_ws}/q")
    assert (kept.rows, kept.unresolved, kept.quarantined) == (clean.rows, clean.unresolved, 1)
    a, b = spark.read.parquet(f"{tmp_ws}/a"), spark.read.parquet(f"{tmp_ws}/b")
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.count() == a.count()
    assert spark.read.parquet(f"{tmp_ws}/q").first().reason == "header"
    with pytest.raises(ValueError, match="schema"):
        run_refine_transactions(spark, both, best, f"{tmp_ws}/b", years=A.YEARS, quarantine=f"{tmp_ws}/q")
