"""Stored lookup tables, map layout, drifting JSON and streamed provider answers."""

import math
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from medallion import fs
from medallion.operators import geo
from medallion.operators import lookup_tables as T
from medallion.plans.sqlsurface import create_database, create_external_text_table, plan_text
from medallion.sinks import map_layout as M
from medallion.sources.drift import drift_report, fields, read_variant

GAZ = "address string, latitude double, longitude double, score double"


def gazetteer(seed, n):
    rng = random.Random(seed)
    return [(f"{rng.randrange(60)} RUE {rng.choice('ABC')}", rng.choice([48.0, 48.5, None]), 2.0 + rng.randrange(4) / 4,
             rng.choice([None, 0.25, 0.5, 1.0])) for _ in range(n)]


def best_rows(df):
    return sorted((r.address_key, r.latitude, r.longitude, r.score) for r in df.collect())


def test_deltas_equal_a_full_build(spark, tmp_ws):
    parts = [gazetteer(k, 60) for k in range(4)]
    path = f"{tmp_ws}/best"
    T.build_best(spark.createDataFrame(parts[0], GAZ), path, parts=8)
    for p in parts[1:]:
        T.merge_best(spark.createDataFrame(p, GAZ), path)
    whole = geo.best_candidates(spark.createDataFrame(sum(parts, []), GAZ))
    assert sorted(map(str, best_rows(T.read_best(spark, path)))) == sorted(map(str, best_rows(whole)))


def test_a_delta_rewrites_only_its_folders(spark, tmp_ws):
    path = f"{tmp_ws}/best"
    T.build_best(spark.createDataFrame(gazetteer(1, 300), GAZ), path, parts=16)
    before = set(fs.glob(spark, f"{path}/key_part=*/part-*"))
    touched = T.merge_best(spark.createDataFrame([("1 RUE A", 47.0, 1.0, 9.0), ("NEW RUE", 1.0, 1.0, None)], GAZ), path)
    changed = {int(p.split("key_part=")[1].split("/")[0]) for p in before ^ set(fs.glob(spark, f"{path}/key_part=*/part-*"))}
    assert changed == set(touched) and 1 <= len(touched) <= 2
    got = {r.address_key: r.latitude for r in T.read_best(spark, path).collect()}
    assert got["1 RUE A"] == 47.0 and got["NEW RUE"] == 1.0
    assert T.merge_best(spark.createDataFrame([], GAZ), path) == []
    with pytest.raises(FileNotFoundError):
        T.merge_best(spark.createDataFrame([], GAZ), f"{tmp_ws}/none")


def test_a_merge_that_died_is_completed_and_can_be_repeated(spark, tmp_ws, monkeypatch):
    path = f"{tmp_ws}/best"
    T.build_best(spark.createDataFrame(gazetteer(1, 100), GAZ), path, parts=8)
    delta = spark.createDataFrame(gazetteer(2, 100), GAZ)
    plain, done = T.replace, []

    def dies(spark, folder, write):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(folder)
        plain(spark, folder, write)

    monkeypatch.setattr(T, "replace", dies)
    with pytest.raises(KeyboardInterrupt):
        T.merge_best(delta, path)
    monkeypatch.setattr(T, "replace", plain)
    T.merge_best(delta, path)
    whole = geo.best_candidates(spark.createDataFrame(gazetteer(1, 100) + gazetteer(2, 100), GAZ))
    assert sorted(map(str, best_rows(T.read_best(spark, path)))) == sorted(map(str, best_rows(whole)))


def test_stored_fill_moves_no_row(spark, tmp_ws):
    db = f"t_{tmp_ws.rsplit('-', 1)[1]}"
    create_database(spark, db, f"{tmp_ws}/db")
    rows = [(i, f"{i % 5} RUE A", None if i % 3 else 1.0, None if i % 3 else 2.0) for i in range(200)] + [(500, None, None, None)]
    df = spark.createDataFrame(rows, "id long, address string, latitude double, longitude double")
    best = geo.best_candidates(spark.createDataFrame([(f"{i} RUE A", 40.0 + i, 3.0, 1.0) for i in range(4)], GAZ))
    T.store_transactions(df, f"{db}.tx", f"{tmp_ws}/tx", "address", 4, spread_by=["id"])
    T.store_best(best, f"{db}.best", f"{tmp_ws}/best", 4)
    out = T.fill_stored(spark, f"{db}.tx", f"{db}.best")
    plan = plan_text(out)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = {(r.id, r.latitude, r.longitude) for r in geo.fill_coordinates(df, best, "address").collect()}
    assert {(r.id, r.latitude, r.longitude) for r in out.collect()} == want
    with pytest.raises(ValueError):
        T.store_best(best, "x; drop", f"{tmp_ws}/x", 2)


def test_external_table_text_is_escaped_and_moves_with_its_folder(spark, tmp_ws):
    db = f"e_{tmp_ws.rsplit('-', 1)[1]}"
    create_database(spark, db, f"{tmp_ws}/it's")
    for name, text in (("a'b", "1|x\n"), ("c", "2|y\n")):
        os.makedirs(f"{tmp_ws}/{name}")
        with open(f"{tmp_ws}/{name}/f.csv", "w") as f:
            f.write(text)
    t = create_external_text_table(spark, db, "t", "n INT, s CHAR(3)", f"{tmp_ws}/a'b", sep="|")
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "x  ")]
    create_external_text_table(spark, db, "t", "n INT, s CHAR(3)", f"{tmp_ws}/c", sep="|")
    assert [tuple(r) for r in spark.table(t).collect()] == [(2, "y  ")]
    assert os.path.exists(f"{tmp_ws}/a'b/f.csv")
    with pytest.raises(Exception):
        create_external_text_table(spark, db, "u", "n INT) USING CSV --", f"{tmp_ws}/c")


# --- map ----------------------------------------------------------------------------------

def test_box_reads_few_files_and_all_its_points(spark, tmp_ws):
    rng = random.Random(4)
    rows = [(48 + rng.random(), 2 + rng.random(), f"p{i}") for i in range(20000)] + [(48.5, 2.5, "crowd")] * 3000
    rows += [(None, 2.5, "n"), (48.5, None, "n"), (float("nan"), 2.5, "n"), (-90.0, -180.0, "sw"), (90.0, 180.0, "ne")]
    df = spark.createDataFrame(rows, "latitude double, longitude double, categorie string").repartition(7)
    M.write_map(df, f"{tmp_ws}/m", files=40)
    assert spark.read.parquet(f"{tmp_ws}/m").count() == len(rows)
    files = len(fs.glob(spark, f"{tmp_ws}/m/part-*"))
    box = (48.2, 2.2, 48.3, 2.3)
    opened = M.box_files(spark, f"{tmp_ws}/m", *box)
    assert files >= 20 and len(opened) <= files / 4
    got = M.read_box(spark, f"{tmp_ws}/m", *box)
    assert got.count() == sum(1 for a, o, _ in rows if a is not None and o is not None and 48.2 <= a <= 48.3 and 2.2 <= o <= 2.3)
    assert "GreaterThanOrEqual(latitude" in plan_text(got)
    assert M.read_box(spark, f"{tmp_ws}/m", 10, 10, 11, 11).count() == 0
    assert M.read_box(spark, f"{tmp_ws}/m", -90, -180, 90, 180).count() == len(rows) - 3
    crowd = M.read_box(spark, f"{tmp_ws}/m", 48.5, 2.5, 48.5, 2.5)
    assert crowd.count() == 3000
    M.write_map(df.limit(0), f"{tmp_ws}/m", files=4)
    assert M.read_box(spark, f"{tmp_ws}/m", *box).count() == 0


def test_curve_interleaves_bits(spark):
    pts = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (12.3, -45.6), (math.nan, 1.0), (None, 1.0)]
    got = [r[0] for r in spark.createDataFrame(pts, "a double, o double").select(M.z_order(F.col("a"), F.col("o"))).collect()]

    def z(a, o):
        x, y = (min(int((v - lo) / w * 65536), 65535) for v, lo, w in ((a, -90, 180), (o, -180, 360)))
        return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(16))

    assert got == [z(*p) for p in pts[:4]] + [None, None]


# --- JSON -----------------------------------------------------------------------------------

def test_fields_of_changing_type(spark, tmp_ws):
    os.makedirs(f"{tmp_ws}/j")
    for name, text in (("a", '{"id": 1, "v": 2.5}\n{"id": "7", "v": "3"}\n\nnot json\n'), ("b", '{"id": {"n": 3}, "v": [1, 2]}\n{"id": null}\n')):
        with open(f"{tmp_ws}/j/{name}.json", "w") as f:
            f.write(text)
    df = read_variant(spark, f"{tmp_ws}/j")
    got = fields(df, {"id": ("bigint", ["$.id", "$.id.n"]), "v": ("double", ["$.v", "$.v[1]"])}).collect()
    assert sorted(((r.id, r.v, r.is_json) for r in got), key=str) == sorted([(1, 2.5, True), (7, 3.0, True), (None, None, False), (3, 2.0, True), (None, None, True)], key=str)
    seen = {(r.path, r.type): r.rows for r in drift_report(df, ["$.id"]).collect()}
    assert sum(seen.values()) == 5 and len(seen) >= 4


# --- provider stream ----------------------------------------------------------------------------

def test_each_address_is_asked_once_across_runs(spark, tmp_ws):
    from medallion.streaming.provider import answers, latest

    log = f"{tmp_ws}/calls"
    os.makedirs(log)

    def provider(keys: pd.Series) -> pd.DataFrame:
        import uuid
        for k in keys:
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write(k)
        known = keys.str.startswith("KNOWN")
        return pd.DataFrame({"latitude": known.map({True: 1.0, False: None}), "longitude": known.map({True: 2.0, False: None})})

    schema = "address string, latitude double, longitude double"

    def run(rows, hours):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_ws}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_ws}/in")
        q = (answers(stream, provider, "address", hours).writeStream.format("parquet").option("checkpointLocation", f"{tmp_ws}/c")
             .trigger(availableNow=True).outputMode("append").start(f"{tmp_ws}/out"))
        q.awaitTermination()

    def calls():
        return sorted(open(f"{log}/{n}").read() for n in os.listdir(log))

    rows = [("known a", None, None), ("Known  A", None, 1.0), ("other b", None, None), (None, None, None), ("full", 1.0, 1.0)]
    run(rows, 24)
    run(rows + [("known c", None, None)], 24)
    assert calls() == ["KNOWN A", "KNOWN C", "OTHER B"]
    got = {r.address_key: (r.latitude, r.outcome) for r in latest(spark.read.parquet(f"{tmp_ws}/out")).collect()}
    assert got == {"KNOWN A": (1.0, "found"), "KNOWN C": (1.0, "found"), "OTHER B": (None, "unknown")}


def test_old_unknowns_are_asked_again(spark, tmp_ws):
    from medallion.streaming.provider import _answer

    class State:
        exists, value, now = False, None, 0

        def getCurrentProcessingTimeMs(self):
            return self.now

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

    asked = []

    def provider(keys):
        asked.append(list(keys))
        return pd.DataFrame({"latitude": [None if "B" in keys[0] or len(asked) < 3 else 1.0], "longitude": [1.0]})

    state, run = State(), _answer(provider, 1000)
    for now, calls in ((0, 1), (999, 1), (1001, 2), (1500, 2), (2100, 3), (10 ** 9, 3)):  # the third answer is found
        state.now = now
        list(run(("A",), iter([pd.DataFrame()]), state))
        assert len(asked) == calls
