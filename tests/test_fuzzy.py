"""Approximate address lookup against the comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from medallion.operators import geo
from medallion.operators.fuzzy import nearest, widened


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def typo(rng, s, n):
    for _ in range(n):
        i = rng.randrange(len(s) + 1)
        kind = rng.randrange(3)
        s = s[:i] + rng.choice("AEX 1é") + s[i:] if kind == 0 else s[:i] + s[i + 1:] if kind == 1 else s[:i] + "Q" + s[i + 1:]
    return s


def tables(seed):
    rng = random.Random(seed)
    gaz = {f"{rng.randrange(40)} {rng.choice(['RUE', 'AVENUE', 'BD'])} {rng.choice(['VICTOR', 'HUGO', 'LÉON', 'AAAAAAAA'])} 7500{rng.randrange(4)} PARIS"
           for _ in range(60)} | {"AB", "ABC", "A", "AAAAAAAAAA", "ABABABAB"}
    rows = [(a, 48 + rng.randrange(8) / 8, 2.0, rng.choice([None, 0.5, 1.0])) for a in sorted(gaz)]
    asked = [typo(rng, rng.choice(sorted(gaz)), rng.randrange(4)) for _ in range(120)] + ["AC", "B", "AAAAAAAAAAA", "ABABAB", None, "zzz"]
    return rows, asked


@pytest.mark.parametrize("max_edits,q", [(1, 2), (2, 3), (2, 2), (3, 3)])
def test_nearest_equals_all_pairs(spark, max_edits, q):
    rows, asked = tables(max_edits * 10 + q)
    best = spark.createDataFrame(rows, "address_key string, latitude double, longitude double, score double")
    keys = spark.createDataFrame([(a,) for a in asked], "address_key string")
    got = {r.address_key: (r.matched_key, r.edits) for r in nearest(keys, best, max_edits, q).collect()}
    want = {}
    for a in {x for x in asked if x is not None}:
        near = [(edits(a, b), s is None, -(s or 0), lat, lon, b) for b, lat, lon, s in rows if edits(a, b) <= max_edits]
        if near:
            want[a] = (min(near)[5], min(near)[0])
    assert got == want


def test_frequent_grams_make_no_pair_of_everything(spark):
    # 400 entries share all grams but a number's: candidates stay near the matches
    best = spark.createDataFrame([(f"{n:05d} RUE DE LA PAIX 75002 PARIS", 48.0, 2.0, 1.0) for n in range(0, 40000, 100)],
                                 "address_key string, latitude double, longitude double, score double")
    keys = spark.createDataFrame([(f"{n:05d} RUE DE LA PAX 75002 PARIS",) for n in range(0, 40000, 100)], "address_key string")
    got = nearest(keys, best, 1)
    assert got.count() == 400 and got.filter("edits <> 1").count() == 0


def test_widened_fills_exact_and_near(spark):
    best = spark.createDataFrame([("1 RUE X 75001 PARIS", 48.5, 2.5, 1.0)], "address_key string, latitude double, longitude double, score double")
    df = spark.createDataFrame([(1, " 1 rue  x 75001 paris", None, None), (2, "1 RUEX 75001 PARIS", None, None), (3, "9 BD Z", None, None),
                                (4, "1 RU X 75001 PARI", 1.0, 1.0), (5, None, None, None)], "k int, a string, latitude double, longitude double")
    out = {r.k: (r.latitude, r.longitude) for r in geo.fill_coordinates(df, widened(df, best, "a"), "a").collect()}
    assert out == {1: (48.5, 2.5), 2: (48.5, 2.5), 3: (None, None), 4: (1.0, 1.0), 5: (None, None)}
    assert widened(df, best, F.col("a")).filter("edits > 0").count() == 1
