"""Operators against brute force on random small inputs."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.operators import geo
from medallion.operators.names import clean_name
from medallion.operators.text import word_count

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

candidate = st.tuples(
    st.sampled_from(["1 RUE A", " 1  rue a ", "2 RUE B", "3 RUE C", "ab"]),
    st.one_of(st.none(), st.sampled_from([48.0, 48.25, 48.5])),
    st.one_of(st.none(), st.sampled_from([2.0, 2.25])),
    st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.0])),
)


def brute_best(rows):
    groups = {}
    for addr, lat, lon, score in rows:
        key = re.sub(r"\s+", " ", addr.strip()).upper()
        if len(key) < 5 or lat is None or lon is None:
            continue
        groups.setdefault(key, []).append((score is None, -(score or 0.0), lat, lon, score))
    return {k: (min(v)[2], min(v)[3], min(v)[4]) for k, v in groups.items()}


@SETTINGS
@given(st.lists(candidate, min_size=1, max_size=25))
def test_best_candidate_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "address string, latitude double, longitude double, score double")
    got = {r.address_key: (r.latitude, r.longitude, r.score) for r in geo.best_candidates(df).collect()}
    assert got == brute_best(rows)


words = st.lists(st.sampled_from(["a", "b", "the", "é", "x-y", ""]), max_size=12)
seps = st.sampled_from([" ", "\t", "\n", "\r", "\f", "  ", " \n"])


@SETTINGS
@given(st.lists(st.tuples(words, seps), max_size=8))
def test_word_count_matches_counter(spark, docs):
    texts = [sep.join(ws) for ws, sep in docs]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.word: r["count"] for r in word_count(df).collect()}
    want = Counter(w for t in texts for w in re.split(r"[ \t\n\r\f]+", t) if w)
    assert got == dict(want)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=20))
def test_clean_name_idempotent_and_complete(name):
    once = clean_name(name)
    assert clean_name(once) == once
    assert not re.search(r"[ ,;{}()\n\t=-]", once)


tx_row = st.tuples(
    st.sampled_from(["1 RUE A", "1 rue a", "2 RUE B", "9 RUE Z", "ab", None]),
    st.one_of(st.none(), st.just(40.0)),
    st.one_of(st.none(), st.just(1.0)),
)


@SETTINGS
@given(st.lists(candidate, max_size=15), st.lists(tx_row, min_size=1, max_size=30))
def test_fill_matches_brute_force(spark, gaz_rows, tx_rows):
    best = brute_best(gaz_rows)
    want = []
    for addr, lat, lon in tx_rows:
        key = re.sub(r"\s+", " ", addr.strip()).upper() if addr is not None else None
        hit = best.get(key) if key is not None and len(key) >= 5 and (lat is None or lon is None) else None
        want.append((addr, lat if lat is not None else (hit[0] if hit else None),
                     lon if lon is not None else (hit[1] if hit else None)))
    gaz = spark.createDataFrame(gaz_rows, "address string, latitude double, longitude double, score double")
    tx = spark.createDataFrame(tx_rows, "addr string, latitude double, longitude double")
    got = geo.fill_coordinates(tx, geo.best_candidates(gaz), "addr").collect()
    assert Counter(tuple(r) for r in got) == Counter(want)


tx_filter_row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["75", "92", "7", ""])),
    st.one_of(st.none(), st.sampled_from(["75001", "92100", "7500", "x75"])),
    st.one_of(st.none(), st.sampled_from(["05/01/1996", "31/12/1998", "01/01/1999", "31/13/1997",
                                          "5/1/1997", "garbage"])),
)


def py_passes(dept, postcode, date):
    import datetime
    place = (dept == "75") or (postcode is not None and postcode.startswith("75"))
    try:
        d = datetime.datetime.strptime(date, "%d/%m/%Y") if date and len(date) == 10 else None
    except ValueError:
        d = None
    return bool(place) and d is not None and 1996 <= d.year <= 1998


@SETTINGS
@given(st.lists(tx_filter_row, min_size=1, max_size=30))
def test_place_and_year_filters_match_python(spark, rows):
    from medallion.functions.columns import parse_date
    from medallion.operators.filters import place_predicate, year_between
    df = spark.createDataFrame(rows, "`Code departement` string, `Code postal` string, d string")
    got = df.filter(place_predicate() & year_between(parse_date("d"), 1996, 1998)).count()
    assert got == sum(py_passes(*r) for r in rows)
