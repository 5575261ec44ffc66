"""Randomized checks of the range and as-of joins against Python brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.asof import latest_as_of
from tidemark.operators.rangejoin import interval_join, window_join

BASE = dt.date(2000, 1, 2)  # a Sunday
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

day = st.integers(min_value=0, max_value=120)


@SETTINGS
@given(
    events=st.lists(day, min_size=1, max_size=40),
    weeks=st.sets(st.integers(min_value=0, max_value=16), min_size=1, max_size=6),
    before=st.integers(min_value=0, max_value=30),
    after=st.integers(min_value=0, max_value=30),
)
def test_window_join_brute_force(spark, events, weeks, before, after):
    pts = [(w, BASE + dt.timedelta(days=7 * w)) for w in sorted(weeks)]
    evs = [(i, BASE + dt.timedelta(days=d)) for i, d in enumerate(events)]
    p = spark.createDataFrame(pts, "week int, as_of date")
    e = spark.createDataFrame(evs, "id int, d date")
    got = sorted((r.id, r.week) for r in window_join(e, "d", p, "as_of", before, after).collect())
    want = sorted(
        (i, w) for i, d in evs for w, a in pts if a - dt.timedelta(days=before) <= d <= a + dt.timedelta(days=after)
    )
    assert got == want


@SETTINGS
@given(
    spans=st.lists(st.tuples(day, st.integers(min_value=-3, max_value=60)), min_size=1, max_size=30),
    weeks=st.sets(st.integers(min_value=0, max_value=26), min_size=1, max_size=8),
)
def test_interval_join_brute_force(spark, spans, weeks):
    pts = [(w, BASE + dt.timedelta(days=7 * w)) for w in sorted(weeks)]
    ivs = [(i, BASE + dt.timedelta(days=s), BASE + dt.timedelta(days=s + n)) for i, (s, n) in enumerate(spans)]
    p = spark.createDataFrame(pts, "week int, as_of date")
    iv = spark.createDataFrame(ivs, "id int, s date, e date")
    got = sorted((r.id, r.week) for r in interval_join(iv, "s", "e", p, "as_of").collect())
    want = sorted((i, w) for i, s, e in ivs for w, a in pts if s <= a <= e)
    assert got == want


@SETTINGS
@given(
    hist=st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 10), day, st.sampled_from(["x", "y", "z"])),
        min_size=1, max_size=30,
    ),
    spine=st.sets(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10)), min_size=1, max_size=12),
)
def test_latest_as_of_brute_force(spark, hist, spine):
    rows = [(a, w, BASE + dt.timedelta(days=d), i, v) for i, (a, w, d, v) in enumerate(hist)]
    h = spark.createDataFrame(rows, "account string, week int, installed date, tie int, box string")
    s = spark.createDataFrame(sorted(spine), "account string, week int")
    got = {(r.account, r.week): r.box for r in latest_as_of(h, s, [F.col("installed"), F.col("tie")], ["box"]).collect()}
    want = {}
    for a, w in spine:
        cands = [(inst, tie, box) for (acc, wk, inst, tie, box) in rows if acc == a and wk <= w]
        if cands:
            want[(a, w)] = max(cands)[2]
    assert got == want
