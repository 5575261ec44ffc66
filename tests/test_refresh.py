import bisect
import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark import ACCOUNT, WEEK
from tidemark.functions.calendar import AS_OF, CAL_DATE, MONTH, map_to_week, normalise_calendar, stored_calendar
from tidemark.operators.asof import as_of_state, latest_as_of
from tidemark.plans.refresh import SINCE, UNTIL, marks, refresh, touched_weeks
from tidemark.plans.star import Star, _arrivals, _fiscal_days
from tidemark.session import SHUFFLE_CLEANUP, materialize, scratch_path
from tidemark.sources.versions import VersionConflict, VersionedMart

D = dt.date(2024, 1, 7)


def _weeks(spark, n):
    return spark.createDataFrame([(w, D + dt.timedelta(weeks=w)) for w in range(n)], f"{WEEK} int, {AS_OF} date")


def _marks(spark, rows):
    df = spark.createDataFrame([(w, v, x, None, None) for w, v, x in rows], f"{WEEK} int, v string, x string, {SINCE} date, {UNTIL} date")
    return marks({"plain": df})


def test_marks_see_added_removed_and_changed_rows(spark):
    rows = [(1, "a", "b"), (1, "a", "b"), (2, None, ""), (3, "x", "y")]
    old, weeks = _marks(spark, rows), _weeks(spark, 6)
    assert touched_weeks(None, old, weeks) == ([0, 1, 2, 3, 4, 5], [])
    assert touched_weeks(old, _marks(spark, rows[::-1]), weeks) == ([], [])
    assert touched_weeks(old, _marks(spark, rows + [(4, "n", "n")]), weeks) == ([4], [])
    assert touched_weeks(old, _marks(spark, rows[1:]), weeks) == ([1], [])  # one of two equal rows is gone
    assert touched_weeks(old, _marks(spark, [*rows[:2], (2, "", None), rows[3]]), weeks) == ([2], [])  # null and empty change places
    assert touched_weeks(old, _marks(spark, rows[:3]), weeks.where(f"{WEEK} <> 3")) == ([], [3])


def test_rows_of_wider_reach_touch_every_week_between_their_days(spark):
    def frame(rows):
        return marks({"wide": spark.createDataFrame(rows, f"{WEEK} int, v int, {SINCE} date, {UNTIL} date")})

    days = lambda a, z: (D + dt.timedelta(weeks=a), D + dt.timedelta(weeks=z))
    old, new = frame([(2, 1, *days(2, 3)), (8, 1, *days(8, 9))]), frame([(2, 2, *days(1, 5)), (8, 1, *days(8, 9))])
    assert touched_weeks(old, new, _weeks(spark, 12)) == ([1, 2, 3, 4, 5], [])


@pytest.fixture(scope="module")
def runs(spark):
    """A first run without the late rows, a killed one, and a second run; (store, star, weeks of each run)."""
    first, late = _arrivals(spark, SF_SMALL, (150, 100), 8)
    copy, root = scratch_path(spark, "t-sources"), scratch_path(spark, "t-mart")
    for name, rows in first.items():
        rows.write.parquet(f"{copy}/{name}")
    star = lambda **kw: Star(spark, SF_SMALL, tables={n: spark.read.parquet(f"{copy}/{n}") for n in first}, **kw)
    store = VersionedMart(spark, root)
    weeks = [refresh(spark, star, root)]
    for name, rows in late.items():
        assert rows.count() > 0
        rows.write.mode("append").parquet(f"{copy}/{name}")
    killed = refresh(spark, star, root, publish=False)
    seen = (store.latest(), store.read().count())
    weeks.append(refresh(spark, star, root))
    return store, star, root, weeks, killed, seen


def _rows(df, cols):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*cols).collect())


def test_second_run_equals_the_full_mart_and_rewrites_only_touched_weeks(spark, runs):
    store, _, _, (all_weeks, again), killed, seen = runs
    want = Star(spark, SF_SMALL).mart()
    got = store.read()
    assert set(got.columns) == set(want.columns) and _rows(got, want.columns) == _rows(want, want.columns)
    assert 0 < len(again) < len(all_weeks) and killed == again
    listing = {r[WEEK]: r for r in store.listing().collect()}
    assert len({r["run"] for r in listing.values()}) == 2
    assert {w for w, r in listing.items() if r["n_runs"] == 2 or w not in all_weeks} == set(again)
    assert all(r["start_time"] <= r["end_time"] and r["elapsed_seconds"] >= 0 for r in listing.values())


def test_killed_run_is_not_seen(spark, runs):
    store, _, _, (all_weeks, _), _, (version, rows) = runs
    assert version == 0 and rows == store.read(0).count()
    assert {r[WEEK] for r in store.read(0).select(WEEK).distinct().collect()} == set(all_weeks)


def test_a_run_without_changes_publishes_nothing(spark, runs):
    store, star, root, _, _, _ = runs
    assert refresh(spark, star, root) == [] and store.latest() == 1


def test_a_run_joins_lines_and_builds_the_spine_once(spark, monkeypatch):
    made = {"lines": 0, "spine": 0}
    for name in made:
        old = getattr(Star, name)
        monkeypatch.setattr(Star, name, lambda self, old=old, name=name: (made.__setitem__(name, made[name] + 1), old(self))[1])
    assert refresh(spark, lambda **kw: Star(spark, SF_SMALL, **kw), scratch_path(spark, "t-once"))
    assert made == {"lines": 1, "spine": 1}


def test_a_run_builds_the_box_block_once(spark, monkeypatch):
    made, given, old = [], {}, Star.set_top_box
    monkeypatch.setattr(Star, "set_top_box", lambda self, *a, **kw: (made.append(1), old(self, *a, **kw))[1])
    monkeypatch.setattr(Star, "mart", lambda self, **kw: (given.update(kw), kw["spine"])[1])
    assert refresh(spark, lambda **kw: Star(spark, SF_SMALL, **kw), scratch_path(spark, "t-boxes"))
    assert len(made) == 1 and given["boxes"].columns == [ACCOUNT, WEEK, "box_type"]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    rows = spark.range(5000).groupBy((F.col("id") % 997).alias("k")).agg(F.sum("id").alias("n"))
    rows.write.format("noop").mode("overwrite").save()
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    seen = _shuffle_files(spark)
    out = materialize(rows, "t-shuffles")
    until = time.time() + 20
    while _shuffle_files(spark) - seen and time.time() < until:  # they are removed without waiting for it
        time.sleep(0.2)
    assert not _shuffle_files(spark) - seen
    assert out.count() == 997 and spark.conf.get(SHUFFLE_CLEANUP, "false") == before


def test_late_rows_are_split_off_without_an_exchange_of_the_lines(spark):
    first, late = _arrivals(spark, SF_SMALL, (150, 100), 8)
    for part in (first, late):
        plan = part["lineitem"]._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    whole = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert first["lineitem"].unionByName(late["lineitem"]).exceptAll(whole).isEmpty() and late["lineitem"].count() > 0
    assert first["lineitem"].count() + late["lineitem"].count() == whole.count()


def test_bills_of_joined_lines_equal_those_of_the_scan(spark):
    day = lambda d: dt.datetime(1997, 1, d)
    orders = [(1, 3, "F", 10.0, day(2), "1-URGENT"), (1, 3, "F", 10.0, day(2), "1-URGENT"), (1, 4, "F", 11.0, day(3), "1-URGENT"), (2, 3, "O", None, day(4), "1-URGENT"),
              (3, 5, "F", 9.0, day(5), "2-HIGH"), (None, 6, "F", 7.0, day(6), "1-URGENT"), (4, None, "F", 7.0, day(6), "1-URGENT"), (5, 7, "F", 8.0, None, "1-URGENT")]
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    lines = [(k, n, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", d) for k, n, d in [(1, 1, day(9)), (1, 2, day(12)), (1, 2, None), (2, 1, None), (None, 1, day(8)), (5, 1, day(7)), (9, 1, day(7))]]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": spark.createDataFrame(lines, ", ".join(f"{n} {t}" for n, t in zip(names, ["bigint", "int", "bigint", *["double"] * 4, "string", "string", "timestamp"]))),
    }
    s = Star(spark, SF_SMALL, tables=tables)
    got, want = (sorted(map(str, df.collect())) for df in (s.bills_src(s.lines()), s.bills_src()))
    assert got == want and len(got) == 5


def test_two_runs_cannot_publish_one_version(spark, scratch):
    store = VersionedMart(spark, scratch)
    with pytest.raises(ValueError):
        store.read()
    store.publish("a", [1], [], dt.datetime.now(), "p", "t")
    stale = VersionedMart(spark, scratch)
    stale.latest = lambda: None  # looked before the other run was published
    with pytest.raises(VersionConflict):
        stale.publish("b", [1], [], dt.datetime.now(), "p", "t")
    store.publish("c", [], [1], dt.datetime.now(), "p", "t")
    assert store.latest() == 1 and store.listing().count() == 0


def test_state_continues_the_history(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 5), rng.randint(0, 20), rng.randint(0, 9), i, rng.choice("xyz")) for i in range(120)]
    hist = spark.createDataFrame(rows, f"{ACCOUNT} bigint, {WEEK} int, o int, t int, v string")
    keys = spark.createDataFrame([(a, w) for a in range(1, 7) for w in range(21)], f"{ACCOUNT} bigint, {WEEK} int")
    order = [F.col("o"), F.col("t")]
    whole = sorted(map(tuple, latest_as_of(hist, keys, order, ["v"]).where(f"{WEEK} > 9").collect()))
    state = as_of_state(hist.where(f"{WEEK} <= 4"), order, ["v"])
    state = as_of_state(hist.where(f"{WEEK} between 5 and 9"), order, ["v"], state)
    assert sorted(map(tuple, latest_as_of(hist.where(f"{WEEK} > 9"), keys.where(f"{WEEK} > 9"), order, ["v"], state=state).collect())) == whole


def test_second_half_scans_only_new_dates(spark):
    s = Star(spark, SF_SMALL)
    spine = s.spine()
    plan = s.set_top_box_after(dt.date(1997, 1, 5), s.box_state(dt.date(1997, 1, 5)).limit(0), spine.where(f"{WEEK} > 199701"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-01-06" in text


def test_stored_calendar_finds_weeks_without_a_join(spark):
    rng = random.Random(7)
    starts, label = [dt.date(2019, 12, 30)], []
    for _ in range(80):  # weeks of 1 to 12 days whose labels follow no formula
        label.append(rng.randint(1, 10**6))
        starts.append(starts[-1] + dt.timedelta(days=rng.randint(1, 12)))
    days = [(starts[0] + dt.timedelta(days=i)) for i in range((starts[-1] - starts[0]).days)]
    week = lambda d: label[bisect.bisect_right(starts, d) - 1]
    table = spark.createDataFrame([(str(d), str(week(d)), "202001") for d in days], "d string, w string, m string")
    cal = stored_calendar(normalise_calendar(table, "d", "w", "m"))
    probe = spark.createDataFrame([(starts[0] + dt.timedelta(days=i),) for i in range(-5, len(days) + 5)] + [(None,)], "day date")
    mapped = map_to_week(probe, F.col("day"), cal)
    assert {r["day"]: r[WEEK] for r in mapped.collect()} == {d: week(d) for d in days}
    assert "Exchange" not in mapped._jdf.queryExecution().executedPlan().toString()
    kept = cal.limited((label[3], label[7]))
    assert {r["day"] for r in map_to_week(probe, F.col("day"), kept).collect()} == {d for d in days if week(d) in (label[3], label[7])}
    assert kept.bounds() == (starts[3], starts[8] - dt.timedelta(days=1))
    assert {(r[WEEK], r[AS_OF]) for r in cal.week_dimension(spark).collect()} == {(w, b - dt.timedelta(days=1)) for w, b in zip(label, starts[1:])}


@pytest.mark.parametrize("fault", ["gap", "twice", "split", "month"])
def test_other_calendars_have_to_be_joined(spark, fault):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), i // 7, 1 + i // 28) for i in range(70)]
    rows = {"gap": rows[:20] + rows[21:], "twice": rows + rows[:1], "split": rows[:63] + [(d, 0, 1) for d, _, _ in rows[63:]], "month": rows[:1] + [(d, w, 2) for d, w, _ in rows[1:]]}[fault]
    days = spark.createDataFrame(rows, f"{CAL_DATE} date, {WEEK} int, {MONTH} int")
    assert stored_calendar(days) is None


def test_fiscal_calendar_of_the_query_has_4_4_5_months(spark):
    days = _fiscal_days(spark, SF_SMALL).groupBy("fiscal_month").agg(F.countDistinct("fiscal_week").alias("n"), F.count("*").alias("d"))
    whole = [r["n"] for r in days.orderBy("fiscal_month").collect()][:-1]
    assert whole == ([4, 4, 5] * len(whole))[: len(whole)]
