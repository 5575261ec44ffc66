import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import (
    AS_OF, CAL_DATE, MONTH, IsoCalendar, generate_calendar, iso_week_bounds, map_to_week, month_of_week, week_dimension, week_end, week_list,
)
from tidemark.functions.predicates import not_in, not_like, present_or_not_blank, valid_key
from tidemark.functions.shape import (
    add_durations, clean_name, clean_names, drop_raw_dates, normalise_values, strip_cast,
)
from tidemark.plans.blocks import SUB_CATEGORY_SPELLINGS


def test_calendar_iso_weeks(spark):
    cal = generate_calendar(spark, dt.date(1997, 12, 28), dt.date(2000, 1, 3))
    got = {r[CAL_DATE]: (r["week"], r[MONTH]) for r in cal.collect()}
    assert got[dt.date(1997, 12, 29)][0] == 199801
    assert got[dt.date(2000, 1, 1)][0] == 199952
    assert got[dt.date(1997, 12, 28)][0] == 199752
    # one month per week, so the (week, month) dimension never fans out
    wd = week_dimension(cal)
    assert wd.count() == wd.select("week").distinct().count()
    assert wd.filter(F.col("week") == 199801).first()[AS_OF] == dt.date(1998, 1, 4)


def test_long_calendar_is_joined_without_a_limit(spark):
    cal = generate_calendar(spark, dt.date(1000, 1, 1), dt.date(2500, 1, 1))
    ev = spark.createDataFrame([(1, dt.date(1066, 10, 14)), (2, dt.date(2499, 12, 31))], "id int, d date")
    assert map_to_week(ev, F.col("d"), cal).count() == 2
    with pytest.raises(ValueError):
        generate_calendar(spark, dt.date(2000, 1, 2), dt.date(2000, 1, 1))


def test_iso_calendar_has_no_range(spark):
    days = [dt.date(1989, 12, 31), dt.date(2031, 1, 1), dt.date(1700, 5, 5), dt.date(2998, 1, 1), dt.date(1998, 1, 4), dt.date(1999, 1, 3), dt.date(2020, 12, 31)]
    ev = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(99, None)], "id int, d date")
    got = {r.id: r for r in map_to_week(ev, F.col("d"), IsoCalendar(), "day").withColumn("end", week_end(F.col("week"))).withColumn("month", month_of_week(F.col("week"))).collect()}
    assert sorted(got) == list(range(len(days)))
    for i, d in enumerate(days):
        y, w, wd = d.isocalendar()
        thursday = d + dt.timedelta(days=4 - wd)
        assert (got[i].week, got[i].end, got[i].month) == (y * 100 + w, d + dt.timedelta(days=7 - wd), thursday.year * 100 + thursday.month)
    some = map_to_week(ev, F.col("d"), IsoCalendar(weeks=(199801, 202053))).collect()
    assert sorted(r.id for r in some) == [4, 6]
    assert sorted(r.id for r in map_to_week(ev, F.col("d"), IsoCalendar(span=(199801, 199853))).collect()) == [4, 5]


def test_map_to_week_drops_outside_calendar(spark):
    cal = generate_calendar(spark, dt.date(2000, 1, 1), dt.date(2000, 12, 31))
    ev = spark.createDataFrame([(1, dt.datetime(2000, 3, 1, 13)), (2, dt.datetime(1999, 3, 1))], "id int, ts timestamp")
    out = map_to_week(ev, F.col("ts"), cal).collect()
    assert [(r.id, r.week) for r in out] == [(1, 200009)]


def test_week_list_and_bounds(spark):
    df = spark.createDataFrame([(199501,), (199503,), (199503,), (199601,)], "week int")
    assert [r.week for r in week_list(df, 199501, 199552).collect()] == [199501, 199503]
    assert iso_week_bounds([199801, 199802]) == (dt.date(1997, 12, 29), dt.date(1998, 1, 11))


def test_sentinel_rejection(spark):
    df = spark.createDataFrame([("?",), (None,), ("A1",)], "account string")
    assert [r.account for r in df.filter(valid_key(df, "account")).collect()] == ["A1"]
    num = spark.createDataFrame([(1,), (None,)], "account bigint")
    assert num.filter(valid_key(num, "account")).count() == 1


def test_not_like_modes(spark):
    pats = ["%Watch Next%", "%Trailer%"]
    df = spark.createDataFrame(
        [("home",), ("Watch Next row",), ("Watch Next Trailer",), (None,)], "ref string"
    )
    anym = [r.ref for r in df.filter(not_like("ref", pats, "any")).collect()]
    allm = [r.ref for r in df.filter(not_like("ref", pats, "all")).collect()]
    assert anym == ["home", "Watch Next row"]  # all patterns present → rejected; NULL rejected
    assert allm == ["home"]
    with pytest.raises(ValueError):
        not_like("ref", pats, "some")


def test_not_in_and_or_form_null_rules(spark):
    df = spark.createDataFrame([("Mini",), ("Q",), (None,)], "t string")
    assert [r.t for r in df.filter(not_in("t", ["Mini"])).collect()] == ["Q"]
    kept = df.filter(present_or_not_blank("t", ["Blank", ""], "%Default%")).count()
    assert kept == 2  # reduces to IS NOT NULL


def test_strip_cast_malformed(spark):
    df = spark.createDataFrame([("12M",), ("",), ("xM",), (None,)], "s string")
    assert [r.v for r in df.select(strip_cast("s", "M").alias("v")).collect()] == [12, None, None, None]


def test_clean_names_and_collision(spark):
    assert clean_name("Recording / Playback Issue") == "recordingplaybackissue"
    assert clean_name("MS+_offer") == "ms_offer"
    df = spark.createDataFrame([(1, 2)], "`x.y` int, `HD Pack` int")
    assert clean_names(df).columns == ["xy", "hdpack"]
    bad = spark.createDataFrame([(1, 2)], "`a b` int, ab int")
    with pytest.raises(ValueError, match="a b"):
        clean_names(bad)


def test_durations_signed_and_typed(spark):
    df = spark.createDataFrame(
        [(dt.date(2000, 1, 10), dt.date(2000, 1, 15), dt.datetime(2000, 1, 5, 8), "2000-01-12", 7)],
        "as_of date, offer_end_dt_actual date, last_modified_dt timestamp, tenure_start_date string, rag_date_count int",
    )
    out = add_durations(df, "as_of").first().asDict()
    assert out["offer_end_dt_actual_duration_days"] == 5
    assert out["last_modified_dt_duration_days"] == -5
    assert out["tenure_start_date_duration_days"] == 2
    assert "rag_date_count_duration_days" not in out  # name matches, type does not (Q14)
    kept = drop_raw_dates(add_durations(df, "as_of")).columns
    assert "offer_end_dt_actual" not in kept and "offer_end_dt_actual_duration_days" in kept


def test_spelling_merge(spark):
    vals = ["Recording / Playback Issue", "Recording/ Playback Issue", "Default/Vague ", "Default / Vague", "Other"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.s for r in df.select(normalise_values("s", SUB_CATEGORY_SPELLINGS).alias("s")).collect()]
    assert got == ["Recording / Playback Issue"] * 2 + ["Default/Vague"] * 2 + ["Other"]


def test_fill_strings_and_run_sequences(spark):
    from tidemark.functions.calendar import run_sequences
    from tidemark.functions.shape import fill_strings

    df = spark.createDataFrame([(None, None, 1.0)], "a string, b string, x double")
    r = fill_strings(df).first()
    assert (r.a, r.b, r.x) == ("None", "None", 1.0)
    asof = spark.createDataFrame([(199602, dt.date(1996, 1, 14)), (199601, dt.date(1996, 1, 7)), (199701, dt.date(1997, 1, 5))], "week int, as_of date")
    assert [tuple(x) for x in run_sequences(asof, 199601, 199652).collect()] == [("1996-01-07", "199601"), ("1996-01-14", "199602")]


def test_stored_calendar_of_any_size_is_joined(spark):
    from tidemark.functions import calendar as c

    stored = spark.createDataFrame([("2000-01-03", "200001", "200001")], "d string, w string, m string")
    out = c.normalise_calendar(stored, "d", "w", "m")
    assert out.schema[c.WEEK].dataType.simpleString() == "int"
    ev = spark.createDataFrame([(1, dt.date(2000, 1, 3)), (2, dt.date(2000, 1, 4))], "id int, d date")
    old = c.BROADCAST_MAX_ROWS
    try:
        for c.BROADCAST_MAX_ROWS in (old, 0):
            assert [r.id for r in map_to_week(ev, F.col("d"), c.normalise_calendar(stored, "d", "w")).collect()] == [1]
    finally:
        c.BROADCAST_MAX_ROWS = old


def test_text_dates_with_a_format(spark):
    from tidemark.functions.shape import parse_dates

    df = spark.createDataFrame([(1, "05/02/2000"), (2, "31/02/2000"), (3, "2000-02-05"), (4, None)], "id int, d string")
    assert [r.d for r in parse_dates(df, ["d"], "dd/MM/yyyy").orderBy("id").collect()] == [dt.date(2000, 2, 5), None, None, None]


def test_catalog_roles(spark, scratch):
    from tests.conftest import SF_SMALL
    from tidemark.sources.catalog import Catalog, has_rows, schema_of, star_catalog

    cat = star_catalog(spark, SF_SMALL)
    assert cat.exists("orders") and not cat.exists("nope")
    orders = cat.table("orders")
    assert has_rows(orders)
    assert ("o_orderkey", "bigint") in schema_of(orders)
    spark.createDataFrame([(1, "a")], "id long, s string").write.json(f"{scratch}/j")
    js = Catalog(spark, {"events_json": f"{scratch}/j", "missing": f"{scratch}/none"}, fmt="json")
    assert js.table("events_json").count() == 1
    assert not js.exists("missing")
