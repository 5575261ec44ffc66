import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.asof import latest_as_of
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.encode import category_counts, discover_vocabulary, top1_pivot, weighted_counts
from tidemark.operators.quality import classify_columns, continuous_profile, discrete_profile
from tidemark.operators.rangejoin import interval_join, window_join

D = dt.date


def test_category_counts_null_and_absent(spark):
    df = spark.createDataFrame([("a", "F"), ("a", None), ("a", "O"), ("b", "F")], "account string, status string")
    vocab = discover_vocabulary(df, ["status"])
    assert vocab == {"status": ["F", "O"]}  # NULL never becomes a category (Q5)
    out = df.groupBy("account").agg(*category_counts("status", vocab["status"] + ["X"], "status"))
    rows = {r.account: r.asDict() for r in out.collect()}
    assert rows["a"]["status_f"] == 1 and rows["a"]["status_o"] == 1 and rows["a"]["status_x"] == 0
    # one-hot counts of a column sum to its non-NULL row count
    assert sum(rows["a"][k] for k in ("status_f", "status_o", "status_x")) == 2


def test_dotted_value_becomes_clean_column(spark):
    df = spark.createDataFrame([("a", "x.y"), ("a", "Recording / Playback Issue")], "account string, c string")
    out = df.groupBy("account").agg(*category_counts("c", ["x.y", "Recording / Playback Issue"], "c"))
    assert out.columns == ["account", "c_xy", "c_recordingplaybackissue"]
    assert out.first()["c_xy"] == 1


def test_vocabulary_has_no_limit(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("v"))
    assert len(discover_vocabulary(df, ["v"])["v"]) == 6000


def test_merged_vocabulary_keeps_stored_and_new_values():
    from tidemark.operators.encode import merge_vocabularies

    assert merge_vocabularies({"e": {"c": ["b"]}}, {"e": {"c": ["a", "b"]}, "f": {"d": []}}) == {"e": {"c": ["a", "b"]}, "f": {"d": []}}


@pytest.mark.parametrize("values", [["A-B", "AB", "ab"], ["x y", "xy"]])
def test_values_that_clean_alike_raise_early(spark, values):
    with pytest.raises(ValueError, match=values[0]):
        category_counts("c", values, "c")
    df = spark.createDataFrame([("a", values[0], 1)], "account string, t string, n int")
    if " " not in values[0]:
        with pytest.raises(ValueError, match=values[0]):
            top1_pivot(df, ["account"], "t", values, [F.col("n")], ["n"])


def test_weighted_counts(spark):
    df = spark.createDataFrame([("a", "drama", 3), ("a", "news", 2), ("a", "drama", 1)], "account string, g string, n long")
    r = df.groupBy("account").agg(*weighted_counts("g", ["drama", "news", "kids"], "n", "genre")).first()
    assert (r.genre_drama, r.genre_news, r.genre_kids) == (4, 2, 0)


def test_first_per_key_tie_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", D(2000, 1, 5), 1, 10.0), ("a", D(2000, 1, 5), 2, 20.0), ("a", None, 3, 30.0), ("b", None, 4, 40.0)],
        "account string, d date, tie int, v double",
    )
    latest = {r.account: r.v for r in first_per_key(df, ["account"], [F.col("d"), F.col("tie")], True).collect()}
    assert latest == {"a": 20.0, "b": 40.0}  # DESC: NULL last, tie-break by highest tie
    earliest = {r.account: r.v for r in first_per_key(df, ["account"], [F.col("d"), F.col("tie")], False).collect()}
    assert earliest == {"a": 30.0, "b": 40.0}  # ASC: NULL first


def test_top1_pivot_matches_window_and_joins(spark):
    rows = [
        ("a", "HD Pack", 5.0, 1, "on"), ("a", "HD Pack", None, 2, "null-amount"), ("a", "MS+", 7.0, 3, "x"),
        ("a", "MS+", 7.0, 1, "tie-wins"), ("b", "OTHER", 1.0, 9, "other-only"),
    ]
    df = spark.createDataFrame(rows, "account string, t string, amount double, tie int, status string")
    out = top1_pivot(df, ["account"], "t", ["HD Pack", "MS+"], [F.col("amount"), F.col("tie")], ["amount", "status"])
    assert out.columns == ["account", "hd_pack_amount", "hd_pack_status", "ms_amount", "ms_status"]
    got = {r.account: r.asDict() for r in out.collect()}
    assert got["a"]["hd_pack_status"] == "null-amount"  # NULL amount is cheapest
    assert got["a"]["ms_status"] == "tie-wins"
    assert got["b"]["hd_pack_status"] is None and got["b"]["ms_status"] is None  # kept, all NULL
    # the reference's formulation: per type filter + window + left join onto distinct accounts
    left = df.select("account").distinct()
    for t in ["HD Pack", "MS+"]:
        w = Window.partitionBy("account").orderBy(F.col("amount").asc_nulls_first(), "tie")
        r = (df.filter(F.col("t") == t).withColumn("rn", F.row_number().over(w)).filter("rn = 1")
             .select("account", F.col("status").alias(t)))
        left = left.join(r, "account", "left")
    ref = {r.account: r.asDict() for r in left.collect()}
    for acc in ("a", "b"):
        assert ref[acc]["HD Pack"] == got[acc]["hd_pack_status"]
        assert ref[acc]["MS+"] == got[acc]["ms_status"]


def test_window_join_edges(spark):
    pts = spark.createDataFrame([(1, D(2000, 3, 1))], "week int, as_of date")
    ev = spark.createDataFrame(
        [(D(2000, 1, 31),), (D(2000, 1, 30),), (D(2000, 3, 31),), (D(2000, 4, 1),), (None,)], "d date"
    )
    got = sorted(r.d for r in window_join(ev, "d", pts, "as_of", 30, 30).collect())
    assert got == [D(2000, 1, 31), D(2000, 3, 31)]  # exactly 30 days kept, 31 dropped


def test_interval_join_edges(spark):
    pts = spark.createDataFrame([(1, D(2000, 3, 5)), (2, D(2000, 3, 12))], "week int, as_of date")
    iv = spark.createDataFrame(
        [("start", D(2000, 3, 5), D(2000, 3, 9)), ("end", D(2000, 2, 1), D(2000, 3, 5)),
         ("both", D(2000, 3, 1), D(2000, 6, 1)), ("none", D(2000, 3, 6), D(2000, 3, 11)),
         ("nullend", D(2000, 3, 1), None)],
        "id string, s date, e date",
    )
    got = sorted((r.id, r.week) for r in interval_join(iv, "s", "e", pts, "as_of").collect())
    assert got == [("both", 1), ("both", 2), ("end", 1), ("start", 1)]
    clipped = sorted((r.id, r.week) for r in interval_join(iv, "s", "e", pts, "as_of", clip=(D(2000, 3, 5), D(2000, 3, 12))).collect())
    assert clipped == got


def test_place_as_of_compares_dates_with_the_as_of_day(spark):
    from tidemark.operators.asof import place_as_of

    asof = spark.createDataFrame([(200010, D(2000, 3, 10)), (200011, D(2000, 3, 17)), (200020, D(2000, 5, 19))], "week int, as_of date")
    days = [D(1980, 1, 1), D(2000, 3, 10), D(2000, 3, 11), D(2000, 3, 17), D(2000, 4, 1), D(2000, 5, 19), D(2000, 5, 20), None]
    rows = place_as_of(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date"), F.col("d"), asof).collect()
    # Friday's as-of day does not see Saturday's row although both lie in one week
    assert {r.i: r.week for r in rows} == {0: 200010, 1: 200010, 2: 200011, 3: 200011, 4: 200020, 5: 200020}


def test_box_of_the_day_after_the_as_of_day_is_not_seen(spark):
    from tidemark.plans.blocks import set_top_box_block

    asof = spark.createDataFrame([(200010, D(2000, 3, 10)), (200011, D(2000, 3, 17))], "week int, as_of date")
    boxes = spark.createDataFrame([(1, D(2000, 1, 1), D(2000, 2, 1), "old", 1), (1, D(2000, 3, 11), D(2000, 3, 11), "new", 2)],
                                  "account int, installed date, modified date, box string, id int")
    spine = spark.createDataFrame([(1, 200010), (1, 200011)], "account int, week int")
    out = set_top_box_block(boxes, asof, spine, "installed", "modified", "box", "id", ["none"]).collect()
    assert {r.week: r.box for r in out} == {200010: "old", 200011: "new"}


def test_open_ended_offer_gives_a_row_per_as_of_week(spark):
    from tidemark.plans.blocks import offers_block

    first = D(2000, 1, 2)
    asof = spark.createDataFrame([(i, first + dt.timedelta(weeks=i)) for i in range(20)], "week int, as_of date")
    offers = spark.createDataFrame([(1, "A", 5.0, D(1900, 1, 1), D(9999, 12, 31), 1), (2, "A", 5.0, D(1900, 1, 1), D(1999, 12, 31), 2)],
                                   "account int, t string, amount double, s date, e date, id int")
    out = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["amount"], ["id"])
    assert sorted((r.account, r.week, r.a_amount) for r in out.collect()) == [(1, i, 5.0) for i in range(20)]
    clip = asof.agg(F.min("as_of"), F.max("as_of")).first()
    joined = interval_join(offers, "s", "e", asof, "as_of", clip=tuple(clip))
    assert joined.count() == 20


def test_latest_as_of(spark):
    hist = spark.createDataFrame(
        [("a", 1, D(2000, 1, 3), 1, "old"), ("a", 3, D(2000, 1, 1), 2, "early-install"), ("a", 5, D(2000, 2, 1), 3, "late")],
        "account string, week int, installed date, tie int, box string",
    )
    spine = spark.createDataFrame([("a", 0), ("a", 1), ("a", 4), ("a", 5), ("b", 4)], "account string, week int")
    out = {(r.account, r.week): r.box for r in latest_as_of(hist, spine, [F.col("installed"), F.col("tie")], ["box"]).collect()}
    # week 4 sees weeks 1 and 3; latest by install date is week 1's row
    assert out == {("a", 1): "old", ("a", 4): "old", ("a", 5): "late"}


def test_quality_profiles(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", 1.0), (1, "a", None, 3.0), (1, "b", "y", None), (2, "c", "y", 5.0)],
        "week int, account string, cat string, val double",
    )
    discrete, continuous = classify_columns(df)
    assert discrete == ["cat"] and continuous == ["val"]
    d = {(r.colname, r.week, r.unique_value): r.number_of_categories for r in discrete_profile(df, discrete).collect()}
    assert d == {("cat", 1, "x"): 3, ("cat", 1, "y"): 3, ("cat", 1, None): 3, ("cat", 2, "y"): 1}  # NULL counted as a category (Q12)
    c = {r.week: r for r in continuous_profile(df, continuous).collect()}
    assert (c[1].maximum_value, c[1].minimum_value, c[1].mean_value) == (3.0, 1.0, 2.0)
    assert abs(c[1].standard_deviation - 2 ** 0.5) < 1e-12
    assert c[2].standard_deviation is None  # sample stddev of one value


def test_download_counts_scalar_filter(spark):
    from tidemark.functions.calendar import generate_calendar
    from tidemark.plans.blocks import download_counts

    cal = generate_calendar(spark, D(2000, 1, 1), D(2000, 12, 31))
    df = spark.createDataFrame(
        [("a", D(2000, 3, 1), "drama", "home", 188), ("a", D(2000, 3, 1), "drama", "home", 0),
         ("a", D(2000, 3, 2), "drama", None, 188), ("a", D(2000, 3, 2), "news", "Trailer", 188)],
        "account string, d date, genre string, referer string, bytes int",
    )
    out = download_counts(df, cal, "d", "genre", "referer", ["%Trailer%"], extra_filter=F.col("bytes") == 188)
    assert sorted((r.genre, r.total_downloads) for r in out.collect()) == [("drama", 1)]


def test_profile_append_and_json_schema(spark, scratch):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from tidemark.operators.quality import append_profile, stamp
    from tidemark.sources.catalog import read_json
    from tidemark.sources.sinks import write_json

    df = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "week int, c string, v double")
    prof = stamp(continuous_profile(df, ["v"]), "created_dt_check")
    append_profile(prof, f"{scratch}/dq")
    append_profile(prof, f"{scratch}/dq")
    assert spark.read.parquet(f"{scratch}/dq").count() == 4
    schema = StructType([StructField("id", LongType()), StructField("s", StringType())])
    write_json(spark.createDataFrame([(1, "a"), (2, None)], schema), f"{scratch}/j")
    back = read_json(spark, f"{scratch}/j", schema)
    assert back.schema == schema and back.count() == 2


def test_lookahead_columns(spark):
    from tidemark.functions.shape import lookahead_columns

    df = spark.createDataFrame([(1, 2, 3, 4)], "DTV_ABs_In_Next_7D int, Offers_Applied_Next_7D_BB int, DTV_ABs_Ever int, TAs_in_next_7d int")
    assert lookahead_columns(df) == ["DTV_ABs_In_Next_7D", "Offers_Applied_Next_7D_BB", "TAs_in_next_7d"]


def test_discrete_profile_lists_every_value(spark):
    df = spark.range(30_000).select(F.lit(1).alias("week"), F.col("id").cast("string").alias("c"), F.lit("k").alias("d"))
    out = discrete_profile(df, ["c", "d"]).groupBy("colname").agg(F.count("*").alias("n"), F.max("number_of_categories").alias("m")).collect()
    assert {r.colname: (r.n, r.m) for r in out} == {"c": (30_000, 30_000), "d": (1, 1)}


def test_hot_account_results_match_brute_force(spark):
    """One account holds a third of the rows; top-1 and counts stay exact."""
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        acct = "hot" if i % 3 == 0 else f"a{rnd.randrange(200)}"
        rows.append((acct, rnd.randrange(4), rnd.choice(["T1", "T2"]), float(rnd.randrange(50)), i))
    df = spark.createDataFrame(rows, "account string, week int, t string, amount double, tie int")
    got = {(r.account, r.week): (r.t1_tie, r.t2_tie) for r in
           top1_pivot(df, ["account", "week"], "t", ["T1", "T2"], [F.col("amount"), F.col("tie")], ["tie"]).collect()}
    want = {}
    for a, w, t, amt, tie in rows:
        cur = want.setdefault((a, w), {})
        if t not in cur or (amt, tie) < cur[t]:
            cur[t] = (amt, tie)
    want = {k: (v.get("T1", (None, None))[1], v.get("T2", (None, None))[1]) for k, v in want.items()}
    assert got == want


def test_interval_join_clip_explodes_only_inside(spark):
    from tidemark.operators import rangejoin

    pts = spark.createDataFrame([(1, D(2000, 3, 5))], "week int, as_of date")
    iv = spark.createDataFrame(
        [("far", D(2030, 1, 1), D(2031, 1, 1)), ("inverted", D(2000, 3, 9), D(2000, 3, 1)), ("hit", D(1990, 1, 1), D(2040, 1, 1))],
        "id string, s date, e date",
    )
    clip = (D(2000, 2, 28), D(2000, 3, 5))
    got = interval_join(iv, "s", "e", pts, "as_of", clip=clip)
    assert [r.id for r in got.collect()] == ["hit"]
    # the explode feeding the join is bounded by the clip: at most 2 buckets for 'hit', none for the others
    s = F.greatest(F.col("s"), F.lit(clip[0]))
    e = F.least(F.col("e"), F.lit(clip[1]))
    n = iv.select(F.size(F.when(s <= e, F.sequence(rangejoin._bucket(s, 7), rangejoin._bucket(e, 7)))).alias("n")).collect()
    assert [r.n for r in n] == [None, None, 2]  # NULL array: no buckets


def test_profile_keeps_small_and_large_values(spark):
    rows = [(1, 1e-7), (1, 2e-7), (1, 4e-7), (2, 1e15), (2, 1e15 + 2), (3, 7.0), (4, None)]
    got = {r.week: r for r in continuous_profile(spark.createDataFrame(rows, "week int, v double"), ["v"]).collect()}
    assert abs(got[1].mean_value - 7e-7 / 3) < 1e-15 and abs(got[1].standard_deviation - 1.5275252316519e-07) < 1e-15
    assert got[2].mean_value == 1e15 + 1 and abs(got[2].standard_deviation - 2**0.5) < 1e-9
    assert got[3].standard_deviation is None and got[4].mean_value is None
    dec = spark.createDataFrame(rows[:3], "week int, v double").withColumn("v", F.col("v").cast("decimal(20,8)"))
    assert continuous_profile(dec, ["v"]).schema["maximum_value"].dataType.simpleString() == "decimal(20,8)"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_registered_means_lie_off_the_cuts(sf):
    """Cutting at four decimals plus 0.0123 of the last: no exact mean of the driver's columns lies within rounding error of a cut."""
    from fractions import Fraction

    import duckdb

    cols = {"l_quantity": 1, "l_extendedprice": 100, "l_discount": 100, "l_tax": 100}
    c = duckdb.connect()
    for col, unit in cols.items():
        rows = c.execute(f"SELECT sum(CAST(round({col} * {unit}) AS HUGEINT)), count(*) FROM '/root/testdata/{sf}/lineitem.parquet' GROUP BY date_trunc('week', l_shipdate)").fetchall()
        for total, n in rows:
            place = Fraction(int(total), unit * n) * 10**4 + Fraction(123, 10**4)
            off = min(place - int(place), int(place) + 1 - place)
            assert off > Fraction(1, 10**6), (col, total, n)


def test_pipeline_block_text_measure_and_own_week(spark):
    from tidemark.functions.calendar import generate_calendar
    from tidemark.plans.blocks import pipeline_block

    cal = generate_calendar(spark, D(2000, 1, 1), D(2000, 12, 31))
    df = spark.createDataFrame(
        [("a", D(2000, 3, 1), "200009", 1, "2"), ("a", D(2000, 3, 2), "200009", 1, "x"),
         ("a", D(2000, 3, 3), "200010", 1, "5")],
        "account string, event_dt date, own_week string, flag int, code string",
    )
    out = pipeline_block(df, cal, "event_dt", ["flag", "code"], own_week="own_week").collect()
    # the third row's own week disagrees with its calendar week (Q19); 'x' sums as NULL (Q3)
    assert [(r.account, r.week, r.flag, r.code) for r in out] == [("a", 200009, 2, 2.0)]


def test_reference_download_filter_values(spark):
    from tidemark.functions.calendar import generate_calendar
    from tidemark.plans.blocks import COUNTED_REQUESTED_BYTES, REFERER_PATTERNS, download_counts

    cal = generate_calendar(spark, D(2017, 1, 1), D(2017, 12, 31))
    df = spark.createDataFrame(
        [("a", D(2017, 7, 25), "Drama", "Home > Watch Next", 188), ("a", D(2017, 7, 25), "Drama", "Home", 0)],
        "account string, d date, genre string, referer string, bytes int",
    )
    out = download_counts(df, cal, "d", "genre", "referer", REFERER_PATTERNS,
                          extra_filter=F.col("bytes") == COUNTED_REQUESTED_BYTES).collect()
    # 'any' mode as coded keeps a referer holding one pattern; the byte filter drops the second row
    assert [(r.genre, r.total_downloads) for r in out] == [("Drama", 1)]


def test_dyadic_cover_is_the_range_in_few_disjoint_blocks(spark):
    from tidemark.operators.rangejoin import dyadic_cover

    ranges = [(a, b) for a in range(-19, 20, 3) for b in range(a - 1, a + 40)] + [(-70, 460), (1, 510)]
    df = spark.createDataFrame(ranges, "a int, b int")
    for r in df.select("a", "b", dyadic_cover(F.col("a"), F.col("b"), 10).alias("c")).collect():
        covered = [x for n in r.c for x in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(covered) == list(range(r.a, r.b + 1))
        assert len(r.c) <= 2 * max(1, (r.b - r.a + 1)).bit_length()


def test_long_offers_match_brute_force_and_stay_few(spark):
    """Offers of up to ten years with ties, NULL amounts and bounds, and one account with most of them."""
    import random
    from tidemark.plans.blocks import offers_block

    rnd = random.Random(5)
    first = D(1995, 1, 4)
    days = [first + dt.timedelta(days=7 * i + (i % 3 == 0)) for i in range(520)]  # as-of days differ in their place in the week
    asof = spark.createDataFrame(list(enumerate(days)), "week int, as_of date")
    rows = []
    for i in range(300):
        s = first + dt.timedelta(days=rnd.randrange(-900, 3600))
        e = s + dt.timedelta(days=rnd.choice([-3, 0, 5, 40, 111, 112, 113, 119, 700, 3650]))
        rows.append((1 if i % 3 else rnd.randrange(2, 6), rnd.choice("AB"), rnd.choice([None, 1.0, 2.0, 2.0, 3.5]),
                     None if i % 97 == 0 else s, None if i % 89 == 0 else e, i))
    offers = spark.createDataFrame(rows, "account int, t string, amount double, s date, e date, id int")
    want = {}
    for account, t, amount, s, e, i in rows:
        for w, day in enumerate(days):
            if s is not None and e is not None and s <= day <= e:
                cell = want.setdefault((account, w), {})
                key = (amount is not None, amount or 0.0, i)
                cell[t] = min(cell.get(t, key), key)
    for long_weeks in (1, 16, 10**6):
        out = offers_block(offers, asof, "s", "e", "t", ["A", "B"], "amount", ["id"], ["id"], long_weeks=long_weeks).collect()
        got = {(r.account, r.week): {k: v for k, v in (("A", r.a_id), ("B", r.b_id)) if v is not None} for r in out}
        assert len(out) == len(got)
        assert got == {k: {t: c[2] for t, c in cell.items()} for k, cell in want.items()}


def test_offers_without_as_of_days(spark):
    from tidemark.plans.blocks import offers_block

    asof = spark.createDataFrame([], "week int, as_of date")
    offers = spark.createDataFrame([(1, "A", 5.0, D(2000, 1, 1), D(2001, 1, 1), 1)], "account int, t string, amount double, s date, e date, id int")
    out = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["amount"], ["id"])
    assert out.columns == ["account", "week", "a_amount"] and out.collect() == []


def test_segment_join_holds_the_pairs_of_the_interval_join(spark):
    from tidemark.operators.rangejoin import HI, LO, POINTS, SEGMENT, point_segments, segment_join

    first = D(2000, 1, 2)
    points = spark.createDataFrame([(i, first + dt.timedelta(days=5 * i)) for i in range(60)] + [(99, None)], "week int, as_of date")
    rows = [(i, None if i == 7 else first + dt.timedelta(days=3 * i - 40), None if i == 8 else first + dt.timedelta(days=3 * i - 40 + 17 * (i % 9) - 5)) for i in range(80)]
    rows += rows[:5]
    offers = spark.createDataFrame(rows, "id int, s date, e date")
    clip = tuple(points.agg(F.min("as_of"), F.max("as_of")).first())
    joined = segment_join(offers, "s", "e", point_segments(points, "as_of", ["week"], 28), "as_of", clip, 28)
    assert joined.groupBy("id", SEGMENT).count().agg(F.max("count")).first()[0] <= 2  # a row per interval and segment; some come twice
    got = joined.join(point_segments(points, "as_of", ["week"], 28), SEGMENT).select("id", F.explode(F.slice(POINTS, F.col(LO) + 1, F.col(HI) - F.col(LO))).alias("p")).select("id", "p.week")
    want = interval_join(offers, "s", "e", points, "as_of", clip=clip).select("id", "week")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_offers_are_exchanged_by_segment_and_not_by_week(spark):
    import re
    from tidemark.plans.blocks import offers_block

    first = D(2000, 1, 2)
    asof = spark.createDataFrame([(i, first + dt.timedelta(weeks=i)) for i in range(64)], "week int, as_of date")
    offers = spark.createDataFrame([(i, "A", 5.0, first, first + dt.timedelta(weeks=63), i) for i in range(50)], "account int, t string, amount double, s date, e date, id int")
    out = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["amount"], ["id"])
    assert out.count() == 50 * 64
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(account#\d+, week#", plan)
    keys = spark.createDataFrame([(3, 5), (3, 40), (7, 63), (99, 1), (None, 2)], "account int, week int")
    some = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["amount"], ["id"], spine_keys=keys)
    assert sorted((r.account, r.week, r.a_amount) for r in some.collect()) == [(3, 5, 5.0), (3, 40, 5.0), (7, 63, 5.0)]


def test_continuous_profile_unpivots_only_values(spark):
    from tidemark.operators.quality import continuous_profile

    rows = [(1, 1.0, None, None), (1, 3.0, None, 7), (2, None, None, None), (None, 5.0, None, 2)]
    df = spark.createDataFrame(rows, "week int, a double, b double, c int")
    out = continuous_profile(df, ["a", "b", "c"])
    got = {(r.colname, r.week): (r.maximum_value, r.minimum_value, r.mean_value, r.standard_deviation) for r in out.collect()}
    none = (None,) * 4
    assert got == {
        ("a", 1): (3.0, 1.0, 2.0, 2.0**0.5), ("b", 1): none, ("c", 1): (7.0, 7.0, 7.0, None),
        ("a", 2): none, ("b", 2): none, ("c", 2): none, ("a", None): (5.0, 5.0, 5.0, None), ("b", None): none, ("c", None): (2.0, 2.0, 2.0, None),
    }
    assert "Generate explode(filter(" in out._jdf.queryExecution().executedPlan().toString()


def test_segment_join_of_timestamps_tests_the_time_of_day(spark):
    from tidemark.operators.rangejoin import HI, LO, POINTS, SEGMENT, point_segments, segment_join

    points = spark.createDataFrame([(i, D(2000, 1, 2) + dt.timedelta(days=7 * i)) for i in range(9)], "week int, as_of date")
    at = lambda d, h: dt.datetime(2000, 1, 2) + dt.timedelta(days=d, hours=h)
    rows = [(i, at(a, h), at(z, k)) for i, (a, h, z, k) in enumerate([(7, 0, 14, 0), (7, 1, 14, 1), (27, 23, 28, 0), (0, 12, 56, 0), (6, 23, 6, 23), (-90, 5, 90, 5)])]
    offers = spark.createDataFrame(rows, "id int, s timestamp, e timestamp")
    clip = tuple(points.agg(F.min("as_of"), F.max("as_of")).first())
    segments = point_segments(points, "as_of", ["week"], 28)
    joined = segment_join(offers.withColumn("s", F.col("s")), "s", "e", segments, "as_of", clip, 28).join(segments, SEGMENT)
    got = joined.select("id", F.explode(F.slice(POINTS, F.col(LO) + 1, F.col(HI) - F.col(LO))).alias("p")).select("id", "p.week")
    want = offers.join(points, (F.col("as_of") >= F.col("s")) & (F.col("as_of") <= F.col("e"))).select("id", "week")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_offers_of_a_spine_keep_one_exchange_by_account_and_segment(spark):
    import re
    from tidemark.plans.blocks import offers_block

    asof = spark.createDataFrame([(i, D(2000, 1, 2) + dt.timedelta(days=7 * i)) for i in range(40)], "week int, as_of date")
    offers = spark.createDataFrame([(1, "A", 5.0, D(2000, 1, 1), D(2000, 3, 1), 1), (2, "A", 4.0, D(2000, 1, 1), D(2000, 9, 1), 2), (1, "A", 6.0, D(2000, 2, 1), D(2000, 5, 1), 3)],
                                   "account int, t string, amount double, s date, e date, id int")
    spine = spark.createDataFrame([(1, 3), (1, 30), (2, 39), (3, 1), (1, 11)], "account int, week int")
    out = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["amount"], ["id"], spine_keys=spine)
    assert sorted(map(tuple, out.collect())) == [(1, 3, 5.0), (1, 11, 6.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(account#\d+, __segment#\d+, code#", plan)


def test_offers_without_a_spine_are_exchanged_once_for_all_segments(spark):
    import re
    from tidemark.plans.blocks import offers_block

    first = D(2000, 1, 2)
    asof = spark.createDataFrame([(i, first + dt.timedelta(weeks=i)) for i in range(64)], "week int, as_of date")
    rows = [(a, "A", float(a + i), first + dt.timedelta(weeks=i), first + dt.timedelta(weeks=i + 30), i) for a in range(4) for i in range(20)]
    offers = spark.createDataFrame(rows, "account int, t string, amount double, s date, e date, id int")
    out = offers_block(offers, asof, "s", "e", "t", ["A"], "amount", ["id"], ["id"])
    got = {(r.account, r.week): r.a_id for r in out.collect()}
    assert got == {(a, w): max(0, w - 30) for a in range(4) for w in range(50)}
    exchanged = re.findall(r"Exchange hashpartitioning\((account)#\d+(?:, (\w+)#\d+)?", out._jdf.queryExecution().executedPlan().toString())
    assert exchanged and all(keys in (("account", "code"), ("account", "")) for keys in exchanged)


def test_point_ranges_hold_the_points_between_the_bounds(spark):
    from tidemark.operators.rangejoin import point_ranges, points_below

    days = [D(2000, 1, 3) + dt.timedelta(days=x) for x in (0, 7, 7, 9, 20, 41)]
    points = spark.createDataFrame([(x,) for x in [*days, None]], "p date")
    at = lambda d, h: dt.datetime(2000, 1, 3) + dt.timedelta(days=d, hours=h)
    rows = [(i, s, e) for i, (s, e) in enumerate([(at(0, 0), at(41, 0)), (at(0, 1), at(40, 23)), (at(7, 0), at(7, 0)), (at(7, 1), at(9, 0)), (at(10, 0), at(8, 0)),
                                                  (at(-900, 0), at(-1, 23)), (at(41, 1), at(999, 0)), (None, at(9, 0)), (at(9, 0), None), (at(-900, 0), at(900, 0))])]
    below = points_below(points, "p", days[0], 42)
    low, high = point_ranges("s", "e", below, days[0], 42)
    midnight = [dt.datetime.combine(x, dt.time()) for x in days]
    for r in spark.createDataFrame(rows, "id int, s timestamp, e timestamp").select("id", "s", "e", low.alias("low"), high.alias("high")).collect():
        want = [i for i, x in enumerate(midnight) if r.s is not None and r.e is not None and r.s <= x <= r.e]
        assert list(range(r.low, r.high)) == want if r.low is not None and r.high is not None else want == []
