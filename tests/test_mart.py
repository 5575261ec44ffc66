import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark import ACCOUNT, WEEK
from tidemark.plans import runlog
from tidemark.plans.mart import assemble, run
from tidemark.plans.star import Star
from tidemark.session import materialize
from tidemark.sources.sinks import read_mart, write_weeks

W1, W2 = 199606, 199607


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_assemble_keeps_spine_and_nulls_for_empty_block(spark):
    spine = spark.createDataFrame(
        [(1, W1, dt.date(1996, 2, 11)), (2, W1, dt.date(1996, 2, 11)), (None, W1, dt.date(1996, 2, 11))],
        "account bigint, week int, as_of date",
    )
    empty = spark.createDataFrame([], "account bigint, week int, score double")
    elig = spark.createDataFrame([(1, W1, "Y", dt.date(1996, 2, 1))], "account bigint, week int, flag string, tenure_start_date date")
    out = assemble(spine, [empty, elig])
    rows = {r.account: r for r in out.collect()}
    assert set(rows) == {1, 2}  # NULL account removed once on the spine
    assert rows[2].score is None and rows[2].flag is None
    assert rows[1].tenure_start_date_duration_days == -10


def test_blocks_unique_on_keys(spark):
    s = Star(spark, SF_SMALL)
    for name in ["lineitem_pass", "events_pass", "pipeline", "eligibility", "billing", "offers", "set_top_box", "journey"]:
        df = getattr(s, name)()
        assert df.count() == df.select(ACCOUNT, WEEK).distinct().count(), name


def test_fused_equals_separate_blocks(spark):
    s = Star(spark, SF_SMALL, [W1, W2, 199801])
    separate = _rows(s.mart(fused=False))
    assert _rows(s.mart()) == separate


def test_every_block_reaches_the_mart(spark):
    m = Star(spark, SF_SMALL).mart()
    blocks = ["min_l_quantity", "status_f", "type_code_small", "score_1", "score_2", "duration_sec", "weekend_calls", "channel_click", "direction_in", "finished_flag",
              "genre_small", "eligibility", "bill_total", "small_offer_amount", "box_type", "event_type_f", "tier_name"]
    n = m.agg(*[F.count(c).alias(c) for c in blocks]).first()
    assert all(n[c] > 0 for c in blocks), n


def test_full_mart_plan_reads_lineitem_from_the_joined_lines(spark):
    plan = Star(spark, SF_SMALL).mart()._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" in plan and "l_suppkey" not in plan  # lineitem itself and part are read once, before
    assert "BroadcastNestedLoopJoin" not in plan


def test_week_restricted_scans_push_their_dates(spark):
    s = Star(spark, SF_SMALL, span=(199601, 199603))
    plan = s.spine()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(o_orderdate") >= 1 and plan.count("GreaterThanOrEqual(ts") >= 1
    for df in (s.line_speed(), s.events_pass(), s.pipeline(), s.journey()):
        assert "PushedFilters: [IsNotNull" in df._jdf.queryExecution().executedPlan().toString()


def test_later_week_brings_a_new_category(spark, scratch):
    """A stored vocabulary without some values: the run adds those its own weeks bring, and counts sum to the rows."""
    stored = {"part": {"p_type": ["ECONOMY"]}, "events": {"channel": ["fax"], "direction": []}}
    s = Star(spark, SF_SMALL, vocab=stored)
    calls = s.calls()
    assert "channel_fax" in calls.columns and "channel_click" in calls.columns
    n = calls.agg(*[F.sum(c).alias(c) for c in calls.columns if c.startswith("channel_")]).first()
    assert sum(n) == s.t("events").count() and n["channel_fax"] == 0
    assert "type_code_economy" in s.reward_claims().columns and "type_code_small" in s.reward_claims().columns


def test_multi_week_equals_union_of_single_weeks(spark):
    vocab = Star(spark, SF_SMALL).vocab("part", "lineitem", "events", "journey")  # stored, so every run has the same columns
    both = Star(spark, SF_SMALL, [W1, W2], vocab).mart()
    one = Star(spark, SF_SMALL, [W1], vocab).mart().unionByName(Star(spark, SF_SMALL, [W2], vocab).mart())
    assert both.count() > 0
    assert _rows(both) == _rows(one)


def test_mart_spine_row_count(spark):
    s = Star(spark, SF_SMALL)
    assert s.mart().count() == s.spine().count()


def test_run_is_idempotent(spark, scratch):
    mart_path, log_path = f"{scratch}/mart", f"{scratch}/log"
    requested = spark.createDataFrame([(W1,), (W2,)], "week int")
    build = lambda weeks: Star(spark, SF_SMALL, weeks).mart()
    assert run(spark, build, requested, mart_path, log_path, "weekly_mart", "mart") == [W1, W2]
    first = _rows(read_mart(spark, mart_path))
    assert run(spark, build, requested, mart_path, log_path, "weekly_mart", "mart") == []
    assert _rows(read_mart(spark, mart_path)) == first
    assert runlog.read_log(spark, log_path).count() == 2


def test_partition_overwrite_and_added_column(spark, scratch):
    path = f"{scratch}/m"
    df = spark.createDataFrame([(1, W1, 1.0), (2, W2, 2.0)], "account bigint, week int, x double")
    write_weeks(df, path)
    write_weeks(spark.createDataFrame([(3, W2, 3.0, "new")], "account bigint, week int, x double, y string"), path)
    got = {r.account: (r.week, r.y) for r in read_mart(spark, path).collect()}
    assert got == {1: (W1, None), 3: (W2, "new")}  # only the written week replaced


def test_pending_weeks_and_high_water(spark):
    requested = spark.createDataFrame([(w,) for w in (1, 2, 3, 4)], "week int")
    log = spark.createDataFrame(
        [(1, None, None, None, "p", "t"), (3, None, None, None, "p", "t"), (4, None, None, None, "other", "t")],
        runlog.LOG_SCHEMA,
    )
    assert sorted(r.week for r in runlog.pending_weeks(requested, log, "p", "t").collect()) == [2, 4]
    assert sorted(r.week for r in runlog.pending_after_high_water(requested, log, "p", "t").collect()) == [4]
    empty = spark.createDataFrame([], runlog.LOG_SCHEMA)
    assert runlog.pending_after_high_water(requested, empty).count() == 4  # missing log: all pending (Q16)
    assert runlog.read_log(spark, "/nonexistent/tidemark/log").count() == 0


def test_eligibility_as_of_form_equals_window_form_on_spine(spark):
    s = Star(spark, SF_SMALL)
    sp = s.spine()
    keys = sp.select(ACCOUNT, WEEK)
    window_form = s.eligibility(sp).join(keys, [ACCOUNT, WEEK], "left_semi")
    asof_form = s.eligibility(sp, as_of_join=True)
    assert asof_form.count() > 0
    assert _rows(asof_form) == _rows(window_form)


def test_week_restricted_run_equals_filtered_full_mart(spark):
    weeks = [W1, W2, 199853]
    whole = Star(spark, SF_SMALL)
    part = Star(spark, SF_SMALL, weeks, whole.vocab("part", "lineitem", "events", "journey")).mart()
    full = whole.mart().filter(F.col(WEEK).isin(*weeks))
    assert part.count() > 0
    assert _rows(part) == _rows(full)


def test_shared_dir_follows_session(spark):
    from tidemark.session import scratch_path, shared_dir

    base = shared_dir(spark)
    assert base == (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x").startswith(base.rstrip("/"))


def test_duplicate_eligibility_rows_do_not_fan_out(spark):
    from tidemark.plans.blocks import eligibility_block

    asof = spark.createDataFrame([(W1, dt.date(1996, 2, 11))], "week int, as_of date")
    rows = spark.createDataFrame(
        [(1, dt.date(1996, 2, 1), 10, "A"), (1, dt.date(1996, 2, 20), 11, "B"), (1, dt.date(1996, 2, 20), 12, "C"),
         (1, dt.date(1995, 1, 1), 13, "old")],
        "account bigint, tenure_start_date date, o_orderkey bigint, eligibility string",
    )
    spine = spark.createDataFrame([(1, W1, dt.date(1996, 2, 11)), (2, W1, dt.date(1996, 2, 11))], "account bigint, week int, as_of date")
    block = eligibility_block(rows, asof, "tenure_start_date", ["eligibility"], "o_orderkey")
    assert [(r.account, r.eligibility) for r in block.collect()] == [(1, "C")]  # latest date, highest tie
    as_of_form = eligibility_block(rows, asof, "tenure_start_date", ["eligibility"], "o_orderkey",
                                   spine_keys=spine.select("account", "week"))
    assert [(r.account, r.eligibility) for r in as_of_form.collect()] == [(1, "C")]
    assert assemble(spine, [block]).count() == spine.count()


def test_cli_builds_pending_weeks_once(spark, scratch):
    from tidemark.plans import cli

    vocab = f"{scratch}/vocab"
    args = ["--data", SF_SMALL, "--mart", f"{scratch}/mart", "--log", f"{scratch}/log", "--from", "199601", "--to", "199603",
            "--vocab", vocab]
    assert cli.main(args) == [199601, 199602, 199603]
    first = {tuple(r) for r in spark.read.parquet(vocab).select("source", "column", "value").collect()}
    assert ("part", "p_type", "SMALL") in first
    assert cli.main(args) == []
    more = args[:9] + ["199605"] + args[10:]
    assert cli.main(more) == [199604, 199605]
    # Event weeks bring categories that no earlier week had: new columns, older weeks NULL.
    later = args[:7] + ["202401", "--to", "202401"] + args[10:]
    assert cli.main(later) == [202401]
    rows = spark.read.parquet(vocab).select("source", "column", "value").collect()
    assert len(rows) == len({tuple(r) for r in rows}) and first < {tuple(r) for r in rows}
    assert any(r["source"] == "events" for r in rows) and not any(r[0] == "events" for r in first)
    mart = read_mart(spark, f"{scratch}/mart")
    assert mart.select(WEEK).distinct().count() == 6
    n = {r[WEEK]: r["n"] for r in mart.groupBy(WEEK).agg(F.count("channel_click").alias("n")).collect()}
    assert n[202401] > 0 and n[199601] == 0


def test_joins_of_the_assembly_carry_one_column_per_block(spark):
    spine = spark.createDataFrame([(1, W1, dt.date(1996, 2, 11)), (2, W1, dt.date(1996, 2, 11))], "account bigint, week int, as_of date")
    wide = [spark.range(1).select(F.lit(1).cast("bigint").alias("account"), F.lit(W1).alias("week"), *[F.lit(i).alias(f"b{n}_{i}") for i in range(30)]) for n in range(3)]
    out = assemble(spine, [*wide, wide[0].select(ACCOUNT, WEEK)])
    widths = []

    def walk(node):
        if node.nodeName() == "Join":
            widths.append(node.output().size())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(out._jdf.queryExecution().optimizedPlan())
    assert widths and max(widths) <= 3 + 3 + 2 * 3
    rows = {r.account: r for r in out.collect()}
    assert set(rows) == {1, 2} and rows[1].b2_29 == 29 and rows[1].b0_0 == 0
    assert rows[2].b0_0 is None and rows[2].b2_29 is None


def test_genre_of_a_title_is_made_before_its_lines(spark):
    s = Star(spark, SF_SMALL)
    lines = materialize(s.lines(), "t-lines")
    plan = s.lineitem_pass(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(" not in plan and "p_name" not in plan
