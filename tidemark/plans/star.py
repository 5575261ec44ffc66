"""Role mapping of the driver's star-schema tables and the registered queries.

Roles (see FIXTURES §C): account = customer key (events: user id), week = ISO
``YYYYWW``, as-of = last calendar day of the week, party→account bridge =
orders (order key → customer key). Each ``q_*`` function takes (spark,
sf_dir) and returns a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

import datetime as dt
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import ACCOUNT, WEEK
from tidemark.functions.calendar import (
    AS_OF,
    IsoCalendar,
    StoredCalendar,
    as_of_frame,
    bounded_frame,
    day_range,
    map_to_week,
    normalise_calendar,
    run_sequences,
    stored_calendar,
    week_end,
    week_list,
)
from tidemark.functions.columns import Rule, apply_map
from tidemark.functions.predicates import not_in, not_like, present_or_not_blank
from tidemark.functions.shape import add_durations, clean_names, drop_raw_dates, fill_strings, normalise_values, parse_dates, strip_cast
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.encode import discover_vocabularies, merge_vocabularies
from tidemark.operators.quality import (
    append_profile,
    classify_columns,
    continuous_profile,
    continuous_state,
    discrete_profile,
    discrete_state,
    merge_continuous,
    merge_discrete,
    stamp,
    stored_ranges,
)
from tidemark.plans import blocks, runlog
from tidemark.plans.mart import assemble, run
from tidemark.session import materialize, scratch_path, shuffles_removed
from tidemark.sources.catalog import Catalog, has_rows, read_json, star_catalog
from tidemark.sources.shards import read_json_shards
from tidemark.sources.sinks import read_mart, write_json, write_weeks

# Fixed values of the role mapping (shared with the SQL oracles).
STAR_REFERER_PATTERNS = ["%small%", "%ring%"]
NAME_PATTERNS = ["%red%", "%bolt%"]
RETURN_FLAGS = ["A", "N", "R", "X"]
OFFER_ATTRS = ["offer_amount", "percent_value", "offer_status", "offer_start_dt_actual", "offer_end_dt_actual", "offer_end_modified", "last_modified_dt"]
EXCLUDED_BOX_TYPES = ["5-LOW"]
PRIORITY_SPELLINGS = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "4-NOT SPECIFIED": "LOW", "5-LOW": "LOW"}
ACCOUNT_NAME_FORMAT = "Customer#%09d"
PROPS_NUMBER = r'"k":\s*(-?[0-9.]+)'
LOGGED_MONTHS = [1, 2, 3, 7, 8, 9]
LOGGED_UNTIL_YEAR = 2000
WEEK_LO, WEEK_HI = 199401, 200252  # the weeks of the order dates
GOLD_PRICE = 250_000
BOX_LEAD_DAYS = 15  # a box is installed up to this many days before it is modified
# INT measures of the call block: output name → expression over the event columns of ``events_src``.
CALL_MEASURES = {
    "duration_sec": "value", "props_total": "props_number", "total_abandons": "abandon_flag", "click_calls": "click_flag", "purchase_calls": "purchase_flag",
    "signup_calls": "signup_flag", "view_calls": "view_flag", "long_calls": "long_flag", "short_calls": "short_flag", "night_calls": "night_flag",
    "weekend_calls": "weekend_flag", "hour_total": "hour_of_day", "minute_total": "minute_of_hour", "day_total": "day_of_month",
}


class Star:
    """Lazy readers of the driver tables plus the derived calendar and spine."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        weeks: list[int] | None = None,
        vocab: dict[str, dict[str, list[str]]] | None = None,
        span: tuple[int, int] | None = None,
        tables: dict[str, DataFrame] | None = None,
        calendar: StoredCalendar | None = None,
    ):
        """``weeks`` (or the inclusive ``span`` of weeks) limits the run: every weekly block maps
        dates through the calendar, so limiting the calendar limits them
        all. As-of blocks also read earlier dates. ``vocab`` supplies stored category
        vocabularies (same shape as ``vocab()`` returns); values that the run's own rows bring are added to them.
        ``tables`` replaces some of the tables of ``sf_dir``; ``calendar`` is a stored calendar in place of the ISO weeks."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.weeks = sorted(weeks) if weeks else None
        self.tables = dict(tables or {})
        limit = tuple(self.weeks) if self.weeks else None
        self.calendar = IsoCalendar(limit, span) if calendar is None else calendar.limited(limit, span)
        self.stored_vocab: dict[str, dict[str, list[str]]] = dict(vocab or {})
        self._vocab: dict[str, dict[str, list[str]]] = {}

    def t(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def dated(self, df: DataFrame, col: str, before: int = 0, after: int = 0, lower: bool = True) -> DataFrame:
        """For a week-restricted run, a raw-date filter that Parquet can use to
        skip row groups. It repeats what the calendar already
        enforces (widened by ``before``/``after`` days where a block looks
        outside the week), so it only prunes I/O."""
        bounds = self.calendar.bounds()
        if bounds is None:
            return df
        lo, hi = bounds
        lo_day = lo - dt.timedelta(days=before) if lower else None
        return df.filter(day_range(df, col, lo_day, hi + dt.timedelta(days=after)))

    # -- bridge: order key → account -------------------------------------
    def bridge(self, key: str = "l_orderkey") -> DataFrame:
        return self.t("orders").select(F.col("o_orderkey").alias(key), F.col("o_custkey").alias(ACCOUNT))

    # -- H1 weekly base ----------------------------------------------------
    def base(self) -> DataFrame:
        o = self.dated(self.t("orders"), "o_orderdate").select(F.col("o_custkey").alias(ACCOUNT), "o_orderdate")
        e = self.dated(self.t("events"), "ts").select(F.col("user_id").alias(ACCOUNT), "ts")
        pairs = map_to_week(o, F.col("o_orderdate"), self.calendar).select(ACCOUNT, WEEK)
        pairs = pairs.unionByName(map_to_week(e, F.col("ts"), self.calendar).select(ACCOUNT, WEEK)).distinct()
        cust = self.t("customer").select(
            F.col("c_custkey").alias(ACCOUNT), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
        )
        return pairs.join(cust, ACCOUNT, "inner")

    def spine(self) -> DataFrame:
        return blocks.spine(
            self.base(),
            self.calendar.week_dimension(self.spark),
            keep=["c_nationkey", "c_acctbal", "c_mktsegment", strip_cast("c_name", "Customer#").alias("name_number")],
            where=(F.col("c_acctbal") > 0) & F.col("c_mktsegment").isNotNull(),
        )

    def asof(self, spine: DataFrame | None = None) -> DataFrame:
        return bounded_frame(as_of_frame(self.spine() if spine is None else spine), "as-of")

    # -- role frames ---------------------------------------------------------
    def line_speed_src(self) -> DataFrame:
        li = self.dated(self.t("lineitem"), "l_shipdate").select(
            "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"
        )
        return li.join(self.bridge(), "l_orderkey", "inner")

    def claims_src(self) -> DataFrame:
        li = self.dated(self.t("lineitem"), "l_shipdate").select(
            "l_orderkey", "l_partkey", F.col("l_linestatus").alias("status"), "l_shipdate"
        )
        types = self.t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("type_code"))
        return li.join(types, "l_partkey", "left").join(self.bridge(), "l_orderkey", "inner")

    def events_src(self) -> DataFrame:
        e = self.dated(self.t("events"), "ts")
        number = F.regexp_extract("props", PROPS_NUMBER, 1)
        flag = lambda cond: F.when(cond, 1).otherwise(0)
        return e.select(
            F.col("user_id").alias(ACCOUNT),
            "ts",
            F.col("event_type").alias("channel"),
            F.when(number.try_cast("int") % 2 == 0, "IN").otherwise("OUT").alias("direction"),
            F.col("value"),
            number.alias("props_number"),
            *[flag(F.col("event_type") == t).alias(f"{n}_flag") for t, n in (("error", "abandon"), ("click", "click"), ("purchase", "purchase"), ("signup", "signup"), ("view", "view"))],
            flag(F.col("value") > 100).alias("long_flag"),
            flag(F.col("value") < 10).alias("short_flag"),
            flag(F.hour("ts") < 6).alias("night_flag"),
            flag(F.weekday("ts") >= 5).alias("weekend_flag"),
            F.hour("ts").alias("hour_of_day"),
            F.minute("ts").alias("minute_of_hour"),
            F.dayofmonth("ts").alias("day_of_month"),
        )

    def pipeline_src(self) -> DataFrame:
        o = self.dated(self.t("orders"), "o_orderdate")
        flag = lambda cond: F.when(cond, 1).otherwise(0)
        return o.select(
            F.col("o_custkey").alias(ACCOUNT),
            "o_orderdate",
            flag(F.col("o_orderstatus") == "F").alias("finished_flag"),
            flag(F.col("o_orderstatus") == "P").alias("pending_flag"),
            flag(F.col("o_orderpriority") == "1-URGENT").alias("urgent_flag"),
            flag(F.col("o_orderpriority") == "5-LOW").alias("low_flag"),
        )

    def downloads_src(self, extra: list[str] | None = None) -> DataFrame:
        li = self.dated(self.t("lineitem"), "l_shipdate").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", *(extra or []))
        p = self.t("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("genre"), F.col("p_name").alias("referer")
        )
        return li.join(p, "l_partkey", "inner").join(self.bridge(), "l_orderkey", "inner")

    def eligibility_src(self) -> DataFrame:
        return self.dated(self.t("orders"), "o_orderdate", before=30, after=30).select(
            F.col("o_custkey").alias(ACCOUNT),
            F.to_date("o_orderdate").alias("tenure_start_date"),
            F.col("o_orderstatus").alias("eligibility"),
            "o_orderkey",
        )

    def bills_src(self, lines: DataFrame | None = None) -> DataFrame:
        bills = self.dated(self.t("orders"), "o_orderdate").filter(F.col("o_orderpriority").like("1%")).select(
            "o_orderkey", "o_custkey", F.col("o_orderdate").alias("tax_date"), "o_totalprice"
        )
        # Join, then aggregate: the lineitem side sits directly under a join
        # with the (selective) bills, so Spark can prune it with a runtime
        # bloom filter; a one-week run then shuffles that week's lines only.
        # A full mart passes its own joined lines instead, which lie by order, so the last ship date of an order is found
        # before the exchange.
        source = self.t("lineitem") if lines is None else lines
        lines = source.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate") if lines is None else source.groupBy(
            F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("l_shipdate"))
        paid = bills.join(lines, "o_orderkey", "left").groupBy("o_orderkey", "o_custkey", "tax_date", "o_totalprice").agg(
            F.max("l_shipdate").alias("balance_zero_dt")
        )
        cabo = self.t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        fo = self.t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        rate = F.lit(1.0) + F.col("n_regionkey").cast("double") / F.lit(10.0)
        chain = paid.join(cabo, "o_custkey", "inner").join(fo, "c_nationkey", "inner")
        return chain.select(
            F.col("o_custkey").alias(ACCOUNT),
            "tax_date",
            "o_orderkey",
            (rate * F.col("o_totalprice")).alias("bill_total"),
            (F.lit(-1.0) * rate * F.col("o_totalprice")).alias("amount_paid"),
            F.datediff(F.to_date("balance_zero_dt"), F.to_date("tax_date")).alias("payment_delay_in_days"),
        )

    def offers_src(self, lines: DataFrame | None = None) -> DataFrame:
        start = F.to_date("l_shipdate")
        if lines is None:
            li = self.dated(self.t("lineitem"), "l_shipdate", lower=False).select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate", "l_quantity"
            )
            p = self.t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
            lines = li.join(p, "l_partkey", "inner").join(self.bridge(), "l_orderkey", "inner")
        return lines.select(
            ACCOUNT,
            "p_type",
            F.col("l_extendedprice").alias("offer_amount"),
            F.col("l_discount").alias("percent_value"),
            F.col("l_linestatus").alias("offer_status"),
            start.alias("offer_start_dt_actual"),
            F.date_add(start, F.col("l_quantity").try_cast("int")).alias("offer_end_dt_actual"),
            F.date_add(start, F.col("l_quantity").try_cast("int") + F.col("l_linenumber")).alias("offer_end_modified"),
            F.date_sub(start, F.col("l_linenumber")).alias("last_modified_dt"),
            "l_orderkey",
            "l_linenumber",
        )

    def boxes_src(self) -> DataFrame:
        d = F.to_date("o_orderdate")
        return self.dated(self.t("orders"), "o_orderdate", lower=False).select(
            F.col("o_custkey").alias(ACCOUNT),
            F.date_sub(d, (F.col("o_orderkey") % BOX_LEAD_DAYS).cast("int")).alias("installed_dt"),
            d.alias("modified_dt"),
            F.col("o_orderpriority").alias("box_type"),
            "o_orderkey",
        )

    def journey_src(self) -> DataFrame:
        return self.dated(self.t("orders"), "o_orderdate").select(
            F.format_string(ACCOUNT_NAME_FORMAT, F.col("o_custkey")).alias("account_obf"),
            F.col("o_orderstatus").alias("event_type"),
            F.col("o_orderpriority").alias("event_sub_category"),
            F.when(F.col("o_totalprice") > GOLD_PRICE, "GOLD").otherwise("SILVER").alias("tier_name"),
            F.col("o_orderpriority").alias("loyalty_status"),
            F.to_date("o_orderdate").alias("event_start_date"),
        )

    # -- blocks ----------------------------------------------------------------
    def line_speed(self) -> DataFrame:
        return blocks.line_speed_block(
            self.line_speed_src(), self.calendar, "l_shipdate",
            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag", RETURN_FLAGS,
        )

    def reward_claims(self) -> DataFrame:
        status = self.vocab("lineitem", "part")["lineitem"]["l_linestatus"]
        return blocks.counts_block(
            self.claims_src(), self.calendar, "l_shipdate",
            {"status": ("status", status), "type_code": ("type_code", self.part_types())},
        )

    def survey(self) -> DataFrame:
        e = self.events_src()
        return blocks.survey_block(e, self.calendar, "ts", {"value": "score_1", "props_number": "score_2"})

    def calls(self) -> DataFrame:
        return blocks.calls_block(self.events_src(), self.calendar, "ts", *self.call_args())

    def call_args(self) -> tuple:
        vocab = self.vocab("events")["events"]
        return (
            {src: dst for dst, src in CALL_MEASURES.items()},
            ("value", "mean_duration"),
            {"channel": ("channel", vocab["channel"]), "direction": ("direction", vocab["direction"])},
        )

    def pipeline(self) -> DataFrame:
        return blocks.pipeline_block(
            self.pipeline_src(), self.calendar, "o_orderdate",
            ["finished_flag", "pending_flag", "urgent_flag", "low_flag"],
        )

    def download_counts(self) -> DataFrame:
        return blocks.download_counts(self.downloads_src(), self.calendar, "l_shipdate", "genre", "referer", STAR_REFERER_PATTERNS)

    def vocab(self, *names: str) -> dict[str, dict[str, list[str]]]:
        """Category vocabularies (F4) of the named sources, discovered together
        in one job over the rows of the run's weeks, merged with the stored ones and kept for the life of this object:
        ``part`` (p_type), ``lineitem`` (l_linestatus), ``events`` (channel, direction),
        ``journey`` (status and merged priority of orders)."""
        def weekly(df: DataFrame, date_col: str) -> DataFrame:
            return map_to_week(self.dated(df, date_col), F.col(date_col), self.calendar)

        sources = {
            "part": lambda: (self.t("part"), ["p_type"]),
            "lineitem": lambda: (weekly(self.t("lineitem").select("l_linestatus", "l_shipdate"), "l_shipdate"), ["l_linestatus"]),
            "events": lambda: (map_to_week(self.events_src(), F.col("ts"), self.calendar), ["channel", "direction"]),
            "journey": lambda: (
                weekly(self.t("orders").select("o_orderstatus", "o_orderpriority", "o_orderdate"), "o_orderdate").select(
                    F.col("o_orderstatus").alias("event_type"),
                    normalise_values("o_orderpriority", PRIORITY_SPELLINGS).alias("event_sub_category"),
                ),
                ["event_type", "event_sub_category"],
            ),
        }
        missing = [n for n in names if n not in self._vocab]
        if missing:
            stored = {n: self.stored_vocab[n] for n in missing if n in self.stored_vocab}
            self._vocab.update(merge_vocabularies(stored, discover_vocabularies({n: sources[n]() for n in missing})))
        return {n: self._vocab[n] for n in names}

    def part_types(self) -> list[str]:
        return self.vocab("part")["part"]["p_type"]

    def genres(self) -> list[str]:
        return sorted({t.lower() for t in self.part_types()})

    def downloads(self) -> DataFrame:
        return blocks.downloads_block(
            self.downloads_src(), self.calendar, "l_shipdate", "genre", "referer", STAR_REFERER_PATTERNS, self.genres(), "genre"
        )

    def eligibility(self, spine: DataFrame | None = None, as_of_join: bool = False, asof: DataFrame | None = None) -> DataFrame:
        """Standalone: all (account, week) pairs with a row in the window.
        ``as_of_join=True`` (the mart): only spine pairs, without fan-out."""
        keys = spine.select(ACCOUNT, WEEK) if (as_of_join and spine is not None) else None
        return blocks.eligibility_block(
            self.eligibility_src(), self.asof(spine) if asof is None else asof, "tenure_start_date", ["eligibility"], "o_orderkey",
            spine_keys=keys,
        )

    def billing(self, lines: DataFrame | None = None) -> DataFrame:
        return blocks.billing_block(
            self.bills_src(lines), self.calendar, "tax_date", ["bill_total", "amount_paid", "payment_delay_in_days"], "o_orderkey"
        )

    def offers(self, spine: DataFrame | None = None, asof: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
        src = materialize(self.offers_src(), "offers") if lines is None else self.offers_src(lines)
        return blocks.offers_block(
            src, self.asof(spine) if asof is None else asof, "offer_start_dt_actual", "offer_end_dt_actual", "p_type",
            self.part_types(),
            "offer_amount",
            OFFER_ATTRS,
            ["l_orderkey", "l_linenumber"],
            spine_keys=None if spine is None else spine.select(ACCOUNT, WEEK),
        )

    def set_top_box(self, spine: DataFrame | None = None, asof: DataFrame | None = None) -> DataFrame:
        sp = self.spine() if spine is None else spine
        return blocks.set_top_box_block(
            self.boxes_src(), self.asof(sp) if asof is None else asof, sp.select(ACCOUNT, WEEK),
            "installed_dt", "modified_dt", "box_type", "o_orderkey", EXCLUDED_BOX_TYPES,
        )

    def box_state(self, upto: dt.date, since: dt.date | None = None, state: DataFrame | None = None) -> DataFrame:
        """State of the boxes modified up to a day; with an earlier ``state`` only those after the day ``since`` are read."""
        after = None if since is None else since + dt.timedelta(days=1)
        orders = self.t("orders")
        part = Star(self.spark, self.sf_dir, tables={**self.tables, "orders": orders.where(day_range(orders, "o_orderdate", after, upto))})
        return blocks.box_state(part.boxes_src(), "installed_dt", "box_type", "o_orderkey", EXCLUDED_BOX_TYPES, state)

    def set_top_box_after(self, since: dt.date, state: DataFrame, spine: DataFrame) -> DataFrame:
        """The box block of spine weeks whose as-of days are after ``since``, from the state as of that day and the
        boxes modified later; the scan of earlier ones is skipped."""
        orders = self.t("orders")
        part = Star(self.spark, self.sf_dir, tables={**self.tables, "orders": orders.where(day_range(orders, "o_orderdate", since + dt.timedelta(days=1), None))})
        keys = spine.where(F.col(AS_OF) > F.lit(since))
        return blocks.set_top_box_block(
            part.boxes_src(), self.asof(keys), keys.select(ACCOUNT, WEEK), "installed_dt", "modified_dt", "box_type", "o_orderkey", EXCLUDED_BOX_TYPES, state
        )

    def journey(self) -> DataFrame:
        return blocks.journey_block(
            self.journey_src(), self.t("customer"), self.calendar,
            "account_obf", "c_name", "c_custkey", "event_start_date", "event_type", "event_sub_category",
            ["tier_name", "loyalty_status"], self.vocab("journey")["journey"], spellings=PRIORITY_SPELLINGS,
        )

    def lines(self) -> DataFrame:
        """lineitem with its part and account: the rows of line speed, claims, downloads, offers and billing."""
        li = self.dated(self.t("lineitem"), "l_shipdate", lower=False).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        )
        kept = blocks.kept_genre("p_type", "p_name", STAR_REFERER_PATTERNS)
        p = self.t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", kept.alias("kept_genre"))
        return li.join(p, "l_partkey", "left").join(self.bridge(), "l_orderkey", "inner")

    def lineitem_pass(self, lines: DataFrame | None = None, spine: DataFrame | None = None) -> DataFrame:
        """Line speed, reward claims and downloads share their rows, so they are one aggregate of ``lines``; of a ``spine``, if given, only its pairs."""
        rows = self.dated(self.lines() if lines is None else lines, "l_shipdate")
        status = self.vocab("lineitem")["lineitem"]["l_linestatus"]
        aggs = (
            blocks.line_speed_aggs(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag", RETURN_FLAGS)
            + blocks.counts_aggs({"l_linestatus": ("status", status)})
            + blocks.counts_aggs({"p_type": ("type_code", self.part_types())})
            + blocks.downloads_aggs("kept_genre", self.genres(), "genre")
        )
        return blocks.weekly_aggregate(rows, self.calendar, F.col("l_shipdate"), aggs, spine)

    def events_pass(self) -> DataFrame:
        """Survey scores and call counts read the same event rows: one aggregate."""
        aggs = blocks.survey_aggs({"value": "score_1", "props_number": "score_2"}) + blocks.calls_aggs(*self.call_args())
        return blocks.weekly_aggregate(self.events_src(), self.calendar, F.col("ts"), aggs)

    def mart(self, fused: bool = True, spine: DataFrame | None = None, lines: DataFrame | None = None, boxes: DataFrame | None = None, apart: bool = False) -> DataFrame:
        """One plan for local and cluster runs. The spine (assembly, as-of frame, box and eligibility joins) and the lineitem
        join (line pass, offers, and billing in a full run) are computed once and written to the shared folder; a
        run of some weeks takes billing's ship dates from a scan that the few bills prune. A caller that has already written the
        ``spine`` of this run, the ``lines`` of all weeks or the box block of the spine (``boxes``) passes them.
        ``apart`` writes the two blocks that exchange all lines before the assembly, so the disk holds the shuffles of one of them at a time. ``fused=False`` builds every block on its own, for comparison."""
        self.vocab("part", "lineitem", "events", "journey")  # one discovery job for the run
        sp = materialize(self.spine(), "spine") if spine is None else spine
        asof = self.asof(sp)
        if fused:
            whole = lines is not None or not self.weeks
            lines = materialize(self.lines(), "lines") if lines is None else lines
            active = self.dated(lines, "l_shipdate", lower=False).where("p_type is not null")
            kept = materialize if apart else lambda df, name: df
            parts = [kept(self.lineitem_pass(lines, sp), "line-pass"), self.events_pass(), self.pipeline(),
                     self.eligibility(sp, as_of_join=True, asof=asof), self.billing(lines if whole else None),
                     kept(self.offers(sp, asof, active), "offers"), self.set_top_box(sp, asof) if boxes is None else boxes, self.journey()]
        else:
            parts = [self.line_speed(), self.reward_claims(), self.survey(), self.calls(), self.pipeline(),
                     self.downloads(), self.eligibility(sp, asof=asof), self.billing(), self.offers(sp, asof), self.set_top_box(sp, asof),
                     self.journey()]
        return assemble(sp, parts)


def _round(df: DataFrame, cols: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), cols[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------

def q_week_calendar_map(spark, d):
    s = Star(spark, d)
    return map_to_week(s.t("orders").select("o_orderdate"), F.col("o_orderdate"), s.calendar).groupBy(WEEK).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def q_run_week_list(spark, d):
    return week_list(Star(spark, d).spine(), WEEK_LO, WEEK_HI)


def q_asof_per_week(spark, d):
    return Star(spark, d).asof()


def q_run_sequences(spark, d):
    return run_sequences(Star(spark, d).asof(), WEEK_LO, WEEK_HI)


def q_weekly_base(spark, d):
    return Star(spark, d).spine()


def q_strip_cast(spark, d):
    p = Star(spark, d).t("part")
    return p.select(
        "p_partkey", "p_brand",
        strip_cast("p_brand", "Brand#").alias("brand_number"),
        strip_cast("p_brand", "Brand#1").alias("teen_number"),
    )


def q_line_speed_block(spark, d):
    return Star(spark, d).line_speed()


def q_reward_claims_block(spark, d):
    return Star(spark, d).reward_claims()


def q_survey_block(spark, d):
    return _round(Star(spark, d).survey(), {"score_1": 6, "score_2": 6})


def q_calls_block(spark, d):
    return _round(Star(spark, d).calls(), {"mean_duration": 6})


def q_pipeline_block(spark, d):
    return Star(spark, d).pipeline()


def q_download_counts(spark, d):
    return Star(spark, d).download_counts()


def q_downloads_block(spark, d):
    return Star(spark, d).downloads()


def _names(spark, d, match):
    p = Star(spark, d).t("part")
    return p.filter(not_like("p_name", NAME_PATTERNS, match)).select("p_partkey", "p_name")


def q_not_like_any(spark, d):
    return _names(spark, d, "any")


def q_not_like_all(spark, d):
    return _names(spark, d, "all")


def q_not_in_null_rule(spark, d):
    o = Star(spark, d).t("orders")
    prio = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise(F.col("o_orderpriority"))
    x = o.select("o_orderkey", prio.alias("priority"))
    return x.select(
        "o_orderkey",
        "priority",
        F.coalesce(not_in("priority", EXCLUDED_BOX_TYPES), F.lit(False)).alias("not_in_keeps"),
        F.coalesce(present_or_not_blank("priority", ["Blank", ""], "%LOW%"), F.lit(False)).alias("or_form_keeps"),
    )


def q_eligibility_block(spark, d):
    return Star(spark, d).eligibility()


def q_billing_block(spark, d):
    return _round(Star(spark, d).billing(), {"bill_total": 4, "amount_paid": 4})


def q_offers_active(spark, d):
    from tidemark.operators.rangejoin import interval_join

    s = Star(spark, d)
    start = F.to_date("l_shipdate")
    li = s.t("lineitem").select(
        "l_orderkey", "l_linenumber",
        start.alias("start_dt"),
        F.date_add(start, F.col("l_quantity").try_cast("int")).alias("end_dt"),
    )
    asof = s.asof()
    return interval_join(li, "start_dt", "end_dt", asof, AS_OF, clip=tuple(asof.agg(F.min(AS_OF), F.max(AS_OF)).first())).select(
        "l_orderkey", "l_linenumber", WEEK, AS_OF
    )


def q_offers_block(spark, d):
    return Star(spark, d).offers()


def q_offers_long(spark, d):
    """Contracts of up to ten years: per week and type, the accounts that hold one and the bounds of their cheapest amounts."""
    s = Star(spark, d)
    src = s.offers_src().withColumn("offer_end_dt_actual", F.date_add("offer_start_dt_actual", 73 * F.datediff("offer_end_dt_actual", "offer_start_dt_actual")))
    block = blocks.offers_block(  # reads the offers once, so they are not written before
        src, s.asof(), "offer_start_dt_actual", "offer_end_dt_actual", "p_type", s.part_types(), "offer_amount",
        ["offer_amount", "offer_status"], ["l_orderkey", "l_linenumber"],
    )
    aggs = []
    for t in map(str.lower, s.part_types()):
        amount = F.col(f"{t}_offer_amount")
        aggs += [F.count(amount).alias(f"{t}_accounts"), F.min(amount).alias(f"{t}_lowest"), F.max(amount).alias(f"{t}_highest"),
                 F.count_if(F.col(f"{t}_offer_status") == "F").alias(f"{t}_finished")]
    return block.groupBy(WEEK).agg(*aggs)


def q_set_top_box_block(spark, d):
    return Star(spark, d).set_top_box()


def q_journey_block(spark, d):
    return Star(spark, d).journey()


def q_clean_names(spark, d):
    p = Star(spark, d).t("part")
    return clean_names(
        p.select(
            F.col("p_partkey").alias("Part Key"),
            F.col("p_brand").alias("MS+ Brand"),
            F.col("p_type").alias("Type/Group"),
            F.col("p_size").alias("x.size"),
            F.col("p_retailprice").alias("Retail Price ($)"),
        )
    )


def _dated_lines(s: Star) -> DataFrame:
    o = s.t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    o = map_to_week(o, F.col("o_orderdate"), s.calendar).withColumn(AS_OF, week_end(F.col(WEEK)))
    li = s.t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return li.join(o, "l_orderkey", "inner").select(
        "l_orderkey", "l_linenumber",
        F.col("l_shipdate").alias("ship_date"),
        F.col("o_orderdate").alias("order_date"),
        AS_OF,
    )


def q_durations(spark, d):
    return add_durations(_dated_lines(Star(spark, d)), AS_OF)


def q_drop_raw_dates(spark, d):
    return drop_raw_dates(add_durations(_dated_lines(Star(spark, d)), AS_OF))


def q_customer_week_mart(spark, d):
    return _round(Star(spark, d).mart(), {"score_1": 6, "score_2": 6, "mean_duration": 6, "bill_total": 4, "amount_paid": 4})


def _requested_and_log(s: Star):
    """The weeks of the spine (one row per week, bounded by the calendar) are
    computed once and written, so the requested list, the log and the
    high-water subquery do not each recompute the spine from orders."""
    weeks = materialize(s.spine().select(WEEK, AS_OF).distinct(), "spine-weeks")
    requested = weeks.select(WEEK)
    log = (
        weeks
        .filter(F.month(AS_OF).isin(*LOGGED_MONTHS) & (F.year(AS_OF) <= LOGGED_UNTIL_YEAR))
        .select(WEEK, F.lit("weekly_mart").alias("process_name"), F.lit("mart").alias("table_name"))
    )
    return requested, log


def q_pending_weeks(spark, d):
    requested, log = _requested_and_log(Star(spark, d))
    return runlog.pending_weeks(requested, log, "weekly_mart", "mart")


def q_pending_after_hwm(spark, d):
    requested, log = _requested_and_log(Star(spark, d))
    return runlog.pending_after_high_water(requested, log, "weekly_mart", "mart")


def q_dq_discrete(spark, d):
    s = Star(spark, d)
    o = s.t("orders")
    prio = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise(F.col("o_orderpriority"))
    src = map_to_week(o.select("o_orderdate", "o_orderstatus", "o_orderpriority", prio.alias("priority_or_null")), F.col("o_orderdate"), s.calendar)
    return discrete_profile(src, ["o_orderstatus", "o_orderpriority", "priority_or_null"])


def q_dq_continuous(spark, d):
    s = Star(spark, d)
    li = map_to_week(s.t("lineitem").select("l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"), F.col("l_shipdate"), s.calendar)
    return _profile_out(continuous_profile(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


def _cut(col: str, digits: int):
    """Value cut down to ``digits`` decimals after adding 0.0123 of the last one. Exact means are
    short decimals, so no value lies on a cut, and the order in which doubles were added does not show."""
    return F.floor(F.col(col) * F.lit(10.0**digits) + F.lit(0.0123)) / F.lit(10.0**digits)


def _profile_out(prof: DataFrame) -> DataFrame:
    return prof.select("colname", WEEK, "maximum_value", "minimum_value", _cut("mean_value", 4).alias("mean_value"), _cut("standard_deviation", 3).alias("standard_deviation"))


def _mart_profiles(spark, d):
    """Profiles read the mart as written (as the reference profiles its loaded
    table): one write to the shared folder, then a columnar scan."""
    m = materialize(q_customer_week_mart(spark, d), "mart-profile")
    discrete, continuous = classify_columns(m)
    return m, discrete, continuous


def q_dq_mart_discrete(spark, d):
    """J1+J2 on the mart itself: text columns except the account, per week."""
    m, discrete, _ = _mart_profiles(spark, d)
    return discrete_profile(m, discrete)


def q_dq_mart_continuous(spark, d):
    """J1+J3 on the mart itself: numeric columns except the week, per week."""
    m, _, continuous = _mart_profiles(spark, d)
    return _profile_out(continuous_profile(m, continuous))


def q_mart_roundtrip(spark, d):
    """A5: write all weeks, rewrite the last week with an added column, read back."""
    s = Star(spark, d)
    path = scratch_path(spark, "mart")
    sp = s.spine().join(_round(s.billing(), {"bill_total": 4, "amount_paid": 4}), [ACCOUNT, WEEK], "left")
    write_weeks(sp, path)
    last = read_mart(spark, path).agg(F.max(WEEK)).first()[0]
    again = sp.filter(F.col(WEEK) == last).withColumn("rerun_flag", F.lit(1))
    write_weeks(again, path)
    return read_mart(spark, path)


def q_json_roundtrip(spark, d):
    """JSON lines out, read back with the explicit schema."""
    o = Star(spark, d).t("orders")
    path = scratch_path(spark, "json")
    write_json(o, path)
    inferred = read_json(spark, path)
    if set(inferred.columns) != set(o.columns):
        raise AssertionError(f"inferred JSON columns {inferred.columns} differ from {o.columns}")
    return read_json(spark, path, o.schema)


def q_set_top_box_asof(spark, d):
    """H11/B5 with the as-of day that the base gives: the last order date of each week."""
    s = Star(spark, d)
    sp = materialize(s.spine(), "spine")
    last = map_to_week(s.t("orders").select("o_orderdate"), F.col("o_orderdate"), s.calendar, keep_date="day")
    asof = bounded_frame(last.groupBy(WEEK).agg(F.max("day").alias(AS_OF)), "as-of")
    keys = sp.select(ACCOUNT, WEEK).join(asof.select(WEEK), WEEK, "left_semi")
    return s.set_top_box(keys, asof)


def q_weighted_downloads(spark, d):
    """per-genre columns as sums of a measure (the counts of ``download_counts``)."""
    s = Star(spark, d)
    return blocks.pivot_download_counts(s.download_counts(), "genre", s.genres(), "genre")


def q_filtered_downloads(spark, d):
    """Downloads of one return flag only, by the block's scalar filter."""
    s = Star(spark, d)
    src = s.downloads_src(extra=["l_returnflag"])
    return blocks.download_counts(src, s.calendar, "l_shipdate", "genre", "referer", STAR_REFERER_PATTERNS, extra_filter=F.col("l_returnflag") == "R")


def q_text_account_spine(spark, d):
    """Text accounts of which some are the '?' sentinel or NULL."""
    s = Star(spark, d)
    account = F.when(F.col(ACCOUNT) % 10 == 3, "?").when(F.col(ACCOUNT) % 10 != 7, F.concat(F.lit("A"), F.col(ACCOUNT)))
    return blocks.spine(s.base().withColumn(ACCOUNT, account), None, ["c_nationkey"], F.col("c_acctbal") > 0)


def q_text_dates(spark, d):
    """Dates written as day/month/year text, some ill-formed, read with an explicit format."""
    o = Star(spark, d).t("orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, "31/02/1999").when(F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
    return parse_dates(o.select("o_orderkey", text.alias("order_text")), ["order_text"], "dd/MM/yyyy")


def q_filled_strings(spark, d):
    """F8: NULL strings of the journey frame filled."""
    o = Star(spark, d).t("orders")
    prio = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority"))
    return fill_strings(o.select("o_orderkey", prio.alias("priority"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), "o_totalprice"))


def q_profile_history(spark, d):
    """Two runs' profiles appended to one history; each row carries its run's timestamp."""
    s = Star(spark, d)
    path = scratch_path(spark, "profiles")
    o = map_to_week(s.t("orders").select("o_orderdate", "o_totalprice"), F.col("o_orderdate"), s.calendar)
    prof = continuous_profile(o, ["o_totalprice"])
    append_profile(stamp(prof), path)
    append_profile(stamp(prof), path)
    rows = spark.read.parquet(path)
    return rows.groupBy("colname", WEEK, "maximum_value", "minimum_value").agg(
        F.count("*").alias("n_runs"), F.countDistinct("created_dt").alias("n_stamps")
    )


def q_table_presence(spark, d):
    """Every given table by its role, whether it is there and has rows, and its row count;
    documents and pages are also read together as shards of one glob."""
    cat = star_catalog(spark, d)
    parts = []
    for n in cat.paths:
        there = cat.exists(n)
        count = cat.table(n).agg(F.count("*").alias("n_rows")) if there else spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
        parts.append(count.select(F.lit(n).alias("role"), F.lit(there).alias("present"), F.lit(there and has_rows(cat.table(n))).alias("has_rows"), "n_rows"))
    shards = Catalog(spark, {"nations": f"{d}/{{nation,region}}.parquet"}).table("nations")
    parts.append(shards.agg(F.count("*").alias("n_rows")).select(F.lit("nation+region").alias("role"), F.lit(True).alias("present"), (F.col("n_rows") > 0).alias("has_rows"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def q_incremental_run(spark, d):
    """An empty log, a run of the even weeks, a second run of all requested weeks that builds only the
    odd ones, and a third that finds nothing pending; the mart read back with each week's number of log rows."""
    mart, log = scratch_path(spark, "incremental-mart"), scratch_path(spark, "incremental-log")
    whole = Star(spark, d)
    weeks = materialize(whole.spine().select(WEEK).distinct(), "incremental-weeks")

    def build(some: list[int]) -> DataFrame:
        s = Star(spark, d, some)
        return assemble(s.spine(), [s.line_speed(), s.pipeline()])

    for requested in (weeks.where(F.col(WEEK) % 2 == 0), weeks, weeks):
        run(spark, build, requested, mart, log, "weekly_mart", "mart")
    logged = runlog.read_log(spark, log).groupBy(WEEK).agg(F.count("*").alias("n_log_rows"))
    return read_mart(spark, mart).join(logged, WEEK)


def _arrivals(spark, d, days=(103, 100), every=16):
    """Stand-in for sources to which rows are added after a run: one of ``every`` order keys (with its lines) of some days
    before the last one and some events of the first day are kept back. Returns (name → rows there at first, name → late rows)."""
    s = Star(spark, d)
    o, li, e = s.t("orders"), s.t("lineitem"), s.t("events")
    last = o.agg(F.max(F.to_date("o_orderdate"))).scalar()
    late = F.to_date("o_orderdate").between(F.date_sub(last, days[0]), F.date_sub(last, days[1])) & (F.col("o_orderkey") % every == 0)
    keys = bounded_frame(o.where(late).select(F.col("o_orderkey").alias("l_orderkey")), "late-orders")  # orders of a few days: lines are not exchanged while they are few
    event = (F.to_date("ts") == e.agg(F.min(F.to_date("ts"))).scalar()) & (F.col("user_id") % 3 == 0)
    first = {"orders": o.where(~late), "lineitem": li.join(keys, "l_orderkey", "left_anti").select(li.columns), "events": e.where(~event)}
    return first, {"orders": o.where(late), "lineitem": li.join(keys, "l_orderkey", "left_semi").select(li.columns), "events": e.where(event)}


def q_incremental_refresh(spark, d):
    """A first run over sources without their late rows, a run that is killed after it wrote its rows and
    before it is published, then the late rows and a second run over all blocks, which rebuilds the weeks whose source
    marks differ. The published mart, with a check of each week's log times."""
    from tidemark.plans.refresh import refresh
    from tidemark.sources.versions import VersionedMart

    root, copy = scratch_path(spark, "refresh-mart"), scratch_path(spark, "refresh-sources")
    first, late = _arrivals(spark, d)
    with shuffles_removed(spark):
        for name, rows in first.items():
            rows.write.parquet(f"{copy}/{name}")
    star = lambda **kw: Star(spark, d, tables={n: spark.read.parquet(f"{copy}/{n}") for n in first}, **kw)
    digits = lambda df: _round(df, {"score_1": 6, "score_2": 6, "mean_duration": 6, "bill_total": 4, "amount_paid": 4})
    refresh(spark, star, root, finish=digits)
    store = VersionedMart(spark, root)
    store.write_run(store.read().limit(1000), store.marks(), store.vocab())  # killed here: no reader follows it
    with shuffles_removed(spark):
        for name, rows in late.items():
            rows.write.mode("append").parquet(f"{copy}/{name}")
    refresh(spark, star, root, finish=digits)
    times = store.listing().select(WEEK, ((F.col("start_time") <= F.col("end_time")) & (F.col("elapsed_seconds") >= 0) & F.col("n_runs").isin(1, 2)).alias("log_ok"))
    return store.read().join(F.broadcast(times), WEEK)  # one row per week of the calendar


def q_box_state_roll(spark, d):
    """The boxes of the first half of the time, a stored state as of its last day, and the second half from
    that state and the later boxes alone."""
    s = Star(spark, d)
    spine = materialize(s.spine(), "spine")
    lo, hi = spine.agg(F.min(AS_OF), F.max(AS_OF)).first()
    if lo is None:
        return s.set_top_box(spine)
    mid = lo + dt.timedelta(days=(hi - lo).days // 2)
    early = lo + dt.timedelta(days=(hi - lo).days // 4)
    state = materialize(s.box_state(early), "box-state")
    state = materialize(s.box_state(mid, since=early, state=state), "box-state")
    before = spine.where(F.col(AS_OF) <= F.lit(mid))
    return s.set_top_box(before).unionByName(s.set_top_box_after(mid, state, spine))


def _fiscal_days(spark, d):
    """Stand-in for a stored calendar: a day table of fiscal years of 52 weeks in quarters of 4, 4 and 5 weeks, over the order dates."""
    lo, hi = Star(spark, d).t("orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    n = F.col("id").cast("int")
    days = spark.range((hi - lo).days + 4).select(F.date_add(F.lit(lo - dt.timedelta(days=3)), n).alias("day"), n.alias("n"))
    year, week = F.expr(f"{(lo - dt.timedelta(days=3)).year} + n div 364"), F.expr("n % 364 div 7 + 1")
    place = (week - 1) % 13
    month = F.floor((week - 1) / 13) * 3 + F.when(place < 4, 1).when(place < 8, 2).otherwise(3)
    return days.select(F.col("day").cast("string").alias("fiscal_day"), (year * 100 + week).cast("string").alias("fiscal_week"), (year * 100 + month).cast("string").alias("fiscal_month"))


def q_fiscal_week_blocks(spark, d):
    """Spine and blocks by a stored 4-4-5 calendar; its weeks are found by binary search, without a join."""
    path = scratch_path(spark, "fiscal")
    _fiscal_days(spark, d).write.parquet(path)
    calendar = stored_calendar(normalise_calendar(spark.read.parquet(path), "fiscal_day", "fiscal_week", "fiscal_month"))
    if calendar is None:
        raise ValueError("the stored calendar has gaps or overlapping weeks")
    s = Star(spark, d, calendar=calendar)
    sp = materialize(s.spine(), "spine")
    asof = s.asof(sp)
    return _round(assemble(sp, [s.line_speed(), s.pipeline(), s.billing(), s.set_top_box(sp, asof)]), {"bill_total": 4, "amount_paid": 4})


def q_profile_states(spark, d):
    """Two runs store the profile states of their weeks (even and odd ones); profiles by year come from the states."""
    s = Star(spark, d)
    o = map_to_week(s.t("orders").select("o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"), F.col("o_orderdate"), s.calendar)
    numbers, texts = scratch_path(spark, "number-states"), scratch_path(spark, "text-states")
    for rest in (0, 1):
        run_rows = o.where(F.col(WEEK) % 2 == rest)
        append_profile(continuous_state(run_rows, ["o_totalprice"]), numbers)
        append_profile(discrete_state(run_rows, ["o_orderstatus", "o_orderpriority"]), texts)
    year = F.floor(F.col(WEEK) / 100).cast("int").alias("year")
    by = ["colname", "year"]
    low = merge_continuous(spark.read.parquet(numbers).withColumn("year", year), by)
    found = merge_discrete(spark.read.parquet(texts).withColumn("year", year), by)
    return low.select(
        *by, F.lit(None).cast("string").alias("unique_value"), F.col("n_values").alias("n_rows"), F.lit(None).cast("bigint").alias("number_of_categories"), "maximum_value", "minimum_value",
        _cut("mean_value", 3).alias("mean_value"), _cut("standard_deviation", 2).alias("standard_deviation"),
    ).unionByName(found.select(*by, "unique_value", "n_rows", "number_of_categories"), allowMissingColumns=True)


def _order_shards(spark, d) -> str:
    """Stand-in for shards of three producers: one complete, one without the priority, one with fractions in a whole-number column;
    some lines are cut off."""
    o = Star(spark, d).t("orders")
    size = F.col("o_orderkey") % 100
    path = scratch_path(spark, "order-shards")
    for i in range(3):
        cols = [F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                (size + F.lit(0.5) if i == 2 else size).alias("size_code")] + ([F.col("o_orderpriority")] if i != 1 else [])
        line = F.to_json(F.struct(*cols))
        line = F.when(F.col("o_orderkey") % 50 == 7, F.substring(line, 1, 30)).otherwise(line)
        o.where(F.col("o_orderkey") % 3 == i).select(line.alias("value")).write.text(f"{path}/part={i}")
    return path


def q_dirty_shards(spark, d):
    """Shards with broken lines, a missing and a widened column; the good rows and the number of quarantined lines."""
    declared = {"o_orderkey": "int", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "date", "size_code": "int", "o_orderpriority": "string"}
    rows, bad = read_json_shards(spark, f"{_order_shards(spark, d)}/*", declared)
    if rows.schema["size_code"].dataType.simpleString() != "double":
        raise AssertionError("the fractions of one shard must widen the column")
    return rows.withColumn("n_bad", bad.agg(F.count("*")).scalar())


def _raw_base(spark, d) -> DataFrame:
    """Stand-in for a raw weekly base: the latest order of each account and week with its customer, as text with signs and prefixes."""
    s = Star(spark, d)
    o = map_to_week(s.t("orders"), F.col("o_orderdate"), s.calendar)
    latest = first_per_key(o, ["o_custkey", WEEK], [F.col("o_orderkey")], descending=True)
    x = latest.join(s.t("customer"), latest.o_custkey == F.col("c_custkey"))
    whole = lambda c: F.floor(c).cast("bigint").cast("string")
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    day = F.to_date("o_orderdate")
    length = (F.col("o_orderkey") % 400).cast("int")
    return x.select(
        F.col("o_custkey").alias(ACCOUNT), WEEK, week_end(F.col(WEEK)).alias(AS_OF), F.col("c_name").alias("customer_text"),
        text("£", whole(F.col("o_totalprice"))).alias("price_text"), text("GBP ", whole(F.col("c_acctbal"))).alias("balance_text"), text("ORD-", F.col("o_orderkey")).alias("order_text"),
        text("N_", F.col("c_nationkey")).alias("nation_text"), F.col("o_orderpriority").alias("priority_text"), text("#", F.col("o_orderkey") % 97).alias("visit_text"),
        F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(" months")).alias("term_text"), F.concat((F.col("o_orderkey") % 80).cast("string"), F.lit(" Mb/s")).alias("speed_text"),
        F.when(F.col("o_orderkey") % 13 == 0, "not known").otherwise(text("T", F.col("o_orderkey") % 7)).alias("tier_text"), text("id:", F.col("o_custkey")).alias("party_text"),
        F.concat(F.lit("~"), (F.col("o_orderkey") % 1000).cast("string"), F.lit(",000")).alias("usage_text"), F.col("c_mktsegment").alias("segment_text"),
        F.date_format(day, "yyyyMMdd").alias("start_text"), F.date_format(F.date_add(day, length), "dd/MM/yyyy").alias("end_text"),
        F.when(F.col("o_orderkey") % 11 == 0, "31/02/1999").otherwise(F.date_format(F.date_sub(day, length), "dd/MM/yyyy")).alias("review_text"),
        F.lit("unused").alias("unused_text"),
    )


BASE_MAP = [
    Rule(ACCOUNT, ACCOUNT), Rule(WEEK, WEEK), Rule(AS_OF, AS_OF),
    Rule("customer_number", "customer_text", "strip", "Customer#"), Rule("price", "price_text", "strip", "£"), Rule("balance", "balance_text", "strip", "GBP "),
    Rule("order_number", "order_text", "strip", "ORD-"), Rule("nation", "nation_text", "strip", "N_", "int"), Rule("priority", "priority_text", "strip", "-.*", "int"),
    Rule("visits", "visit_text", "strip", "#", "int"), Rule("term", "term_text", "strip", " months", "int"), Rule("speed", "speed_text", "strip", " Mb/s", "double"),
    Rule("tier", "tier_text", "strip", "T", "int"), Rule("party", "party_text", "strip", "id:"), Rule("usage", "usage_text", "strip", "[~,]"),
    Rule("segment", "segment_text", "lower"), Rule("contract_start_date", "start_text", "date", "yyyyMMdd"), Rule("contract_end_date", "end_text", "date", "dd/MM/yyyy"),
    Rule("review_date", "review_text", "date", "dd/MM/yyyy"),
]


def q_weekly_base_wide(spark, d):
    """A raw base through its column map (twelve pattern casts, three contract dates) with durations."""
    return add_durations(apply_map(_raw_base(spark, d), BASE_MAP), AS_OF)


RANGE_COLUMNS = ["customer_number", "price", "order_number", "nation", "visits", "tier", "segment", "contract_start_date", "contract_end_date", "review_date"]


def q_stored_ranges(spark, d):
    """Counts and ranges of the columns of a written weekly base; those without NULLs from the Parquet footers."""
    path = scratch_path(spark, "ranges")
    write_weeks(apply_map(_raw_base(spark, d), BASE_MAP), path)
    return stored_ranges(spark, path, RANGE_COLUMNS)


QUERIES = {
    "week_calendar_map": q_week_calendar_map,
    "run_week_list": q_run_week_list,
    "asof_per_week": q_asof_per_week,
    "run_sequences": q_run_sequences,
    "weekly_base": q_weekly_base,
    "strip_cast": q_strip_cast,
    "line_speed_block": q_line_speed_block,
    "reward_claims_block": q_reward_claims_block,
    "survey_block": q_survey_block,
    "calls_block": q_calls_block,
    "pipeline_block": q_pipeline_block,
    "download_counts": q_download_counts,
    "downloads_block": q_downloads_block,
    "not_like_any": q_not_like_any,
    "not_like_all": q_not_like_all,
    "not_in_null_rule": q_not_in_null_rule,
    "eligibility_block": q_eligibility_block,
    "billing_block": q_billing_block,
    "offers_active": q_offers_active,
    "offers_block": q_offers_block,
    "offers_long": q_offers_long,
    "set_top_box_block": q_set_top_box_block,
    "journey_block": q_journey_block,
    "clean_names": q_clean_names,
    "durations": q_durations,
    "drop_raw_dates": q_drop_raw_dates,
    "customer_week_mart": q_customer_week_mart,
    "pending_weeks": q_pending_weeks,
    "pending_after_hwm": q_pending_after_hwm,
    "dq_discrete": q_dq_discrete,
    "dq_continuous": q_dq_continuous,
    "dq_mart_discrete": q_dq_mart_discrete,
    "dq_mart_continuous": q_dq_mart_continuous,
    "mart_roundtrip": q_mart_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "set_top_box_asof": q_set_top_box_asof,
    "weighted_downloads": q_weighted_downloads,
    "filtered_downloads": q_filtered_downloads,
    "text_account_spine": q_text_account_spine,
    "text_dates": q_text_dates,
    "filled_strings": q_filled_strings,
    "profile_history": q_profile_history,
    "table_presence": q_table_presence,
    "incremental_run": q_incremental_run,
    "incremental_refresh": q_incremental_refresh,
    "box_state_roll": q_box_state_roll,
    "fiscal_week_blocks": q_fiscal_week_blocks,
    "profile_states": q_profile_states,
    "dirty_shards": q_dirty_shards,
    "weekly_base_wide": q_weekly_base_wide,
    "stored_ranges": q_stored_ranges,
}
