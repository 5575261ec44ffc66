"""One feature block per source (H1-H12), each keyed by (account, week).

Every block is a lazy DataFrame that ends in one aggregate on (account,
week), so the left joins of the assembly find both sides hash-partitioned on
the same keys. Blocks take role frames whose column names are parameters;
output names are derived from them the way the reference derives its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import ACCOUNT, WEEK
from tidemark.functions.calendar import AS_OF, MONTH, IsoCalendar, map_to_week, month_of_week, week_end
from tidemark.functions.predicates import not_in, not_like, present_or_not_blank, valid_key
from tidemark.functions.shape import clean_name as _clean
from tidemark.functions.shape import normalise_values
from tidemark.operators.asof import as_of_state, latest_as_of, place_as_of
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.encode import category_counts, discover_vocabulary, pivot_cells, pivot_code, top1_pivot, weighted_counts
from tidemark.operators.rangejoin import HI, LO, POINTS, SEGMENT, point_ranges, point_segments, points_below, segment_join, window_join

KEYS = [ACCOUNT, WEEK]

# The line-quality status vocabulary (Q4), the spelling merges
# of the journey sub-category (G8) and the blank markers of its filter.
RAG_STATUSES = ["AMBER", "GREEN", "RED", "UNKNOWN"]
SUB_CATEGORY_SPELLINGS = {
    "Recording / Playback Issue": "Recording / Playback Issue",
    "Recording/ Playback Issue": "Recording / Playback Issue",
    "Default/Vague ": "Default/Vague",
    "Default / Vague": "Default/Vague",
}
SUB_CATEGORY_BLANKS = ["Blank", ""]
SUB_CATEGORY_DEFAULT_PATTERN = "%Default%"
# Referer patterns of the download filter (B8) and the
# requested-bytes value of a counted download.
REFERER_PATTERNS = [
    "%Watch Next%",
    "%Download Next%",
    "%DownloadNext%",
    "%WatchNext%",
    "%Personalised Recommendation%",
    "%Trailer%",
    "%Mosaic Tile%",
]
COUNTED_REQUESTED_BYTES = 188
# Weeks of a segment of time, within which an offer is one row.
LONG_OFFER_WEEKS = 16


def weekly_aggregate(
    df: DataFrame, calendar: DataFrame | IsoCalendar, date_expr: Column, aggs: list[Column], spine_keys: DataFrame | None = None
) -> DataFrame:
    """C1 then one aggregate on (account, week). With ``spine_keys`` (the mart) only rows of these pairs are aggregated, so no wide row
    is made for a pair that the assembly does not hold."""
    rows = map_to_week(df, date_expr, calendar)
    if spine_keys is not None:
        rows = rows.join(spine_keys.select(*KEYS), KEYS, "left_semi")
    return rows.groupBy(*KEYS).agg(*aggs)


def spine(
    base: DataFrame,
    week_dim: DataFrame | None,
    keep: list[Column | str],
    where: Column | None = None,
) -> DataFrame:
    """H1: filter the weekly base once (B11, B6), project, add month and as-of
    (C3): from the one-row-per-week dimension of a stored calendar, or computed from the ISO week when there is none."""
    b = base.filter(valid_key(base, ACCOUNT))
    if where is not None:
        b = b.filter(where)
    b = b.select(ACCOUNT, WEEK, *keep)
    if week_dim is None:
        return b.select(*b.columns, month_of_week(F.col(WEEK)).alias(MONTH), week_end(F.col(WEEK)).alias(AS_OF))
    out = b.join(week_dim, WEEK, "inner")
    return out.select(ACCOUNT, WEEK, *[c for c in out.columns if c not in (ACCOUNT, WEEK)])


def line_speed_aggs(
    measures: list[str], status_col: str, vocab: list[str] = RAG_STATUSES, where: Column | None = None
) -> list[Column]:
    """H2: min and max of each measure, count per status (fixed vocabulary, Q4).
    ``where`` limits the rows used (for an aggregate shared with other blocks)."""
    aggs: list[Column] = []
    for m in measures:
        x = F.col(m) if where is None else F.when(where, F.col(m))
        aggs += [F.min(x).alias(f"min_{m}"), F.max(x).alias(f"max_{m}")]
    return aggs + category_counts(status_col, vocab, status_col, where)


def line_speed_block(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    measures: list[str],
    status_col: str,
    vocab: list[str] = RAG_STATUSES,
) -> DataFrame:
    return weekly_aggregate(df, calendar, F.col(date_col), line_speed_aggs(measures, status_col, vocab))


def counts_block(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    categories: dict[str, tuple[str, list[str]]],
) -> DataFrame:
    """H3: one count per observed value of each category column (F1+D-7)."""
    return weekly_aggregate(df, calendar, F.col(date_col), counts_aggs(categories))


def counts_aggs(categories: dict[str, tuple[str | Column, list[str]]], where: Column | None = None) -> list[Column]:
    """Category counts; the dict key names the source column, the tuple gives
    (prefix, values). ``where`` limits the rows counted."""
    aggs: list[Column] = []
    for col, (prefix, values) in categories.items():
        aggs += category_counts(col, values, prefix, where)
    return aggs


def survey_block(df: DataFrame, calendar: DataFrame | IsoCalendar, date_col: str, scores: dict[str, str]) -> DataFrame:
    """Cast each score to FLOAT (bad text → NULL) and average it."""
    return weekly_aggregate(df, calendar, F.col(date_col), survey_aggs(scores))


def survey_aggs(scores: dict[str, str]) -> list[Column]:
    return [F.avg(F.col(src).try_cast("float")).alias(dst) for src, dst in scores.items()]


def calls_block(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    int_measures: dict[str, str],
    mean_of: tuple[str, str],
    categories: dict[str, tuple[str, list[str]]],
) -> DataFrame:
    """H5: INT-cast measures summed, one INT-cast measure averaged, counts per
    channel/direction value — all in one aggregate (D-10)."""
    return weekly_aggregate(df, calendar, F.col(date_col), calls_aggs(int_measures, mean_of, categories))


def calls_aggs(
    int_measures: dict[str, str], mean_of: tuple[str, str], categories: dict[str, tuple[str, list[str]]]
) -> list[Column]:
    aggs = [F.sum(F.col(src).try_cast("int")).alias(dst) for src, dst in int_measures.items()]
    aggs.append(F.avg(F.col(mean_of[0]).try_cast("int")).alias(mean_of[1]))
    return aggs + counts_aggs(categories)


def pipeline_block(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    measures: list[str],
    own_week: str | None = None,
) -> DataFrame:
    """H6: sum of each flag per (account, week). The reference keys this block
    by account only; carrying the week keeps multi-week runs correct (Q22).
    If the source has its own week column it must agree with the calendar (Q19).
    A text measure is summed through ``try_cast`` to DOUBLE (Q3)."""
    src = map_to_week(df, F.col(date_col), calendar)
    if own_week is not None:
        src = src.filter(F.col(own_week).try_cast("int") == F.col(WEEK))
    aggs = []
    for m in measures:
        t = df.schema[m].dataType.simpleString()
        x = F.col(m).try_cast("double") if t == "string" else F.col(m)
        aggs.append(F.sum(x).alias(m))
    return src.groupBy(*KEYS).agg(*aggs)


def download_counts(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    genre_col: str,
    referer_col: str,
    patterns: list[str],
    match: str = "any",
    extra_filter: Column | None = None,
) -> DataFrame:
    """H7 extract / D-1: downloads per (account, week, genre).

    The reference counts per seven keys and sums per three; since the inner
    keys contain the outer ones, that equals one count per three keys, done
    here in one aggregate.
    """
    keep = not_like(referer_col, patterns, match)
    if extra_filter is not None:
        keep = keep & extra_filter
    src = map_to_week(df.filter(keep), F.col(date_col), calendar)
    return src.groupBy(ACCOUNT, WEEK, genre_col).agg(F.count(F.lit(1)).alias("total_downloads"))


def pivot_download_counts(counts: DataFrame, genre_col: str, vocab: list[str], prefix: str) -> DataFrame:
    """H7/F2/G9 as the reference does it: per-genre counts summed into one
    column per lower-case genre, 0 where absent (a second shuffle)."""
    g = F.lower(F.col(genre_col))
    return counts.groupBy(*KEYS).agg(*weighted_counts(g, vocab, "total_downloads", prefix))


def kept_genre(genre_col: str, referer_col: str, patterns: list[str], match: str = "any") -> Column:
    """H7: the lower-case genre of a title whose downloads count by the referer filter (B8); NULL for other titles. Both depend on the
    title alone, so they are made once per title and not per download."""
    return F.when(not_like(referer_col, patterns, match), F.lower(F.col(genre_col)))


def downloads_aggs(kept_col: str, vocab: list[str], prefix: str) -> list[Column]:
    """H7 fused into one aggregate: count of kept downloads per lower-case genre, from a column of ``kept_genre``.

    When an (account, week) has no kept download the columns are NULL, not 0 (Q24), so the
    aggregate can share a pass with other blocks over the same rows."""
    g = F.col(kept_col)
    has_rows = F.count(g) > 0
    return [F.when(has_rows, F.count_if(g == F.lit(v))).alias(_clean(f"{prefix}_{v}")) for v in vocab]


def downloads_block(
    df: DataFrame,
    calendar: DataFrame | IsoCalendar,
    date_col: str,
    genre_col: str,
    referer_col: str,
    patterns: list[str],
    vocab: list[str],
    prefix: str,
    match: str = "any",
    extra_filter: Column | None = None,
) -> DataFrame:
    """H7 in one aggregate (one shuffle instead of count-then-pivot)."""
    keep = not_like(referer_col, patterns, match)
    if extra_filter is not None:
        keep = keep & extra_filter
    g = F.lower(F.col(genre_col))
    aggs = [F.count_if(g == F.lit(v)).alias(_clean(f"{prefix}_{v}")) for v in vocab]
    return weekly_aggregate(df.filter(keep), calendar, F.col(date_col), aggs)


def eligibility_block(
    df: DataFrame,
    asof: DataFrame,
    date_col: str,
    values: list[str],
    tie_col: str,
    before: int = 30,
    after: int = 30,
    spine_keys: DataFrame | None = None,
) -> DataFrame:
    """H8: the latest row per (account, week) whose date lies within
    [as_of - before, as_of + after] (B3), so the spine cannot fan out (Q11).

    Without ``spine_keys``: a bucketed window join (C11) gives every (account,
    week) with a row in the window; each row meets about (before+after)/7
    weeks before the top-1 aggregate.

    With ``spine_keys`` (the mart): no fan-out. The latest row in the window
    is the latest row with ``date <= as_of + after``, kept if its date is
    ``>= as_of - before``. So this is the bounded-state as-of join on the
    date shifted by ``after``, followed by one filter.
    """
    src = df.select(ACCOUNT, date_col, tie_col, *values)
    if spine_keys is not None:
        hist = place_as_of(src, F.date_sub(F.col(date_col), after), asof)
        latest = latest_as_of(hist, spine_keys, [F.col(date_col), F.col(tie_col)], [*values, date_col])
        kept = latest.join(asof.select(WEEK, AS_OF), WEEK, "inner").filter(F.col(date_col) >= F.date_sub(F.col(AS_OF), before))
        return kept.select(ACCOUNT, WEEK, *values, date_col)
    joined = window_join(src, date_col, asof.select(WEEK, AS_OF), AS_OF, before, after)
    top = first_per_key(
        joined.select(ACCOUNT, WEEK, date_col, tie_col, *values),
        KEYS,
        [F.col(date_col), F.col(tie_col)],
        descending=True,
    )
    return top.select(ACCOUNT, WEEK, *values, date_col)


def billing_block(
    bills: DataFrame,
    calendar: DataFrame | IsoCalendar,
    tax_date_col: str,
    values: list[str],
    tie_col: str,
) -> DataFrame:
    """The latest bill per (account, week) by tax date, unique tie-break."""
    src = map_to_week(bills, F.col(tax_date_col), calendar).select(ACCOUNT, WEEK, tax_date_col, tie_col, *values)
    top = first_per_key(src, KEYS, [F.col(tax_date_col), F.col(tie_col)], descending=True)
    return top.select(ACCOUNT, WEEK, *values)


def offers_block(
    offers: DataFrame,
    asof: DataFrame,
    start_col: str,
    end_col: str,
    type_col: str,
    vocab: list[str],
    amount_col: str,
    attrs: list[str],
    tie_cols: list[str],
    long_weeks: int = LONG_OFFER_WEEKS,
    spine_keys: DataFrame | None = None,
) -> DataFrame:
    """Offers active at each week's as-of date (B4, interval join C11),
    then per (account, week) and type the cheapest offer's attributes as
    ``<type>_<attr>`` columns (F3, E3). Intervals are clipped to the range of the as-of days.

    An offer is one row with the range of its weeks; the cheapest is found per account, range and type, and what is left of an account,
    bounded by the calendar and the types, is one array in the order of type and price. Time is cut into segments of ``long_weeks`` weeks:
    each takes its part of the array and each week the first offer of each type from that part, in place, so no row per offer and
    segment or week is sorted or exchanged. With ``spine_keys`` (the mart, whose offers are short) an offer gives a row per segment instead, the arrays are
    per account and segment, and only the weeks of these pairs are made."""
    points = asof.select(WEEK, AS_OF)
    order = [F.col(amount_col)] + [F.col(c) for c in tie_cols]
    lo, hi = asof.agg(F.min(AS_OF), F.max(AS_OF)).first()
    if lo is None:
        none = offers.where(F.lit(False)).withColumn(WEEK, F.lit(None).cast(asof.schema[WEEK].dataType))
        return top1_pivot(none, KEYS, type_col, vocab, order, attrs)
    kept = list(dict.fromkeys([amount_col, *tie_cols, *attrs]))  # the order's columns lead, so the least struct is the first row
    rows = offers.select(ACCOUNT, F.col(start_col).alias("__start"), F.col(end_col).alias("__end"), pivot_code(type_col, vocab).alias("code"), F.struct(*kept).alias("best"))
    if spine_keys is None:
        weeks = _weekly_cells(rows, points, (lo, hi), long_weeks)
    else:
        weeks = _spine_cells(rows, points, (lo, hi), long_weeks, spine_keys)
    return pivot_cells(weeks, KEYS, "cells", vocab, attrs)


def _held(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The cheapest row per ``keys``, range and type, then per ``keys`` one array ``cells`` of them in the order of type and price."""
    least = rows.groupBy(*keys, "code", LO, HI).agg(F.min("best").alias("best"))
    if keys == [ACCOUNT]:  # reduced under all of its keys, so a hot account is spread until here
        least = least.repartition(ACCOUNT)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("code", "best", LO, HI))).alias("cells"))


def _active(at: str, cells: str) -> Column:
    """Array of (week, cells): per (week, place) of ``at`` the cells whose range holds the place; only weeks that hold any."""
    active = F.transform(at, lambda w: F.struct(w[WEEK].alias(WEEK), F.filter(cells, lambda c: (c[LO] <= w["at"]) & (c[HI] > w["at"])).alias("cells")))
    return F.filter(active, lambda w: F.size(w["cells"]) > 0)


def _weekly_cells(rows: DataFrame, points: DataFrame, span: tuple[dt.date, dt.date], long_weeks: int) -> DataFrame:
    """(account, week, cells) of every week in which an account holds an offer."""
    days = (span[1] - span[0]).days + 1
    low, high = point_ranges("__start", "__end", points_below(points, AS_OF, span[0], days), span[0], days)
    reached = rows.select(ACCOUNT, "code", "best", low.alias(LO), high.alias(HI)).where(F.col(LO) < F.col(HI))
    dated = points.where(F.col(AS_OF).isNotNull()).select(WEEK, (F.row_number().over(Window.orderBy(AS_OF, WEEK)) - 1).alias("at"))  # one row per week
    segments = dated.groupBy(F.floor(F.col("at") / long_weeks)).agg(
        F.min("at").alias("low"), (F.max("at") + 1).alias("high"), F.collect_list(F.struct(WEEK, "at")).alias("at")
    ).agg(F.collect_list(F.struct("low", "high", "at")))
    parts = _held(reached, [ACCOUNT]).select(ACCOUNT, "cells", F.explode(segments.scalar()).alias("s")).select(ACCOUNT, "cells", "s.*")
    own = F.filter("cells", lambda c: (c[LO] < F.col("high")) & (c[HI] > F.col("low")))
    parts = parts.select(ACCOUNT, "at", own.alias("cells"))
    return parts.select(ACCOUNT, F.explode(_active("at", "cells")).alias("w")).select(ACCOUNT, "w.*")


def _spine_cells(rows: DataFrame, points: DataFrame, span: tuple[dt.date, dt.date], long_weeks: int, spine_keys: DataFrame) -> DataFrame:
    """(account, week, cells) of the pairs of ``spine_keys``, on whose keys the rows are spread and sorted while they are narrow."""
    days = 7 * long_weeks
    segments = point_segments(points, AS_OF, [WEEK], days)
    reached = segment_join(rows, "__start", "__end", segments, AS_OF, span, days)
    # Only accounts and segments with a week of the spine are reduced, and both aggregates and the join below keep this exchange.
    places = segments.select(SEGMENT, F.posexplode(POINTS).alias("at", "p")).select(SEGMENT, "at", F.col("p")[WEEK].alias(WEEK))
    own = spine_keys.select(ACCOUNT, WEEK).join(F.broadcast(places), WEEK)
    own = own.groupBy(ACCOUNT, SEGMENT).agg(F.collect_set(F.struct(WEEK, "at")).alias("at"))
    reached = reached.join(own.select(ACCOUNT, SEGMENT), [ACCOUNT, SEGMENT], "left_semi")
    wanted = _held(reached, [ACCOUNT, SEGMENT]).join(own, [ACCOUNT, SEGMENT])
    weeks = wanted.select(ACCOUNT, F.explode(_active("at", "cells")).alias("w")).select(ACCOUNT, "w.*")
    return weeks.groupBy(*KEYS).agg(F.min("cells").alias("cells"))


def set_top_box_block(
    boxes: DataFrame,
    asof: DataFrame,
    spine_keys: DataFrame,
    installed_col: str,
    modified_col: str,
    type_col: str,
    tie_col: str,
    excluded_types: list[str],
    state: DataFrame | None = None,
) -> DataFrame:
    """Per spine (account, week), the latest installed box among boxes
    modified on or before the week's as-of date (B5, E2), excluding some box
    types (B9, NULL type rejected). With a ``state`` of ``box_state``, ``boxes`` need only hold the rows modified after it."""
    src = boxes.filter(not_in(type_col, excluded_types))
    hist = place_as_of(src, F.col(modified_col), asof)
    return latest_as_of(hist, spine_keys, [F.col(installed_col), F.col(tie_col)], [type_col], state=state)


def box_state(
    boxes: DataFrame, installed_col: str, type_col: str, tie_col: str, excluded_types: list[str], state: DataFrame | None = None
) -> DataFrame:
    """The latest installed box of each account among ``boxes`` and those behind an earlier ``state``."""
    return as_of_state(boxes.filter(not_in(type_col, excluded_types)), [F.col(installed_col), F.col(tie_col)], [type_col], state)


def journey_block(
    events: DataFrame,
    account_map: DataFrame,
    calendar: DataFrame | IsoCalendar,
    obfuscated_col: str,
    map_from: str,
    map_to: str,
    date_col: str,
    type_col: str,
    sub_col: str,
    last_cols: list[str],
    vocab: dict[str, list[str]] | None = None,
    spellings: dict[str, str] = SUB_CATEGORY_SPELLINGS,
    blanks: list[str] = SUB_CATEGORY_BLANKS,
    blank_pattern: str = SUB_CATEGORY_DEFAULT_PATTERN,
    match: str = "any",
) -> DataFrame:
    """Map obfuscated ids to accounts (C7), merge sub-category spellings
    (G8), keep rows by the reference's filter (B10/Q2), count per type and
    sub-category, and carry the value of the latest event for ``last_cols``
    (Q6: ``max_by`` on (date, value), deterministic)."""
    mapped = events.join(account_map.select(F.col(map_from).alias(obfuscated_col), F.col(map_to).alias(ACCOUNT)), obfuscated_col, "inner")
    mapped = mapped.withColumn(sub_col, normalise_values(sub_col, spellings))
    mapped = mapped.filter(present_or_not_blank(sub_col, blanks, blank_pattern, match))
    if vocab is None:
        vocab = discover_vocabulary(mapped, [type_col, sub_col])
    aggs = category_counts(type_col, vocab[type_col], type_col) + category_counts(sub_col, vocab[sub_col], sub_col)
    aggs += [F.max_by(F.col(c), F.struct(F.col(date_col), F.col(c))).alias(c) for c in last_cols]
    return weekly_aggregate(mapped, calendar, F.col(date_col), aggs)
