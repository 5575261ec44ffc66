"""Independent DuckDB formulations of the registered queries (the oracle).

They use the textbook forms the Spark side avoids at scale — ``row_number``
windows, plain range joins, two-level counts, ``FILTER`` aggregates — so a
match checks the rewrite as well as the result. Category vocabularies are the
values present in the driver tables.
"""

from __future__ import annotations

CALENDAR = r"""calendar AS (
  SELECT x AS calendar_date,
         CAST(isoyear(x) * 100 + week(x) AS INTEGER) AS week,
         CAST(year(x + CAST(4 - isodow(x) AS INTEGER)) * 100 + month(x + CAST(4 - isodow(x) AS INTEGER)) AS INTEGER) AS month_of_year
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS x
        FROM (SELECT date_trunc('week', min(d)) AS lo, date_trunc('week', max(d)) + INTERVAL 6 DAY AS hi
              FROM (SELECT CAST(o_orderdate AS TIMESTAMP) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS TIMESTAMP) FROM lineitem
                    UNION ALL SELECT CAST(ts AS TIMESTAMP) FROM events)))),
week_dim AS (SELECT week, month_of_year, max(calendar_date) AS as_of FROM calendar GROUP BY week, month_of_year)"""

SPINE = r"""base AS (
  SELECT o.o_custkey AS account, c.week
  FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date
  UNION SELECT e.user_id, c.week FROM events e JOIN calendar c ON CAST(e.ts AS DATE) = c.calendar_date),
spine AS (
  SELECT b.account, b.week, cu.c_nationkey, cu.c_acctbal, cu.c_mktsegment,
         TRY_CAST(regexp_replace(cu.c_name, 'Customer#', '', 'g') AS BIGINT) AS name_number,
         w.month_of_year, w.as_of
  FROM base b JOIN customer cu ON cu.c_custkey = b.account JOIN week_dim w ON w.week = b.week
  WHERE b.account IS NOT NULL AND cu.c_acctbal > 0 AND cu.c_mktsegment IS NOT NULL),
week_asof AS (SELECT week, max(as_of) AS as_of FROM spine GROUP BY week)"""

def rnd(expr: str, digits: int) -> str:
    """Spark's ``round`` on DOUBLE: HALF_UP on the shortest decimal form of the
    value. DuckDB's ``round(double)`` scales in binary and can land on the other
    side of a tie (0.056249999999999994 → 0.0563), so the oracle rounds the
    decimal text instead."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def cut(expr: str, digits: int) -> str:
    """Cut down to ``digits`` decimals after adding 0.0123 of the last one: no exact mean of the
    data lies on such a cut, so two engines that add doubles in another order agree."""
    return f"floor(({expr}) * 1e{digits} + 0.0123) / 1e{digits}"


PROPS = r"""regexp_extract(e.props, '"k":\s*(-?[0-9.]+)', 1)"""


def _counts(expr: str, values: list[str], prefix: str) -> str:
    import re

    out = []
    for v in values:
        name = re.sub(r"[^\w_]", "", f"{prefix}_{v}").lower()
        out.append(f"count(*) FILTER (WHERE {expr} = '{v}') AS {name}")
    return ",\n  ".join(out)


LINE_SPEED = f"""SELECT o.o_custkey AS account, c.week,
  min(l.l_quantity) AS min_l_quantity, max(l.l_quantity) AS max_l_quantity,
  min(l.l_extendedprice) AS min_l_extendedprice, max(l.l_extendedprice) AS max_l_extendedprice,
  min(l.l_discount) AS min_l_discount, max(l.l_discount) AS max_l_discount,
  min(l.l_tax) AS min_l_tax, max(l.l_tax) AS max_l_tax,
  {_counts('l.l_returnflag', ['A', 'N', 'R', 'X'], 'l_returnflag')}
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN calendar c ON CAST(l.l_shipdate AS DATE) = c.calendar_date
GROUP BY o.o_custkey, c.week"""

REWARD_CLAIMS = f"""SELECT o.o_custkey AS account, c.week,
  {_counts('l.l_linestatus', ['F', 'O'], 'status')},
  {_counts('p.p_type', ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], 'type_code')}
FROM lineitem l
LEFT JOIN part p ON p.p_partkey = l.l_partkey
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN calendar c ON CAST(l.l_shipdate AS DATE) = c.calendar_date
GROUP BY o.o_custkey, c.week"""

SURVEY = f"""SELECT e.user_id AS account, c.week,
  {rnd('avg(CAST(e.value AS FLOAT))', 6)} AS score_1,
  {rnd(f'avg(TRY_CAST({PROPS} AS FLOAT))', 6)} AS score_2
FROM events e JOIN calendar c ON CAST(e.ts AS DATE) = c.calendar_date
GROUP BY e.user_id, c.week"""

_DIRECTION = f"(CASE WHEN TRY_CAST({PROPS} AS INTEGER) % 2 = 0 THEN 'IN' ELSE 'OUT' END)"
_FLAGS = {
    "total_abandons": "e.event_type = 'error'", "click_calls": "e.event_type = 'click'", "purchase_calls": "e.event_type = 'purchase'",
    "signup_calls": "e.event_type = 'signup'", "view_calls": "e.event_type = 'view'", "long_calls": "e.value > 100", "short_calls": "e.value < 10",
    "night_calls": "hour(e.ts) < 6", "weekend_calls": "isodow(e.ts) >= 6",
}
_FLAG_SUMS = ",\n  ".join(f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}" for name, cond in _FLAGS.items())
CALLS = f"""SELECT e.user_id AS account, c.week,
  CAST(sum(CAST(trunc(e.value) AS INTEGER)) AS BIGINT) AS duration_sec,
  CAST(sum(TRY_CAST({PROPS} AS INTEGER)) AS BIGINT) AS props_total,
  {_FLAG_SUMS},
  CAST(sum(hour(e.ts)) AS BIGINT) AS hour_total, CAST(sum(minute(e.ts)) AS BIGINT) AS minute_total, CAST(sum(day(e.ts)) AS BIGINT) AS day_total,
  {rnd('avg(CAST(trunc(e.value) AS INTEGER))', 6)} AS mean_duration,
  {_counts('e.event_type', ['click', 'error', 'purchase', 'signup', 'view'], 'channel')},
  {_counts(_DIRECTION, ['IN', 'OUT'], 'direction')}
FROM events e JOIN calendar c ON CAST(e.ts AS DATE) = c.calendar_date
GROUP BY e.user_id, c.week"""

PIPELINE = """SELECT o.o_custkey AS account, c.week,
  CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished_flag,
  CAST(sum(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS pending_flag,
  CAST(sum(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent_flag,
  CAST(sum(CASE WHEN o.o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS low_flag
FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date
GROUP BY o.o_custkey, c.week"""

def _download_counts(extra: str = "") -> str:
    return f"""SELECT account, week, genre, CAST(sum(download_count) AS BIGINT) AS total_downloads
FROM (
  SELECT o.o_custkey AS account, c.week, l.l_suppkey, l.l_partkey, l.l_orderkey,
         CAST(l.l_shipdate AS DATE) AS download_date, p.p_type AS genre, count(*) AS download_count
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN calendar c ON CAST(l.l_shipdate AS DATE) = c.calendar_date
  WHERE (p.p_name NOT LIKE '%small%' OR p.p_name NOT LIKE '%ring%'){extra}
  GROUP BY 1, 2, 3, 4, 5, 6, 7)
GROUP BY 1, 2, 3"""


DOWNLOAD_COUNTS = _download_counts()

GENRES = ["economy", "large", "medium", "promo", "small", "standard"]
DOWNLOADS = "SELECT account, week,\n  " + ",\n  ".join(
    f"CAST(sum(CASE WHEN lower(genre) = '{g}' THEN total_downloads ELSE 0 END) AS BIGINT) AS genre_{g}" for g in GENRES
) + "\nFROM download_counts GROUP BY account, week"

ELIGIBILITY = """SELECT account, week, eligibility, tenure_start_date FROM (
  SELECT o.o_custkey AS account, a.week, o.o_orderstatus AS eligibility,
         CAST(o.o_orderdate AS DATE) AS tenure_start_date,
         row_number() OVER (PARTITION BY o.o_custkey, a.week
                            ORDER BY CAST(o.o_orderdate AS DATE) DESC, o.o_orderkey DESC) AS rn
  FROM orders o JOIN week_asof a
    ON CAST(o.o_orderdate AS DATE) BETWEEN a.as_of - 30 AND a.as_of + 30)
WHERE rn = 1"""

RATE = "(CAST(1.0 AS DOUBLE) + CAST(n.n_regionkey AS DOUBLE) / CAST(10.0 AS DOUBLE))"
BILLING = f"""SELECT account, week, {rnd('bill_total', 4)} AS bill_total, {rnd('amount_paid', 4)} AS amount_paid,
       payment_delay_in_days FROM (
  SELECT cu.c_custkey AS account, c.week,
         {RATE} * o.o_totalprice AS bill_total,
         CAST(-1.0 AS DOUBLE) * {RATE} * o.o_totalprice AS amount_paid,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(lz.balance_zero_dt AS DATE)) AS INTEGER) AS payment_delay_in_days,
         row_number() OVER (PARTITION BY cu.c_custkey, c.week ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
  FROM orders o
  JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS balance_zero_dt FROM lineitem GROUP BY l_orderkey) lz
         ON lz.l_orderkey = o.o_orderkey
  JOIN customer cu ON cu.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = cu.c_nationkey
  WHERE o.o_orderpriority LIKE '1%')
WHERE rn = 1"""

OFFER_END = "CAST(l.l_shipdate AS DATE) + CAST(trunc(l.l_quantity) AS INTEGER)"
OFFERS_ACTIVE = f"""SELECT l.l_orderkey, l.l_linenumber, a.week, a.as_of
FROM lineitem l JOIN week_asof a ON a.as_of BETWEEN CAST(l.l_shipdate AS DATE) AND {OFFER_END}"""

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
OFFER_ATTRS = ["offer_amount", "percent_value", "offer_status", "offer_start_dt_actual", "offer_end_dt_actual", "offer_end_modified", "last_modified_dt"]
OFFERS = f"""SELECT account, week,
  """ + ",\n  ".join(
    f"max(CASE WHEN p_type = '{t}' THEN {a} END) AS {t.lower()}_{a}" for t in TYPES for a in OFFER_ATTRS
) + f"""
FROM (
  SELECT o.o_custkey AS account, a.week, p.p_type,
         l.l_extendedprice AS offer_amount, l.l_discount AS percent_value, l.l_linestatus AS offer_status,
         CAST(l.l_shipdate AS DATE) AS offer_start_dt_actual, {OFFER_END} AS offer_end_dt_actual,
         {OFFER_END} + l.l_linenumber AS offer_end_modified, CAST(l.l_shipdate AS DATE) - l.l_linenumber AS last_modified_dt,
         row_number() OVER (PARTITION BY o.o_custkey, a.week, p.p_type
                            ORDER BY l.l_extendedprice ASC NULLS FIRST, l.l_orderkey, l.l_linenumber) AS rn
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN week_asof a ON a.as_of BETWEEN CAST(l.l_shipdate AS DATE) AND {OFFER_END})
WHERE rn = 1
GROUP BY account, week"""

OFFERS_LONG = """SELECT week,
  """ + ",\n  ".join(
    f"""count(*) FILTER (p_type = '{t}' AND offer_amount IS NOT NULL) AS {t.lower()}_accounts,
  min(offer_amount) FILTER (p_type = '{t}') AS {t.lower()}_lowest, max(offer_amount) FILTER (p_type = '{t}') AS {t.lower()}_highest,
  count(*) FILTER (p_type = '{t}' AND offer_status = 'F') AS {t.lower()}_finished"""
    for t in TYPES
) + """
FROM (
  SELECT a.week, p.p_type, l.l_extendedprice AS offer_amount, l.l_linestatus AS offer_status,
         row_number() OVER (PARTITION BY o.o_custkey, a.week, p.p_type
                            ORDER BY l.l_extendedprice ASC NULLS FIRST, l.l_orderkey, l.l_linenumber) AS rn
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN week_asof a ON a.as_of BETWEEN CAST(l.l_shipdate AS DATE) AND CAST(l.l_shipdate AS DATE) + 73 * CAST(trunc(l.l_quantity) AS INTEGER))
WHERE rn = 1
GROUP BY week"""

SET_TOP_BOX = """SELECT account, week, box_type FROM (
  SELECT s.account, s.week, o.o_orderpriority AS box_type,
         row_number() OVER (PARTITION BY s.account, s.week
                            ORDER BY CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 15 AS INTEGER) DESC, o.o_orderkey DESC) AS rn
  FROM spine s JOIN orders o ON o.o_custkey = s.account AND CAST(o.o_orderdate AS DATE) <= s.as_of
  WHERE o.o_orderpriority NOT IN ('5-LOW'))
WHERE rn = 1"""

JOURNEY = f"""SELECT cu.c_custkey AS account, c.week,
  {_counts('x.event_type', ['F', 'O', 'P'], 'event_type')},
  {_counts('x.event_sub_category', ['3-MEDIUM', 'HIGH', 'LOW'], 'event_sub_category')},
  max({{'d': x.event_start_date, 'v': x.tier_name}}).v AS tier_name,
  max({{'d': x.event_start_date, 'v': x.loyalty_status}}).v AS loyalty_status
FROM (
  SELECT printf('Customer#%09d', o_custkey) AS account_obf,
         o_orderstatus AS event_type,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'HIGH'
              WHEN o_orderpriority = '2-HIGH' THEN 'HIGH'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'LOW'
              WHEN o_orderpriority = '5-LOW' THEN 'LOW'
              ELSE o_orderpriority END AS event_sub_category,
         CASE WHEN o_totalprice > 250000 THEN 'GOLD' ELSE 'SILVER' END AS tier_name, o_orderpriority AS loyalty_status,
         CAST(o_orderdate AS DATE) AS event_start_date
  FROM orders) x
JOIN customer cu ON cu.c_name = x.account_obf
JOIN calendar c ON x.event_start_date = c.calendar_date
WHERE x.event_sub_category IS NOT NULL OR x.event_sub_category NOT IN ('Blank', '')
   OR x.event_sub_category NOT LIKE '%Default%'
GROUP BY cu.c_custkey, c.week"""

DATED_LINES = """SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_date,
       CAST(o.o_orderdate AS DATE) AS order_date, w.as_of
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date
JOIN week_dim w ON w.week = c.week"""


def _dur(col: str, as_of: str = "as_of") -> str:
    return f"CAST(date_diff('day', {as_of}, {col}) AS INTEGER) AS {col}_duration_days"


DURATIONS = f"""SELECT *, {_dur('ship_date')}, {_dur('order_date')} FROM dated_lines"""
DROP_RAW_DATES = f"""SELECT l_orderkey, l_linenumber, as_of, {_dur('ship_date')}, {_dur('order_date')} FROM dated_lines"""

BLOCKS = {
    "line_speed": LINE_SPEED,
    "reward_claims": REWARD_CLAIMS,
    "survey": SURVEY,
    "calls": CALLS,
    "pipeline": PIPELINE,
    "download_counts": DOWNLOAD_COUNTS,
    "downloads": DOWNLOADS,
    "eligibility": ELIGIBILITY,
    "billing": BILLING,
    "offers": OFFERS,
    "set_top_box": SET_TOP_BOX,
    "journey": JOURNEY,
}
MART_BLOCKS = ["line_speed", "reward_claims", "survey", "calls", "pipeline", "downloads", "eligibility",
               "billing", "offers", "set_top_box", "journey"]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _block_ctes() -> list[str]:
    return [f"{name} AS (\n{sql})" for name, sql in BLOCKS.items()]


def _block_query(name: str) -> str:
    return _with(CALENDAR, SPINE, *_block_ctes()) + f"SELECT * FROM {name}"


MART_DATE_COLS = ["tenure_start_date"] + [
    f"{t.lower()}_{a}" for t in TYPES for a in ("offer_start_dt_actual", "offer_end_dt_actual", "last_modified_dt")  # F6 goes by the name
]


def _mart_select() -> str:
    joins = "\n".join(f"LEFT JOIN {b} USING (account, week)" for b in MART_BLOCKS)
    durs = ",\n  ".join(_dur(c) for c in MART_DATE_COLS)
    return f"SELECT *,\n  {durs}\nFROM spine\n{joins}"


def _mart() -> str:
    return _with(CALENDAR, SPINE, *_block_ctes()) + _mart_select()


# Column classes of the mart (J1): text columns except the account, numeric
# columns except the week. Dates are neither.
MART_DISCRETE = ["c_mktsegment", "eligibility", "box_type", "tier_name", "loyalty_status"] + [
    f"{t.lower()}_offer_status" for t in TYPES
]
MART_CONTINUOUS = (
    ["c_nationkey", "c_acctbal", "name_number", "month_of_year"]
    + [f"{m}_{c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for m in ("min", "max")]
    + [f"l_returnflag_{v}" for v in "anrx"]
    + ["status_f", "status_o"] + [f"type_code_{t.lower()}" for t in TYPES]
    + ["score_1", "score_2", "duration_sec", "props_total", *_FLAGS, "hour_total", "minute_total", "day_total", "mean_duration"]
    + [f"channel_{v}" for v in ("click", "error", "purchase", "signup", "view")] + ["direction_in", "direction_out"]
    + ["finished_flag", "pending_flag", "urgent_flag", "low_flag"]
    + [f"genre_{g}" for g in GENRES]
    + ["bill_total", "amount_paid", "payment_delay_in_days"]
    + [f"{t.lower()}_{a}" for t in TYPES for a in ("offer_amount", "percent_value")]
    + [f"event_type_{v}" for v in "fop"]
    + ["event_sub_category_3medium", "event_sub_category_high", "event_sub_category_low"]
    + [f"{c}_duration_days" for c in MART_DATE_COLS]
)


# Mart columns of DOUBLE type; every other continuous column is an integer type.
MART_DOUBLES = (
    ["c_acctbal"]
    + [f"{m}_{c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for m in ("min", "max")]
    + ["score_1", "score_2", "mean_duration", "bill_total", "amount_paid"]
    + [f"{t.lower()}_{a}" for t in TYPES for a in ("offer_amount", "percent_value")]
)
MART_INTEGRAL = [c for c in MART_CONTINUOUS if c not in MART_DOUBLES]


_DISCRETE = """SELECT l.colname, l.week, l.v AS unique_value, n.number_of_categories
FROM (SELECT DISTINCT colname, week, v FROM long) l
JOIN (SELECT colname, week, count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS number_of_categories FROM long GROUP BY colname, week) n
  ON n.colname = l.colname AND n.week = l.week"""
_CONTINUOUS = f"""SELECT colname, week, max(v) AS maximum_value, min(v) AS minimum_value,
  {cut('avg(v)', 4)} AS mean_value, {cut('stddev_samp(v)', 3)} AS standard_deviation
FROM long GROUP BY colname, week"""


def _mart_profile(kind: str) -> str:
    cols = MART_DISCRETE if kind == "discrete" else MART_CONTINUOUS
    cast = "VARCHAR" if kind == "discrete" else "DOUBLE"
    long = "\n  UNION ALL ".join(f"SELECT week, '{c}' AS colname, CAST({c} AS {cast}) AS v FROM mart" for c in cols)
    head = _with(CALENDAR, SPINE, *_block_ctes(), f"mart AS (\n{_mart_select()})", f"long AS (\n  {long})")
    return head + (_DISCRETE if kind == "discrete" else _CONTINUOUS)


REQUESTED_AND_LOG = """requested AS (SELECT DISTINCT week FROM spine),
run_log AS (SELECT DISTINCT week FROM spine
            WHERE month(as_of) IN (1, 2, 3, 7, 8, 9) AND year(as_of) <= 2000)"""

DQ_DISCRETE = _with(CALENDAR, """src AS (
  SELECT c.week, o.o_orderstatus, o.o_orderpriority,
         CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN NULL ELSE o.o_orderpriority END AS priority_or_null
  FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date)""", """long AS (
  SELECT week, 'o_orderstatus' AS colname, o_orderstatus AS v FROM src
  UNION ALL SELECT week, 'o_orderpriority', o_orderpriority FROM src
  UNION ALL SELECT week, 'priority_or_null', priority_or_null FROM src)""") + _DISCRETE

_CONT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DQ_CONTINUOUS = _with(CALENDAR, "long AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT c.week, '{c}' AS colname, l.{c} AS v FROM lineitem l JOIN calendar c ON CAST(l.l_shipdate AS DATE) = c.calendar_date" for c in _CONT
) + ")") + _CONTINUOUS

# Registered queries that need only the tables, by name.
LAST_ORDER = """last_order AS (
  SELECT c.week, max(c.calendar_date) AS as_of FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date GROUP BY c.week)"""

FISCAL = """fiscal AS (
  SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS x, a FROM (
    SELECT min(CAST(o_orderdate AS DATE)) - 3 AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders)),
numbered AS (SELECT x, year(a) + (x - a) // 364 AS y, (x - a) % 364 // 7 AS w FROM (SELECT x, CAST(a AS DATE) AS a FROM fiscal)),
calendar AS (
  SELECT x AS calendar_date, CAST(y * 100 + w + 1 AS INTEGER) AS week,
    CAST(y * 100 + w // 13 * 3 + CASE WHEN w % 13 < 4 THEN 1 WHEN w % 13 < 8 THEN 2 ELSE 3 END AS INTEGER) AS month_of_year FROM numbered),
week_dim AS (SELECT week, month_of_year, max(calendar_date) AS as_of FROM calendar GROUP BY week, month_of_year)"""

# The weekly base of 16 mapped columns, shared by two queries.
_WIDE = """wide AS (
  SELECT o.o_custkey AS account, o.week, w.as_of, TRY_CAST(replace(cu.c_name, 'Customer#', '') AS BIGINT) AS customer_number, CAST(floor(o.o_totalprice) AS BIGINT) AS price,
    CAST(floor(cu.c_acctbal) AS BIGINT) AS balance, o.o_orderkey AS order_number, cu.c_nationkey AS nation, TRY_CAST(regexp_replace(o.o_orderpriority, '-.*', '') AS INTEGER) AS priority,
    CAST(o.o_orderkey % 97 AS INTEGER) AS visits, CAST(o.o_orderkey % 24 AS INTEGER) AS term, CAST(o.o_orderkey % 80 AS DOUBLE) AS speed,
    CASE WHEN o.o_orderkey % 13 <> 0 THEN CAST(o.o_orderkey % 7 AS INTEGER) END AS tier, o.o_custkey AS party, o.o_orderkey % 1000 * 1000 AS usage, lower(cu.c_mktsegment) AS segment,
    CAST(o.o_orderdate AS DATE) AS contract_start_date, CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 400 AS INTEGER) AS contract_end_date,
    CASE WHEN o.o_orderkey % 11 <> 0 THEN CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 400 AS INTEGER) END AS review_date
  FROM (SELECT o.*, c.week, row_number() OVER (PARTITION BY o.o_custkey, c.week ORDER BY o.o_orderkey DESC) AS rn
        FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date) o
  JOIN customer cu ON cu.c_custkey = o.o_custkey JOIN (SELECT week, max(as_of) AS as_of FROM week_dim GROUP BY week) w ON w.week = o.week WHERE rn = 1)"""

ORACLE_SQL = {
    "week_calendar_map": _with(CALENDAR) + """SELECT c.week, count(*) AS n_orders
FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date GROUP BY c.week""",
    "run_week_list": _with(CALENDAR, SPINE) + "SELECT DISTINCT week FROM spine WHERE week BETWEEN 199401 AND 200252 ORDER BY week",
    "asof_per_week": _with(CALENDAR, SPINE) + "SELECT week, as_of FROM week_asof",
    "run_sequences": _with(CALENDAR, SPINE) + """SELECT strftime(as_of, '%Y-%m-%d') AS as_of, CAST(week AS VARCHAR) AS week
FROM week_asof WHERE week BETWEEN 199401 AND 200252 ORDER BY week""",
    "weekly_base": _with(CALENDAR, SPINE) + "SELECT * FROM spine",
    "strip_cast": """SELECT p_partkey, p_brand,
  TRY_CAST(regexp_replace(p_brand, 'Brand#', '', 'g') AS BIGINT) AS brand_number,
  TRY_CAST(regexp_replace(p_brand, 'Brand#1', '', 'g') AS BIGINT) AS teen_number
FROM part""",
    "line_speed_block": _block_query("line_speed"),
    "reward_claims_block": _block_query("reward_claims"),
    "survey_block": _block_query("survey"),
    "calls_block": _block_query("calls"),
    "pipeline_block": _block_query("pipeline"),
    "download_counts": _block_query("download_counts"),
    "downloads_block": _block_query("downloads"),
    "not_like_any": "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%red%' OR p_name NOT LIKE '%bolt%'",
    "not_like_all": "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%red%' AND p_name NOT LIKE '%bolt%'",
    "not_in_null_rule": """SELECT o_orderkey, priority,
  COALESCE(priority NOT IN ('5-LOW'), false) AS not_in_keeps,
  COALESCE(priority IS NOT NULL OR priority NOT IN ('Blank', '') OR priority NOT LIKE '%LOW%', false) AS or_form_keeps
FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderpriority END AS priority
      FROM orders)""",
    "eligibility_block": _block_query("eligibility"),
    "billing_block": _block_query("billing"),
    "offers_active": _with(CALENDAR, SPINE) + OFFERS_ACTIVE,
    "offers_block": _block_query("offers"),
    "offers_long": _with(CALENDAR, SPINE) + OFFERS_LONG,
    "set_top_box_block": _block_query("set_top_box"),
    "journey_block": _block_query("journey"),
    "clean_names": """SELECT p_partkey AS partkey, p_brand AS msbrand, p_type AS typegroup, p_size AS xsize,
  p_retailprice AS retailprice FROM part""",
    "durations": _with(CALENDAR, f"dated_lines AS (\n{DATED_LINES})") + DURATIONS,
    "drop_raw_dates": _with(CALENDAR, f"dated_lines AS (\n{DATED_LINES})") + DROP_RAW_DATES,
    "customer_week_mart": _mart(),
    "pending_weeks": _with(CALENDAR, SPINE, REQUESTED_AND_LOG)
    + "SELECT week FROM requested r WHERE NOT EXISTS (SELECT 1 FROM run_log l WHERE l.week = r.week)",
    "pending_after_hwm": _with(CALENDAR, SPINE, REQUESTED_AND_LOG)
    + "SELECT week FROM requested WHERE week > COALESCE((SELECT max(week) FROM run_log), -2147483648)",
    "dq_discrete": DQ_DISCRETE,
    "dq_continuous": DQ_CONTINUOUS,
    "dq_mart_discrete": _mart_profile("discrete"),
    "dq_mart_continuous": _mart_profile("continuous"),
    "mart_roundtrip": _with(CALENDAR, SPINE, *_block_ctes()) + """SELECT s.*, b.bill_total, b.amount_paid, b.payment_delay_in_days,
  CASE WHEN s.week = (SELECT max(week) FROM spine) THEN 1 END AS rerun_flag
FROM spine s LEFT JOIN billing b ON b.account = s.account AND b.week = s.week""",
    "json_roundtrip": "SELECT * FROM orders",
    "set_top_box_asof": _with(CALENDAR, SPINE, LAST_ORDER) + """SELECT account, week, box_type FROM (
  SELECT s.account, s.week, o.o_orderpriority AS box_type,
         row_number() OVER (PARTITION BY s.account, s.week
                            ORDER BY CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 15 AS INTEGER) DESC, o.o_orderkey DESC) AS rn
  FROM spine s JOIN last_order a ON a.week = s.week JOIN orders o ON o.o_custkey = s.account AND CAST(o.o_orderdate AS DATE) <= a.as_of
  WHERE o.o_orderpriority NOT IN ('5-LOW'))
WHERE rn = 1""",
    "weighted_downloads": _block_query("downloads"),
    "filtered_downloads": _with(CALENDAR) + _download_counts(" AND l.l_returnflag = 'R'"),
    "text_account_spine": _with(CALENDAR, SPINE) + """SELECT account, week, c_nationkey, month_of_year, as_of FROM (
  SELECT CASE WHEN b.account % 10 = 3 THEN '?' WHEN b.account % 10 <> 7 THEN 'A' || CAST(b.account AS VARCHAR) END AS account, b.week, cu.c_nationkey, w.month_of_year, w.as_of
  FROM base b JOIN customer cu ON cu.c_custkey = b.account JOIN week_dim w ON w.week = b.week WHERE cu.c_acctbal > 0)
WHERE account IS NOT NULL AND account <> '?'""",
    "text_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_text FROM orders""",
    "filled_strings": """SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' OR o_orderpriority IS NULL THEN 'None' ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderstatus = 'P' OR o_orderstatus IS NULL THEN 'None' ELSE o_orderstatus END AS status, o_totalprice FROM orders""",
    "profile_history": _with(CALENDAR) + """SELECT 'o_totalprice' AS colname, c.week, max(o.o_totalprice) AS maximum_value, min(o.o_totalprice) AS minimum_value,
  CAST(2 AS BIGINT) AS n_runs, CAST(2 AS BIGINT) AS n_stamps
FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date GROUP BY c.week""",
    "table_presence": "\nUNION ALL ".join(
        f"SELECT '{t}' AS role, true AS present, count(*) > 0 AS has_rows, count(*) AS n_rows FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ) + "\nUNION ALL SELECT 'nation+region', true, true, (SELECT count(*) FROM nation) + (SELECT count(*) FROM region)",
    "incremental_run": _with(CALENDAR, SPINE, *_block_ctes()) + """SELECT s.*, l.* EXCLUDE (account, week), p.* EXCLUDE (account, week), CAST(1 AS BIGINT) AS n_log_rows
FROM spine s LEFT JOIN line_speed l USING (account, week) LEFT JOIN pipeline p USING (account, week)""",
    "incremental_refresh": _with(CALENDAR, SPINE, *_block_ctes()) + _mart_select().replace("SELECT *,", "SELECT *, true AS log_ok,", 1),
    "box_state_roll": _block_query("set_top_box"),
    "fiscal_week_blocks": _with(FISCAL, SPINE, *_block_ctes()) + """SELECT * FROM spine LEFT JOIN line_speed USING (account, week)
LEFT JOIN pipeline USING (account, week) LEFT JOIN billing USING (account, week) LEFT JOIN set_top_box USING (account, week)""",
    "profile_states": _with(CALENDAR, "src AS (SELECT CAST(c.week // 100 AS INTEGER) AS year, o.* FROM orders o JOIN calendar c ON CAST(o.o_orderdate AS DATE) = c.calendar_date)",
        """vals AS (SELECT 'o_orderstatus' AS colname, year, o_orderstatus AS unique_value, count(*) AS n_rows FROM src GROUP BY ALL
  UNION ALL SELECT 'o_orderpriority', year, o_orderpriority, count(*) FROM src GROUP BY ALL)""") + f"""SELECT 'o_totalprice' AS colname, year, CAST(NULL AS VARCHAR) AS unique_value, count(o_totalprice) AS n_rows, CAST(NULL AS BIGINT) AS number_of_categories,
  max(o_totalprice) AS maximum_value, min(o_totalprice) AS minimum_value, {cut('avg(o_totalprice)', 3)} AS mean_value, {cut('stddev_samp(o_totalprice)', 2)} AS standard_deviation FROM src GROUP BY year
UNION ALL SELECT colname, year, unique_value, n_rows, count(*) OVER (PARTITION BY colname, year), NULL, NULL, NULL, NULL FROM vals""",
    "dirty_shards": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderkey % 100 + CASE WHEN o_orderkey % 3 = 2 THEN 0.5::DOUBLE ELSE 0 END AS size_code, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS o_orderpriority,
  (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 7) AS n_bad
FROM orders WHERE o_orderkey % 50 <> 7""",
    "weekly_base_wide": _with(CALENDAR, _WIDE)
    + f"SELECT *, {_dur('contract_start_date')}, {_dur('contract_end_date')}, {_dur('review_date')} FROM wide",
    "stored_ranges": _with(CALENDAR, _WIDE) + " UNION ALL ".join(
        f"SELECT '{c}' AS colname, week, count(*) AS n_rows, count({c}) AS n_values, CAST(min({c}) AS VARCHAR) AS minimum_value, CAST(max({c}) AS VARCHAR) AS maximum_value FROM wide GROUP BY week"
        for c in ("customer_number", "price", "order_number", "nation", "visits", "tier", "segment", "contract_start_date", "contract_end_date", "review_date")
    ),
}
