"""Upserts, referential checks, profiles and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as Z
from ..functions import series as S
from ..operators import keys as K
from ..operators import profile as P
from ..operators import rules as R
from ..operators.candles import raw_projection
from . import fixtures as X
from .registry import query

_NEW_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus,
  o_totalprice * 1.1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"""
_OLD_ORDERS = "SELECT * FROM orders WHERE o_orderkey % 3 <> 0"
_ORDER_OUT = (
    "o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, "
    "o_orderdate, o_orderpriority"
)


def _old_and_new(spark, d):
    orders = X.table(spark, d, "orders")
    old = orders.where(F.col("o_orderkey") % 3 != 0)
    even, third = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3 == 0
    new = orders.where(even | third).withColumn(
        "o_totalprice", F.col("o_totalprice") * 1.1
    )
    return old, new


def _price(df):
    return df.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "upsert",
    f"""SELECT {_ORDER_OUT} FROM ({_OLD_ORDERS}) o
      WHERE NOT EXISTS (SELECT 1 FROM ({_NEW_ORDERS}) n WHERE n.o_orderkey = o.o_orderkey)
    UNION ALL SELECT {_ORDER_OUT} FROM ({_NEW_ORDERS})""",
)
def upsert(spark, d):
    return _price(K.upsert(*_old_and_new(spark, d), ["o_orderkey"]))


@query(
    "insert_ignore",
    f"""SELECT {_ORDER_OUT} FROM ({_NEW_ORDERS}) n
      WHERE NOT EXISTS (SELECT 1 FROM ({_OLD_ORDERS}) o WHERE n.o_orderkey = o.o_orderkey)""",
)
def insert_ignore(spark, d):
    return _price(K.insert_ignore(*_old_and_new(spark, d), ["o_orderkey"]))


@query(
    "fk_violations",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS
    (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""",
)
def fk_violations(spark, d):
    lines = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    finished = X.table(spark, d, "orders").where(F.col("o_orderstatus") == "F")
    return K.fk_violations(lines, finished, {"l_orderkey": "o_orderkey"})


@query(
    "fk_version",
    """SELECT c_custkey, c_nationkey FROM customer c WHERE NOT EXISTS
    (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 0)""",
)
def fk_version(spark, d):
    customers = X.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nations = X.table(spark, d, "nation").where(F.col("n_regionkey") != 0)
    return K.fk_violations(customers, nations, {"c_nationkey": "n_nationkey"})


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, d):
    return K.duplicate_keys(X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("count_rows", f"SELECT count(*) AS row_count, count(close) AS ts_count FROM ({X.BRONZE_SQL})")
def count_rows(spark, d):
    return P.count_rows(X.bronze(spark, d), "close")


@query(
    "period_bounds",
    f"""SELECT min(ts) AS period_start, max(ts) AS period_end, epoch(min(ts)) AS start_epoch,
      epoch(max(ts)) AS end_epoch FROM ({X.BARS})""",
)
def period_bounds(spark, d):
    return P.period_bounds(X.bars(spark, d))


_SHARED = ["symbol", "open_time", "open", "high", "low", "close"]
_SHARED_SQL = ", ".join(_SHARED)


def _without_extraction(spark, d):
    return X.bronze(spark, d).select(*_SHARED)


@query(
    "null_count",
    f"""SELECT CAST(sum(CAST(close IS NULL AS INT) + CAST(high IS NULL AS INT)
      + CAST(low IS NULL AS INT) + CAST(open IS NULL AS INT) + CAST(symbol IS NULL AS INT)
      + CAST(open_time IS NULL AS INT)) AS BIGINT) AS null_count FROM ({X.BRONZE_SQL})""",
)
def null_count(spark, d):
    return P.null_count(_without_extraction(spark, d))


@query(
    "duplicate_rows",
    f"""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count FROM
    (SELECT {_SHARED_SQL}, count(*) AS n FROM ({X.BRONZE_SQL}) GROUP BY ALL)""",
)
def duplicate_rows(spark, d):
    return P.duplicate_rows(_without_extraction(spark, d))


@query("distinct_symbols", f"SELECT DISTINCT symbol FROM ({X.BRONZE_SQL})")
def distinct_symbols(spark, d):
    return P.distinct_values(X.bronze(spark, d), "symbol")


_AVERAGES = {
    "avg_quantity": "l_quantity",
    "avg_price": "l_extendedprice",
    "avg_discount": "l_discount",
    "avg_tax": "l_tax",
}


def _calendar_sql(unit: str) -> str:
    averages = ", ".join(f"round(avg({c}), 2) AS {n}" for n, c in _AVERAGES.items())
    return f"""SELECT date_trunc('{unit}', l_shipdate) AS {unit}, {averages}
    FROM lineitem GROUP BY 1 ORDER BY 1"""


@query("monthly_profile", _calendar_sql("month"))
def monthly_profile(spark, d):
    return P.calendar_profile(X.table(spark, d, "lineitem"), "month", _AVERAGES, "l_shipdate")


@query("yearly_profile", _calendar_sql("year"))
def yearly_profile(spark, d):
    return P.calendar_profile(X.table(spark, d, "lineitem"), "year", _AVERAGES, "l_shipdate")


_EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


@query(
    "schema_listing",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count "
        "FROM events"
        for c, t in _EVENT_TYPES.items()
    ),
)
def schema_listing(spark, d):
    return P.schema_listing(X.table(spark, d, "events"))


_METRICS_SQL = f"""
SELECT {{by}} CAST(sum(n) AS DOUBLE) AS row_count, CAST(6 AS DOUBLE) AS column_count,
  CAST(sum(CASE WHEN close IS NULL THEN n ELSE 0 END) AS DOUBLE) AS null_count,
  CAST(sum(n - 1) AS DOUBLE) AS duplicate_count,
  epoch(min(open_time)) AS min_timestamp, epoch(max(open_time)) AS max_timestamp
FROM (SELECT {{cols}}, count(*) AS n FROM ({X.BRONZE_SQL}) GROUP BY ALL) {{group}}
"""
_TOTALS = _METRICS_SQL.format(by="", cols=_SHARED_SQL, group="")


@query(
    "quality_metrics",
    f"""SELECT metric_name, metric_value FROM (UNPIVOT ({_TOTALS})
    ON {", ".join(P.METRICS)} INTO NAME metric_name VALUE metric_value)""",
)
def quality_metrics(spark, d):
    return P.in_long_form(P.quality_metrics(_without_extraction(spark, d)))


_BY_WEEK = _METRICS_SQL.format(
    by="week, symbol,",
    cols=f"date_trunc('week', open_time) AS week, {_SHARED_SQL}",
    group="GROUP BY week, symbol",
)
_COVERED = f"""SELECT *, CASE WHEN row_count > 0 THEN least(100.0, row_count / 10080 * 100) END
    AS coverage_pct, (max_timestamp - min_timestamp) / 3600 AS span_hours,
    (max_timestamp - min_timestamp) / 3600 / 24 AS span_days FROM ({_BY_WEEK})"""


def _by_week(spark, d):
    week = Z.week_start("open_time").alias("week")
    batches = _without_extraction(spark, d).select(week, *_SHARED)
    return P.quality_metrics(batches, by=["week", "symbol"], with_columns=len(_SHARED))


@query(
    "coverage",
    f"SELECT week, symbol, row_count, coverage_pct, span_hours, span_days FROM ({_COVERED})",
)
def coverage(spark, d):
    measured = P.coverage(_by_week(spark, d))
    return measured.select(
        "week", "symbol", "row_count", "coverage_pct", "span_hours", "span_days"
    )


def _level(good: str, fair: str) -> str:
    return f"CASE WHEN {good} THEN 'ok' WHEN {fair} THEN 'warn' ELSE 'fail' END"


def _colour(c: str, warn: int, danger: int) -> str:
    return f"CASE WHEN {c} >= {danger} THEN 'red' WHEN {c} >= {warn} THEN 'amber' ELSE 'green' END"


_CHECKS = [
    ("nulls", "null_count", _level("null_count = 0", "null_count < 5"), _colour("null_count", 5, 50)),
    (
        "duplicates",
        "duplicate_count",
        _level("duplicate_count = 0", "duplicate_count < 1"),
        _colour("duplicate_count", 1, 10),
    ),
    ("volume", "row_count", _level("row_count > 1000", "row_count > 100"), "NULL"),
    ("schema", "column_count", _level("column_count >= 5", "column_count >= 4"), "NULL"),
    ("coverage", "coverage_pct", _level("coverage_pct >= 95", "coverage_pct >= 80"), "NULL"),
]


@query(
    "dq_checks",
    f"WITH m AS ({_COVERED}) "
    + " UNION ALL ".join(
        f"SELECT week, symbol, '{name}' AS check_name, {value} AS check_value, "
        f"{level} AS check_status, CAST({alert} AS VARCHAR) AS alert FROM m"
        for name, value, level, alert in _CHECKS
    ),
)
def dq_checks(spark, d):
    return R.batch_checks(_by_week(spark, d), by=["week", "symbol"])


def _rule_sql(rule: str, column: str, fails: str, source: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column",
      count(*) FILTER (WHERE {fails}) AS failed_rows,
      CASE WHEN count(*) FILTER (WHERE {fails}) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM {source}"""


def _rules_sql(checks: list[tuple[str, str, str]], source: str) -> str:
    parts = " UNION ALL ".join(_rule_sql(r, c, f, "t") for r, c, f in checks)
    return f"WITH t AS ({source}) {parts}"


@query(
    "dq_not_null",
    _rules_sql(
        [("not_null", c, f"{c} IS NULL") for c in ("open_time", "close", "volume", "symbol")],
        X.BRONZE_SQL,
    ),
)
def dq_not_null(spark, d):
    rules = [r for r in R.BRONZE_RULES if isinstance(r, R.NotNull)]
    return R.evaluate(X.bronze(spark, d), rules)


def _unique_sql(columns: str, keys: str, source: str, where: str = "TRUE") -> str:
    repeated = f"""SELECT {keys} FROM {source} WHERE {where}
      GROUP BY {keys} HAVING count(*) > 1"""
    return f"""SELECT 'unique' AS rule, '{columns}' AS "column", count(*) AS failed_rows,
      CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({repeated})"""


@query(
    "dq_unique",
    _unique_sql("l_orderkey,l_linenumber", "l_orderkey, l_linenumber", "lineitem")
    + " UNION ALL "
    + _unique_sql("l_orderkey", "l_orderkey", "lineitem"),
)
def dq_unique(spark, d):
    rules = [R.Unique(("l_orderkey", "l_linenumber")), R.Unique(("l_orderkey",))]
    return R.evaluate(X.table(spark, d, "lineitem"), rules)


@query(
    "dq_accepted_values",
    _rules_sql(
        [
            ("accepted_values", "interval", "\"interval\" NOT IN ('1m')"),
            ("accepted_values", "source", "source NOT IN ('src_a')"),
            ("accepted_values", "symbol", "symbol NOT IN ('click', 'view')"),
        ],
        X.BRONZE_SQL,
    ),
)
def dq_accepted_values(spark, d):
    rules = [
        R.AcceptedValues("interval", ("1m",)),
        R.AcceptedValues("source", ("src_a",)),
        R.AcceptedValues("symbol", ("click", "view")),
    ]
    return R.evaluate(X.bronze(spark, d), rules)


_RAW_SQL = f"""SELECT open AS open_price, high AS high_price, low AS low_price,
  close AS close_price, volume, "interval" AS timeframe FROM ({X.BRONZE_SQL})"""


@query(
    "dq_expression",
    _rules_sql(
        [
            ("expression_is_true", "high_price", "NOT (high_price >= low_price)"),
            ("expression_is_true", "open_price", "NOT (open_price >= 0 AND close_price >= 0)"),
            ("expression_is_true", "volume", "NOT (volume >= 0)"),
        ],
        _RAW_SQL,
    ),
)
def dq_expression(spark, d):
    rules = [r for r in R.SILVER_RULES if isinstance(r, R.IsTrue)]
    return R.evaluate(raw_projection(X.bronze(spark, d)), rules)


@query(
    "dq_ohlc_checks",
    _rules_sql(
        [
            ("check", "high_gte_low", "NOT (high_price >= low_price)"),
            ("check", "high_gte_open", "NOT (high_price >= open_price)"),
            ("check", "high_gte_close", "NOT (high_price >= close_price)"),
            ("check", "low_lte_open", "NOT (low_price <= open_price)"),
            ("check", "low_lte_close", "NOT (low_price <= close_price)"),
            ("check", "volume_pos", "NOT (volume >= 0)"),
            (
                "accepted_values",
                "timeframe",
                "timeframe NOT IN ('1m', '5m', '15m', '1h', '4h', '12h', '1d')",
            ),
        ],
        _RAW_SQL,
    ),
)
def dq_ohlc_checks(spark, d):
    return R.evaluate(raw_projection(X.bronze(spark, d)), R.CANDLE_CHECKS)


_REGISTRY_SQL = """SELECT c_custkey AS version_id, c_acctbal > 9000 AS is_active FROM customer"""


@query(
    "dq_one_active",
    f"WITH t AS ({_REGISTRY_SQL}) "
    + " UNION ALL ".join(
        [
            _rule_sql("not_null", "version_id", "version_id IS NULL", "t"),
            _rule_sql("not_null", "is_active", "is_active IS NULL", "t"),
            _unique_sql("version_id", "version_id", "t"),
            _unique_sql("is_active", "is_active", "t", "is_active"),
        ]
    ),
)
def dq_one_active(spark, d):
    registry = X.table(spark, d, "customer").select(
        F.col("c_custkey").alias("version_id"), (F.col("c_acctbal") > 9000).alias("is_active")
    )
    return R.evaluate(registry, R.VERSION_RULES)


@query(
    "scalar_time",
    """SELECT event_id, date_trunc('minute', ts) AS minute, epoch_us(ts) // 1000 AS millis,
      CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso,
      date_trunc('week', ts) AS week_start,
      strftime(date_trunc('week', ts), '%Y%m%d') AS week_label,
      date_trunc('week', ts) - INTERVAL 7 DAY AS previous_monday,
      strftime(ts, '%b %d') AS day_label,
      date_diff('minute', date_trunc('week', ts), date_trunc('minute', ts)) AS minutes_in_week
    FROM events""",
)
def scalar_time(spark, d):
    previous, _ = Z.previous_full_week("ts")
    return X.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).select(
        "event_id",
        Z.floor_to_minute("ts").alias("minute"),
        Z.to_milliseconds("ts").alias("millis"),
        Z.iso_utc("ts").alias("iso"),
        Z.week_start("ts").alias("week_start"),
        Z.week_label("ts").alias("week_label"),
        previous.alias("previous_monday"),
        F.date_format("ts", "MMM dd").alias("day_label"),
        Z.expected_minutes(Z.week_start("ts"), Z.floor_to_minute("ts")).alias("minutes_in_week"),
    )


@query(
    "scalar_math",
    """SELECT event_id, round(CASE WHEN value > 0 THEN ln(value) END, 6) AS log_value,
      round(value / NULLIF(user_id % 3, 0), 6) AS ratio,
      CASE WHEN event_id % 4 <> 0 THEN greatest(value, user_id) END AS larger,
      CASE WHEN event_id % 4 <> 0 THEN least(value, user_id) END AS smaller,
      CAST(CASE WHEN value > 50 THEN 1 ELSE 0 END AS BIGINT) AS signal,
      round(sqrt(abs(value - 50)), 6) AS root,
      CASE WHEN value >= 100 THEN 'red' WHEN value >= 20 THEN 'amber' ELSE 'green' END AS alert,
      CASE WHEN value <= 20 THEN 'ok' WHEN value <= 100 THEN 'warn' ELSE 'fail' END AS tier
    FROM events""",
)
def scalar_math(spark, d):
    value, user = F.col("value"), F.col("user_id").cast("double")
    known = F.when(F.col("event_id") % 4 != 0, value)
    return X.table(spark, d, "events").select(
        "event_id",
        F.round(S.log_volume("value"), 6).alias("log_value"),
        F.round(S.safe_divide("value", user % 3), 6).alias("ratio"),
        S.strict_greatest(known, user).alias("larger"),
        S.strict_least(known, user).alias("smaller"),
        S.binary_signal(value > 50).alias("signal"),
        F.round(F.sqrt(F.abs(value - 50)), 6).alias("root"),
        Z.alert("value", 20, 100).alias("alert"),
        Z.tier(value, value <= 20, value <= 100).alias("tier"),
    )
