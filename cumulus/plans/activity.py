"""Registered queries: date lists, bitmaps and monthly arrays (fact modelling)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.functions.columns import bit_string
from cumulus.operators import arrays as A
from cumulus.operators import datelist as D
from cumulus.operators import distinct_counts as DC
from cumulus.plans.common import DS, PREV_DS, dates_text, ints_text, stored
from cumulus.plans.role_sql import with_roles
from cumulus.sources import roles


def _flat_dates(df, keys):
    return df.select(*keys, F.size("dates_active").cast("bigint").alias("n_dates"),
                     F.try_element_at("dates_active", F.lit(1)).alias("first_active"),
                     F.try_element_at("dates_active", F.lit(-1)).alias("last_active"),
                     dates_text(F.col("dates_active")).alias("dates"), "date")


def q_active_dates_backfill(spark, d):
    ev = roles.web_events(spark, d)
    return _flat_dates(D.active_dates_backfill(ev, DS), ["user_id"])


def q_active_dates_step(spark, d):
    ev = roles.web_events(spark, d)
    prev = D.active_dates_backfill(ev, PREV_DS)
    return _flat_dates(D.active_dates_step(prev, ev, DS), ["user_id"])


def _cum(spark, d):
    return D.active_dates_backfill(roles.web_events(spark, d), DS)


def q_datelist_int(spark, d):
    return D.datelist_int(_cum(spark, d), DS).withColumn("datelist_bits", bit_string(F.col("datelist_int")))


def q_activity_flags(spark, d):
    return D.activity_flags(D.datelist_int(_cum(spark, d), DS))


def _device_events(spark, d):
    ev = roles.web_events(spark, d)
    dev = roles.devices(spark, d)
    return (ev.join(dev, "device_id", "left")
              .withColumn("browser_type", F.coalesce("browser_type", F.lit("unknown"))))


def q_device_datelist(spark, d):
    lists = D.active_dates_backfill(_device_events(spark, d), DS, ["user_id", "browser_type"])
    return _flat_dates(lists, ["user_id", "browser_type"])


def q_device_datelist_step(spark, d):
    ev = _device_events(spark, d)
    prev = D.active_dates_backfill(ev, PREV_DS, ["user_id", "browser_type"])
    return _flat_dates(D.active_dates_step(prev, ev, DS, ["user_id", "browser_type"]), ["user_id", "browser_type"])


def q_device_date_map(spark, d):
    ev = _device_events(spark, d)
    prev = D.keyed_date_map(ev, "user_id", "browser_type", PREV_DS)
    maps = D.keyed_date_map_step(prev, ev, "user_id", "browser_type", DS)
    told = F.transform(F.array_sort(F.map_entries("dates_by_type")),
                       lambda e: F.concat(e["key"], F.lit("="), dates_text(e["value"])))
    return maps.select("user_id", F.array_join(told, ";").alias("dates_by_type"), "date")


def q_device_datelist_int(spark, d):
    lists = D.active_dates_backfill(_device_events(spark, d), DS, ["user_id", "browser_type"])
    return D.activity_flags(D.datelist_int(lists, DS, ["user_id", "browser_type"])).select(
        "user_id", "browser_type", "datelist_int", "l32", "l7", "date")


def q_host_datelist(spark, d):
    ev = roles.web_events(spark, d)
    prev = D.active_dates_backfill(ev, PREV_DS, "host")
    return _flat_dates(D.active_dates_step(prev, ev, DS, "host"), ["host"])


def _flat_month(df):
    return df.select("user_id", "month_start", "metric_name",
                     ints_text(F.col("metric_array")).alias("metric_array"),
                     F.size("metric_array").cast("bigint").alias("array_length"))


def q_array_metric_month(spark, d):
    return _flat_month(A.array_metric_month(roles.web_events(spark, d), DS))


def q_array_metric_step(spark, d):
    ev = roles.web_events(spark, d)
    prev = A.array_metric_month(ev, PREV_DS).select("user_id", "month_start", "metric_name", "metric_array")
    return _flat_month(A.array_metric_step(prev, ev, DS))


def q_monthly_hits(spark, d):
    m = A.array_metric_month(roles.web_events(spark, d), DS, null_pad=True)
    return m.select("user_id", "month_start", ints_text(F.col("metric_array")).alias("hit_array"),
                    "first_found_date", "date_partition")


def q_monthly_hits_step(spark, d):
    ev = roles.web_events(spark, d)
    prev = A.array_metric_month(ev, PREV_DS, null_pad=True)
    m = A.array_metric_step(prev, ev, DS, null_pad=True)
    return m.select("user_id", "month_start", ints_text(F.col("metric_array")).alias("hit_array"),
                    "first_found_date", "date_partition")


def q_array_first_days(spark, d):
    m = A.array_metric_month(roles.web_events(spark, d), DS)
    return A.array_first_days(m, 3)


def q_array_daily(spark, d):
    return A.array_daily(A.array_metric_month(roles.web_events(spark, d), DS))


def q_array_length_hist(spark, d):
    return A.array_length_hist(A.array_metric_month(roles.web_events(spark, d), DS))


def _flat_host(df):
    return df.select("host", "month", ints_text(F.col("hit_array")).alias("hit_array"),
                     ints_text(F.col("unique_visitors")).alias("unique_visitors"))


def q_host_reduced(spark, d):
    return _flat_host(A.host_reduced_month(roles.web_events(spark, d), DS))


def q_host_reduced_step(spark, d):
    ev = roles.web_events(spark, d)
    return _flat_host(A.host_reduced_step(A.host_reduced_month(ev, PREV_DS), ev, DS))


def q_host_unique_visitors(spark, d):
    """Visitors of a host and month from the daily states alone, each day stored as it is loaded."""
    days = DC.distinct_state(roles.web_events(spark, d), ["host", "event_date"], "user_id")
    state = stored(days, "visitors").withColumn("month", F.trunc("event_date", "MM"))
    return DC.count_distinct(state, ["host", "month"], "unique_visitors")


QUERIES = {
    "host_unique_visitors": q_host_unique_visitors,
    "active_dates_backfill": q_active_dates_backfill,
    "active_dates_step": q_active_dates_step,
    "datelist_int": q_datelist_int,
    "activity_flags": q_activity_flags,
    "device_datelist": q_device_datelist,
    "device_datelist_step": q_device_datelist_step,
    "device_date_map": q_device_date_map,
    "device_datelist_int": q_device_datelist_int,
    "host_datelist": q_host_datelist,
    "array_metric_month": q_array_metric_month,
    "array_metric_step": q_array_metric_step,
    "monthly_hits": q_monthly_hits,
    "monthly_hits_step": q_monthly_hits_step,
    "array_first_days": q_array_first_days,
    "array_daily": q_array_daily,
    "array_length_hist": q_array_length_hist,
    "host_reduced": q_host_reduced,
    "host_reduced_step": q_host_reduced_step,
}

# ----------------------------------------------------------------------------
# Oracle SQL (DuckDB)

_DATES_SQL = with_roles("web_events") + """,
days AS (SELECT DISTINCT user_id, event_date AS d FROM web_events
         WHERE user_id IS NOT NULL AND event_date <= DATE '2024-01-30')
SELECT user_id, COUNT(*) AS n_dates, MIN(d) AS first_active, MAX(d) AS last_active,
       string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates, DATE '2024-01-30' AS date
FROM days GROUP BY user_id"""

_BITS_CTE = with_roles("web_events") + """,
days AS (SELECT DISTINCT user_id, event_date AS d FROM web_events
         WHERE user_id IS NOT NULL AND event_date <= DATE '2024-01-30'),
bits AS (SELECT user_id,
                CAST(COALESCE(SUM(CASE WHEN date_diff('day', d, DATE '2024-01-30') BETWEEN 0 AND 31
                                  THEN CAST(1 AS BIGINT) << (31 - date_diff('day', d, DATE '2024-01-30')) END), 0) AS BIGINT) AS datelist_int
         FROM days GROUP BY user_id)"""

_DEVICE_DAYS = with_roles("web_events", "devices") + """,
days AS (SELECT DISTINCT e.user_id, COALESCE(v.browser_type, 'unknown') AS browser_type, e.event_date AS d
         FROM web_events e LEFT JOIN devices v ON e.device_id = v.device_id
         WHERE e.user_id IS NOT NULL AND e.event_date <= DATE '2024-01-30')"""

_MONTH_CTE = with_roles("web_events") + """,
cal AS (SELECT CAST(t.d AS DATE) AS day FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(d)),
cnt AS (SELECT user_id, event_date AS day, COUNT(*) AS n FROM web_events
        WHERE user_id IS NOT NULL AND event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1, 2),
users AS (SELECT user_id, MIN(day) AS first_found_date FROM cnt GROUP BY user_id),
grid AS (SELECT u.user_id, u.first_found_date, c.day, COALESCE(n.n, 0) AS n
         FROM users u CROSS JOIN cal c LEFT JOIN cnt n ON n.user_id = u.user_id AND n.day = c.day)"""

_MONTH_SQL = _MONTH_CTE + """
SELECT user_id, DATE '2024-01-01' AS month_start, 'site_hits' AS metric_name,
       string_agg(CAST(n AS VARCHAR), ',' ORDER BY day) AS metric_array, COUNT(*) AS array_length
FROM grid GROUP BY user_id"""

_HOST_SQL = with_roles("web_events") + """,
cal AS (SELECT CAST(t.d AS DATE) AS day FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(d)),
cnt AS (SELECT host, event_date AS day, COUNT(*) AS hits, COUNT(DISTINCT user_id) AS visitors FROM web_events
        WHERE host IS NOT NULL AND event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1, 2),
hosts AS (SELECT DISTINCT host FROM cnt)
SELECT h.host, DATE '2024-01-01' AS month,
       string_agg(CAST(COALESCE(n.hits, 0) AS VARCHAR), ',' ORDER BY c.day) AS hit_array,
       string_agg(CAST(COALESCE(n.visitors, 0) AS VARCHAR), ',' ORDER BY c.day) AS unique_visitors
FROM hosts h CROSS JOIN cal c LEFT JOIN cnt n ON n.host = h.host AND n.day = c.day
GROUP BY h.host"""

_DEVICE_LISTS = _DEVICE_DAYS + """
SELECT user_id, browser_type, COUNT(*) AS n_dates, MIN(d) AS first_active, MAX(d) AS last_active,
       string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates, DATE '2024-01-30' AS date
FROM days GROUP BY user_id, browser_type"""

_HIT_ARRAYS = _MONTH_CTE + """
SELECT user_id, DATE '2024-01-01' AS month_start,
       string_agg(CASE WHEN day < first_found_date THEN 'null' ELSE CAST(n AS VARCHAR) END, ',' ORDER BY day) AS hit_array,
       MIN(first_found_date) AS first_found_date, DATE '2024-01-30' AS date_partition
FROM grid GROUP BY user_id"""

ORACLE = {
    "active_dates_backfill": _DATES_SQL,
    "active_dates_step": _DATES_SQL,
    "datelist_int": _BITS_CTE + """
SELECT user_id, datelist_int, DATE '2024-01-30' AS date, lpad(bin(datelist_int), 32, '0') AS datelist_bits FROM bits""",
    "activity_flags": _BITS_CTE + """
SELECT user_id, datelist_int, DATE '2024-01-30' AS date,
       bit_count(datelist_int) > 0 AS monthly_active,
       CAST(bit_count(datelist_int) AS BIGINT) AS l32,
       bit_count(datelist_int & 4261412864) > 0 AS weekly_active,
       CAST(bit_count(datelist_int & 4261412864) AS BIGINT) AS l7,
       bit_count(datelist_int & 33292288) > 0 AS weekly_active_previous_week,
       (datelist_int & 2147483648) <> 0 AS daily_active
FROM bits""",
    "device_datelist": _DEVICE_LISTS,
    "device_datelist_step": _DEVICE_LISTS,
    "device_date_map": _DEVICE_DAYS + """,
lists AS (SELECT user_id, browser_type, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates
          FROM days GROUP BY user_id, browser_type)
SELECT user_id, string_agg(browser_type || '=' || dates, ';' ORDER BY browser_type) AS dates_by_type,
       DATE '2024-01-30' AS date
FROM lists GROUP BY user_id""",
    "device_datelist_int": _DEVICE_DAYS + """,
bits AS (SELECT user_id, browser_type,
                CAST(COALESCE(SUM(CASE WHEN date_diff('day', d, DATE '2024-01-30') BETWEEN 0 AND 31
                                  THEN CAST(1 AS BIGINT) << (31 - date_diff('day', d, DATE '2024-01-30')) END), 0) AS BIGINT) AS datelist_int
         FROM days GROUP BY user_id, browser_type)
SELECT user_id, browser_type, datelist_int, CAST(bit_count(datelist_int) AS BIGINT) AS l32,
       CAST(bit_count(datelist_int & 4261412864) AS BIGINT) AS l7, DATE '2024-01-30' AS date
FROM bits""",
    "host_datelist": with_roles("web_events") + """,
days AS (SELECT DISTINCT host, event_date AS d FROM web_events
         WHERE host IS NOT NULL AND event_date <= DATE '2024-01-30')
SELECT host, COUNT(*) AS n_dates, MIN(d) AS first_active, MAX(d) AS last_active,
       string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates, DATE '2024-01-30' AS date
FROM days GROUP BY host""",
    "array_metric_month": _MONTH_SQL,
    "array_metric_step": _MONTH_SQL,
    "monthly_hits": _HIT_ARRAYS,
    "monthly_hits_step": _HIT_ARRAYS,
    "array_first_days": _MONTH_CTE + """
SELECT DATE '2024-01-01' AS month_start,
       CAST(SUM(CASE WHEN day = DATE '2024-01-01' THEN n ELSE 0 END) AS BIGINT) AS num_hits_day_1,
       CAST(SUM(CASE WHEN day = DATE '2024-01-02' THEN n ELSE 0 END) AS BIGINT) AS num_hits_day_2,
       CAST(SUM(CASE WHEN day = DATE '2024-01-03' THEN n ELSE 0 END) AS BIGINT) AS num_hits_day_3
FROM grid""",
    "array_daily": _MONTH_CTE + """
SELECT 'site_hits' AS metric_name, day AS date, CAST(SUM(n) AS BIGINT) AS value FROM grid GROUP BY day""",
    "array_length_hist": _MONTH_CTE + """
SELECT CAST((SELECT COUNT(*) FROM cal) AS BIGINT) AS array_length, COUNT(*) AS n_rows FROM users""",
    "host_reduced": _HOST_SQL,
    "host_reduced_step": _HOST_SQL,
}

ORACLE["host_unique_visitors"] = with_roles("web_events") + """
SELECT host, CAST(date_trunc('month', event_date) AS DATE) AS month, COUNT(DISTINCT user_id) AS unique_visitors
FROM web_events GROUP BY 1, 2"""
