"""Registered queries: sessionization and enrichment (batch form of the
streaming operators; the stream form is exercised in tests)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cumulus.plans.role_sql import with_roles
from cumulus.sources import roles
from cumulus.sources.tables import table
from cumulus.streaming import enrich as EN
from cumulus.streaming import sessions as SS

ADDRESSES = 1 << 32


def _sessions(spark, d):
    # batch form: sliced sessionization (a hot ip+host is not sorted in one
    # task); the streaming form uses session_window, tested to agree
    return SS.sessionize_sliced(roles.web_events(spark, d), ["ip", "host"], "event_time", 300, 3600)


def q_sessionize(spark, d):
    return _sessions(spark, d)


def q_session_avg(spark, d):
    r = SS.session_stats(_sessions(spark, d))
    return r.withColumn("avg_events_per_session", F.round("avg_events_per_session", 6))


def q_session_by_host(spark, d):
    r = SS.session_stats(_sessions(spark, d), ["host"])
    return r.withColumn("avg_events_per_session", F.round("avg_events_per_session", 6))


def geo_ranges(spark, d):
    """IP ranges per nation (with its region): the whole address space cut into one equal range a nation."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    whole = Window.partitionBy(F.lit(0))  # nations are a fixed small table
    ranked = n.withColumn("n", F.count(F.lit(1)).over(whole)).withColumn(
        "i", F.row_number().over(whole.orderBy("n_nationkey")).cast("bigint"))
    at = lambda i: F.expr(f"({i}) * {ADDRESSES} div n")
    return (ranked.join(r, F.col("n_regionkey") == r.r_regionkey)
             .select(at("i - 1").alias("ip_start"), (at("i") - 1).alias("ip_end"),
                     F.col("n_name").alias("country"), F.col("r_name").alias("region")))


def q_enrich_batch(spark, d):
    ev = roles.web_events(spark, d).select(
        "event_id", "ip", F.date_format("event_time", EN.ISO_MILLIS).alias("event_time_text"))
    out = EN.enrich(ev, geo_ranges(spark, d), "ip", ["country", "region"], "event_time_text")
    return out.select("event_id", "ip", "event_timestamp", "geodata")


QUERIES = {
    "sessionize": q_sessionize,
    "session_avg": q_session_avg,
    "session_by_host": q_session_by_host,
    "enrich_batch": q_enrich_batch,
}

_SESS = with_roles("web_events") + """,
g AS (SELECT ip, host, event_time,
             CASE WHEN LAG(event_time) OVER (PARTITION BY ip, host ORDER BY event_time) IS NULL
                    OR event_time - LAG(event_time) OVER (PARTITION BY ip, host ORDER BY event_time) > INTERVAL 5 MINUTE
                  THEN 1 ELSE 0 END AS brk FROM web_events),
s AS (SELECT *, SUM(brk) OVER (PARTITION BY ip, host ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
sess AS (SELECT ip, host, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 5 MINUTE AS session_end,
                COUNT(*) AS num_events FROM s GROUP BY ip, host, sid)"""

ORACLE = {
    "sessionize": _SESS + "\nSELECT * FROM sess",
    "session_avg": _SESS + "\nSELECT round(AVG(num_events), 6) AS avg_events_per_session, COUNT(*) AS num_sessions FROM sess",
    "session_by_host": _SESS + """
SELECT host, round(AVG(num_events), 6) AS avg_events_per_session, COUNT(*) AS num_sessions FROM sess GROUP BY host""",
    "enrich_batch": with_roles("web_events") + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS i, count(*) OVER () AS n FROM nation),
rng AS (SELECT (i - 1) * 4294967296 // n AS ip_start, i * 4294967296 // n - 1 AS ip_end,
               n_name AS country, r.r_name AS region
        FROM ranked JOIN region r ON n_regionkey = r.r_regionkey),
ev AS (SELECT event_id, ip, date_trunc('millisecond', event_time) AS event_timestamp,
              CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS ipl
       FROM web_events)
SELECT ev.event_id, ev.ip, ev.event_timestamp,
       CASE WHEN rng.ip_start IS NULL THEN '{}' ELSE json_object('country', rng.country, 'region', rng.region)::VARCHAR END AS geodata
FROM ev LEFT JOIN rng ON ev.ipl BETWEEN rng.ip_start AND rng.ip_end""",
}
