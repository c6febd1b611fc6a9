"""Funnels: did a later event of the same key on the same day reach a target?

The self-join of the textbook query (every event against every later event
of the same user-day) is quadratic in the size of a user-day.  Here the
per-(user, day) facts needed - latest event time and latest target time -
are aggregated (partial, map-side) and joined back, which keeps the same
semantics, including dropping events that have no later event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.operators.ordered import running_totals


def _clean(events: DataFrame, key: str, time_col: str, url_col: str, date_col: str) -> DataFrame:
    return (events.filter(F.col(key).isNotNull())
                  .select(key, time_col, url_col, F.to_date(time_col).alias(date_col))
                  .distinct())


def funnel_event(events: DataFrame, target: str, key: str = "user_id", time_col: str = "event_time",
                 url_col: str = "url", min_hits: int = 100) -> DataFrame:
    """Per url: events with a later same-day event, and the share of them
    followed later that day by a ``target`` event (HAVING share > 0 and
    count > ``min_hits``)."""
    e = _clean(events, key, time_col, url_col, "_day")
    day = e.groupBy(key, "_day").agg(
        F.max(time_col).alias("_last"),
        F.max(F.when(F.col(url_col) == target, F.col(time_col))).alias("_last_target"))
    j = e.join(day, [key, "_day"]).filter(F.col("_last") > F.col(time_col))
    converted = F.coalesce(F.col("_last_target") > F.col(time_col), F.lit(False)).cast("bigint")
    g = j.groupBy(url_col).agg(F.count(F.lit(1)).alias("num_events"), F.sum(converted).alias("num_converted"))
    g = g.withColumn("pct_converted", F.col("num_converted").cast("double") / F.col("num_events").cast("double"))
    return g.filter((F.col("pct_converted") > 0) & (F.col("num_events") > min_hits))


def funnel_user(events: DataFrame, target: str, key: str = "user_id", time_col: str = "event_time",
                url_col: str = "url", min_hits: int = 500, bucket_seconds: int = 60) -> DataFrame:
    """Per url: number of (event, later same-day event) pairs summed over
    keys, keys that reached ``target`` later, and their share.

    Pairs per event = events in the user-day minus those at or before it
    (ties do not count as later).  The "at or before" count is a bucketed
    running count (``bucket_seconds`` time slices), so a hot user-day is
    spread over many tasks; day totals and the latest target time are
    partial aggregates joined back.
    """
    e = _clean(events, key, time_col, url_col, "_day")
    day = e.groupBy(key, "_day").agg(
        F.count(F.lit(1)).alias("_day_n"),
        F.max(F.when(F.col(url_col) == target, F.col(time_col))).alias("_last_target"))
    t = F.col(time_col)
    slice_ = F.floor((F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)) / F.lit(bucket_seconds))
    r = running_totals(e, [key, "_day"], [time_col], slice_, ties="range", rn_col="_upto")
    w = r.join(day, [key, "_day"]).withColumn("_pairs", F.col("_day_n") - F.col("_upto"))
    w = w.filter(F.col("_pairs") > 0)
    conv = F.coalesce(F.col("_last_target") > F.col(time_col), F.lit(False)).cast("int")
    per_user = w.groupBy(key, url_col).agg(F.sum("_pairs").alias("_hits"), F.max(conv).alias("_conv"))
    g = per_user.groupBy(url_col).agg(F.sum("_hits").cast("bigint").alias("number_of_hits"),
                                      F.sum("_conv").cast("bigint").alias("num_converted"))
    g = g.withColumn("pct_converted", F.col("num_converted").cast("double") / F.col("number_of_hits").cast("double"))
    return g.filter(F.col("number_of_hits") > min_hits)
