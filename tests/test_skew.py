"""A third of all events on one key: the skew-safe operators still agree
with plain per-key windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cumulus.operators import funnel as FN
from cumulus.operators import windows as W
from cumulus.sources import roles
from cumulus.streaming import sessions as SS
from tests.conftest import SF_SMALL


def _hot(spark):
    ev = roles.web_events(spark, SF_SMALL)
    # every third event moves to user 0 (a hot key holding a third of the rows)
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_funnel_user_on_hot_key_matches_window_form(spark):
    ev = _hot(spark)
    got = {r.url: (r.number_of_hits, r.num_converted) for r in FN.funnel_user(ev, "/purchase", min_hits=0).collect()}
    e = ev.select("user_id", "url", "event_time", F.to_date("event_time").alias("d")).distinct()
    part = Window.partitionBy("user_id", "d")
    upto = part.orderBy("event_time").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    w = e.select("user_id", "url", "event_time",
                 (F.count(F.lit(1)).over(part) - F.count(F.lit(1)).over(upto)).alias("pairs"),
                 F.max(F.when(F.col("url") == "/purchase", F.col("event_time"))).over(part).alias("lt"))
    w = w.filter("pairs > 0")
    per = w.groupBy("user_id", "url").agg(F.sum("pairs").alias("h"),
                                          F.max(F.coalesce(F.col("lt") > F.col("event_time"), F.lit(False)).cast("int")).alias("c"))
    exp = {r.url: (r.h, r.c) for r in per.groupBy("url").agg(F.sum("h").alias("h"), F.sum("c").alias("c")).collect()}
    assert got == exp


def test_streak_and_sessions_on_hot_key(spark):
    ev = _hot(spark).select("user_id", "event_id", "event_time", "ip", "host")
    got = {r.user_id: r.longest_streak for r in
           W.longest_streak(ev, "user_id", ["event_id"], F.col("event_id") % 2 == 0,
                            bucket=F.floor(F.col("event_id") / 50)).collect()}
    rows = sorted((r.user_id, r.event_id) for r in ev.collect())
    best, cur, prev_u = {}, 0, None
    for u, i in rows:
        cur = 0 if u != prev_u else cur
        cur = cur + 1 if i % 2 == 0 else 0
        best[u] = max(best.get(u, 0), cur)
        prev_u = u
    assert got == {u: b for u, b in best.items() if b > 0}
    hot_ip = ev.withColumn("ip", F.when(F.col("user_id") == 0, F.lit("10.0.0.0")).otherwise(F.col("ip")))
    a = SS.sessionize(hot_ip, ["ip", "host"], "event_time").select(
        "ip", "host", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz"),
        "num_events")
    b = SS.sessionize_sliced(hot_ip, ["ip", "host"], "event_time", 300, 600)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))
