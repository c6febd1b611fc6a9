"""Invariants over the registered queries and property tests on random activity."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cumulus.operators import arrays as A
from cumulus.operators import datelist as D
from cumulus.operators import growth as GR
from cumulus.plans import activity, analytics, dimensional, streams
from cumulus.sources import roles
from tests.conftest import SF_SMALL


def test_scd_intervals_tile_each_entity(spark):
    scd = dimensional.q_scd2_backfill_two_attr(spark, SF_SMALL)
    cum = dimensional.q_cumulate_backfill(spark, SF_SMALL)
    spans = {}
    for r in scd.collect():
        spans.setdefault(r.player_name, []).append((r.start_season, r.end_season))
    periods = {}
    for r in cum.select("player_name", "current_season").collect():
        periods.setdefault(r.player_name, set()).add(r.current_season)
    for name, iv in spans.items():
        iv.sort()
        covered = [p for s, e in iv for p in range(s, e + 1)]
        assert len(covered) == len(set(covered)), name          # no overlap
        assert set(covered) == periods[name], name              # full cover
        assert all(iv[i][1] + 1 == iv[i + 1][0] for i in range(len(iv) - 1)), name


def test_bit_count_equals_active_days_in_window(spark):
    flags = {r.user_id: r.l32 for r in activity.q_activity_flags(spark, SF_SMALL).collect()}
    ev = roles.web_events(spark, SF_SMALL)
    days = (ev.filter(F.col("user_id").isNotNull() & (F.col("event_date") <= "2024-01-30")
                      & (F.col("event_date") >= F.date_sub(F.lit("2024-01-30").cast("date"), 31)))
              .groupBy("user_id").agg(F.count_distinct("event_date").alias("n")))
    assert flags == {r.user_id: r.n for r in days.collect()} | {u: 0 for u in flags if u not in
                                                                {r.user_id for r in days.collect()}}


def test_grouping_set_levels_sum_to_total(spark):
    rows = analytics.q_hits_grouping_sets(spark, SF_SMALL).collect()
    totals = {}
    for r in rows:
        totals[r.aggregation_level] = totals.get(r.aggregation_level, 0) + r.number_of_hits
    assert len(set(totals.values())) == 1 and len(totals) == 4


def test_sessions_cover_every_event(spark):
    n = sum(r.num_events for r in streams.q_sessionize(spark, SF_SMALL).collect())
    assert n == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_growth_daily_states_partition_users(spark):
    ga = analytics.q_growth_backfill(spark, SF_SMALL)
    per_day = {r.date: r.n for r in ga.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()}
    ev = roles.web_events(spark, SF_SMALL)
    firsts = [r.f for r in ev.groupBy("user_id").agg(F.min("event_date").alias("f")).collect()]
    for day, n in per_day.items():
        assert n == sum(1 for f in firsts if f <= day)


activity_sets = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(activity_sets)
def test_property_growth_and_arrays_fold_equals_backfill(spark, acts):
    start = dt.date(2024, 3, 1)
    ev = spark.createDataFrame([(u, start + dt.timedelta(days=k)) for u, k in acts], "user_id long, event_date date")
    days = [(start + dt.timedelta(days=k)).isoformat() for k in range(10)]
    ga = spark.createDataFrame([], "user_id long, first_active_date date, last_active_date date, "
                                   "daily_active_state string, weekly_active_state string, "
                                     "dates_active array<date>, date date")
    am = spark.createDataFrame([], "user_id long, month_start date, metric_name string, metric_array array<bigint>")
    ad = spark.createDataFrame([], "user_id long, dates_active array<date>, date date")
    folded = []
    for ds in days:
        ga = spark.createDataFrame(GR.growth_accounting_step(ga, ev, ds).collect(), ga.schema)
        am = spark.createDataFrame(A.array_metric_step(am, ev, ds).collect(), am.schema)
        ad = spark.createDataFrame(D.active_dates_step(ad, ev, ds).collect(), ad.schema)
        folded += [tuple(r) for r in ga.collect()]
    back = [tuple(r) for r in GR.growth_accounting_backfill(ev, days[-1]).collect()]
    assert sorted(folded, key=str) == sorted(back, key=str)
    bm = {r.user_id: list(r.metric_array) for r in A.array_metric_month(ev, days[-1]).collect()}
    assert {r.user_id: list(r.metric_array) for r in am.collect()} == bm
    bd = {r.user_id: list(r.dates_active) for r in D.active_dates_backfill(ev, days[-1]).collect()}
    assert {r.user_id: list(r.dates_active) for r in ad.collect()} == bd


attr_hist = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6), st.sampled_from(["a", "b", None])),
                     min_size=1, max_size=30)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(attr_hist)
def test_property_scd_incremental_fold_equals_backfill(spark, rows):
    from cumulus.operators import scd as S
    # one value per (key, period); keys may skip periods (absent entities)
    seen = {}
    for k, p, v in rows:
        seen[(k, p)] = v
    data = [(k, p, v) for (k, p), v in sorted(seen.items())]
    df = spark.createDataFrame(data, "k int, p int, c string")
    periods = sorted({p for _, p, _ in data})
    first = periods[0]
    scd = S.scd2_backfill(df.filter(F.col("p") == first), "k", ["c"], "p")
    prev = first
    for p in periods[1:]:
        cur = df.filter(F.col("p") == p).select("k", "c")
        scd = spark.createDataFrame(S.scd2_incremental(scd, cur, "k", ["c"], prev, p, current_col=None).collect(),
                                    scd.schema)
        prev = p
    # the backfill over the same snapshots, where a missing entity closes its interval
    # and a returning one opens a new interval: compare against streaks over
    # consecutive snapshot periods
    idx = {p: i for i, p in enumerate(periods)}
    exp = []
    for k in sorted({k for k, _, _ in data}):
        mine = [(idx[p], p, v) for kk, p, v in data if kk == k]
        run = None
        for i, p, v in mine:
            if run and run[3] == i - 1 and run[0] == v:
                run = (v, run[1], p, i)
            else:
                if run:
                    exp.append((k, run[0], run[1], run[2]))
                run = (v, p, p, i)
        exp.append((k, run[0], run[1], run[2]))
    got = [(r.k, r.c, r.start_date, r.end_date) for r in scd.collect()]
    assert sorted(map(str, got)) == sorted(map(str, exp))


event_times = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4 * 3600)), min_size=1, max_size=60)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(event_times, st.sampled_from([60, 600, 3600]))
def test_property_sliced_sessions_equal_session_window(spark, evs, slice_s):
    base = dt.datetime(2024, 1, 1, 22, 0, 0)
    df = spark.createDataFrame([(f"ip{k}", base + dt.timedelta(seconds=t)) for k, t in evs],
                               "ip string, event_time timestamp_ntz")
    a = streams.SS.sessionize(df, ["ip"], "event_time", "5 minutes").select(
        "ip", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz"), "num_events")
    b = streams.SS.sessionize_sliced(df, ["ip"], "event_time", 300, slice_s)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


dup_rows = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)),
                              st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(dup_rows, st.booleans())
def test_property_dedupe_matches_brute_force(spark, rows, desc):
    from cumulus.operators.dedupe import deduplicate
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = {r.k: (r.o, r.v) for r in deduplicate(df, ["k"], ["o"], descending=desc).collect()}

    # NULL sorts before any value (first ascending, last descending)
    exp = {}
    for k, o, v in rows:
        cand = (o, v)
        best = exp.get(k)
        key_c = ((o is not None, o or 0), (v is not None, v or ""))
        if best is None:
            exp[k] = cand
            continue
        key_b = ((best[0] is not None, best[0] or 0), (best[1] is not None, best[1] or ""))
        if (key_c > key_b) if desc else (key_c < key_b):
            exp[k] = cand
    assert got == exp
