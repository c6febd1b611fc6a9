"""Folding the day-by-day operators equals their one-pass backfill."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cumulus.operators import arrays as A
from cumulus.operators import cumulative as C
from cumulus.operators import datelist as D
from cumulus.operators import growth as GR
from cumulus.sources import roles
from tests.conftest import SF_SMALL


def _random_activity(spark, users=12, days=14, seed=7):
    rnd = random.Random(seed)
    start = dt.date(2024, 1, 1)
    rows = [(u, start + dt.timedelta(days=k)) for u in range(users) for k in range(days) if rnd.random() < 0.35]
    rows += [(None, start)]
    return spark.createDataFrame(rows, "user_id long, event_date date"), start, days


def test_growth_step_fold_equals_backfill(spark):
    ev, start, days = _random_activity(spark)
    snap = spark.createDataFrame([], "user_id long, first_active_date date, last_active_date date, "
                                     "daily_active_state string, weekly_active_state string, "
                                     "dates_active array<date>, date date")
    folded = []
    for k in range(days):
        ds = (start + dt.timedelta(days=k)).isoformat()
        # materialise each day (tiny) so the fold's lineage stays short
        snap = spark.createDataFrame(GR.growth_accounting_step(snap, ev, ds).collect(), snap.schema)
        folded += snap.collect()
    back = GR.growth_accounting_backfill(ev, (start + dt.timedelta(days=days - 1)).isoformat()).collect()
    key = lambda r: (r.user_id, r.date)
    assert sorted(map(tuple, folded), key=str) == sorted(map(tuple, back), key=str)
    assert {key(r) for r in folded} == {key(r) for r in back}


def test_cumulate_step_equals_backfill(spark):
    seasons = roles.seasons(spark, SF_SMALL)
    args = ("player_name", ["country", "college"], ["gp", "pts", "ast", "reb"], "season")
    prev = C.cumulate_backfill(seasons, *args, 1995, 2000, "pts")
    step = C.cumulate_step(prev, seasons, *args, 2001, "pts")
    back = C.cumulate_backfill(seasons, *args, 1995, 2001, "pts").filter(F.col("current_season") == 2001)
    cols = ["player_name", "country", "college", "seasons", "scoring_class", "years_since_last_active",
            "is_active", "current_season"]
    assert sorted(map(str, step.select(cols).collect())) == sorted(map(str, back.select(cols).collect()))


def test_active_dates_fold(spark):
    ev, start, days = _random_activity(spark)
    snap = spark.createDataFrame([], "user_id long, dates_active array<date>, date date")
    for k in range(days):
        ds = (start + dt.timedelta(days=k)).isoformat()
        snap = spark.createDataFrame(D.active_dates_step(snap, ev, ds).collect(), snap.schema)
    back = D.active_dates_backfill(ev, (start + dt.timedelta(days=days - 1)).isoformat())
    assert sorted(map(str, snap.collect())) == sorted(map(str, back.select(snap.columns).collect()))


def test_array_metric_fold(spark):
    ev, start, days = _random_activity(spark)
    schema = "user_id long, month_start date, metric_name string, metric_array array<bigint>"
    snap = spark.createDataFrame([], schema)
    for k in range(days):
        ds = (start + dt.timedelta(days=k)).isoformat()
        snap = spark.createDataFrame(A.array_metric_step(snap, ev, ds).collect(), snap.schema)
    back = A.array_metric_month(ev, (start + dt.timedelta(days=days - 1)).isoformat())
    got = {r.user_id: list(r.metric_array) for r in snap.collect() if r.user_id is not None}
    exp = {r.user_id: list(r.metric_array) for r in back.collect()}
    # keys first seen today appear in the fold with padding, keys never seen do not
    assert {k: v for k, v in got.items() if any(v)} == exp


def test_fold_days_writes_and_matches_backfill(spark):
    from cumulus.operators.incremental import fold_days
    ev = roles.web_events(spark, SF_SMALL)
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=k)).isoformat() for k in range(10)]
    empty = spark.createDataFrame([], "user_id long, first_active_date date, last_active_date date, "
                                      "daily_active_state string, weekly_active_state string, "
                                     "dates_active array<date>, date date")
    name = f"test_growth_{random.randrange(10**9)}"
    last = fold_days(spark, lambda s, ds: GR.growth_accounting_step(s, ev, ds), empty, days, name)
    back = GR.growth_accounting_backfill(ev, days[-1]).filter(F.col("date") == days[-1])
    assert sorted(map(str, last.select(back.columns).collect())) == sorted(map(str, back.collect()))


def test_cumulative_fold_over_seasons(spark):
    from cumulus.operators.incremental import fold_days
    seasons = roles.seasons(spark, SF_SMALL)
    args = ("player_name", ["country", "college"], ["gp", "pts", "ast", "reb"], "season")
    first = C.cumulate_backfill(seasons, *args, 1995, 1995, "pts")
    name = f"test_cum_{random.randrange(10**9)}"
    last = fold_days(spark, lambda snap, p: C.cumulate_step(snap, seasons, *args, int(p), "pts"),
                     first, [str(p) for p in range(1996, 2002)], name)
    back = C.cumulate_backfill(seasons, *args, 1995, 2001, "pts").filter(F.col("current_season") == 2001)
    assert sorted(map(str, last.select(back.columns).collect())) == sorted(map(str, back.collect()))


def test_null_padded_monthly_hits_fold(spark):
    ev, start, days = _random_activity(spark, users=8, days=9, seed=11)
    schema = "user_id long, month_start date, metric_name string, metric_array array<bigint>"
    snap = spark.createDataFrame([], schema)
    for k in range(days):
        ds = (start + dt.timedelta(days=k)).isoformat()
        snap = spark.createDataFrame(A.array_metric_step(snap, ev, ds, null_pad=True).collect(), snap.schema)
    back = A.array_metric_month(ev, (start + dt.timedelta(days=days - 1)).isoformat(), null_pad=True)
    got = {r.user_id: list(r.metric_array) for r in snap.collect()}
    exp = {r.user_id: list(r.metric_array) for r in back.collect()}
    assert got == exp and any(None in v for v in got.values())
