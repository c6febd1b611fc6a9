"""As-of snapshots, replayed micro-batches, summed-up runs, arg-max plans."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from cumulus.operators import cumulative as C
from cumulus.operators import growth as GR
from cumulus.operators import windows as W
from cumulus.sources import roles, sinks
from cumulus.streaming import sessions as SS
from tests.conftest import SF_SMALL


def test_snapshot_equals_the_backfills_last_period(spark):
    args = (roles.seasons(spark, SF_SMALL), "player_name", ["country"], ["pts"], "season", 1995, 2001, "pts")
    whole = C.cumulate_backfill(*args).filter(F.col("current_season") >= 2000)
    assert sorted(map(str, C.cumulate_backfill(*args, since=2000).collect())) == sorted(map(str, whole.collect()))


def test_growth_snapshot_equals_the_backfills_last_days(spark):
    d0 = dt.date(2024, 3, 1)
    days = {1: [0, 1, 9], 2: [3], 3: [9], 4: [8, 9], 5: [2, 4]}
    ev = spark.createDataFrame([(u, d0 + dt.timedelta(days=n)) for u, ns in days.items() for n in ns],
                               "user_id long, event_date date")
    for since in ("2024-03-10", "2024-03-09", "2024-03-05"):
        whole = GR.growth_accounting_backfill(ev, "2024-03-10").filter(F.col("date") >= F.lit(since).cast("date"))
        part = GR.growth_accounting_backfill(ev, "2024-03-10", since=since)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


def test_a_replayed_batch_is_kept_once(spark):
    path = tempfile.mkdtemp(prefix="cumulus-epoch-") + "/sink"
    sink = sinks.epoch_sink(path)
    sink(spark.range(5), 0)
    sink(spark.range(10, 12), 1)
    sink(spark.range(10, 12), 1)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(i, 0) for i in range(5)] + [(10, 1), (11, 1)]


def test_runs_and_stretches_over_one_and_several_levels(spark):
    rnd = random.Random(8)
    rows = [(g, o, None if rnd.random() < 0.05 else int(rnd.random() < 0.8))
            for g in ("a", None, "none") for o in rnd.sample(range(400), 150)]
    rows = [(g, o, 0 if g == "none" else v) for g, o, v in rows] + [("all", o, 1) for o in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "g string, o long, v int")
    runs, flags = {}, {}
    for g, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        flags.setdefault(g, []).append(v or 0)
    for g, fs in flags.items():
        run = best = 0
        for f in fs:
            run = run + 1 if f else 0
            best = max(best, run)
        if best:
            runs[g] = best
    o = F.col("o")
    for bucket, coarser in ((None, ()), (F.floor(o / 7), ()), (F.floor(o / 4), (F.floor(o / 16), F.floor(o / 64)))):
        got = W.longest_streak(df, "g", ["o"], F.col("v") == 1, bucket, coarser)
        assert {r.g: r.longest_streak for r in got.collect()} == runs
    for n in (1, 2, 9, 1000):
        best = {g: max(sum(fs[max(0, i - n + 1):i + 1]) for i in range(len(fs))) for g, fs in flags.items()}
        for width in (3, 50, 1000):
            assert {r[0]: r[1] for r in W.best_stretch(df, "g", "o", "v", n, F.floor(o / width)).collect()} == best


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordered_operators_shuffle_rows_once(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "id as o", "cast(id % 2 as int) as v")
    for out in (W.best_stretch(df, "g", "o", "v", 5), W.longest_streak(df, "g", ["o"], F.col("v") == 1)):
        assert _plan(out).count("Exchange hashpartitioning") == 2
    ev = df.selectExpr("cast(g as string) as ip",
                       "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, o) as event_time")
    assert _plan(SS.sessionize_sliced(ev, ["ip"])).count("Exchange hashpartitioning") == 2


def test_argmax_cuts_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("b", 1, 2.0), (None, 1, 9.0),
                                ("c", 1, None)], "team string, k int, pts double")
    out = W.argmax_per_group(df, ["team"], "pts")
    assert sorted(map(tuple, out.collect())) == [("a", 1, 5.0), ("a", 2, 5.0), ("b", 1, 2.0)]
    assert "WindowGroupLimit" in _plan(out) and "Join" not in _plan(out)
