"""Bucketed running totals equal the plain window, including ties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cumulus.operators.ordered import running_totals
from cumulus.operators.windows import best_stretch, longest_streak


def _data(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b"]), rnd.randrange(0, 300), rnd.randrange(0, 2)) for _ in range(n)]
    return spark.createDataFrame(rows, "g string, o long, v long")


def test_running_totals_range_matches_window(spark):
    df = _data(spark)
    got = running_totals(df, ["g"], ["o"], F.floor(F.col("o") / 7), F.col("v"), ties="range")
    w = Window.partitionBy("g").orderBy("o").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    exp = df.select("g", "o", "v", F.count(F.lit(1)).over(w).alias("_rn"), F.sum("v").over(w).alias("_cum"))
    assert sorted(map(tuple, got.select("g", "o", "v", "_rn", "_cum").collect())) == \
        sorted(map(tuple, exp.collect()))


def test_running_totals_rows_numbers_are_dense(spark):
    df = _data(spark).dropDuplicates(["g", "o"])
    got = running_totals(df, ["g"], ["o"], F.floor(F.col("o") / 5), F.col("v"))
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("g", "o", F.row_number().over(w).alias("_rn"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"))
    assert sorted(map(tuple, got.select("g", "o", "_rn", "_cum").collect())) == sorted(map(tuple, exp.collect()))


def test_best_stretch_and_streak_match_plain_windows(spark):
    df = _data(spark).dropDuplicates(["g", "o"])
    n = 9
    got = {r.g: r[1] for r in best_stretch(df, "g", "o", "v", n, bucket=F.floor(F.col("o") / 11)).collect()}
    w = Window.partitionBy("g").orderBy("o")
    exp = {r.g: r.m for r in df.select("g", F.sum("v").over(w.rowsBetween(-(n - 1), 0)).alias("s"))
                                 .groupBy("g").agg(F.max("s").alias("m")).collect()}
    assert got == exp
    streak = {r.g: r.longest_streak for r in
              longest_streak(df, "g", ["o"], F.col("v") == 1, bucket=F.floor(F.col("o") / 13)).collect()}
    pdf = sorted(map(tuple, df.collect()))
    best = {}
    cur = {}
    for g, o, v in pdf:
        cur[g] = cur.get(g, 0) + 1 if v == 1 else 0
        best[g] = max(best.get(g, 0), cur[g])
    assert streak == {g: b for g, b in best.items() if b > 0}


def test_null_group_keys_are_kept(spark):
    import datetime as dt
    from cumulus.streaming import sessions as SS
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 0), ("a", 1, 1)], "g string, o long, v long")
    got = sorted(map(tuple, running_totals(df, ["g"], ["o"], F.floor(F.col("o") / 10), F.col("v"))
                     .select("g", "o", "_rn", "_cum").collect()), key=str)
    assert got == sorted([(None, 1, 1, 1), (None, 2, 2, 1), ("a", 1, 1, 1)], key=str)
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    ev = spark.createDataFrame([(None, t0), (None, t0 + dt.timedelta(minutes=2)), ("x", t0)],
                               "ip string, event_time timestamp_ntz")
    s = sorted(map(str, SS.sessionize_sliced(ev, ["ip"], "event_time", 300, 3600).collect()))
    w = SS.sessionize(ev, ["ip"], "event_time").select(
        "ip", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz"), "num_events")
    assert s == sorted(map(str, w.collect()))


def test_best_stretch_null_group(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 1), (None, 3, 0), ("a", 1, 0)], "g string, o long, v long")
    got = sorted(map(tuple, best_stretch(df, "g", "o", "v", 2, bucket=F.floor(F.col("o") / 2)).collect()), key=str)
    assert got == sorted([(None, 2), ("a", 0)], key=str)
