"""Cases that earlier versions got wrong."""

import datetime as dt

from pyspark.sql import functions as F

from cumulus.operators import dedupe as DD
from cumulus.operators.arrays import array_metric_step
from cumulus.operators.bi import avg_over_top
from cumulus.operators.incremental import fold_days
from cumulus.operators.scd import scd2_expire_insert
from cumulus.plans import streams
from cumulus.plans.registry import all_queries
from cumulus.sources.roles import address
from cumulus.streaming.enrich import enrich, range_lookup
from tests.conftest import SF_SMALL


def test_every_user_id_has_an_address_and_a_range(spark):
    ids = spark.range(0, 20_000).select((F.col("id") * 1_000_003).alias("user_id"))
    ips = ids.select(address(F.col("user_id")).alias("ip"), F.lit("2024-01-01T00:00:00.000Z").alias("t"))
    assert ips.where(~F.col("ip").rlike(r"^(\d{1,3}\.){3}\d{1,3}$")).count() == 0
    assert ips.select("ip").distinct().count() == 20_000
    out = enrich(ips, streams.geo_ranges(spark, SF_SMALL), "ip", ["country", "region"], "t")
    assert out.count() == 20_000 and out.where("geodata = '{}'").count() == 0
    assert out.select("geodata").distinct().count() == 25


def test_ranges_tile_the_address_space(spark):
    r = sorted((x["ip_start"], x["ip_end"]) for x in streams.geo_ranges(spark, SF_SMALL).collect())
    assert r[0][0] == 0 and r[-1][1] == 2**32 - 1
    assert all(a[1] + 1 == b[0] for a, b in zip(r, r[1:]))


def test_overlapping_ranges_give_one_row_the_narrowest(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "wide"), (256, 511, "narrow"), (300, 555, "later")],
                                   "ip_start long, ip_end long, country string")
    ev = spark.createDataFrame([(1, "0.0.1.44"), (2, "0.0.2.3"), (3, "9.9.9.9"), (4, None)], "id int, ip string")
    for bound in (200_000, 0):  # broadcast or not
        got = range_lookup(ev, ranges, "ip", max_blocks=bound).collect()
        assert sorted((r["id"], r["country"]) for r in got if r["country"]) == [(1, "narrow"), (2, "later"), (3, "wide")]
        assert len(got) == 4


def test_win_rate_ranks_by_wins(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 1), ("c", 0)], "p string, did_win int")
    got = avg_over_top(df, "p", "did_win", "did_win", 2).collect()
    assert [(r["p"], r["total_did_win"]) for r in got] == [("b", 1), ("a", 2)]


def test_a_second_run_of_a_fold_has_its_own_days(spark):
    step = lambda snap, ds: snap.withColumn("day", F.lit(ds))
    one = spark.createDataFrame([(1,)], "x int")
    fold_days(spark, step, one, ["2024-01-01", "2024-01-02"], "refold", keep_all=True)
    again = fold_days(spark, step, one, ["2024-01-05"], "refold", keep_all=True)
    assert [r["day"] for r in again.collect()] == ["2024-01-05"]


def test_second_change_on_one_day_replaces_the_row(spark):
    day = dt.date(2024, 2, 1)
    scd = spark.createDataFrame([("k", "old", dt.date(2024, 1, 1), day - dt.timedelta(1)), ("k", "new", day, None)],
                                "k string, v string, start_date date, end_date date")
    latest = spark.createDataFrame([("k", "newer")], "k string, v string")
    got = scd2_expire_insert(scd, latest, "k", ["v"], "2024-02-01").collect()
    assert sorted((r["v"], r["start_date"], r["end_date"]) for r in got) == [
        ("newer", day, None), ("old", dt.date(2024, 1, 1), day - dt.timedelta(1))]


def test_missed_days_of_a_known_key_are_zero(spark):
    ev = lambda *days: spark.createDataFrame([(7, dt.date(2024, 1, d)) for d in days], "user_id long, event_date date")
    none = spark.createDataFrame([], "user_id long, month_start date, metric_name string, metric_array array<bigint>")
    first = array_metric_step(none, ev(2), "2024-01-02", null_pad=True)
    fourth = array_metric_step(first, ev(5), "2024-01-05", null_pad=True)
    assert fourth.first()["metric_array"] == [None, 1, 0, 0, 1]


def test_dedupe_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (2, 5, "x"), (2, None, "y")], "k int, o int, v string")
    up, down = DD.deduplicate(df, ["k"], ["o"]), DD.deduplicate(df, ["k"], ["o"], descending=True)
    assert sorted(map(tuple, up.collect())) == [(1, None, "a"), (2, None, "y")]
    assert sorted(map(tuple, down.collect())) == [(1, None, "b"), (2, 5, "x")]
    for name in ("dedupe_rows", "graph_edges_direct", "fact_build"):
        plan = all_queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan and "SortAggregate" not in plan, name


def test_dedupe_sorts_no_scan_partition(spark):
    """A task sorts a shuffle partition, whatever it reads of a file; a key with most of the rows is dealt out."""
    for name in ("dedupe_rows", "longest_streak"):
        df = all_queries()[name](spark, SF_SMALL)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
        below = "\n".join(lines[partial:])
        assert "Exchange" in below[:below.index("Scan parquet")] and "SPARK_PARTITION_ID" in below, name
    rows = [(1, i % 3, i) for i in range(900)] + [(None, 5, 7), (None, 5, 6), (2, 1, 1)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(9)
    assert sorted(map(tuple, DD.deduplicate(df, ["k"], ["o"]).collect()), key=str) == [(1, 0, 0), (2, 1, 1), (None, 5, 6)]
