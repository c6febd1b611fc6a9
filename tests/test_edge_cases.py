"""Edge cases: NULL dimension next to '(overall)', zero denominators, ties."""

from pyspark.sql import functions as F

from cumulus.operators import bi as BI
from cumulus.operators import cubes as CB
from cumulus.operators import cumulative as C
from cumulus.operators import windows as W
from cumulus.operators.experiments import assign_variant, hash_bucket


def test_null_dimension_is_unknown_not_overall(spark):
    df = spark.createDataFrame([("mac", None), ("mac", "chrome"), (None, "chrome")], "os string, browser string")
    df = CB.fill_unknown(df, ["os", "browser"])
    out = CB.grouping_sets(df, [("os", "browser"), ("os",)], [F.count(F.lit(1)).alias("n")])
    rows = {(r.aggregation_level, r.os, r.browser): r.n for r in out.collect()}
    assert rows[("os__browser", "mac", "unknown")] == 1
    assert rows[("os__browser", "unknown", "chrome")] == 1
    assert rows[("os", "unknown", "(overall)")] == 1
    assert sum(n for (lvl, _, _), n in rows.items() if lvl == "os") == 3


def test_career_ratio_zero_first_value(spark):
    df = spark.createDataFrame([("a", [(1, 0.0), (2, 5.0)]), ("b", [(1, 2.0), (2, 3.0)])],
                               "k string, h array<struct<season:int,pts:double>>")
    got = {r.k: r.career_ratio for r in C.career_ratio(df, "k", "pts", "h").collect()}
    assert got == {"a": 5.0, "b": 1.5}


def test_argmax_keeps_ties_and_top_by_breaks_them(spark):
    df = spark.createDataFrame([("t1", "x", 5), ("t1", "y", 5), ("t1", "z", 1), ("t2", "w", 0)],
                               "team string, player string, pts int")
    got = sorted((r.team, r.player) for r in W.argmax_per_group(df, ["team"], "pts").collect())
    assert got == [("t1", "x"), ("t1", "y"), ("t2", "w")]
    top = [r.player for r in BI.top_by(df, ["player"], F.sum("pts"), "total", 2).collect()]
    assert top == ["x", "y"]


def test_variant_assignment_is_stable_and_balanced(spark):
    ids = spark.range(20000).withColumnRenamed("id", "user_id")
    a = {r.user_id: r.variant for r in assign_variant(ids, "user_id", "s1").collect()}
    b = {r.user_id: r.variant for r in assign_variant(ids.repartition(7), "user_id", "s1").collect()}
    assert a == b
    share = sum(v == "control" for v in a.values()) / len(a)
    assert 0.47 < share < 0.53
    r = spark.createDataFrame([(42,)], "user_id long").select(hash_bucket("user_id", "exp1").alias("b")).first().b
    assert 0 <= r < 100


def test_normal_cdf_known_values(spark):
    from cumulus.functions.columns import normal_cdf, two_sided_p
    r = spark.createDataFrame([(0.0,), (1.0,), (1.96,), (-2.5758,)], "z double").select(
        "z", normal_cdf("z").alias("c"), two_sided_p("z").alias("p")).collect()
    got = {row.z: (row.c, row.p) for row in r}
    assert abs(got[0.0][0] - 0.5) < 1e-7 and abs(got[0.0][1] - 1.0) < 1e-7
    assert abs(got[1.0][0] - 0.8413447) < 1e-6
    assert abs(got[1.96][1] - 0.0499958) < 1e-6
    assert abs(got[-2.5758][0] - 0.005) < 1e-5


def test_classify_null_and_prefer_today(spark):
    from cumulus.functions.columns import classify
    r = spark.createDataFrame([(None,), (25.0,), (15.0,), (10.5,)], "v double").select(
        classify("v").alias("c")).collect()
    assert [x.c for x in r] == ["bad", "star", "average", "average"]
    prev = spark.createDataFrame([("p", "old", [], "bad", 0, 2000)],
                                 "player_name string, country string, seasons array<struct<season:int,pts:double>>, "
                                 "scoring_class string, years_since_last_active int, current_season int")
    today = spark.createDataFrame([("p", "new", 2001, 21.0)], "player_name string, country string, season int, pts double")
    keep = C.cumulate_step(prev, today, "player_name", ["country"], ["pts"], "season", 2001, "pts").first()
    flip = C.cumulate_step(prev, today, "player_name", ["country"], ["pts"], "season", 2001, "pts",
                           prefer="today").first()
    assert keep.country == "old" and flip.country == "new"
    assert keep.scoring_class == "star" and keep.is_active and keep.years_since_last_active == 0


def test_ipv4_parsing_and_unmatched_ranges(spark):
    from cumulus.functions.columns import ipv4_to_long
    from cumulus.streaming.enrich import enrich
    ips = spark.createDataFrame([("10.0.1.2",), ("300.1.1.1",), ("abc",), (None,), ("1.2.3",)], "ip string")
    got = [r.v for r in ips.select(ipv4_to_long("ip").alias("v")).collect()]
    assert got == [167772418, None, None, None, None]
    ranges = spark.createDataFrame([(167772160, 167772415, "N0", "R0")], "ip_start long, ip_end long, country string, region string")
    ev = spark.createDataFrame([(1, "10.0.0.7", "2024-01-01T00:00:00.123Z"), (2, "10.0.1.2", "2024-01-01T00:00:01.000Z")],
                               "event_id int, ip string, t string")
    out = {r.event_id: (r.geodata, r.event_timestamp.isoformat()) for r in
           enrich(ev, ranges, "ip", ["country", "region"], "t").collect()}
    assert out[1] == ('{"country":"N0","region":"R0"}', "2024-01-01T00:00:00.123000")
    assert out[2][0] == "{}"
