"""Golden cases (small literal inputs) for the core operators."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulus.operators import arrays as A
from cumulus.operators import datelist as D
from cumulus.operators import dedupe as DD
from cumulus.operators import graph as G
from cumulus.operators import scd as S


def d(s):
    return dt.date.fromisoformat(s)


def test_scd2_backfill_single_attr(spark):
    rated = [("amber", p, "high" if p in (10, 11, 14) else "low") for p in range(10, 15)] + [("birch", 12, "low")]
    df = spark.createDataFrame(rated, "tree string, visit int, grade string")
    spans = S.scd2_backfill(df, "tree", ["grade"], "visit").select("tree", "grade", "start_date", "end_date")
    assert sorted(map(tuple, spans.collect())) == [
        ("amber", "high", 10, 11), ("amber", "high", 14, 14), ("amber", "low", 12, 13), ("birch", "low", 12, 12)]


def test_scd2_null_attribute_is_a_value(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "x")],
                               "k string, p int, c string")
    out = S.scd2_backfill(df, "k", ["c"], "p").orderBy("start_date").collect()
    assert [(r.c, r.start_date, r.end_date) for r in out] == [(None, 1, 2), ("x", 3, 3)]


def test_vertices_keep_the_last_of_repeated_rows(spark):
    shops = [(40, "alder lane", 3), (41, "quay", None), (40, "zinc yard", 8), (40, "mill", 5)]
    df = spark.createDataFrame(shops, "shop_id long, street string, floors long")
    v = G.vertices_deduped(df, "shop_id", "shop", [("street", "street"), ("n_floors", "floors")],
                           order=["street"], descending=True)
    assert {r.identifier: (r.type, r.properties) for r in v.collect()} == {
        "40": ("shop", {"street": "zinc yard", "n_floors": "8"}), "41": ("shop", {"street": "quay", "n_floors": None})}


def test_dedupe_keeps_first_by_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (2, None, "q"), (2, 1, "a")], "k int, o int, v string")
    out = {r.k: (r.o, r.v) for r in DD.deduplicate(df, ["k"], ["o"]).collect()}
    assert out == {1: (3, "z"), 2: (None, "q")}


def test_first_days_sums(spark):
    may, june = d("2022-05-01"), d("2022-06-01")
    df = spark.createDataFrame([(may, [7]), (may, [2, None, 9]), (may, [0, 5, 1, 90]), (june, []), (june, [4, 4])],
                               "month_start date, metric_array array<long>")
    sums = A.array_first_days(df, 2, names=["day_1", "day_2"])
    assert {r.month_start: (r.day_1, r.day_2) for r in sums.collect()} == {may: (9, 5), june: (4, 4)}


STATE = "user_id long, month_start date, metric_name string, metric_array array<long>"
EVENTS = "user_id long, event_date date"


def _step(spark, state_rows, event_rows, ds):
    prev = spark.createDataFrame(state_rows, STATE)
    ev = spark.createDataFrame(event_rows, EVENTS)
    return {r.user_id: list(r.metric_array) for r in A.array_metric_step(prev, ev, ds).collect()}


def test_array_metric_step_cases(spark):
    may, before = d("2022-05-01"), [(5, d("2022-05-01"), "site_hits", [6, 0, 1])]
    fourth = d("2022-05-04")
    # known and active twice; known and absent; new in mid-month; first day of a month
    assert _step(spark, before, [(5, fourth), (5, fourth)], "2022-05-04") == {5: [6, 0, 1, 2]}
    assert _step(spark, before, [(8, d("2022-05-03"))], "2022-05-04") == {5: [6, 0, 1, 0]}
    assert _step(spark, before, [(8, fourth)], "2022-05-04") == {5: [6, 0, 1, 0], 8: [0, 0, 0, 1]}
    assert _step(spark, [], [(8, may), (8, may), (9, may)], "2022-05-01") == {8: [2], 9: [1]}


def test_array_metric_step_is_idempotent(spark):
    before, today = [(5, d("2022-05-01"), "site_hits", [6])], [(5, d("2022-05-02"))]
    first = _step(spark, before, today, "2022-05-02")
    again = _step(spark, [(5, d("2022-05-01"), "site_hits", first[5])], today, "2022-05-02")
    assert again == first == {5: [6, 1]}


def _bit(days_ago: int) -> int:
    return 1 << (31 - days_ago)


def test_datelist_bits_and_flags(spark):
    today = d("2022-08-20")
    ago = {11: [0, 6], 12: [7, 13, 31], 13: [14], 14: [32]}
    df = spark.createDataFrame([(u, sorted(today - dt.timedelta(days=n) for n in days)) for u, days in ago.items()],
                               "user_id long, dates_active array<date>")
    out = {r.user_id: r for r in D.activity_flags(D.datelist_int(df, "2022-08-20")).collect()}
    seen = {u: [n for n in days if n < 32] for u, days in ago.items()}
    assert {u: r.datelist_int for u, r in out.items()} == {u: sum(map(_bit, days)) for u, days in seen.items()}
    assert {u: r.l32 for u, r in out.items()} == {11: 2, 12: 3, 13: 1, 14: 0}
    assert {u: r.l7 for u, r in out.items()} == {11: 2, 12: 0, 13: 0, 14: 0}
    assert [u for u in ago if out[u].weekly_active] == [11]
    assert [u for u in ago if out[u].weekly_active_previous_week] == [12]
    assert [u for u in ago if out[u].monthly_active] == [11, 12, 13]


def test_datelist_bits_and_flags(spark):
    df = spark.createDataFrame(
        [(1, [d("2023-03-01"), d("2023-03-15")]), (2, [d("2023-03-10"), d("2023-03-20")])],
        "user_id long, dates_active array<date>")
    out = {r.user_id: r for r in D.activity_flags(D.datelist_int(df, "2023-03-31")).collect()}
    assert out[1].datelist_int == 32770 and out[2].datelist_int == 1049600
    assert out[1].l32 == 2 and out[2].l32 == 2
    assert out[1].l7 == 0 and out[2].l7 == 0
    assert not out[1].weekly_active and not out[2].weekly_active
    assert not out[1].weekly_active_previous_week and out[2].weekly_active_previous_week
    assert out[1].monthly_active and out[2].monthly_active


def test_datelist_today_is_msb(spark):
    df = spark.createDataFrame([(1, [d("2022-08-20")]), (2, [])], "user_id long, dates_active array<date>")
    out = {r.user_id: r for r in D.activity_flags(D.datelist_int(df, "2022-08-20")).collect()}
    assert out[1].datelist_int == _bit(0) and out[1].daily_active
    assert out[2].datelist_int == 0 and not out[2].monthly_active


def test_active_dates_step_idempotent_and_null_users(spark):
    prev = spark.createDataFrame([(1, [d("2023-01-01")])], "user_id long, dates_active array<date>")
    ev = spark.createDataFrame([(1, d("2023-01-02")), (None, d("2023-01-02")), (3, d("2023-01-02"))], EVENTS)
    s1 = D.active_dates_step(prev, ev, "2023-01-02")
    s2 = D.active_dates_step(s1, ev, "2023-01-02")
    got = {r.user_id: list(r.dates_active) for r in s2.collect()}
    assert got == {1: [d("2023-01-01"), d("2023-01-02")], 3: [d("2023-01-02")]}


def test_scd2_incremental_cases(spark):
    scd = spark.createDataFrame([("a", "x", 1, 2), ("b", "y", 1, 2), ("c", "z", 1, 1), ("d", "w", 2, 2)],
                                "k string, c string, start_date int, end_date int")
    cur = spark.createDataFrame([("a", "x"), ("b", "q"), ("e", "n")], "k string, c string")
    out = S.scd2_incremental(scd, cur, "k", ["c"], 2, 3, current_col=None)
    got = sorted((r.k, r.c, r.start_date, r.end_date) for r in out.collect())
    assert got == [("a", "x", 1, 3), ("b", "q", 3, 3), ("b", "y", 1, 2), ("c", "z", 1, 1),
                   ("d", "w", 2, 2), ("e", "n", 3, 3)]


def test_keyed_date_map_and_merge(spark):
    ev = spark.createDataFrame([(1, "Chrome", d("2024-01-01")), (1, "Safari", d("2024-01-02")),
                                (1, "Chrome", d("2024-01-02")), (2, None, d("2024-01-02"))],
                               "user_id long, browser_type string, event_date date")
    m = {r.user_id: r.dates_by_type for r in D.keyed_date_map(ev, "user_id", "browser_type", "2024-01-02").collect()}
    assert m == {1: {"Chrome": [d("2024-01-01"), d("2024-01-02")], "Safari": [d("2024-01-02")]}}
    merged = spark.createDataFrame([(1,)], "user_id long").select(
        D.merge_date_maps(F.create_map(F.lit("Chrome"), F.array(F.lit(d("2024-01-01")))),
                          F.create_map(F.lit("Chrome"), F.array(F.lit(d("2024-01-02"))),
                                       F.lit("Edge"), F.array(F.lit(d("2024-01-02"))))).alias("m")).first().m
    assert merged == {"Chrome": [d("2024-01-01"), d("2024-01-02")], "Edge": [d("2024-01-02")]}


def test_growth_states_rules(spark):
    from cumulus.operators import growth as GR
    ev = spark.createDataFrame([(1, d("2024-01-01")), (1, d("2024-01-02")), (1, d("2024-01-12")),
                                (2, d("2024-01-01"))], "user_id long, event_date date")
    ga = {(r.user_id, r.date.isoformat()): (r.daily_active_state, r.weekly_active_state)
          for r in GR.growth_accounting_backfill(ev, "2024-01-12").collect()}
    assert ga[(1, "2024-01-01")] == ("New", "New")
    assert ga[(1, "2024-01-02")] == ("Retained", "Retained")
    assert ga[(1, "2024-01-03")] == ("Churned", "Retained")
    assert ga[(1, "2024-01-04")] == ("Stale", "Retained")
    assert ga[(1, "2024-01-10")] == ("Stale", "Churned")
    assert ga[(1, "2024-01-12")] == ("Resurrected", "Resurrected")
    assert ga[(2, "2024-01-02")] == ("Churned", "Retained")


def test_scd2_incremental_is_idempotent(spark):
    scd = spark.createDataFrame([("a", "x", 1, 2), ("b", "y", 1, 2), ("c", "z", 1, 1)],
                                "k string, c string, start_date int, end_date int")
    cur = spark.createDataFrame([("a", "x"), ("b", "q"), ("e", "n")], "k string, c string")
    once = S.scd2_incremental(scd, cur, "k", ["c"], 2, 3, current_col=None)
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = S.scd2_incremental(once, cur, "k", ["c"], 2, 3, current_col=None)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_window_dedupe_agrees_with_aggregate_dedupe(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "q"), (2, 1, "a")],
                               "k int, o int, v string")
    agg = DD.deduplicate(df, ["k"], ["o"])
    win = DD.deduplicate_window(df, ["k"], [F.col("o").asc_nulls_first(), F.col("v").asc_nulls_first()])
    assert sorted(map(tuple, agg.collect())) == sorted(map(tuple, win.collect()))
