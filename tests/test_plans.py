"""Physical-plan shape checks."""

import tempfile

from pyspark.sql import functions as F

from cumulus.operators import datelist as D
from cumulus.operators import warehouse as WH
from cumulus.operators.facts import lookup_dimension
from cumulus.plans import activity, analytics
from cumulus.sources import roles
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        loc = tempfile.mkdtemp(prefix="cumulus-bucket-")
        WH.bucketed_save(roles.match_details(spark, SF_SMALL), "t_md", "match_id", 16, path=f"{loc}/md")
        WH.bucketed_save(roles.matches(spark, SF_SMALL), "t_m", "match_id", 16, path=f"{loc}/m")
        j = spark.table("t_md").join(spark.table("t_m"), "match_id")
        assert "Exchange" not in plan(j)
        assert j.count() == roles.match_details(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS t_md")
        spark.sql("DROP TABLE IF EXISTS t_m")


def test_dimension_is_broadcast_by_its_bytes_only(spark):
    fact = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_partkey")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    small = plan(lookup_dimension(fact, part, "l_partkey", "p_partkey", ["p_type"]))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "BroadcastHashJoin" not in plan(lookup_dimension(fact, part, "l_partkey", "p_partkey", ["p_type"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_growth_counts_carry_no_date_list_beside_the_days(spark):
    text = plan(analytics.q_growth_state_counts(spark, SF_SMALL))
    carried = [line.rsplit("], false, [", 1)[0].rsplit("[", 1)[1] for line in text.splitlines() if "Generate explode(transform(" in line]
    assert carried and all("_days" not in c for c in carried)


def test_layout_sorts_order_their_rows(spark):
    from cumulus.plans import warehouse
    key = lambda r: (r.user_id, r.ts)
    rows = warehouse.q_layout_global_sort(spark, SF_SMALL).collect()
    assert [key(r) for r in rows] == sorted(map(key, rows))
    parts = {}
    placed = warehouse.q_layout_local_sort(spark, SF_SMALL).withColumn("part", F.spark_partition_id())
    for r in placed.collect():
        parts.setdefault(r.part, []).append(r)
    assert all([key(r) for r in p] == sorted(map(key, p)) for p in parts.values())
    homes = {}
    for n, p in parts.items():
        for r in p:
            homes.setdefault(r.user_id, set()).add(n)
    assert all(len(h) == 1 for h in homes.values())


def test_datelist_bits_need_no_shuffle(spark):
    cum = spark.createDataFrame([(1, [])], "user_id long, dates_active array<date>")
    p = plan(D.datelist_int(cum, "2024-01-30"))
    assert "Exchange" not in p and "NestedLoop" not in p and "Cartesian" not in p


def test_no_quadratic_joins(spark):
    for q in [analytics.q_funnel_event, analytics.q_funnel_user, activity.q_datelist_int,
              analytics.q_growth_backfill]:
        p = plan(q(spark, SF_SMALL))
        assert "NestedLoop" not in p and "Cartesian" not in p, q.__name__


def test_scan_prunes_columns_and_pushes_filters(spark):
    import re
    from cumulus.plans import warehouse
    p = plan(analytics.q_funnel_event(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("value:" not in s and "event_id:" not in s for s in schemas)
    p = plan(warehouse.q_pruned_join(spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*o_orderdate", p)


def test_layout_stats_sorted_vs_unsorted(spark):
    from cumulus.plans import warehouse
    base = tempfile.mkdtemp(prefix="cumulus-layout-")
    warehouse.q_layout_local_sort(spark, SF_SMALL).write.parquet(f"{base}/sorted")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(f"{base}/unsorted")
    stats = {r.layout: r for r in WH.layout_stats(spark, {"sorted": f"{base}/sorted",
                                                          "unsorted": f"{base}/unsorted"}).collect()}
    assert stats["unsorted"].num_files == 4 and stats["sorted"].num_files >= 1
    assert all(r.total_bytes > 0 for r in stats.values())
    p = plan(warehouse.q_layout_local_sort(spark, SF_SMALL))
    assert "Exchange hashpartitioning(user_id" in p and "rangepartitioning" not in p


def test_shared_aggregate_is_cached_and_reused(spark):
    agg = WH.shared_aggregate(roles.web_events(spark, SF_SMALL), "user_id", "device_id", "host", cache=True)
    try:
        users = agg.groupBy("user_id").count()
        devices = agg.groupBy("device_id").count()
        assert "InMemoryTableScan" in plan(users) and "InMemoryTableScan" in plan(devices)
        assert users.count() > 0 and devices.count() > 0
    finally:
        agg.unpersist()


def test_every_query_stays_jvm_side_without_quadratic_joins(spark):
    from cumulus.plans.registry import all_queries
    bad = []
    for name, q in all_queries().items():
        p = plan(q(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                       "NestedLoopJoin", "CartesianProduct"):
            if marker in p:
                bad.append((name, marker))
    assert bad == []
