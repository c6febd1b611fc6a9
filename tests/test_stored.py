"""Stored tables: changes touch only their partitions and give the rows of the plain operators."""

import datetime as dt
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulus.operators import dedupe, distinct_counts, layout, ordered, quality, scd, stored
from cumulus.plans import common, warehouse
from cumulus.sources import roles
from tests.conftest import SF_SMALL


@pytest.fixture
def name(spark):
    n = f"t_{uuid.uuid4().hex}"
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def files(spark, table, part):
    """File names of each partition."""
    out = {}
    for r in spark.table(table).select(part, F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r[part], set()).add(r["f"])
    return out


def rows(df):
    return Counter(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


T = "k long, v string, p string"
TARGET = [(i, f"old{i}", f"p{i % 5}") for i in range(40)] + [(None, "null key", "p0"), (100, "no part", None)]


@pytest.mark.parametrize("updates,touched", [
    ([(0, "new0", "p0"), (5, "new5", "p0"), (200, "added", "p0")], {("p0",)}),
    ([(1, "moves", "p2")], {("p1",), ("p2",)}),
    ([(3, "new", "p9")], {("p3",), ("p9",)}),
    ([(None, "another", "p4")], {("p4",)}),
    ([(100, "moves", "p1"), (101, "added", None)], {(None,), ("p1",)}),
    ([(i, "all gone", "p0") for i in range(1, 40, 5)], {("p0",), ("p1",)}),  # p1 is left without a row
    ([(2, "quote", "it's")], {("p2",), ("it's",)}),
    ([], set()),
])
def test_upsert_touches_only_its_partitions(spark, name, updates, touched):
    target, new = spark.createDataFrame(TARGET, T), spark.createDataFrame(updates, T)
    want = rows(dedupe.upsert(target, new, ["k"]))
    target.write.partitionBy("p").saveAsTable(name)
    before = files(spark, name, "p")
    for again in range(2):  # the same change again changes nothing; a NULL key is added each time
        named = set(stored.upsert_partitions(name, new, ["k"]))
        assert named <= touched if again else named == touched
        assert rows(spark.table(name).select("k", "v", "p")) == want
        if any(k is None for k, _, _ in updates):
            break
    after = files(spark, name, "p")
    kept = {p for p in before if (p,) not in touched}
    assert {p: after[p] for p in kept} == {p: before[p] for p in kept}
    assert all(not before.get(p, set()) & after.get(p, set()) for (p,) in touched)
    listed = {tuple(r) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert len(listed) == len(after)


def test_upsert_by_key_buckets_reads_no_other_partition(spark, name):
    bucket = stored.key_bucket(["k"], 8).alias("b")
    target = spark.createDataFrame(TARGET, T).select("*", bucket)
    target.write.partitionBy("b").saveAsTable(name)
    new = spark.createDataFrame([(7, "new", "x"), (8, "new", "x"), (500, "added", "x")], T).select("*", bucket)
    hit = {(r["b"],) for r in new.collect()}
    before = files(spark, name, "b")
    assert set(stored.upsert_partitions(name, new, ["k"], keys_move=False)) == hit
    assert rows(spark.table(name).select("k", "v", "p")) == rows(
        dedupe.upsert(spark.createDataFrame(TARGET, T), new.drop("b"), ["k"]))
    after = files(spark, name, "b")
    assert {p for p in before if before[p] != after[p]} <= {b for b, in hit}
    scan = spark.table(name).where(stored.in_partitions(["b"], list(hit)))
    assert "PartitionFilters: [" in scan._jdf.queryExecution().toString() and len(scan.select(
        "_metadata.file_path").distinct().collect()) <= sum(len(after[b]) for b, in hit)


def test_two_partition_columns(spark, name):
    df = spark.createDataFrame([(i, i % 3, f"x{i % 2}") for i in range(24)], "k int, a int, b string")
    df.write.partitionBy("a", "b").saveAsTable(name)
    new = spark.createDataFrame([(0, 0, "x1"), (99, None, None)], "k int, a int, b string")
    assert set(stored.upsert_partitions(name, new, ["k"])) == {(0, "x0"), (0, "x1"), (None, None)}
    assert rows(spark.table(name).select("k", "a", "b")) == rows(dedupe.upsert(df, new, ["k"]))


H = "key string, cls string, active boolean, period int"
SNAPSHOTS = {  # key g appears late, d goes and comes back, e goes for good, n is NULL in one period
    1: [("a", "x", True), ("b", "x", True), ("d", "y", True), ("e", "x", False), ("n", None, True)],
    2: [("a", "x", True), ("b", "y", True), ("d", "y", True), ("e", "x", False), ("n", "x", True)],
    3: [("a", "x", True), ("b", "y", False), ("n", None, True), ("g", "x", True)],
    4: [("a", "x", True), ("b", "y", False), ("d", "y", True), ("n", None, True), ("g", "z", True)],
    5: [("a", "x", True), ("b", "x", True), ("d", "y", True), ("n", None, True), ("g", "z", True)],
}
ATTRS = ["cls", "active"]


def snapshot(spark, p, rows_=None):
    return spark.createDataFrame([(*r, p) for r in (SNAPSHOTS[p] if rows_ is None else rows_)], H)


def folded(spark, upto):
    """The same periods through the plain operator, which rewrites everything."""
    out = scd.scd2_backfill(snapshot(spark, 1), "key", ATTRS, "period").withColumn("end_date", F.lit(1))
    for p in range(2, upto + 1):
        out = scd.scd2_incremental(out, snapshot(spark, p), "key", ATTRS, p - 1, p, current_col=None)
    return rows(out.select("key", *ATTRS, "start_date", "end_date"))


def test_history_merges_equal_the_plain_fold_and_leave_closed_files(spark, name):
    stored.create_history(spark, name, snapshot(spark, 1), "key", ATTRS, 1)
    view = lambda p: rows(stored.history_rows(spark, name, p, "key", ATTRS))
    closed = {}
    for p in range(2, 6):
        stored.merge_history(name, snapshot(spark, p), "key", ATTRS, p - 1, p)
        assert view(p) == folded(spark, p)
        now = files(spark, name, "closed_in")
        assert all(now[c] == f for c, f in closed.items())  # never rewritten
        closed = {c: f for c, f in now.items() if c is not None}
    # a period again, with the same and with other rows: as if it had been merged so at first
    stored.merge_history(name, snapshot(spark, 5), "key", ATTRS, 4, 5)
    assert view(5) == folded(spark, 5)
    stored.merge_history(name, snapshot(spark, 5, SNAPSHOTS[4]), "key", ATTRS, 4, 5)
    assert 5 not in files(spark, name, "closed_in")  # nothing closes in it any more
    assert view(5) == Counter({(k, c, a, s, 5 if e == 4 else e): n for (k, c, a, s, e), n in folded(spark, 4).items()})
    stored.merge_history(name, snapshot(spark, 5), "key", ATTRS, 4, 5)
    assert view(5) == folded(spark, 5)
    with pytest.raises(ValueError, match="later period"):
        stored.merge_history(name, snapshot(spark, 4), "key", ATTRS, 3, 4)


def test_history_merge_scans_the_open_partition_only(spark, name):
    stored.create_history(spark, name, snapshot(spark, 1), "key", ATTRS, 1)
    for p in (2, 3):
        stored.merge_history(name, snapshot(spark, p), "key", ATTRS, p - 1, p)
    t = spark.table(name).where(F.col("closed_in").isNull() | (F.col("closed_in") == F.lit(4)))
    text = plan(t)
    assert "PartitionFilters: [(isnull(closed_in" in text
    assert {r["closed_in"] for r in t.collect()} == {None}


def test_history_of_changes_alone_by_date(spark, name):
    """Dates, and snapshots that hold changed keys only: missing keys stay open (expire and insert)."""
    day = dt.date
    first = spark.createDataFrame([("a", "x", True), ("b", "x", True)], "key string, cls string, active boolean")
    stored.create_history(spark, name, first, "key", ATTRS, day(2024, 1, 1))
    change = spark.createDataFrame([("b", "y", True), ("c", "x", True)], first.schema)
    for _ in range(2):
        stored.merge_history(name, change, "key", ATTRS, day(2024, 1, 9), day(2024, 1, 10), missing_closes=False)
        got = rows(spark.table(name).select("key", *ATTRS, "start_date", "end_date"))
        plain = scd.scd2_expire_insert(
            first.select("*", F.lit(day(2024, 1, 1)).alias("start_date"), F.lit(None).cast("date").alias("end_date")),
            change.unionByName(first.where("key = 'a'")), "key", ATTRS, "2024-01-10")
        assert got == rows(plain.select("key", *ATTRS, "start_date", "end_date"))


def test_history_without_open_rows(spark, name):
    stored.create_history(spark, name, snapshot(spark, 1, []), "key", ATTRS, 1)
    stored.merge_history(name, snapshot(spark, 2), "key", ATTRS, 1, 2)
    stored.merge_history(name, snapshot(spark, 3, []), "key", ATTRS, 2, 3)
    assert {r["closed_in"] for r in spark.table(name).collect()} == {3}
    assert spark.table(name).count() == len(SNAPSHOTS[2])


def test_months_are_pruned_by_range_and_by_the_header(spark, tmp_path):
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.enabled", "true")
    j = warehouse.month_pruned_join(spark, SF_SMALL, str(tmp_path / "lines"))
    text = plan(j)
    assert "dynamicpruning" in text and "PartitionFilters" in text
    months = {r["order_month"] for r in j.select("order_month").distinct().collect()}
    assert months and all(m.year == 1998 for m in months)
    whole = spark.read.parquet(str(tmp_path / "lines"))
    assert whole.where(stored.between_days("o_orderdate", "order_month", "1998-03-05", "1998-05-20")).count() == \
        whole.where("o_orderdate BETWEEN timestamp_ntz'1998-03-05' AND timestamp_ntz'1998-05-20'").count()


def test_star_join_on_buckets_has_no_exchange(spark):
    """Only the dimensions (parts, maps) are below the broadcast threshold."""
    names = [f"t_{uuid.uuid4().hex}" for _ in range(3)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with stored.setting(spark, *warehouse.SUBSET_OF_KEYS):
            text = plan(warehouse.bucketed_star(spark, SF_SMALL, names))
        assert text.count("SortMergeJoin") + text.count("ShuffledHashJoin") == 2
        assert "Exchange hashpartitioning" not in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_star_buckets_grow_with_the_rows(spark, monkeypatch):
    names = [f"t_{uuid.uuid4().hex}" for _ in range(3)]
    monkeypatch.setattr(common, "ROWS_A_TASK", 200)
    rows = roles.match_details(spark, SF_SMALL).count()
    try:
        with stored.setting(spark, *warehouse.SUBSET_OF_KEYS):
            got = warehouse.bucketed_star(spark, SF_SMALL, names)
            for n in names:
                told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {n}").collect()}
                assert int(told["Num Buckets"]) == -(-rows // 200) > warehouse.STAR_BUCKETS
            want = warehouse.q_star_join(spark, SF_SMALL)
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_distinct_counts_merge(spark):
    ids = [0, 1, -1, 32768, 32769, -32768, 2**31, 2**40 + 5, -(2**45), 7, 7, None]
    data = [(f"h{(i or 0) % 3}", d, i) for d in range(6) for i in ids if i is None or (i + d) % 2 == 0]
    data += [("only null", 1, None), (None, 1, 5), (None, 2, 5)]
    df = spark.createDataFrame(data, "host string, day int, user long")
    state = distinct_counts.distinct_state(df, ["host", "day"], "user")
    for keys in (["host", "day"], ["host"], ["day"], []):
        want = Counter()
        for h, d, u in {(h, d, u) for h, d, u in data if u is not None}:
            want[tuple({"host": h, "day": d}[k] for k in keys)] = 0
        for key in want:
            want[key] = len({u for h, d, u in data if u is not None and tuple({"host": h, "day": d}[k] for k in keys) == key})
        got = distinct_counts.count_distinct(state, keys).collect()
        assert {tuple(r[k] for k in keys): r["n_distinct"] for r in got} == dict(want)
    # yesterday's merged state and today's
    merged = distinct_counts.merge_states(state.where("day < 3"), ["host"])
    again = merged.unionByName(distinct_counts.merge_states(state.where("day >= 3"), ["host"]))
    assert rows(distinct_counts.count_distinct(again, ["host"])) == rows(distinct_counts.count_distinct(state, ["host"]))


def test_zone_maps_skip_files_that_cannot_match(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts").withColumn(
        "user_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")))
    ev.repartitionByRange(12, "user_id").write.parquet(str(tmp_path / "e"))
    path = str(tmp_path / "e")
    zones = layout.zone_map(spark, path, ["user_id", "ts"]).cache()
    assert sum(r["n_rows"] for r in zones.collect()) == ev.count()
    assert sum(r["nulls_user_id"] for r in zones.collect()) == ev.where("user_id IS NULL").count()
    n_files = zones.count()
    for ranges in ({"user_id": (3, 4)}, {"user_id": (None, 2)}, {"user_id": (10, None), "ts": (dt.datetime(2024, 1, 20), None)},
                   {"user_id": (10**9, None)}, {}):
        want = ev
        for c, (low, high) in ranges.items():
            want = want.where(F.lit(True) if low is None else F.col(c) >= F.lit(low)).where(
                F.lit(True) if high is None else F.col(c) <= F.lit(high))
        assert rows(layout.read_matching(spark, path, zones, ranges)) == rows(want)
    assert 0 < len(layout.matching_files(zones, {"user_id": (3, 4)})) < n_files
    assert layout.matching_files(zones, {"user_id": (10**9, None)}) == []


@pytest.mark.parametrize("levels", [(1,), (7,), (3, 12), (1, 2, 4, 64)])
def test_running_max_equals_the_plain_window(spark, levels):
    import random
    r = random.Random(len(levels))
    data = [(g, i, None if r.random() < 0.1 else r.randint(0, 99)) for g in ("a", None, "c") for i in range(90)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    got = ordered.running_max(df, ["g"], ["o"], "v", [F.floor(F.col("o") / n) for n in levels])
    assert got.columns == ["g", "o", "v", "_max_before"]
    want, seen = Counter(), {}
    for g, o, v in data:
        want[g, o, v, seen.get(g)] += 1
        if v is not None:
            seen[g] = max(v, seen.get(g, v))
    assert rows(got) == want


def test_late_rows(spark):
    t = dt.datetime(2024, 3, 31, 0, 30)
    at = lambda minutes: t + dt.timedelta(minutes=minutes)
    data = [(1, at(0)), (2, at(10)), (3, at(5)), (4, None), (5, at(10)), (6, at(9.5)), (7, at(300)), (8, at(100)), (9, at(301))]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # the clock changes that night
    try:
        late = quality.lateness(df, "id", "ts", [F.floor(F.col("id") / 2)])
        assert {r["id"]: r["late_seconds"] for r in late.collect()} == {
            1: 0, 2: 0, 3: 300, 4: None, 5: 0, 6: 30, 7: 0, 8: 12000, 9: 0}
        assert tuple(quality.late_report(late, [F.lit(1).alias("all")], 60).first()) == (1, 9, 3, 2, 12000.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
