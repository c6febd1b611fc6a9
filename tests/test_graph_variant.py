"""VARIANT properties, and rolling counts by the calendar."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cumulus.operators import graph, windows


def test_typed_vertices_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([(1, 7, 2.5, True, "x"), (2, None, None, None, None)], "id long, n long, r double, b boolean, s string")
    v = graph.typed_vertices(df, "id", "thing", [(c, F.col(c)) for c in ("n", "r", "b", "s")])
    v.write.parquet(str(tmp_path / "v"))
    back = spark.read.parquet(str(tmp_path / "v"))
    assert dict(back.dtypes)["properties"] == "variant"
    got = graph.typed_properties(back, {"n": "long", "r": "double", "b": "boolean", "s": "string", "gone": "int"})
    assert sorted(map(tuple, got.collect())) == [("1", "thing", 7, 2.5, True, "x", None), ("2", "thing", None, None, None, None, None)]
    wrong = graph.typed_properties(back, {"s": "int", "n": "string"}).orderBy("identifier").first()
    assert wrong["s"] is None and wrong["n"] == "7"


def test_json_that_is_none(spark):
    rows = [(1, '{"k": 9, "a b": [1, 2]}'), (2, '{"k": "nine"}'), (3, "{k"), (4, None), (5, ""), (6, "3"), (7, '{"k": 12345678901}')]
    v = graph.json_properties(spark.createDataFrame(rows, "id long, j string"), "j")
    got = graph.typed_properties(v.drop("j"), {"k": "long", "a b": "string"}).orderBy("id").collect()
    assert [(r["id"], r["is_malformed"], r["k"], r["a b"]) for r in got] == [
        (1, False, 9, "[1,2]"), (2, False, None, None), (3, True, None, None), (4, False, None, None),
        (5, True, None, None), (6, False, None, None), (7, False, 12345678901, None)]


def test_calendar_frames_do_not_stretch_over_missing_days(spark):
    r = random.Random(4)
    start = dt.date(2024, 1, 1)
    data = [(k, start + dt.timedelta(days=i), r.randint(1, 9)) for k in "ab" for i in sorted(r.sample(range(70), 25))]
    df = spark.createDataFrame(data, "k string, d date, count long")
    got = windows.rolling_counts(df, ["k"], "d", "count", 0, (-13, -7), calendar=True).collect()
    for row in got:
        back = lambda a, b: sum(c for k, d, c in data if k == row["k"] and a <= (row["d"] - d).days <= b)
        assert row["weekly_rolling_count"] == back(0, 6) and (row["previous_weekly_rolling_count"] or 0) == back(7, 13)
