"""Stored cubes, constraints on write, levels of best_stretch."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulus.operators import constraints, cubes, windows

SETS = [["os", "kind"], ["os"], ["kind"], []]
LABELS = {("os", "kind"): "os__kind", ("os",): "os", ("kind",): "kind", (): "all"}


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def facts(spark):
    r = random.Random(5)
    data = [(r.choice("xyz"), r.choice("ab"), f"2024-01-0{r.randint(1, 6)}", r.randint(1, 9)) for _ in range(300)]
    return spark.createDataFrame(data, "os string, kind string, d string, hits long").withColumn("d", F.to_date("d"))


def test_cube_loaded_by_day_equals_the_backfill(spark, facts):
    name, whole = (f"cube_{uuid.uuid4().hex}" for _ in range(2))
    made = lambda df: cubes.cube_rows(df, SETS, ["hits"], "d", LABELS)
    on = lambda i: facts.where(F.col("d") == F.lit(f"2024-01-0{i}").cast("date"))
    cols = ["os", "kind", "hits", "aggregation_level", "day"]
    try:
        cubes.create_cube(made(on(1)), name)
        for i in (2, 3, 4, 3, 5, 6, 2):  # days come again, too
            cubes.load_cube_day(name, made(on(i)), f"2024-01-0{i}")
        cubes.create_cube(made(facts), whole)
        assert rows(spark.table(name).select(*cols)) == rows(spark.table(whole).select(*cols))
        # another version of a day replaces it, also one without a row
        less = on(4).where("os = 'x'")
        cubes.load_cube_day(name, made(less), "2024-01-04")
        assert rows(spark.table(name).where("day = date'2024-01-04'").select(*cols)) == rows(made(less).select(*cols))
        cubes.load_cube_day(name, made(less.limit(0)), "2024-01-04")
        assert spark.table(name).where("day = date'2024-01-04'").isEmpty()
        # totals from partial sums
        got = cubes.cube_slice(spark.table(whole), "os", ["os"], ["hits"], "2024-01-02", "2024-01-05")
        want = facts.where("d BETWEEN date'2024-01-02' AND date'2024-01-05'").groupBy("os").agg(F.sum("hits"))
        assert rows(got.select("os", "hits")) == rows(want)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "aggregation_level" in text.split("PartitionFilters: [")[1].split("]")[0]
    finally:
        for t in (name, whole):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_constraints_against_a_plain_version(spark, tmp_path):
    r = random.Random(1)
    data = [(r.choice([None, 1, 2, 3, 4, 5]), r.choice([None, "a", "b"]), r.choice([None, -1, 0, 7]), r.choice([None, "red", "blue", "pink"]))
            for _ in range(150)] + [(9, "hot", 1, "red")] * 300
    df = spark.createDataFrame(data, "k long, j string, v long, colour string").repartition(6)
    known = spark.createDataFrame([(1, "a"), (4, "b"), (4, "b"), (None, "a")], "k long, j string")
    rules = {"v_given": constraints.not_null("v"), "v_positive": constraints.check(F.col("v") > 0),
             "colour": constraints.one_of("colour", ["red", "blue"])}
    judged = constraints.judge(df, rules, ["k", "j"], known)
    assert judged.columns == ["k", "j", "v", "colour", "broken_rules"]
    seen, want = set(), Counter()
    null_first = lambda row: tuple((x is not None, x) for x in row)
    for k, j, v, colour in sorted(data, key=null_first):
        broken = [n for n, bad in (("v_given", v is None), ("v_positive", v is not None and v <= 0), ("colour", colour == "pink"),
                                   ("duplicate_key", None not in (k, j) and (k, j) in seen),
                                   ("known_key", (k, j) in {(1, "a"), (4, "b")})) if bad]
        seen.add((k, j))
        want[k, j, v, colour, tuple(broken)] += 1
    assert Counter((*r[:4], tuple(r[4])) for r in judged.collect()) == want
    told = constraints.write_judged(judged, str(tmp_path / "load"), [*rules, "duplicate_key", "known_key"])
    back = spark.read.parquet(str(tmp_path / "load"))
    assert told["n_rows"] == len(data) and told["n_accepted"] == sum(n for r, n in want.items() if not r[4])
    assert back.where("accepted = 1").count() == told["n_accepted"] and back.where("accepted = 0").count() == told["n_rows"] - told["n_accepted"]
    per_rule = Counter()
    for r_, n in want.items():
        per_rule.update({b: n for b in r_[4]})
    assert rows(constraints.rule_counts(judged)) == Counter({(k, v): 1 for k, v in per_rule.items()})
    assert {k: told[k] for k in per_rule} == dict(per_rule)
    assert constraints.judge(df.limit(0), rules, ["k", "j"], known).count() == 0
    assert all(r_["broken_rules"] == [] for r_ in constraints.judge(df, {}).collect())


@pytest.mark.parametrize("n", [1, 3, 5, 40])
def test_best_stretch_of_any_levels(spark, n):
    r = random.Random(n)
    data = [(g, o, r.choice([None, 0, 1, 1, 2])) for g in ("a", "b") for o in sorted(r.sample(range(500), 160))] + [("c", 3, 1), ("d", 5, None)]
    df = spark.createDataFrame(data, "g string, o long, f long")
    want = {}
    for g in "abcd":
        f = [x or 0 for k, _, x in data if k == g]
        want[g] = max(sum(f[max(0, i - n + 1):i + 1]) for i in range(len(f)))
    cut = lambda k: F.floor(F.col("o") / k)
    for bucket, coarser in ((None, ()), (cut(2), ()), (cut(3), (cut(12),)), (cut(1), (cut(4), cut(64))), (cut(700), (cut(1400),))):
        got = windows.best_stretch(df, "g", "o", "f", n, bucket, coarser)
        assert {r_["g"]: r_[f"max_in_{n}"] for r_ in got.collect()} == want


def test_best_stretch_levels_bound_what_a_task_sees(spark):
    """A group of 1e5 buckets: with a level of 300 buckets the last windows see some 300 of them, not all."""
    df = spark.range(100_000).select((F.col("id") % 1).alias("g"), F.col("id").alias("o"), (F.col("id") % 3).alias("f"))
    cut = lambda k: F.floor(F.col("o") / k)
    got = windows.best_stretch(df, "g", "o", "f", 4, cut(1), (cut(300),))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 3
    assert "hashpartitioning(g" in text and got.first()["max_in_4"] == 5
