"""Constraints on write: NOT NULL, CHECK, ENUM and keys, with the rows that break one set aside.

Every row gets the names of the rules it breaks.  Rows that break none are
accepted, the others quarantined; one write puts them into two partitions, and
the counts by rule are observed while it runs, so the rows are computed once.

As in SQL, a CHECK or ENUM whose value is NULL holds, and a key with a NULL
equals no other; add ``not_null`` where that is not wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

BROKEN, ACCEPTED = "broken_rules", "accepted"


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def check(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def one_of(column: str, values: Sequence) -> Column:
    return check(F.col(column).isin(list(values)))


def judge(df: DataFrame, rules: dict[str, Column], key: Sequence[str] = (), stored_keys: DataFrame | None = None,
          order: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``broken_rules``, the names of the rules that each row breaks, in the order of ``rules``.

    With ``key``, all rows of a key but the first (by ``order``, then all other columns) break ``duplicate_key``, and
    all rows of a key that ``stored_keys`` has break ``known_key``.  Rows are ordered inside (key, input partition),
    then the first ones of each partition are compared, so no task sees all rows of a hot key.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    if key:
        whole = F.lit(True)
        for k in key:
            whole = whole & F.col(k).isNotNull()
        by = [F.col(c) for c in dict.fromkeys([*order, *[c for c in df.columns if c not in key]])]
        df = df.withColumn("_part", F.spark_partition_id())
        place = F.row_number().over(Window.partitionBy(*key, "_part").orderBy(*(by or [F.lit(1)])))
        df = df.withColumn("_place", place)
        first = df.where("_place = 1").groupBy(*key).agg(F.min(F.struct(*by, "_part"))["_part"].alias("_part"))
        df = df.join(first.withColumn("_holds", F.lit(True)), [*key, "_part"], "left")
        df = df.withColumn("_first", F.coalesce(F.col("_holds") & (F.col("_place") == 1), F.lit(False)))
        broken.append(F.when(whole & ~F.col("_first"), F.lit("duplicate_key")))
        if stored_keys is not None:
            have = stored_keys.select(*key).distinct().withColumn("_known", F.lit(True))
            df = df.join(have, list(key), "left")
            broken.append(F.when(F.col("_known"), F.lit("known_key")))
    return df.withColumn(BROKEN, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")).drop(
        "_first", "_known", "_holds", "_place", "_part")


def write_judged(judged: DataFrame, path: str, rules: Sequence[str]) -> dict[str, int]:
    """Write accepted rows below ``path``/accepted=1 and the others below accepted=0, in one pass.

    Returns n_rows, n_accepted and the number of rows that break each rule.
    """
    seen = Observation()
    counts = [F.count_if(F.array_contains(BROKEN, r)).alias(r) for r in rules]
    rows = judged.withColumn(ACCEPTED, (F.size(BROKEN) == 0).cast("int")).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(BROKEN) == 0).alias("n_accepted"), *counts)
    rows.write.partitionBy(ACCEPTED).parquet(path)
    return dict(seen.get)


def rule_counts(judged: DataFrame) -> DataFrame:
    """One row a broken rule: rule, n_rows."""
    return judged.select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))
