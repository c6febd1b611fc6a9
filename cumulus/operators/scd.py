"""Slowly changing dimensions, type 2.

* ``scd2_backfill``      - whole history: change flag by LAG, running SUM =
  streak id, one [start, end] row per streak.
* ``scd2_incremental``   - merge one new period into an SCD table.
* ``scd2_expire_insert`` - date-stamped variant with open rows (NULL end).

Attribute comparisons are NULL-safe throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.functions.columns import distinct_from


def _changed(attrs, prefix_a="", prefix_b="_o_"):
    cond = F.lit(False)
    for a in attrs:
        cond = cond | distinct_from(F.col(f"{prefix_a}{a}"), F.col(f"{prefix_b}{a}"))
    return cond


def scd2_backfill(df: DataFrame, key: str, attrs: Sequence[str], period_col: str,
                  start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Streaks of unchanged ``attrs`` per key -> (key, attrs, start, end).

    The window partitions by key; the following groupBy on (key, streak)
    reuses that partitioning, so the plan has one Exchange.
    """
    w = Window.partitionBy(key).orderBy(period_col)
    changed = F.lag(period_col).over(w).isNull()
    for a in attrs:
        changed = changed | distinct_from(F.lag(a).over(w), F.col(a))
    flagged = df.select(key, period_col, *attrs, changed.cast("int").alias("_chg"))
    streaks = flagged.withColumn("_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (streaks.groupBy(key, "_streak", *attrs)
                   .agg(F.min(period_col).alias(start_col), F.max(period_col).alias(end_col))
                   .drop("_streak"))


def scd2_incremental(scd: DataFrame, current: DataFrame, key: str, attrs: Sequence[str],
                     prev_period, period, start_col: str = "start_date", end_col: str = "end_date",
                     current_col: str | None = "current_season") -> DataFrame:
    """Merge snapshot ``current`` (period ``period``) into ``scd`` (through ``prev_period``).

    One FULL OUTER JOIN of the open rows with the new snapshot; each joined
    row emits one or two intervals through ``explode``:
    unchanged -> extended; changed -> old closed + new opened;
    new key -> opened; key missing from the snapshot -> kept closed.
    History already closed before ``prev_period`` passes through untouched.

    The input is first reduced to its state as of ``prev_period`` (intervals
    opened later are dropped, later ends are clipped), so merging a period
    into a table that already contains it gives the same result again.
    """
    cols = [key, *attrs, start_col, end_col]
    prev = F.lit(prev_period)
    scd = (scd.filter(F.col(start_col) <= prev)
              .withColumn(end_col, F.least(F.col(end_col), prev.cast(scd.schema[end_col].dataType))))
    closed = scd.filter(F.col(end_col) < F.lit(prev_period)).select(*cols)
    open_ = scd.filter(F.col(end_col) == F.lit(prev_period)).select(
        key, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.col(start_col).alias("_o_s"),
        F.col(end_col).alias("_o_e"), F.lit(True).alias("_old"))
    cur = current.select(key, *attrs, F.lit(True).alias("_new"))
    j = open_.join(cur, key, "full_outer")
    p = F.lit(period)
    old_row = F.struct(*[F.col(f"_o_{a}").alias(a) for a in attrs], F.col("_o_s").alias(start_col),
                       F.col("_o_e").alias(end_col))
    new_row = F.struct(*[F.col(a).alias(a) for a in attrs], p.alias(start_col), p.alias(end_col))
    ext_row = F.struct(*[F.col(a).alias(a) for a in attrs], F.col("_o_s").alias(start_col), p.alias(end_col))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    rows = (F.when(both & ~_changed(attrs), F.array(ext_row))
             .when(both, F.array(old_row, new_row))
             .when(F.col("_new").isNotNull(), F.array(new_row))
             .otherwise(F.array(old_row)))
    merged = j.select(key, F.explode(rows).alias("_r")).select(key, "_r.*")
    out = closed.unionByName(merged.select(*cols))
    if current_col:
        out = out.withColumn(current_col, p)
    return out


def scd2_expire_insert(scd: DataFrame, latest: DataFrame, key: str, attrs: Sequence[str], as_of,
                       start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Date-stamped SCD2: open rows have NULL ``end``.

    Open rows whose attributes differ from ``latest`` are closed at
    ``as_of - 1 day`` and a new open row starting ``as_of`` is inserted; new
    keys get an open row; unchanged and closed rows stay.  A row opened on
    ``as_of`` itself is replaced, so a second change on one day leaves no empty interval.
    """
    d = F.lit(as_of).cast("date")
    cols = [key, *attrs, start_col, end_col]
    closed = scd.filter(F.col(end_col).isNotNull()).select(*cols)
    open_ = scd.filter(F.col(end_col).isNull()).select(
        key, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.col(start_col).alias("_o_s"), F.lit(True).alias("_old"))
    cur = latest.select(key, *attrs, F.lit(True).alias("_new"))
    j = open_.join(cur, key, "full_outer")
    null_date = F.lit(None).cast("date")
    keep = F.struct(*[F.col(f"_o_{a}").alias(a) for a in attrs], F.col("_o_s").alias(start_col), null_date.alias(end_col))
    expire = F.struct(*[F.col(f"_o_{a}").alias(a) for a in attrs], F.col("_o_s").alias(start_col),
                      F.date_sub(d, 1).alias(end_col))
    insert = F.struct(*[F.col(a).alias(a) for a in attrs], d.alias(start_col), null_date.alias(end_col))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    rows = (F.when(both & _changed(attrs) & (F.col("_o_s") == d), F.array(insert))
             .when(both & _changed(attrs), F.array(expire, insert))
             .when(both, F.array(keep))
             .when(F.col("_new").isNotNull(), F.array(insert))
             .otherwise(F.array(keep)))
    merged = j.select(key, F.explode(rows).alias("_r")).select(key, "_r.*")
    return closed.unionByName(merged.select(*cols))
