"""Window analytics: referrer channels, rolling counts, arg-max per group,
top-N, best stretch and longest streak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.functions import constants as K

# ids per bucket of the ordered operators: one task sorts the rows of one group and bucket
BUCKET_IDS = 1 << 16


def referrer_channel(ref, rules: Sequence[tuple[str, str]] = K.REFERRER_RULES,
                     site_hosts: Sequence[str] = ("example.com",), site_label: str = "On Site") -> Column:
    """First matching substring wins; no match keeps the raw referrer."""
    r = F.col(ref) if isinstance(ref, str) else ref
    expr = None
    for needle, label in list(rules) + [(h, site_label) for h in site_hosts]:
        cond = r.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(r)


def rolling_counts(daily: DataFrame, keys: Sequence[str], date_col: str, count_col: str = "count",
                   min_total: int = 500, prev_frame: tuple[int, int] = (-13, -6), calendar: bool = False) -> DataFrame:
    """Month total, running total, overall total, 7-row rolling and the
    previous-window count, shares of month and total; keep keys whose total
    exceeds ``min_total``.

    Frames are rows; with ``calendar`` they are days, so that a day without
    rows counts as one and seven days never stretch beyond a week.

    Input is already one row per key and day.  All windows partition by
    ``keys`` first (the month window adds the month), so one Exchange
    serves them.
    """
    keys = list(keys)
    base = Window.partitionBy(*keys).orderBy(date_col)
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    month = Window.partitionBy(*keys, F.trunc(F.col(date_col), "MM")).orderBy(date_col).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    c = F.col(count_col)
    by_day = Window.partitionBy(*keys).orderBy(F.unix_date(F.col(date_col)))
    frame = by_day.rangeBetween if calendar else base.rowsBetween
    out = daily.select(
        *keys, date_col, count_col,
        F.sum(c).over(base.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("rolling_cumulative_sum"),
        F.sum(c).over(whole).alias("total_cumulative_sum"),
        F.sum(c).over(frame(-6, 0)).alias("weekly_rolling_count"),
        F.sum(c).over(frame(*prev_frame)).alias("previous_weekly_rolling_count"),
        F.sum(c).over(month).alias("monthly_cumulative_sum"))
    return (out.filter(F.col("total_cumulative_sum") > min_total)
               .withColumn("pct_of_month", c.cast("double") / F.col("monthly_cumulative_sum").cast("double"))
               .withColumn("pct_of_total", c.cast("double") / F.col("total_cumulative_sum").cast("double")))


def argmax_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows whose ``value`` equals their group's maximum (ties kept).

    ``rank() = 1``, which the planner cuts to the best rows of each input
    partition before the shuffle (partial WindowGroupLimit), so no task sees a
    whole group.  Rows whose group or value is NULL match no maximum and are
    left out.
    """
    known = df.filter(F.col(value).isNotNull())
    for g in group:
        known = known.filter(F.col(g).isNotNull())
    place = F.rank().over(Window.partitionBy(*group).orderBy(F.col(value).desc()))
    return known.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n (TakeOrdered: each partition keeps its top n)."""
    return df.orderBy(*order).limit(n)


def _bucket(order_col: str) -> Column:
    return F.floor(F.col(order_col) / F.lit(BUCKET_IDS))


def best_stretch(df: DataFrame, group: str, order_col: str, flag: str, n: int = 90,
                 bucket: Column | None = None, coarser: Sequence[Column] = ()) -> DataFrame:
    """Per group, the largest sum of ``flag`` (not negative, NULL counts 0) over
    any ``n`` consecutive rows.

    A stretch of rows is summed up as its length, its best sum and its first
    and last n - 1 rows.  Rows are summed up inside (group, bucket), buckets
    inside the next of ``coarser`` (each level constant within the one
    before), the last level inside the group: stretches that cross an edge are
    summed over the kept rows by position.  Buckets must not decrease as
    ``order_col`` grows; the default is ``order_col div BUCKET_IDS``.  One task
    sees the rows of a bucket, then 2 (n - 1) rows for each bucket of the next
    level.  One Exchange a level.
    """
    levels = [bucket if bucket is not None else _bucket(order_col), *coarser]
    names = [f"_b{i}" for i in range(len(levels))]
    edge = max(n - 1, 1)
    rows = df.select(F.col(group), *[c.alias(b) for c, b in zip(levels, names, strict=True)], F.col(order_col).alias("_o"),
                     F.coalesce(F.col(flag).cast("bigint"), F.lit(0)).alias("_f"))
    inner = Window.partitionBy(group, *names)
    rows = rows.select(group, *names, "_f", F.row_number().over(inner.orderBy("_o")).cast("bigint").alias("_pos"),
                       F.sum("_f").over(inner.orderBy("_o").rowsBetween(1 - n, 0)).alias("_sum"),
                       F.count(F.lit(1)).over(inner).alias("_n"))
    part = _stretch(rows, [group, *names], edge)
    for i in range(len(names)):
        keys, by = [group, *names[i + 1:]], names[i]
        w = Window.partitionBy(*keys).orderBy(by)
        before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        total = F.sum("_n").over(Window.partitionBy(*keys))
        placed = part.select(*keys, "_best", "_edge", before.alias("_before"), total.alias("_n"))
        edges = placed.select(*keys, "_best", "_before", "_n", F.explode("_edge").alias("_e"))
        edges = edges.select(*keys, "_best", "_n", (F.col("_before") + F.col("_e._pos")).alias("_pos"), F.col("_e._f").alias("_f"))
        across = F.sum("_f").over(Window.partitionBy(*keys).orderBy("_pos").rangeBetween(1 - n, 0))
        part = _stretch(edges.withColumn("_sum", F.greatest("_best", across)), keys, edge)
    return part.select(group, F.col("_best").alias(f"max_in_{n}"))


def _stretch(rows: DataFrame, keys: Sequence[str], edge: int) -> DataFrame:
    """Rows (position, flag, best sum so far) of each stretch of _n rows as one: its best sum and the rows at its edges."""
    at_edge = (F.col("_pos") <= edge) | (F.col("_pos") > F.col("_n") - edge)
    return rows.groupBy(*keys).agg(
        F.max("_sum").alias("_best"), F.max("_n").alias("_n"),
        F.sort_array(F.collect_list(F.when(at_edge, F.struct("_pos", "_f")))).alias("_edge"))


def longest_streak(df: DataFrame, group: str, order_cols: Sequence[str], cond: Column,
                   bucket: Column | None = None, coarser: Sequence[Column] = ()) -> DataFrame:
    """Per group, the longest run of consecutive rows satisfying ``cond`` (NULL:
    not satisfied); groups without such a row are left out.

    A stretch of rows is summed up as its length, the runs it starts and ends
    with, and its longest run; neighbouring stretches add up to one.  Rows are
    summed up inside (group, bucket), buckets inside the next of ``coarser``
    (each level constant within the one before), the last level inside the
    group.  Buckets must not decrease in the order; the default is the first
    order column ``div BUCKET_IDS``.  One Exchange a level.
    """
    levels = [bucket if bucket is not None else _bucket(order_cols[0]), *coarser]
    names = [f"_b{i}" for i in range(len(levels))]
    ok = F.coalesce(cond, F.lit(False)).cast("bigint")
    part = df.select(group, *[c.alias(n) for c, n in zip(levels, names)],
                     *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                     F.lit(1).cast("bigint").alias("_n"), ok.alias("_lead"), ok.alias("_trail"), ok.alias("_best"))
    order = [f"_o{i}" for i in range(len(order_cols))]
    for i in range(len(names) + 1):
        part = _joined_runs(part, [group, *names[i:]], order)
        order = names[i:i + 1]
    return part.filter("_best > 0").select(group, F.col("_best").alias("longest_streak"))


def _joined_runs(part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stretches (_n rows, run at the start, run at the end, longest run) that follow one another, as one a key."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    broken = F.col("_lead") < F.col("_n")
    p = part.withColumn("_end", F.sum("_n").over(upto)).withColumn("_begin", F.col("_end") - F.col("_n"))
    # position of the last row so far that breaks a run, before this stretch
    breaks = F.max(F.when(broken, F.col("_end") - F.col("_trail")))
    since = F.coalesce(breaks.over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    p = p.withColumn("_run", F.col("_begin") + F.col("_lead") - since)
    total, first = F.max("_end"), F.min(F.when(broken, F.col("_begin") + F.col("_lead")))
    return p.groupBy(*keys).agg(
        total.alias("_n"), F.coalesce(first, total).alias("_lead"), (total - F.coalesce(breaks, F.lit(0))).alias("_trail"),
        F.greatest(F.max("_best"), F.max("_run")).alias("_best"))
