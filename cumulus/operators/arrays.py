"""Monthly reduced facts: one row per key and month with an array indexed by
day of month (element 1 = first day).

* ``array_metric_step``  - append one day's value; new keys get zero (or
  NULL) padding for the days before they first appeared.
* ``array_metric_month`` - the whole month at once (equals folding steps).
* ``array_first_days``, ``array_daily``, ``array_length_hist`` - readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _fit(arr: Column, n: Column, fill: Column) -> Column:
    """Pad ``arr`` with ``fill`` (or cut it) to exactly ``n`` elements."""
    size = F.size(arr)
    return F.when(size >= n, F.slice(arr, 1, n)).otherwise(
        F.concat(arr, F.array_repeat(fill, n - size)))


def daily_counts(events: DataFrame, key, date_col: str = "event_date", value=None,
                 name: str = "n") -> DataFrame:
    """(key..., day, n): count (or sum of ``value``) per key and day; NULL keys dropped."""
    ks = _keys(key)
    df = events
    for k in ks:
        df = df.filter(F.col(k).isNotNull())
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(*ks, F.col(date_col).alias("day")).agg(agg.cast("bigint").alias(name))


def array_metric_step(prev: DataFrame, events: DataFrame, ds, key="user_id", metric_name: str = "site_hits",
                      date_col: str = "event_date", value=None, null_pad: bool = False) -> DataFrame:
    """One day's increment of (key..., month_start, metric_name, metric_array).

    Keys seen today but not before get ``day-1`` padding (0, or NULL with
    ``null_pad``); keys absent today get 0 appended.  An array already
    holding ``ds`` is cut back before appending, so re-running a day is a
    no-op.  If ``prev`` has ``first_found_date``, it is carried (``ds`` for
    new keys), with ``date_partition`` = ``ds``.
    """
    ks = _keys(key)
    d = F.lit(ds).cast("date")
    month = F.trunc(d, "MM")
    day = F.dayofmonth(d)
    today = (daily_counts(events.filter(F.col(date_col) == d), ks, date_col, value)
             .select(*ks, F.col("n").alias("_n")))
    found = ["first_found_date"] if "first_found_date" in prev.columns else []
    y = (prev.filter((F.col("month_start") == month) & (F.col("metric_name") == metric_name))
             .select(*ks, F.col("metric_array").alias("_arr"), *found))
    j = y.join(today, ks, "full_outer")
    fill = F.lit(None).cast("bigint") if null_pad else F.lit(0).cast("bigint")
    # NULL stands for days before a key was known; a known key's missed days are 0
    base = (F.when(F.col("_arr").isNull(), _fit(F.array().cast("array<bigint>"), day - 1, fill))
             .otherwise(_fit(F.col("_arr"), day - 1, F.lit(0).cast("bigint"))))
    return j.select(*ks, month.alias("month_start"), F.lit(metric_name).alias("metric_name"),
                    F.concat(base, F.array(F.coalesce(F.col("_n"), F.lit(0).cast("bigint")))).alias("metric_array"),
                    *[c for f in found for c in (F.coalesce(f, d).alias(f), d.alias("date_partition"))])


def array_metric_month(events: DataFrame, ds, key="user_id", metric_name: str = "site_hits",
                       date_col: str = "event_date", value=None, null_pad: bool = False) -> DataFrame:
    """Whole month through ``ds`` in one pass.

    Daily totals per key are reduced map-side first, then each key's at most
    31 (day, n) pairs become the array.  With ``null_pad`` days before the
    key's first appearance are NULL (and 0 afterwards), else 0.
    """
    ks = _keys(key)
    d = F.lit(ds).cast("date")
    month = F.trunc(d, "MM")
    ev = events.filter((F.col(date_col) >= month) & (F.col(date_col) <= d))
    per_day = daily_counts(ev, ks, date_col, value)
    per_key = per_day.groupBy(*ks).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), F.col("n")))).alias("_m"),
        F.min("day").alias("first_found_date"))
    first_day = F.dayofmonth("first_found_date")

    def elem(i):
        v = F.coalesce(F.element_at(F.col("_m"), i), F.lit(0).cast("bigint"))
        return F.when(i < first_day, F.lit(None).cast("bigint")).otherwise(v) if null_pad else v

    arr = F.transform(F.sequence(F.lit(1), F.dayofmonth(d)), elem)
    return per_key.select(*ks, month.alias("month_start"), F.lit(metric_name).alias("metric_name"),
                          arr.alias("metric_array"), "first_found_date", d.alias("date_partition"))


def array_first_days(df: DataFrame, n: int = 3, array_col: str = "metric_array",
                     group: str = "month_start", names=None) -> DataFrame:
    """Per group, SUM of the first ``n`` elements (missing/NULL elements add 0)."""
    names = names or [f"num_hits_day_{i + 1}" for i in range(n)]
    aggs = [F.sum(F.coalesce(F.get(F.col(array_col), i), F.lit(0))).cast("bigint").alias(names[i])
            for i in range(n)]
    return df.groupBy(group).agg(*aggs)


def array_daily(df: DataFrame, array_col: str = "metric_array", month_col: str = "month_start",
                metric_col: str = "metric_name") -> DataFrame:
    """Element-wise SUM across keys, unnested to (metric, date, value).

    ``posexplode`` first, then a plain groupBy: partial sums happen map-side
    and arrays of any length work.
    """
    ex = df.select(metric_col, month_col, F.posexplode(array_col).alias("pos", "v"))
    return (ex.groupBy(metric_col, F.date_add(F.col(month_col), F.col("pos")).alias("date"))
              .agg(F.sum("v").cast("bigint").alias("value")))


def array_length_hist(df: DataFrame, array_col: str = "metric_array") -> DataFrame:
    return df.groupBy(F.size(array_col).cast("bigint").alias("array_length")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def host_reduced_month(events: DataFrame, ds, key: str = "host", user_col: str = "user_id",
                       date_col: str = "event_date") -> DataFrame:
    """Per key and month: hit_array (rows per day) and unique_visitors (distinct users per day)."""
    d = F.lit(ds).cast("date")
    month = F.trunc(d, "MM")
    ev = events.filter(F.col(key).isNotNull() & (F.col(date_col) >= month) & (F.col(date_col) <= d))
    per_day = ev.groupBy(key, F.col(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct(user_col).alias("visitors"))
    per_key = per_day.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), F.struct("hits", "visitors")))).alias("_m"))
    days = F.sequence(F.lit(1), F.dayofmonth(d))
    return per_key.select(
        key, month.alias("month"),
        F.transform(days, lambda i: F.coalesce(F.element_at("_m", i)["hits"], F.lit(0).cast("bigint"))).alias("hit_array"),
        F.transform(days, lambda i: F.coalesce(F.element_at("_m", i)["visitors"], F.lit(0).cast("bigint"))).alias("unique_visitors"))


def host_reduced_step(prev: DataFrame, events: DataFrame, ds, key: str = "host", user_col: str = "user_id",
                      date_col: str = "event_date") -> DataFrame:
    """Day-by-day load of ``host_reduced_month``."""
    d = F.lit(ds).cast("date")
    month = F.trunc(d, "MM")
    day = F.dayofmonth(d)
    today = (events.filter((F.col(date_col) == d) & F.col(key).isNotNull())
                   .groupBy(key).agg(F.count(F.lit(1)).alias("_h"), F.count_distinct(user_col).alias("_v")))
    y = prev.filter(F.col("month") == month).select(key, F.col("hit_array").alias("_ha"),
                                                     F.col("unique_visitors").alias("_uv"))
    j = y.join(today, key, "full_outer")
    zero = F.lit(0).cast("bigint")
    empty = F.array().cast("array<bigint>")
    return j.select(key, month.alias("month"),
                    F.concat(_fit(F.coalesce("_ha", empty), day - 1, zero), F.array(F.coalesce("_h", zero))).alias("hit_array"),
                    F.concat(_fit(F.coalesce("_uv", empty), day - 1, zero), F.array(F.coalesce("_v", zero))).alias("unique_visitors"))
