"""Date lists and 32-day activity bitmaps (cumulative activity per key).

* ``active_dates_backfill`` - one pass over history: key -> sorted active dates.
* ``active_dates_step``     - one day's increment on yesterday's snapshot.
* ``datelist_int``          - dates -> unsigned 32-bit map, bit 31 = as-of day.
* ``activity_flags``        - monthly / weekly / daily activity from the map.

Keyed date lists are ``collect_set`` aggregations that merge map-side, so a
key holding a large share of the raw rows ships at most one entry per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.functions.columns import bits_in, day_bit


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def active_dates_backfill(events: DataFrame, ds, key="user_id", date_col: str = "event_date",
                          dates_col: str = "dates_active") -> DataFrame:
    """Snapshot as of ``ds``: key..., dates_active (oldest first), date.

    One shuffle: ``collect_set`` merges map-side, so each key ships at most
    one entry per distinct day whatever its row count.
    """
    ks = _keys(key)
    df = events
    for k in ks:
        df = df.filter(F.col(k).isNotNull())
    df = df.filter(F.col(date_col) <= F.lit(ds).cast("date"))
    return (df.groupBy(*ks)
              .agg(F.sort_array(F.collect_set(date_col)).alias(dates_col))
              .withColumn("date", F.lit(ds).cast("date")))


def active_dates_step(prev: DataFrame, events: DataFrame, ds, key="user_id",
                      date_col: str = "event_date", dates_col: str = "dates_active") -> DataFrame:
    """Append ``ds`` to the date list of every key active on ``ds``.

    Full outer join of yesterday's snapshot with today's distinct keys.  A
    key already carrying ``ds`` as its newest date is left as is, so running
    the same day twice changes nothing.
    """
    ks = _keys(key)
    d = F.lit(ds).cast("date")
    today = (events.filter(F.col(date_col) == d).select(*ks).dropna().distinct()
                   .withColumn("_today", F.lit(True)))
    y = prev.select(*ks, F.col(dates_col).alias("_dates"))
    j = y.join(today, ks, "full_outer")
    base = F.coalesce(F.col("_dates"), F.array().cast("array<date>"))
    already = F.coalesce(F.try_element_at(base, F.lit(-1)) == d, F.lit(False))
    add = F.col("_today").isNotNull() & ~already
    return j.select(*ks, F.when(add, F.concat(base, F.array(d))).otherwise(base).alias(dates_col),
                    d.alias("date"))


def datelist_bits(dates: Column, ds, width: int = K.DATELIST_DAYS) -> Column:
    """OR of ``1 << (width-1-days_since)`` over the dates within ``width`` days of ``ds``.

    A per-row fold over the array: no calendar cross join, no shuffle.
    """
    d = F.lit(ds).cast("date")

    def step(acc, x):
        diff = F.datediff(d, x)
        return acc.bitwiseOR(F.when((diff >= 0) & (diff < width), day_bit(diff, width)).otherwise(F.lit(0).cast("bigint")))

    return F.aggregate(F.coalesce(dates, F.array().cast("array<date>")), F.lit(0).cast("bigint"), step)


def datelist_int(cum: DataFrame, ds, key="user_id", dates_col: str = "dates_active",
                 width: int = K.DATELIST_DAYS, out_col: str = "datelist_int") -> DataFrame:
    ks = _keys(key)
    return cum.select(*ks, datelist_bits(F.col(dates_col), ds, width).alias(out_col),
                      F.lit(ds).cast("date").alias("date"))


def activity_flags(df: DataFrame, bits_col: str = "datelist_int") -> DataFrame:
    """Monthly/weekly/daily activity, L32, L7 and previous-week activity."""
    b = F.col(bits_col)
    return df.select(
        "*",
        (F.bit_count(b) > 0).alias("monthly_active"),
        F.bit_count(b).cast("bigint").alias("l32"),
        (bits_in(bits_col, K.MASK_LAST_7_DAYS) > 0).alias("weekly_active"),
        bits_in(bits_col, K.MASK_LAST_7_DAYS).alias("l7"),
        (bits_in(bits_col, K.MASK_DAYS_8_TO_14) > 0).alias("weekly_active_previous_week"),
        (b.bitwiseAND(F.lit(K.MASK_TODAY).cast("bigint")) != 0).alias("daily_active"),
    )


def keyed_date_map(events: DataFrame, entity: str, kind: str, ds, date_col: str = "event_date") -> DataFrame:
    """entity -> map(kind -> sorted dates): the MAP form of a per-type date list."""
    lists = active_dates_backfill(events.filter(F.col(kind).isNotNull()), ds, [entity, kind], date_col)
    return (lists.groupBy(entity)
                 .agg(F.map_from_entries(F.collect_list(F.struct(kind, "dates_active"))).alias("dates_by_type"))
                 .withColumn("date", F.lit(ds).cast("date")))


def keyed_date_map_step(prev: DataFrame, events: DataFrame, entity: str, kind: str, ds,
                        date_col: str = "event_date") -> DataFrame:
    """Yesterday's ``keyed_date_map`` with ``ds`` appended to the types seen on it."""
    today = keyed_date_map(events.filter(F.col(date_col) == F.lit(ds).cast("date")), entity, kind, ds, date_col)
    both = prev.select(entity, F.col("dates_by_type").alias("_old")).join(
        today.select(entity, F.col("dates_by_type").alias("_new")), entity, "full_outer")
    return both.select(entity, merge_date_maps(F.col("_old"), F.col("_new")).alias("dates_by_type"),
                       F.lit(ds).cast("date").alias("date"))


def merge_date_maps(prev: Column, today: Column) -> Column:
    """Merge two map(kind -> dates) columns, appending today's dates."""
    empty = F.create_map().cast("map<string,array<date>>")
    return F.map_zip_with(F.coalesce(prev, empty), F.coalesce(today, empty),
                          lambda k, a, b: F.array_distinct(F.concat(F.coalesce(a, F.array().cast("array<date>")),
                                                                    F.coalesce(b, F.array().cast("array<date>")))))
