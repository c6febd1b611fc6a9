"""Growth accounting (lifecycle states), retention and state transitions.

Daily state, first match wins: no history -> New; last active yesterday ->
Retained; last active earlier -> Resurrected; inactive today after being
active yesterday -> Churned; else Stale.  Weekly state: New; active after
more than 7 idle days -> Resurrected; inactive with the last activity exactly
8 days ago -> Churned; activity within the week -> Retained; else Stale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.functions.columns import distinct_from


def _daily(new: Column, active: Column, prev: Column, d: Column) -> Column:
    return (F.when(new, K.STATE_NEW)
             .when(active & (prev == F.date_sub(d, 1)), K.STATE_RETAINED)
             .when(active, K.STATE_RESURRECTED)
             .when(prev == F.date_sub(d, 1), K.STATE_CHURNED)
             .otherwise(K.STATE_STALE))


def _weekly(new: Column, active: Column, prev: Column, d: Column) -> Column:
    return (F.when(new, K.STATE_NEW)
             .when(active & (prev < F.date_sub(d, 7)), K.STATE_RESURRECTED)
             .when(~active & (prev == F.date_sub(d, 8)), K.STATE_CHURNED)
             .when(active | (prev >= F.date_sub(d, 8)), K.STATE_RETAINED)
             .otherwise(K.STATE_STALE))


def growth_accounting_step(prev: DataFrame, events: DataFrame, ds, key: str = "user_id",
                           date_col: str = "event_date") -> DataFrame:
    """One day's lifecycle states from yesterday's snapshot and today's events.

    ``dates_active`` (oldest first) grows by ``ds`` for every key active on it.
    """
    d = F.lit(ds).cast("date")
    today = (events.filter((F.col(date_col) == d) & F.col(key).isNotNull())
                   .select(key).distinct().withColumn("_t", F.lit(True)))
    y = prev.filter(F.col("date") == F.date_sub(d, 1)).select(
        key, F.col("first_active_date").alias("_first"), F.col("last_active_date").alias("_last"),
        F.col("dates_active").alias("_dates"), F.lit(True).alias("_y"))
    j = y.join(today, key, "full_outer")
    new = F.col("_y").isNull()
    active = F.col("_t").isNotNull()
    prev_last = F.col("_last")
    none = F.array().cast("array<date>")
    return j.select(
        key,
        F.coalesce(F.col("_first"), d).alias("first_active_date"),
        F.when(active, d).otherwise(prev_last).alias("last_active_date"),
        _daily(new, active, prev_last, d).alias("daily_active_state"),
        _weekly(new, active, prev_last, d).alias("weekly_active_state"),
        F.concat(F.coalesce("_dates", none), F.when(active, F.array(d)).otherwise(none)).alias("dates_active"),
        d.alias("date"))


def growth_accounting_backfill(events: DataFrame, end, key: str = "user_id",
                               date_col: str = "event_date", since=None) -> DataFrame:
    """Every (key, day) from the key's first active day (or ``since``, if that
    is later) through ``end``; ``since = end`` gives one row a key.

    One shuffle: each key's distinct active days are collected (a set that
    merges map-side and is bounded by the number of days), sorted, and every
    active day emits itself and the idle days up to the next active day with
    its predecessor read from the array.  Row count = output size, no
    calendar cross join, no window sort.  ``dates_active`` of a day is a slice
    of the key's array, cut per emitted row; readers that don't select it
    don't pay for it: a day is exploded with its neighbours, so the array
    itself goes along only where the slice is asked for.
    """
    e = F.lit(end).cast("date")
    days = (events.filter(F.col(key).isNotNull() & (F.col(date_col) <= e))
                  .groupBy(key).agg(F.sort_array(F.collect_set(date_col)).alias("_days")))
    day = lambda d, i: F.struct(
        i.alias("i"), d.alias("d"), F.get("_days", F.lit(0)).alias("first"), F.when(i > 0, F.get("_days", i - 1)).alias("prev"), F.get("_days", i + 1).alias("next"))
    spans = days.select(key, "_days", F.explode(F.transform("_days", day)).alias("_s"))
    spans = spans.select(key, F.col("_s.first").alias("first_active_date"), F.col("_s.d").alias("_d"), F.col("_s.prev").alias("_prev"),
                         F.col("_s.next").alias("_next"), F.slice("_days", F.lit(1), F.col("_s.i") + 1).alias("dates_active"))
    upto = F.coalesce(F.date_sub(F.col("_next"), 1), e)
    spans = spans.withColumn("_upto", upto)
    opening = F.col("_d")
    if since is not None:
        spans = spans.filter(F.col("_upto") >= F.lit(since).cast("date"))
        opening = F.greatest("_d", F.lit(since).cast("date"))
    rows = spans.select(key, "first_active_date", "_d", "_prev", "dates_active",
                        F.explode(F.sequence(opening, F.col("_upto"))).alias("date"))
    active = F.col("date") == F.col("_d")
    prev = F.when(active, F.col("_prev")).otherwise(F.col("_d"))
    new = F.col("date") == F.col("first_active_date")
    d = F.col("date")
    return rows.select(key, "first_active_date",
                       F.when(active, d).otherwise(F.col("_d")).alias("last_active_date"),
                       _daily(new, active, prev, d).alias("daily_active_state"),
                       _weekly(new, active, prev, d).alias("weekly_active_state"),
                       "dates_active", "date")


def state_counts(ga: DataFrame, state_col: str = "daily_active_state") -> DataFrame:
    return ga.groupBy("date", state_col).agg(F.count(F.lit(1)).alias("n_users"))


def retention_curve(ga: DataFrame, by_cohort: bool = False, cohort=None) -> DataFrame:
    """Share of keys active by days since first activity (optionally per cohort)."""
    df = ga if cohort is None else ga.filter(F.col("first_active_date") == F.lit(cohort).cast("date"))
    since = F.datediff("date", "first_active_date").alias("days_since_first_active")
    keys = ([F.col("first_active_date")] if by_cohort else []) + [since]
    active = F.col("daily_active_state").isin(*K.ACTIVE_STATES)
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_users"), F.count_if(active).alias("n_active"))
              .withColumn("pct_active", F.col("n_active").cast("double") / F.col("n_users").cast("double")))


def _label(was, now, table: dict, default: str):
    """Label of the pair (was active, is active); a missing value is ``none``."""
    word = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    pairs = F.create_map(*[F.lit(x) for pair, label in table.items() for x in (pair, label)])
    return F.coalesce(F.try_element_at(pairs, F.concat_ws(" ", word(was), word(now))), F.lit(default))


def state_changes(scd: DataFrame, key: str, start_col: str, end_col: str, active_col: str = "is_active") -> DataFrame:
    """Label SCD intervals by the change of activity from the previous one;
    keep only intervals where activity changed (or the first)."""
    before = F.lag(active_col).over(Window.partitionBy(key).orderBy(start_col))
    return (scd.select(key, start_col, active_col, before.alias("_was"))
               .filter(F.col("_was").isNull() | distinct_from("_was", active_col))
               .select(key, start_col, _label(F.col("_was"), F.col(active_col), K.INTERVAL_CHANGES,
                                              K.CAREER_UNKNOWN).alias("player_state")))


def career_states(df: DataFrame, key: str, period_col: str, active_col: str = "is_active") -> DataFrame:
    """Per period, the activity transition from the previous period."""
    before = F.lag(active_col).over(Window.partitionBy(key).orderBy(period_col))
    return (df.select(key, period_col, active_col, before.alias("_was"))
              .select(key, period_col, _label(F.col("_was"), F.col(active_col), K.PERIOD_CHANGES,
                                              K.CAREER_CONTINUED).alias("state_change")))
