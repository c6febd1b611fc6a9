"""Cumulative tables: one row per entity and period carrying the entity's
whole history as an array of structs.

* ``cumulate_step``     - yesterday's snapshot FULL OUTER JOIN today's facts.
* ``cumulate_backfill`` - every period at once; equals folding the steps.
* ``unnest_history``, ``career_ratio`` - readers of the history array.

Facts must be at (entity, period) grain, so a history array holds at most
one element per period whatever the skew of the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.functions.columns import classify, ratio_or_one


def cumulate_step(prev: DataFrame, today: DataFrame, key: str, statics: Sequence[str],
                  struct_cols: Sequence[str], period_col: str, period: int,
                  metric: str, history_col: str = "seasons", class_col: str = "scoring_class",
                  current_col: str = "current_season", thresholds=K.SCORING_THRESHOLDS,
                  default_class: str = K.SCORING_DEFAULT, prefer: str = "prev") -> DataFrame:
    """Advance the cumulative snapshot ``prev`` (at period-1) by one period.

    Static attributes: previous value wins (``prefer="today"`` flips it).
    The history array gets today's struct appended; class is re-derived when
    the entity is active, otherwise carried; ``years_since_last_active``
    resets to 0 or grows by one.
    """
    t = today.filter(F.col(period_col) == period).select(
        key, *statics, F.struct(period_col, *struct_cols).alias("_t"))
    st_type = t.schema["_t"].dataType
    y = prev.filter(F.col(current_col) == period - 1).select(
        key, *[F.col(s).alias(f"_p_{s}") for s in statics], F.col(history_col).alias("_h"),
        F.col(class_col).alias("_c"), F.col("years_since_last_active").alias("_y"))
    j = y.join(t, key, "full_outer")
    active = F.col("_t").isNotNull()
    empty = F.array().cast(f"array<{st_type.simpleString()}>")
    stat_cols = [(F.coalesce(F.col(f"_p_{s}"), F.col(s)) if prefer == "prev"
                  else F.coalesce(F.col(s), F.col(f"_p_{s}"))).alias(s) for s in statics]
    return j.select(
        key, *stat_cols,
        F.concat(F.coalesce(F.col("_h"), empty), F.when(active, F.array("_t")).otherwise(empty)).alias(history_col),
        F.when(active, classify(F.col("_t")[metric], thresholds, default_class)).otherwise(F.col("_c")).alias(class_col),
        F.when(active, F.lit(0)).otherwise(F.col("_y") + 1).alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period).alias(current_col),
    )


def cumulate_backfill(facts: DataFrame, key: str, statics: Sequence[str], struct_cols: Sequence[str],
                      period_col: str, start: int, end: int, metric: str,
                      history_col: str = "seasons", class_col: str = "scoring_class",
                      current_col: str = "current_season", thresholds=K.SCORING_THRESHOLDS,
                      default_class: str = K.SCORING_DEFAULT, since: int | None = None) -> DataFrame:
    """All snapshots from each entity's first period (or ``since``, if that is
    later) through ``end`` in one pass; ``since = end`` gives one row an entity.

    One shuffle: facts grouped by entity (history sorted by period), then
    each entity's periods are generated with ``sequence`` and every snapshot
    keeps the history elements up to its period.  Statics take MAX, a
    deterministic pick.
    """
    f = facts.filter((F.col(period_col) >= start) & (F.col(period_col) <= end))
    g = f.groupBy(key).agg(
        *[F.max(s).alias(s) for s in statics],
        F.sort_array(F.collect_list(F.struct(period_col, *struct_cols))).alias("_all"),
        F.min(period_col).alias("_first"))
    opening = F.col("_first") if since is None else F.greatest("_first", F.lit(since))
    snap = g.select(key, *statics, "_all", F.explode(F.sequence(opening, F.lit(end))).alias(current_col))
    hist = F.filter(F.col("_all"), lambda x: x[period_col] <= F.col(current_col))
    last = F.try_element_at(F.col(history_col), F.lit(-1))
    return (snap.select(key, *statics, hist.alias(history_col), current_col)
                .select(key, *statics, history_col,
                        classify(last[metric], thresholds, default_class).alias(class_col),
                        (F.col(current_col) - last[period_col]).alias("years_since_last_active"),
                        (last[period_col] == F.col(current_col)).alias("is_active"),
                        current_col))


def unnest_history(df: DataFrame, key: str, history_col: str = "seasons") -> DataFrame:
    """One row per history element, struct fields expanded."""
    return df.select(key, F.explode(history_col).alias("_s")).select(key, "_s.*")


def career_ratio(df: DataFrame, key: str, metric: str, history_col: str = "seasons",
                 class_col: str | None = None, class_value: str | None = None) -> DataFrame:
    """Latest element's metric over the first element's (zero first -> 1)."""
    if class_col and class_value:
        df = df.filter(F.col(class_col) == class_value)
    first = F.try_element_at(F.col(history_col), F.lit(1))[metric]
    last = F.try_element_at(F.col(history_col), F.lit(-1))[metric]
    return df.select(key, ratio_or_one(last, first).alias("career_ratio"))


def _mean(rating_col: str, units_per_point: float | None):
    """AVG, or - for ratings stored as integer units - an exact integer sum
    divided by count and units (reproducible to the last bit anywhere)."""
    if units_per_point is None:
        return F.avg(rating_col)
    return (F.sum(rating_col).cast("double") / F.count(F.lit(1)).cast("double")) / F.lit(float(units_per_point))


def entity_history(rows: DataFrame, key: str, name_col: str, period_col: str, rating_col: str,
                   as_of: int, thresholds=K.RATING_THRESHOLDS, default_class: str = K.RATING_DEFAULT,
                   class_col: str = "quality_class", units_per_point: float | None = None) -> DataFrame:
    """Per entity as of ``as_of``: item count, most recent period, that
    period's average rating -> class, and ``is_active`` (recent = as_of).

    Two partial-aggregation levels (entity x period, then entity), so a hot
    entity is reduced map-side before any shuffle.
    """
    per = (rows.filter(F.col(period_col) <= as_of)
               .groupBy(key, period_col)
               .agg(F.max(name_col).alias("_name"), _mean(rating_col, units_per_point).alias("_avg"),
                    F.count(F.lit(1)).alias("_n")))
    ent = per.groupBy(key).agg(F.max("_name").alias(name_col), F.sum("_n").alias("n_items"),
                               F.max(period_col).alias("recent_period"),
                               F.max_by("_avg", period_col).alias("recent_avg_rating"))
    return ent.select(key, name_col, "n_items", "recent_period", "recent_avg_rating",
                      classify("recent_avg_rating", thresholds, default_class).alias(class_col),
                      (F.col("recent_period") == F.lit(as_of)).alias("is_active"),
                      F.lit(as_of).alias("current_period"))


def entity_history_backfill(rows: DataFrame, key: str, period_col: str, rating_col: str,
                            start: int, end: int, thresholds=K.RATING_THRESHOLDS,
                            default_class: str = K.RATING_DEFAULT, class_col: str = "quality_class",
                            units_per_point: float | None = None, since: int | None = None) -> DataFrame:
    """Snapshots of ``entity_history``'s class and activity for every period
    (one row per entity and period from its first period, or ``since`` if later)."""
    per = (rows.groupBy(key, period_col)
               .agg(_mean(rating_col, units_per_point).alias("avg_rating"), F.count(F.lit(1)).alias("n_items")))
    return cumulate_backfill(per, key, [], ["avg_rating", "n_items"], period_col, start, end, "avg_rating",
                             history_col="history", class_col=class_col, current_col="current_period",
                             thresholds=thresholds, default_class=default_class, since=since)
