"""Pipeline checks and multi-grain reports: freshness, NULL counts,
outliers, late rows, roll-up reports, unit-level vs aggregate metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.operators.ordered import running_max


def freshness(df: DataFrame, by: Sequence[str], time_col: str, stale_before) -> DataFrame:
    """Latest timestamp and row count per group, flagged stale when older
    than ``stale_before``."""
    g = df.groupBy(*by).agg(F.max(time_col).alias("max_event_time"), F.count(F.lit(1)).alias("n_rows"))
    return g.withColumn("is_stale", F.col("max_event_time") < F.lit(stale_before).cast("timestamp_ntz"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: total rows and NULL count per column."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def group_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and sample standard deviation per group, one row each."""
    return df.groupBy(*by).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))


def outliers(df: DataFrame, by: Sequence[str], value: str, z_max: float = 3.0, id_cols: Sequence[str] = (),
             stats: DataFrame | None = None) -> DataFrame:
    """Rows whose value lies more than ``z_max`` sample standard deviations
    from their group mean.

    ``stats``: the ``group_stats``, stored beforehand; their size is known then,
    and few groups are joined without a shuffle of the rows on few keys.
    """
    stats = group_stats(df, by, value) if stats is None else stats
    z = (F.col(value) - F.col("_mu")) / F.col("_sd")
    j = df.join(stats, list(by)).withColumn("z", z)
    return j.filter(F.abs(F.col("z")) > z_max).select(*id_cols, *by, value, "z")


def schema_changes(df: DataFrame, expected) -> DataFrame:
    """Schema drift against an expected ``StructType`` (or DDL string):
    one row per added, removed or retyped column."""
    from pyspark.sql.types import StructType

    exp = expected if isinstance(expected, StructType) else df.sparkSession.createDataFrame([], expected).schema
    want = {f.name: f.dataType.simpleString() for f in exp.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, "removed", want[c], None) for c in want if c not in have]
    rows += [(c, "added", None, have[c]) for c in have if c not in want]
    rows += [(c, "retyped", want[c], have[c]) for c in want if c in have and want[c] != have[c]]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, change string, expected_type string, actual_type string")


def rollup_report(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """ROLLUP over ``dims`` with the grouping id as the level."""
    return df.rollup(*dims).agg(*aggs, F.grouping_id().alias("grouping_level"))


def day_over_day(daily: DataFrame, date_col: str, measure: str) -> DataFrame:
    """Previous day's value and growth, via an equi-join on date - 1 (no
    unpartitioned window)."""
    prev = daily.select(F.date_add(F.col(date_col), 1).alias(date_col), F.col(measure).alias(f"prev_{measure}"))
    j = daily.join(prev, date_col, "left")
    return j.withColumn("growth", F.try_divide((F.col(measure) - F.col(f"prev_{measure}")).cast("double"),
                                                F.col(f"prev_{measure}").cast("double")))


def lateness(df: DataFrame, arrival: str, time_col: str, levels: Sequence[Column], group: Sequence[str] = ()) -> DataFrame:
    """Add ``late_seconds``: how far ``time_col`` lies behind the largest event time that arrived before, 0 if it does not.

    ``levels``: buckets of the arrival order, see ``ordered.running_max``.  Rows without an event time have NULL.
    """
    seen = running_max(df, group, [arrival], time_col, levels)
    gap = F.greatest(_micros("_max_before") - _micros(time_col), F.lit(0)) / F.lit(1e6)
    late = F.when(F.col(time_col).isNotNull(), F.coalesce(gap, F.lit(0.0)))
    return seen.withColumn("late_seconds", late).drop("_max_before")


def _micros(time_col: str) -> Column:
    """Microseconds on the clock of the column itself, whatever the session's time zone."""
    c = F.col(time_col)
    seconds = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def late_report(late: DataFrame, by: Sequence[Column], allowed_seconds: float) -> DataFrame:
    """Per group: n_rows, n_late (behind at all), n_dropped (a watermark of ``allowed_seconds`` would drop them), max_late_seconds."""
    return late.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("late_seconds") > 0).alias("n_late"),
        F.count_if(F.col("late_seconds") > allowed_seconds).alias("n_dropped"),
        F.max("late_seconds").alias("max_late_seconds"))
