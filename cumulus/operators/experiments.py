"""Experiment assignment, exposure and readouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.functions.columns import two_sided_p


def hash_bucket(id_col, salt: str, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets): first 32 bits of md5(salt || id).

    The same on every run and machine (unlike a per-process salted hash)."""
    h = F.md5(F.concat(F.lit(salt), F.col(id_col).cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def assign_variant(df: DataFrame, id_col: str, salt: str,
                   weights: Sequence[tuple[str, int]] = (("control", 50), ("treatment", 50))) -> DataFrame:
    """Add ``variant`` by cumulative percentage weights over the hash bucket."""
    b = hash_bucket(id_col, salt)
    expr, acc = None, 0
    for name, w in weights:
        acc += w
        expr = F.when(b < acc, F.lit(name)) if expr is None else expr.when(b < acc, F.lit(name))
    return df.withColumn("variant", expr)


def first_exposure(events: DataFrame, id_col: str, time_col: str, exposure: Column, salt: str,
                   weights=(("control", 50), ("treatment", 50))) -> DataFrame:
    """Per id: variant and time of first exposure event."""
    e = events.filter(exposure & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(time_col).alias("first_exposure_time"))
    return assign_variant(e, id_col, salt, weights)


def user_outcomes(events: DataFrame, exposures: DataFrame, id_col: str, time_col: str,
                  conversion: Column, value_col: str, window_hours: int | None = None) -> DataFrame:
    """Per exposed id: events after exposure, converted flag and converted
    value (conversions counted within ``window_hours`` of exposure)."""
    j = events.join(exposures, id_col).filter(F.col(time_col) >= F.col("first_exposure_time"))
    if window_hours is not None:
        conversion = conversion & (F.col(time_col) < F.col("first_exposure_time")
                                   + F.make_interval(hours=F.lit(window_hours)))
    g = j.groupBy(id_col, "variant").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max(conversion.cast("int")).alias("converted"),
        F.sum(F.when(conversion, F.col(value_col)).otherwise(F.lit(0.0))).alias("revenue"))
    return g


def experiment_readout(outcomes: DataFrame) -> DataFrame:
    """Per variant: exposed ids, mean/variance of the leading metric (events
    per id), conversion rate and mean of the lagging metric (revenue)."""
    return outcomes.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg("n_events").alias("mean_events"), F.var_samp("n_events").alias("var_events"),
        F.avg("converted").alias("conversion_rate"),
        F.avg("revenue").alias("mean_revenue"), F.var_samp("revenue").alias("var_revenue"))


def compare_variants(readout: DataFrame, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Two-proportion z test on conversion and Welch t on revenue (treatment
    vs control), with a normal-approximation two-sided p-value."""
    def pick(c, v):
        return F.max(F.when(F.col("variant") == v, F.col(c)))
    cols = ["n_users", "conversion_rate", "mean_revenue", "var_revenue"]
    one = readout.agg(*[pick(c, control).alias(f"c_{c}") for c in cols],
                      *[pick(c, treatment).alias(f"t_{c}") for c in cols])
    n1, n2 = F.col("c_n_users").cast("double"), F.col("t_n_users").cast("double")
    p1, p2 = F.col("c_conversion_rate"), F.col("t_conversion_rate")
    pooled = (p1 * n1 + p2 * n2) / (n1 + n2)
    z = F.try_divide(p2 - p1, F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
    t = F.try_divide(F.col("t_mean_revenue") - F.col("c_mean_revenue"),
                     F.sqrt(F.col("c_var_revenue") / n1 + F.col("t_var_revenue") / n2))
    return one.select(p1.alias("control_rate"), p2.alias("treatment_rate"), z.alias("z"),
                      two_sided_p(z).alias("p_value"), t.alias("welch_t"))


def variant_row_filter(df: DataFrame, id_col: str, odd_variants: Sequence[str]) -> DataFrame:
    """Odd ids for ``odd_variants``, even ids for the others."""
    want = F.when(F.col("variant").isin(*odd_variants), F.lit(1)).otherwise(F.lit(0))
    return df.filter(F.pmod(F.col(id_col), F.lit(2)) == want)
