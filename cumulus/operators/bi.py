"""Report-sheet queries: sums per class, top-N by distinct count or sum,
monthly totals and averages over a top-N subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def top_by(df: DataFrame, keys: Sequence[str], agg: Column, name: str, n: int = 20) -> DataFrame:
    """Top ``n`` groups by an aggregate; ties broken by the keys."""
    g = df.groupBy(*keys).agg(agg.alias(name))
    return g.orderBy(F.col(name).desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def monthly(df: DataFrame, date_col: str, measure: str, name: str) -> DataFrame:
    return df.groupBy(F.trunc(F.to_date(date_col), "MM").alias("month")).agg(F.sum(measure).alias(name))


def avg_over_top(df: DataFrame, key: str, rank_measure: str, avg_measure: str, n: int = 20) -> DataFrame:
    """Average of ``avg_measure`` for the top ``n`` keys chosen by SUM(rank_measure), highest average first."""
    g = df.groupBy(key).agg(F.sum(rank_measure).alias(f"total_{rank_measure}"),
                            F.avg(avg_measure).alias(f"avg_{avg_measure}"))
    top = g.orderBy(F.col(f"total_{rank_measure}").desc(), F.col(key).asc()).limit(n)
    return top.orderBy(F.col(f"avg_{avg_measure}").desc(), F.col(key).asc())
