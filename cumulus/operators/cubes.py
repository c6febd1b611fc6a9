"""Grouping-set dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.operators.stored import replace_partitions


def fill_unknown(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Dimension NULLs become 'unknown' so that '(overall)' never means missing."""
    return df.select(*[F.coalesce(F.col(c), F.lit(K.UNKNOWN)).alias(c) if c in dims else F.col(c)
                       for c in df.columns])


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Sequence[Column],
                  labels: dict | None = None, fill: str | None = K.OVERALL) -> DataFrame:
    """GROUP BY GROUPING SETS with a level label from ``grouping()``.

    ``labels`` maps a tuple of grouped columns to its label (default: the
    names joined by '__').  Rolled-up dimensions are filled with ``fill``.
    """
    dims = sorted({c for s in sets for c in s}, key=lambda c: [c in s for s in sets].index(True))
    gcols = {c: F.grouping(c).alias(f"_g_{c}") for c in dims}
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        *aggs, *gcols.values())
    level = None
    for s in sets:
        cond = F.lit(True)
        for c in dims:
            cond = cond & (F.col(f"_g_{c}") == (0 if c in s else 1))
        name = (labels or {}).get(tuple(s), "__".join(s))
        level = F.when(cond, F.lit(name)) if level is None else level.when(cond, F.lit(name))
    out = g.select(level.alias("aggregation_level"),
                   *[(F.coalesce(F.col(c).cast("string"), F.lit(fill)) if fill is not None else F.col(c)).alias(c)
                     for c in dims],
                   *[c for c in g.columns if c not in dims and not c.startswith("_g_")])
    return out


# --- a cube that is stored and loaded day by day --------------------------------

LEVEL, DAY = "aggregation_level", "day"


def cube_rows(df: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[str], day_col: str,
              labels: dict | None = None) -> DataFrame:
    """Partial sums of every level and day: rows of one day add up to any span of days."""
    by_day = [[*s, day_col] for s in sets]
    names = {tuple([*s, day_col]): (labels or {}).get(tuple(s), "__".join(s)) for s in sets}
    rows = grouping_sets(df, by_day, [F.sum(m).alias(m) for m in measures], names)
    return rows.withColumn(day_col, F.col(day_col).cast("date")).withColumnRenamed(day_col, DAY)


def create_cube(rows: DataFrame, table: str) -> None:
    """Partitioned by level, then day: a slice of one level opens no other, a day is replaced alone."""
    rows.write.format("parquet").partitionBy(LEVEL, DAY).saveAsTable(table)


def load_cube_day(table: str, rows: DataFrame, day) -> None:
    """The cube rows of one day (``cube_rows`` of its facts) replace what is stored of it, at every level."""
    replace_partitions(table, rows, F.col(DAY) == F.lit(day).cast("date"))


def cube_slice(cube: DataFrame, level: str, dims: Sequence[str], measures: Sequence[str], first=None, last=None) -> DataFrame:
    """Totals of one level over the days from ``first`` to ``last`` (None: unbounded), from the stored partial sums."""
    rows = cube.where(F.col(LEVEL) == level)
    if first is not None:
        rows = rows.where(F.col(DAY) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col(DAY) <= F.lit(last).cast("date"))
    return rows.groupBy(LEVEL, *dims).agg(*[F.sum(m).alias(m) for m in measures])
