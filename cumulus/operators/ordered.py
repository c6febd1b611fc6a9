"""Skew-safe running counts and row numbers inside (possibly huge) groups.

A window ``PARTITION BY g ORDER BY o`` sorts each group in one task, so a
group holding a large share of the rows becomes a straggler.  Here the order
key is cut into buckets that are monotone in the order (e.g. minute of day,
or id ranges):

1. a window inside each (group, bucket) only (running values and the
   bucket's totals);
2. prefix sums over the buckets of each group - a window over the small
   bucket table (one row per bucket, not per input row);
3. an equi-join back on (group, bucket).

The result equals the plain window as long as ``bucket`` never decreases
when the order increases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column,
                   value: Column | None = None, ties: str = "rows",
                   rn_col: str = "_rn", cum_col: str = "_cum") -> DataFrame:
    """Add ``rn_col`` (rows up to and including this one) and ``cum_col``
    (running sum of ``value``) in ``order`` within ``group``.

    ``ties="rows"`` numbers rows one by one (ROW_NUMBER / ROWS frame);
    ``ties="range"`` counts every row whose order key is <= this one's
    (RANGE frame, peers included).

    Plan: one Exchange of the input on (group, bucket) feeds the in-bucket
    window; the per-bucket totals are read off the same windowed rows (both
    branches start from that shuffle, which Spark reuses when the pruned
    plans coincide), prefix-summed per group on the small bucket table and
    joined back on (group, bucket), where the large side is already
    partitioned.
    """
    group = list(group)
    v = F.lit(0).cast("bigint") if value is None else value
    # the group as one struct key: a NULL group value still matches itself in
    # the equi-join below, and windows and join share one hash key
    if len(group) == 1 and isinstance(df.schema[group[0]].dataType, StructType):
        gk = F.col(group[0])          # already a struct key: keep the caller's partitioning
    else:
        gk = F.struct(*[F.col(g) for g in group])
    t = df.withColumn("_rt_gk", gk).withColumn("_rt_bk", bucket).withColumn("_rt_v", v)
    inner = Window.partitionBy("_rt_gk", "_rt_bk").orderBy(*order)
    whole = Window.partitionBy("_rt_gk", "_rt_bk")
    if ties == "range":
        frame = inner.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        rn = F.count(F.lit(1)).over(frame)
    else:
        frame = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rn = F.row_number().over(inner)
    tw = t.select("*", rn.alias("_rt_rn_in"), F.sum("_rt_v").over(frame).alias("_rt_cum_in"),
                  F.count(F.lit(1)).over(whole).alias("_rt_nb"), F.sum("_rt_v").over(whole).alias("_rt_sb"),
                  F.row_number().over(inner).alias("_rt_first"))
    per_b = tw.filter(F.col("_rt_first") == 1).select("_rt_gk", "_rt_bk", "_rt_nb", "_rt_sb")
    wb = Window.partitionBy("_rt_gk").orderBy("_rt_bk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_b.select("_rt_gk", "_rt_bk", F.coalesce(F.sum("_rt_nb").over(wb), F.lit(0)).alias("_rt_pn"),
                          F.coalesce(F.sum("_rt_sb").over(wb), F.lit(0)).alias("_rt_ps"))
    j = tw.join(prefix, ["_rt_gk", "_rt_bk"])
    return (j.withColumn(rn_col, F.col("_rt_pn") + F.col("_rt_rn_in"))
             .withColumn(cum_col, F.col("_rt_ps") + F.col("_rt_cum_in"))
             .drop("_rt_gk", "_rt_bk", "_rt_v", "_rt_pn", "_rt_ps", "_rt_rn_in", "_rt_cum_in", "_rt_nb", "_rt_sb", "_rt_first"))


def running_max(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, levels: Sequence[Column],
                name: str = "_max_before") -> DataFrame:
    """Add ``name``: the largest ``value`` of all earlier rows in ``order`` within ``group`` (NULL if there is none).

    ``levels``: buckets of the order from fine to coarse, each constant within
    the next and never decreasing in the order.  A window runs inside a
    finest bucket only; the maxima of buckets are carried over windows inside
    the next coarser bucket, level by level, and joined back down: no task sees
    more rows than a bucket has, or buckets than a coarser one has.
    """
    group, names = list(group), [f"_l{i}" for i in range(len(levels))]
    # one struct key: a NULL group or bucket still matches itself in the joins
    keys = [F.struct(*[F.col(g) for g in group], *[F.col(n) for n in names[i:]], F.lit(0)).alias(f"_k{i}")
            for i in range(len(names) + 1)]
    rows = df.select("*", *[c.alias(n) for c, n in zip(levels, names, strict=True)]).select("*", *keys)
    ks = [f"_k{i}" for i in range(len(keys))]

    def before(part: DataFrame, key: str, by: Sequence[str], v: str, out: str) -> DataFrame:
        w = Window.partitionBy(key).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return part.withColumn(out, F.max(v).over(w))

    # per level the maximum of each bucket, then the maximum of the buckets before it
    tops = rows.select(*ks, *names, F.col(value).alias("_v0")).groupBy("_k0", *ks[1:], *names).agg(F.max("_v0").alias("_v"))
    carried = []
    for i in range(len(names)):
        here = before(tops, ks[i + 1], [names[i]], "_v", "_b")
        carried.append(here.select(ks[i], F.col("_b").alias(f"_b{i}")))
        tops = tops.groupBy(*ks[i + 1:], *names[i + 1:]).agg(F.max("_v").alias("_v"))
    out = before(rows, "_k0", order, value, "_b")
    for i, c in enumerate(carried):
        out = out.join(c, ks[i])
    return out.withColumn(name, F.greatest("_b", *[f"_b{i}" for i in range(len(carried))])).drop(
        *ks, *names, "_b", *[f"_b{i}" for i in range(len(carried))])
