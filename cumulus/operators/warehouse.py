"""Physical layout and join-strategy operators: bucketed tables, local vs
global sort, file-layout statistics, load-time validation and shared
aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bucketed_save(df: DataFrame, table: str, key: str, buckets: int = 16, sort: bool = True,
                  mode: str = "overwrite", path: str | None = None) -> None:
    """Write ``df`` as a bucketed (and sorted) table so that joins on ``key``
    between tables with the same bucket count need no Exchange."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def clean_load(df: DataFrame, keys: Sequence[str], dedupe_on: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL key, then exact (or subset) duplicates."""
    out = df.dropna(subset=list(keys))
    return out.dropDuplicates(list(dedupe_on)) if dedupe_on else out.dropDuplicates()


def local_sort(df: DataFrame, key: str, sort_cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Cluster rows by ``key`` into ``n`` partitions (default: as many as AQE
    finds their bytes need), sorted inside each partition (no global sort) -
    better compression for written files."""
    by_key = df.repartition(F.col(key)) if n is None else df.repartition(n, F.col(key))
    return by_key.sortWithinPartitions(*sort_cols)


def global_sort(df: DataFrame, sort_cols: Sequence[str]) -> DataFrame:
    return df.sort(*sort_cols)


def layout_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Total bytes and file count per written layout (UNION ALL of one row
    per path), read from the ``_metadata`` column of each scan."""
    frames = []
    for label, path in paths.items():
        files = (spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct())
        frames.append(files.agg(F.sum("file_size").alias("total_bytes"),
                                F.count(F.lit(1)).alias("num_files")).select(F.lit(label).alias("layout"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def shared_aggregate(events: DataFrame, key: str, by: str, set_col: str, cache: bool = False) -> DataFrame:
    """(key, by) -> event count and the sorted distinct ``set_col`` values;
    optionally cached because several reports reuse it.  A (key, by) holds at
    most as many values as ``set_col`` has: choose one with few (hosts)."""
    agg = events.groupBy(key, by).agg(F.count(F.lit(1)).alias("n_events"),
                                      F.sort_array(F.collect_set(set_col)).alias(f"{set_col}s"))
    return agg.cache() if cache else agg


def pruned_join(fact: DataFrame, header: DataFrame, key: str, date_col: str, start, end) -> DataFrame:
    """Join with a date predicate on the header side; the predicate reaches
    the header scan (and partition pruning when the table is partitioned by
    date), and dynamic partition pruning can filter the fact side."""
    h = header.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) <= F.lit(end)))
    return fact.join(h, key)
