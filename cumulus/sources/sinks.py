"""Writers: append, dynamic partition overwrite, create-table-as, upsert
into a new location, CSV export, and a JDBC ``foreachBatch`` sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.operators.dedupe import upsert


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """INSERT INTO ... SELECT."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions present in ``df`` (dynamic partition
    overwrite): re-running one day replaces that day and keeps the others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def create_table_as(df: DataFrame, table: str, path: str | None = None,
                    partition_by: Sequence[str] = ()) -> None:
    """CREATE TABLE ... AS SELECT (Parquet, optionally partitioned)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE into an existing catalogue table, columns matched by name.

    A partitioned table loses only the partitions present in ``df`` if the
    session's ``spark.sql.sources.partitionOverwriteMode`` is dynamic.
    """
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def upsert_to(target: DataFrame, updates: DataFrame, keys: Sequence[str], out_path: str) -> None:
    """Upsert written to a new location (never the path being read)."""
    upsert(target, updates, keys).write.mode("overwrite").parquet(out_path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def epoch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function keeping each micro-batch in a partition ``epoch``
    of its own below ``path`` (one path per checkpoint): a batch that is
    replayed after a failure replaces what it wrote before."""

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    return sink


def jdbc_batch_sink(url: str, table: str, properties: dict | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function appending each micro-batch, with its ``epoch``,
    to a JDBC table (the driver jar for the target database must be on the
    classpath).  Delivery is at least once: a replayed batch repeats its rows
    under the same epoch."""
    props = dict(properties or {})

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("epoch", F.lit(epoch_id)).write.mode("append").jdbc(url, table, properties=props)

    return sink
