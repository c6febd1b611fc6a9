"""Kafka JSON source and sink builders for Structured Streaming.

They need the Spark-Kafka connector on the classpath (not bundled here), so
they are exercised only through the file source in tests; the event shape
after ``from_json`` is the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_json_source(spark: SparkSession, servers: str, topic: str, schema: T.StructType,
                      starting_offsets: str = "latest", options: dict | None = None) -> DataFrame:
    """Subscribe to ``topic`` and parse each JSON value with ``schema``."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    raw = r.load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_v")).select("_v.*")


def to_kafka_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Shape rows as Kafka records: JSON ``value`` (and optional ``key``)."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def kafka_json_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str | None = None):
    """Start an append-mode stream writing JSON records to ``topic``."""
    return (to_kafka_value(df, key_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).outputMode("append").start())
