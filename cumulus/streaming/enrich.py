"""Event enrichment: ISO event time to timestamp, and a geo JSON per IP
from an IP-range table via a bucketed range join (no per-row lookups)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.functions.columns import ipv4_to_long, json_object

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
BLOCK_BITS = 16


def range_lookup(events: DataFrame, ranges: DataFrame, ip_col: str, start_col: str = "ip_start",
                 end_col: str = "ip_end", max_blocks: int = 200_000) -> DataFrame:
    """Left-join every event to the range containing its IP.

    Ranges are listed by the /16 blocks they cover, at most one row a block;
    an event looks its block up and takes the first of the block's ranges that
    holds its address.  Of overlapping ranges the narrowest wins, then the one
    that starts first, so an event never comes out twice.  The listing is
    broadcast only if its size (summed over the ranges' blocks) is bounded.
    """
    ev = events.withColumn("_ip", ipv4_to_long(F.col(ip_col))).withColumn("_b", F.shiftright(F.col("_ip"), BLOCK_BITS))
    low, high = F.shiftright(F.col(start_col), BLOCK_BITS), F.shiftright(F.col(end_col), BLOCK_BITS)
    ordered = F.struct((F.col(end_col) - F.col(start_col)).alias("_w"), F.col(start_col).alias("_s"),
                       F.struct(*ranges.columns).alias("_range"))
    blocks = (ranges.select(F.explode(F.sequence(low, high)).alias("_b"), ordered.alias("_o"))
                    .groupBy("_b").agg(F.sort_array(F.collect_list("_o")).alias("_found")))
    size = ranges.agg(F.sum(high - low + 1)).first()[0] or 0
    blocks = F.broadcast(blocks) if size <= max_blocks else blocks
    holds = F.filter("_found", lambda o: F.col("_ip").between(o["_range"][start_col], o["_range"][end_col]))
    j = ev.join(blocks, "_b", "left").withColumn("_hit", F.get(holds, 0))
    return j.select(*events.columns, "_hit._range.*")


def enrich(events: DataFrame, ranges: DataFrame, ip_col: str, geo_fields: list[str], time_text_col: str,
           fmt: str = ISO_MILLIS) -> DataFrame:
    """Add ``event_timestamp`` (parsed) and ``geodata`` (JSON, '{}' when no range matches)."""
    j = range_lookup(events, ranges, ip_col)
    geo = F.when(F.col("ip_start").isNotNull(), json_object(*[(f, F.col(f)) for f in geo_fields])).otherwise(F.lit("{}"))
    return j.withColumn("event_timestamp", F.to_timestamp_ntz(F.col(time_text_col), F.lit(fmt))).withColumn("geodata", geo)


def stream_enrich(spark, source_dir: str, schema, ranges: DataFrame, ip_col: str, geo_fields: list[str],
                  time_text_col: str, checkpoint: str, sink, prepare=None, glob: str = "*.parquet",
                  trigger: dict | None = None):
    """Start a streaming enrichment (stream-static range join) into a
    ``foreachBatch`` sink; ``prepare`` maps the raw rows to the event shape."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source_dir)
    ev = prepare(raw) if prepare else raw
    out = enrich(ev, ranges, ip_col, geo_fields, time_text_col)
    return (out.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
               .trigger(**(trigger or {"availableNow": True})).start())
