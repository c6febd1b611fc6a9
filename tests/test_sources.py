"""Sources and sinks: CSV with schema, dynamic partition overwrite, CTAS,
upsert to a new path, catalogue lookup, schema drift, Kafka record shape."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from cumulus.operators.quality import schema_changes
from cumulus.sources import sinks
from cumulus.sources.tables import list_columns, read_csv, table
from cumulus.streaming.kafka import to_kafka_value
from tests.conftest import SF_SMALL


def test_csv_roundtrip_with_schema(spark):
    base = tempfile.mkdtemp(prefix="cumulus-csv-")
    df = table(spark, SF_SMALL, "nation")
    sinks.write_csv(df, f"{base}/nation")
    back = read_csv(spark, f"{base}/nation", "n_nationkey int, n_name string, n_regionkey int")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_dynamic_partition_overwrite_keeps_other_days(spark):
    base = tempfile.mkdtemp(prefix="cumulus-parts-") + "/t"
    day = lambda s: dt.date.fromisoformat(s)
    first = spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-01-02"))], "v int, ds date")
    sinks.append(first, base, ["ds"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, day("2024-01-02"))], "v int, ds date"), base, ["ds"])
    got = sorted((r.v, r.ds.isoformat()) for r in spark.read.parquet(base).collect())
    assert got == [(1, "2024-01-01"), (9, "2024-01-02")]


def test_ctas_and_upsert_to_new_path(spark):
    base = tempfile.mkdtemp(prefix="cumulus-ctas-")
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.create_table_as(t, "t_ctas", path=f"{base}/t")
    try:
        sinks.upsert_to(spark.table("t_ctas"), spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"),
                        ["k"], f"{base}/t2")
        assert sorted(map(tuple, spark.read.parquet(f"{base}/t2").collect())) == [(1, "a"), (2, "B"), (3, "c")]
    finally:
        spark.sql("DROP TABLE IF EXISTS t_ctas")


def test_catalogue_and_schema_drift(spark):
    ev = table(spark, SF_SMALL, "events")
    cols = {r.column_name: r.data_type for r in list_columns(ev).collect()}
    assert cols["user_id"] == "bigint" and cols["ts"] == "timestamp_ntz"
    drift = {(r.column_name, r.change) for r in schema_changes(
        ev.drop("props").withColumn("extra", F.lit(1)),
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value int, props string").collect()}
    assert drift == {("props", "removed"), ("extra", "added"), ("value", "retyped")}


def test_kafka_record_shape(spark):
    df = spark.createDataFrame([(1, "x")], "id long, s string")
    r = to_kafka_value(df, "id").first()
    assert r.key == "1" and r.value == '{"id":1,"s":"x"}'


def test_job_runner_writes_partitions(spark):
    from cumulus.__main__ import main
    out = tempfile.mkdtemp(prefix="cumulus-job-") + "/flags"
    assert main(["activity_flags", "--sf", SF_SMALL, "--out", out, "--partition-by", "date"]) == 0
    back = spark.read.parquet(out)
    assert back.count() == table(spark, SF_SMALL, "events").select("user_id").distinct().count()
    assert "date" in back.columns
