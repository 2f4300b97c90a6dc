"""Streams driven to the end of the available data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedup_batch, hourly_partials, insert_new, partials_to_profile
from ..session import scratch_dir
from ..sources import AppendTable, VersionedTable, staging
from ..streaming import latest_state, start_latest
from .merging import DELIVERED
from .products import HOURLY_SQL, USAGE, props_k, usage_dimension
from .registry import Tables, query


def _event_stream(tables: Tables) -> DataFrame:
    return (tables.spark.readStream.schema(tables("events").schema)
            .option("pathGlobFilter", "events.parquet").parquet(tables.folder))


def _drain(stream: DataFrame, consume, checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


@query("stream_hourly_profile", HOURLY_SQL)
def stream_hourly_profile(tables: Tables) -> DataFrame:
    """Each micro-batch writes its partials under its own id, so a repeated batch replaces
    them; the profile is rolled up from the table."""
    path = scratch_dir(tables.spark, "stream-partials")

    def consume(batch: DataFrame, batch_id: int) -> None:
        readings = batch.select("user_id", "ts", props_k())
        hourly_partials(readings, USAGE, day=F.to_date("ts")).write.mode("overwrite") \
            .parquet(f"{path}/batch={batch_id}")

    _drain(_event_stream(tables), consume, scratch_dir(tables.spark, "checkpoint"))
    return partials_to_profile(tables.spark.read.parquet(path), usage_dimension(tables), USAGE)


LATEST = T.StructType([
    T.StructField("user_id", T.LongType(), False), T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("event_id", T.LongType(), False), T.StructField("value", T.DoubleType(), True)])


@query("stream_current", """
    SELECT user_id, ts, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""")
def stream_current(tables: Tables) -> DataFrame:
    """Latest event per user as a stateful stream: three deliveries dealt by id, so that each holds
    rows later and earlier than those before, with a restart from the state after each."""
    spark = tables.spark
    table = VersionedTable(spark, scratch_dir(spark, "latest"), LATEST)
    landed, checkpoint = scratch_dir(spark, "stream-landed"), scratch_dir(spark, "checkpoint")
    events = tables("events").select(*LATEST.fieldNames())
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(LATEST).parquet(landed)
        start_latest(latest_state(stream, ["user_id"], "ts", first=["event_id"]), table, ["user_id"],
                     checkpoint).awaitTermination()
    return table.read()


@query("stream_insert_ignore", """
    SELECT user_id, ts, event_id, 1::BIGINT AS delivery FROM events""")
def stream_insert_ignore(tables: Tables) -> DataFrame:
    """Every event is delivered twice, over several files and triggers whose days overlap: a
    repeat falls out against its batch or the table, a late first arrival stays."""
    spark = tables.spark
    table = AppendTable(spark, scratch_dir(spark, "stream-table"), DELIVERED, "ts")
    landed = scratch_dir(spark, "stream-landed")
    events = tables("events").select("user_id", "ts", "event_id")
    for _ in range(2):
        events.repartition(3, "event_id").write.mode("append").parquet(landed)
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(landed))

    def consume(batch: DataFrame, batch_id: int) -> None:
        with staging(spark) as stage:
            rows = stage(dedup_batch(batch, ["user_id", "ts"]).withColumn("delivery", F.lit(1)))
            table.append(insert_new(table.colliding(rows), rows, ["user_id", "ts"]))

    _drain(stream, consume, scratch_dir(spark, "checkpoint"))
    return table.read()
