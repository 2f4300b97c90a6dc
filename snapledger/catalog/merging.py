"""Upsert, insert-ignore, reload: through real tables in the scratch folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import insert_new, latest_one, require_unique, upsert
from ..session import scratch_dir
from ..sources import AppendTable, VersionedTable
from .registry import Tables, query

LAST_ORDER = T.StructType([
    T.StructField("o_custkey", T.LongType(), False),
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_orderdate", T.TimestampNTZType(), False),
    T.StructField("o_totalprice", T.DoubleType(), True),
])

SPLIT = "DATE '1998-01-01'"


def _last_orders(orders: DataFrame) -> DataFrame:
    return latest_one(orders.select(*LAST_ORDER.fieldNames()), ["o_custkey"],
                      [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("upsert_merge", f"""
    WITH last_orders AS (
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderdate >= {SPLIT} AS new,
               row_number() OVER (PARTITION BY o_custkey, o_orderdate >= {SPLIT}
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders)
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM last_orders t
    WHERE rn = 1 AND (new OR NOT EXISTS (
        SELECT 1 FROM last_orders s WHERE s.o_custkey = t.o_custkey AND s.new))""")
def upsert_merge(tables: Tables) -> DataFrame:
    """Last order per customer as of 1997, then merged with the last orders since 1998."""
    table = VersionedTable(tables.spark, scratch_dir(tables.spark, "last_order"), LAST_ORDER)
    orders = tables("orders")
    table.replace(_last_orders(orders.filter(f"o_orderdate < {SPLIT}")))
    source = require_unique(_last_orders(orders.filter(f"o_orderdate >= {SPLIT}")), ["o_custkey"])
    table.replace(upsert(table.read(), source, ["o_custkey"]))
    return table.read()


DELIVERED = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("event_id", T.LongType(), False),
    T.StructField("delivery", T.IntegerType(), False),
])


@query("insert_ignore", """
    SELECT user_id, ts, event_id,
           CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END::BIGINT AS delivery
    FROM events""")
def insert_ignore(tables: Tables) -> DataFrame:
    """A second delivery overlaps the first by ten days; stored rows stay as they are."""
    table = AppendTable(tables.spark, scratch_dir(tables.spark, "delivered"), DELIVERED, "ts")
    events = tables("events").select("user_id", "ts", "event_id")

    def bound(day: date):
        return F.lit(day).cast("timestamp_ntz")

    table.append(events.filter(F.col("ts") < bound(date(2024, 1, 20)))
                 .withColumn("delivery", F.lit(1)))
    batch = events.filter(F.col("ts") >= bound(date(2024, 1, 10))).withColumn(
        "delivery", F.lit(2))
    table.append(insert_new(table.colliding(batch), batch, ["user_id", "ts"]))
    return table.read()


@query("insert_ignore_straggler", """
    SELECT user_id, ts, event_id, 1::BIGINT AS delivery FROM events
    UNION ALL SELECT user_id, ts - INTERVAL 365 DAY, event_id, 2::BIGINT FROM events
    WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events)""")
def insert_ignore_straggler(tables: Tables) -> DataFrame:
    """A batch of the newest day again and of a day a year before: only these two are opened."""
    table = AppendTable(tables.spark, scratch_dir(tables.spark, "delivered"), DELIVERED, "ts")
    events = tables("events").select("user_id", "ts", "event_id")
    table.append(events.withColumn("delivery", F.lit(1)))
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    year = F.expr("INTERVAL 365 DAYS")
    late = events.filter(F.to_date("ts") == F.lit(first)).withColumn("ts", F.col("ts") - year)
    batch = events.filter(F.to_date("ts") == F.lit(last)).unionByName(late).withColumn("delivery", F.lit(2))
    for _ in range(2):
        table.append(insert_new(table.colliding(batch), batch, ["user_id", "ts"]))
    return table.read()


@query("compacted_log", """
    SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS events, sum(event_id)::BIGINT AS ids,
           CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) AS packed
    FROM events GROUP BY 1, 4""")
def compacted_log(tables: Tables) -> DataFrame:
    """A log appended in many small batches, its closed days packed into a file each; then the
    rest of its rows arrives."""
    table = AppendTable(tables.spark, scratch_dir(tables.spark, "log"), DELIVERED, "ts")
    events = tables("events").select("user_id", "ts", "event_id").withColumn("delivery", F.lit(1))
    for k in range(4):
        table.append(events.filter(F.col("event_id") % 5 == k))
    last = events.agg(F.max("ts").cast("date")).first()[0]
    packed = table.compact(last)
    table.append(events.filter(F.col("event_id") % 5 == 4))
    return table.read().groupBy(F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("ids")).select(
        F.col("d").cast("string").alias("day"), "events", "ids", F.col("d").isin(packed).alias("packed"))


BALANCE = T.StructType([
    T.StructField("c_mktsegment", T.StringType(), False),
    T.StructField("customers", T.LongType(), False),
    T.StructField("balance", T.DecimalType(18, 2), True),
])


@query("truncate_reload", """
    SELECT c_mktsegment, count(*) AS customers,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
    FROM customer GROUP BY c_mktsegment""")
def truncate_reload(tables: Tables) -> DataFrame:
    """A summary is replaced as a whole; readers of the table see only the last version."""
    table = VersionedTable(tables.spark, scratch_dir(tables.spark, "balance"), BALANCE)

    def summary(customers: DataFrame) -> DataFrame:
        return customers.groupBy("c_mktsegment").agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"))

    table.replace(summary(tables("customer").filter("c_acctbal < 0")))
    table.replace(summary(tables("customer")), sort=["c_mktsegment"])
    return table.read()
