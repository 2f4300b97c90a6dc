"""Envelopes, landing, profiling.

The driver's tables hold rows, not documents, so rows are packed into documents of bounded
size first: the key of a document is a range of a unique id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_long_or_null, to_number_or_null
from ..session import scratch_dir
from ..sources import (
    document_structure,
    drift,
    element_profile,
    entity_columns,
    explode_payload,
    feed_profile,
    json_key_profile,
    land,
    latest_file,
    project_required,
    read_envelope,
    sort_out,
)
from ..sources.landing import LANDED_GLOB
from .products import props_k
from .registry import Tables, query

PER_DOCUMENT = 500


def pack(df: DataFrame, unique_id: str, fields: list[Column],
         size: int = PER_DOCUMENT) -> DataFrame:
    """``chunk, payload``: documents ``{"data": {"stations": [..]}}`` of at most ``size``
    elements in id order.  ``unique_id`` being unique bounds every group."""
    element = F.struct(F.col(unique_id).alias("id"), *fields)
    chunk = F.floor(F.col(unique_id) / size).alias("chunk")
    grouped = df.select(chunk, element.alias("e")).groupBy("chunk").agg(
        F.sort_array(F.collect_list("e")).alias("stations"))
    document = F.struct(F.lit(1).alias("version"), F.struct("stations").alias("data"))
    return grouped.select("chunk", F.to_json(document, {"ignoreNullFields": "false"})
                          .alias("payload"))


def event_documents(tables: Tables) -> DataFrame:
    """Errors lack their value: the field is there, but null."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return pack(tables("events").withColumn("k", props_k()), "event_id", [
        F.col("user_id").alias("stationCode"), F.col("event_type").alias("name"),
        value.alias("value"), F.struct(F.col("k").alias("k")).alias("nested")])


RENAMED = {"id": "event_id", "stationCode": "user_id", "name": "event_type"}


def _typed(elements: DataFrame) -> DataFrame:
    """Projection, renaming and coercion of the elements' text columns."""
    fields = ["chunk", "pos", "id", "stationCode", "name", "value", "nested"]
    return project_required(elements, fields).withColumnsRenamed(RENAMED).withColumns({
        "event_id": to_long_or_null(F.col("event_id")),
        "user_id": to_long_or_null(F.col("user_id")),
        "value": to_number_or_null(F.col("value"))})


ENVELOPE_SQL = f"""
    SELECT event_id // {PER_DOCUMENT} AS chunk,
           row_number() OVER (PARTITION BY event_id // {PER_DOCUMENT} ORDER BY event_id) - 1
               AS pos,
           event_id, user_id, event_type,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           concat('{{"k":', json_extract_string(props, '$.k'), '}}') AS nested
    FROM events"""


@query("envelope_explode", ENVELOPE_SQL)
def envelope_explode(tables: Tables) -> DataFrame:
    elements = explode_payload(event_documents(tables), "payload")
    return _typed(entity_columns(elements, ["id", "stationCode", "name", "value", "nested"]))


@query("landing_roundtrip", ENVELOPE_SQL)
def landing_roundtrip(tables: Tables) -> DataFrame:
    """The same documents written as files and scanned from there."""
    path = scratch_dir(tables.spark, "landing")
    documents = event_documents(tables).withColumn("feed", F.lit("events")).withColumn(
        "at", F.lit("2024-01-31 00:00:00").cast("timestamp"))
    land(documents, path, "feed", "at", "payload")
    elements = read_envelope(tables.spark, path, glob=LANDED_GLOB)
    columns = entity_columns(elements, ["id", "stationCode", "name", "value", "nested"])
    first = to_long_or_null(F.col("id"))
    return _typed(columns.withColumn("chunk", F.floor(first / PER_DOCUMENT))).drop(
        "file", "file_time")


@query("latest_landing", """
    SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS events,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total
    FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
    GROUP BY 1""")
def latest_landing(tables: Tables) -> DataFrame:
    """One document per day is landed, the last day after the others; only the newest file is
    read back."""
    path = scratch_dir(tables.spark, "landing")
    days = tables("events").select(F.to_date("ts").alias("d"), props_k()).groupBy("d").agg(
        F.count(F.lit(1)).alias("events"), F.sum("k").alias("total"))
    document = F.struct(F.struct(F.array(F.struct(
        F.col("d").cast("string").alias("day"), "events", "total")).alias("stations"))
        .alias("data"))
    documents = days.select("d", F.to_json(document).alias("payload"),
                            F.lit("daily").alias("feed"), F.col("d").cast("timestamp").alias("at"))
    newest = F.lit(days.agg(F.max("d")).first()[0])
    land(documents.filter(F.col("d") < newest), path, "feed", "at", "payload")
    land(documents.filter(F.col("d") == newest), path, "feed", "at", "payload")
    file = latest_file(tables.spark, path, LANDED_GLOB)
    elements = read_envelope(tables.spark, file, glob=LANDED_GLOB)
    return entity_columns(elements, ["day", "events", "total"]).select(
        "day", to_long_or_null(F.col("events")).alias("events"),
        to_long_or_null(F.col("total")).alias("total"))


@query("damaged_documents", f"""
    SELECT event_id // {PER_DOCUMENT} AS chunk,
           CASE event_id // {PER_DOCUMENT} % 5 WHEN 0 THEN 'malformed document'
                WHEN 1 THEN 'document without data.stations' WHEN 2 THEN 'empty document' END AS reason,
           count(*) FILTER (event_id // {PER_DOCUMENT} % 5 > 2) AS elements
    FROM events GROUP BY 1, 2""")
def damaged_documents(tables: Tables) -> DataFrame:
    """Of every five documents one has lost its end, one its array and one all; the others go on."""
    kind = F.col("chunk") % 5
    documents = event_documents(tables).withColumn("payload", (
        F.when(kind == 0, F.expr("left(payload, length(payload) - 9)"))
        .when(kind == 1, F.replace("payload", F.lit('"stations"'), F.lit('"others"')))
        .when(kind == 2, F.lit(" ")).otherwise(F.col("payload"))))
    sound, damaged = sort_out(documents)
    counted = explode_payload(sound, "payload").groupBy("chunk").agg(F.count(F.lit(1)).alias("elements"))
    return counted.select("chunk", F.lit(None).cast("string").alias("reason"), "elements").unionByName(
        damaged.select("chunk", "reason", F.lit(0).cast("long").alias("elements")))


@query("feed_drift", f"""
    WITH last AS (SELECT max(event_id // {PER_DOCUMENT}) AS n FROM events),
    changes AS (SELECT 2 AS chunk, 'value' AS key, 'removed' AS change, 'DOUBLE' AS before, NULL AS after
          UNION ALL SELECT 2, 'k', 'added', NULL, 'BIGINT' UNION ALL SELECT 4, 'k', 'removed', 'BIGINT', NULL
          UNION ALL SELECT 4, 'value', 'added', NULL, 'STRING'
          UNION ALL SELECT 6, 'value', 'type', 'STRING', 'DOUBLE')
    SELECT 'events' AS feed, c.chunk::BIGINT AS chunk, key, change, before, after
    FROM changes c, last WHERE c.chunk <= n""")
def feed_drift(tables: Tables) -> DataFrame:
    """Snapshots in which a measure goes, comes back as text, and is a number again."""
    kind = F.floor(F.col("event_id") / PER_DOCUMENT / 2)
    events = tables("events").withColumn("k", props_k())

    def documents(rows: DataFrame, fields: list[Column]) -> DataFrame:
        return pack(rows, "event_id", [F.col("user_id").alias("stationCode"), *fields])

    number, text = (F.col("value") + 0.5).alias("value"), F.concat(F.lit("v"), "value").alias("value")
    packed = (documents(events.filter((kind == 0) | (kind > 2)), [number])
              .unionByName(documents(events.filter(kind == 1), [F.col("k")]))
              .unionByName(documents(events.filter(kind == 2), [text])))
    structures = document_structure(packed.withColumn("feed", F.lit("events")), "payload")
    return drift(structures, ["feed"], ["chunk"])


@query("json_profile", """
    SELECT 'k' AS key, count(*) AS occurrences,
           count(*) FILTER (json_extract_string(props, '$.k') IS NULL) AS nulls,
           'BIGINT' AS inferred_type
    FROM events""")
def json_profile(tables: Tables) -> DataFrame:
    return json_key_profile(tables("events"), "props")


@query("json_profile_damaged", """
    SELECT CASE WHEN event_id % 10 <> 0 THEN 'k' END AS key, count(*) AS occurrences,
           count(*) FILTER (event_id % 10 = 0) AS nulls,
           CASE WHEN event_id % 10 <> 0 THEN 'BIGINT' ELSE 'VOID' END AS inferred_type
    FROM events GROUP BY ALL""")
def json_profile_damaged(tables: Tables) -> DataFrame:
    """Every tenth object has lost its end."""
    cut = F.expr("left(props, length(props) - 1)")
    props = F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.col("props"))
    return json_key_profile(tables("events").select(props.alias("props")), "props")


@query("feed_profile", f"""
    SELECT event_id // {PER_DOCUMENT} AS chunk, 'version,data' AS document_keys,
           'stations' AS parent_keys, count(*) AS element_count,
           min(event_id) AS first_id
    FROM events GROUP BY 1""")
def document_profile(tables: Tables) -> DataFrame:
    profile = feed_profile(event_documents(tables), "payload")
    return profile.select(
        "chunk", F.concat_ws(",", "document_keys").alias("document_keys"),
        F.concat_ws(",", "parent_keys").alias("parent_keys"), "element_count",
        F.get_json_object("first_element", "$.id").cast("bigint").alias("first_id"))


@query("element_profile", """
    SELECT unnest(['id', 'stationCode', 'name', 'value', 'nested']) AS key,
           count(*) AS occurrences,
           unnest([0, 0, 0, count(*) FILTER (event_type = 'error'), 0])::BIGINT AS nulls,
           unnest(['BIGINT', 'BIGINT', 'STRING', 'DOUBLE', 'OBJECT<k: BIGINT>']) AS inferred_type
    FROM events""")
def column_profile(tables: Tables) -> DataFrame:
    return element_profile(event_documents(tables), "payload")
