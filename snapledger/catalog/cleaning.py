"""Coercion, filling, dedup, typing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    batch_instant,
    epoch_to_timestamp,
    instant_from_name,
    is_blank,
    pivot_sum,
    stamp,
    to_int_or_zero,
    to_long_or_null,
    to_number_or_null,
)
from ..operators import (
    conform,
    dedup_first,
    drop_incomplete,
    packed_key,
    surrogate_key,
    unpacked_key,
)
from .products import props_k
from .registry import Tables, query

NUMBER_SQL = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"

# The same number written as sensors write it: padded, with decimals, as an exponent,
# with a unit, or not at all.
RAW_NUMBER = """CASE event_type WHEN 'click' THEN concat(' ', k, ' ')
    WHEN 'view' THEN concat(k, '.7') WHEN 'purchase' THEN concat('-', k, 'e1')
    WHEN 'signup' THEN concat(k, 'd') ELSE 'n/a' END"""
EVENTS_K_SQL = ("(SELECT *, json_extract_string(props, '$.k') AS k FROM events)")


@query("clean_numeric", f"""
    SELECT event_id, raw, number, trunc(number)::BIGINT AS whole,
           coalesce(trunc(number)::BIGINT, 0) AS filled
    FROM (SELECT event_id, raw, CASE WHEN regexp_full_match(raw, {NUMBER_SQL})
                                     THEN TRY_CAST(trim(raw) AS DOUBLE) END AS number
          FROM (SELECT event_id, {RAW_NUMBER} AS raw FROM {EVENTS_K_SQL}))""")
def clean_numeric(tables: Tables) -> DataFrame:
    raw = F.col("raw")
    return (tables("events").select("event_id", "event_type", props_k())
            .withColumn("raw", F.expr(RAW_NUMBER))
            .select("event_id", "raw", to_number_or_null(raw).alias("number"),
                    to_long_or_null(raw).alias("whole"), to_int_or_zero(raw).alias("filled")))


@query("epoch_to_ts", """
    SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL
                          ELSE date_trunc('second', ts) END::TIMESTAMP AS reported
    FROM events""")
def epoch_to_ts(tables: Tables) -> DataFrame:
    """Epoch seconds as text; one event type reports garbage, one an impossible instant."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    raw = (F.when(F.col("event_type") == "error", F.lit("x"))
           .when(F.col("event_type") == "signup", F.lit("1e20")).otherwise(seconds))
    return tables("events").select(
        "event_id",
        epoch_to_timestamp(to_number_or_null(raw)).cast("timestamp_ntz").alias("reported"))


@query("batch_stamps", """
    SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS instant,
           strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
           date_trunc('second', ts)::TIMESTAMP AS parsed
    FROM events""")
def batch_stamps(tables: Tables) -> DataFrame:
    """Batch instant, its rendering in a file name, and the way back."""
    name = F.concat(F.lit("bronze/feed/feed_"), "stamp", F.lit(".json"))
    return tables("events").select(
        "event_id", batch_instant(F.col("ts")).cast("timestamp_ntz").alias("instant"),
        stamp(F.col("ts")).alias("stamp")).withColumn(
        "parsed", instant_from_name(name).cast("timestamp_ntz"))


# An array of one-key objects per event.  Purchases carry an element that is no object,
# errors are no array at all.
RAW_TYPES = """CASE event_type
    WHEN 'purchase' THEN concat('[5,{"any":1},{"', event_type, '":', k, '}]')
    WHEN 'error' THEN '"oops"'
    WHEN 'signup' THEN concat('[{"any":null},{"', event_type, '":', k, '},{"any":2}]')
    ELSE concat('[{"any":1},{"', event_type, '":"', k, '"}]') END"""


@query("nested_pivot_sum", """
    SELECT user_id,
           CAST(sum(CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 2 ELSE 1 END)
                AS BIGINT) AS items,
           CAST(sum(CASE WHEN event_type = 'click' THEN k ELSE 0 END) AS BIGINT) AS clicked,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN k ELSE 0 END) AS BIGINT) AS bought
    FROM (SELECT user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
          FROM events) GROUP BY user_id""")
def nested_pivot_sum(tables: Tables) -> DataFrame:
    keys = {"items": "any", "clicked": "click", "bought": "purchase"}
    raw = tables("events").select("user_id", "event_type", props_k()).withColumn(
        "types", F.expr(RAW_TYPES))
    return (raw.select("user_id", pivot_sum(F.col("types"), keys).alias("sums"))
            .groupBy("user_id").agg(*[F.sum(f"sums.{name}").alias(name) for name in keys]))


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                "l_shipdate"]


@query("dedup_first", f"""
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
           {', '.join(LINE_COLUMNS[2:])}
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {', '.join(LINE_COLUMNS)}) AS rn FROM lineitem)
    WHERE rn = 1""")
def first_of_key(tables: Tables) -> DataFrame:
    return dedup_first(tables("lineitem").select(*LINE_COLUMNS), ["l_orderkey", "l_linenumber"],
                       [F.col(c) for c in LINE_COLUMNS])


@query("drop_then_fill", """
    SELECT partkey, shipdate, count(*) AS rows, CAST(sum(coalesce(q, 0)) AS BIGINT) AS filled,
           CAST(sum(CASE WHEN q IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS gaps
    FROM (SELECT CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS partkey,
                 l_shipdate AS shipdate,
                 CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem)
    WHERE partkey IS NOT NULL GROUP BY partkey, shipdate""")
def drop_then_fill(tables: Tables) -> DataFrame:
    """Rows without a key go before the fill, so that no key 0 comes into being."""
    raw = tables("lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("partkey"),
        F.col("l_shipdate").alias("shipdate"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("string")).alias("q"))
    kept = drop_incomplete(raw, ["partkey", "shipdate"]).withColumn(
        "n", to_int_or_zero(F.col("q")))
    return kept.groupBy("partkey", "shipdate").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("filled"),
        F.sum(F.when(F.col("q").isNull(), 1).otherwise(0)).alias("gaps"))


VISIBLE_SQL = r"'[^\t-\r\x1c-\x20\x85\p{Z}]'"


def _blank_sql(origin: str, key: str, text: str, table: str) -> str:
    return f"""SELECT '{origin}' AS origin, {key} AS id,
        NOT regexp_matches({text}, {VISIBLE_SQL}) AS blank,
        len(list_filter(string_split({text}, chr(10)),
                        lambda x: NOT regexp_matches(x, {VISIBLE_SQL})))::BIGINT AS blank_lines
        FROM {table}"""


@query("blank_strings", _blank_sql("documents", "doc_id", "text", "documents") + " UNION ALL "
       + _blank_sql("pages", "page_id", "html", "pages"))
def blank_strings(tables: Tables) -> DataFrame:
    """Blank texts, and blank lines within texts."""

    def tested(origin: str, key: str, text: str) -> DataFrame:
        lines = F.split(text, "\n", -1)
        return tables(origin).select(
            F.lit(origin).alias("origin"), F.col(key).alias("id"),
            is_blank(F.col(text)).alias("blank"),
            F.size(F.filter(lines, is_blank)).alias("blank_lines"))

    return tested("documents", "doc_id", "text").unionByName(tested("pages", "page_id", "html"))


ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.LongType(), False),
    T.StructField("o_totalprice", T.DecimalType(12, 2), True),
    T.StructField("o_orderdate", T.TimestampNTZType(), True),
    T.StructField("o_orderpriority", T.StringType(), False),
    T.StructField("weight", T.DoubleType(), True),
    T.StructField("cancelled", T.BooleanType(), False),
    T.StructField("note", T.StringType(), True),
])


@query("conform_typed", """
    SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12, 2))::DOUBLE AS o_totalprice,
           o_orderdate, CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE o_orderpriority END
               AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS weight,
           false AS cancelled, NULL::VARCHAR AS note
    FROM orders""")
def conform_typed(tables: Tables) -> DataFrame:
    """Text columns in another order, gaps to default, NaN, and two columns missing."""
    raw = tables("orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("weight"))
    return conform(raw, ORDER_SCHEMA, {"o_orderpriority": "none", "cancelled": False})


@query("surrogate_keys", """
    SELECT o_orderpriority, count(*) AS rows, count(DISTINCT (o_custkey, o_orderdate)) AS ids
    FROM orders GROUP BY o_orderpriority""")
def surrogate_keys(tables: Tables) -> DataFrame:
    """As many ids as natural keys."""
    keyed = tables("orders").select("o_orderpriority",
                                    surrogate_key(["o_custkey", "o_orderdate"]).alias("id"))
    per_id = keyed.groupBy("o_orderpriority", "id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("o_orderpriority").agg(F.sum("n").alias("rows"),
                                                 F.count(F.lit(1)).alias("ids"))


@query("packed_keys", """
    SELECT o_orderkey, CAST(CAST(o_custkey AS HUGEINT) * 1000000000000000000
               + epoch_us(CAST(o_orderdate AS TIMESTAMP)) + 100000000000000000 AS VARCHAR) AS id,
           o_custkey AS number, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS micros
    FROM orders""")
def packed_keys(tables: Tables) -> DataFrame:
    """Keys that hold the natural key, and the natural key taken out of them again."""
    number, instant = unpacked_key("id")
    keyed = tables("orders").select("o_orderkey", packed_key("o_custkey", "o_orderdate")
                                    .alias("id"))
    return keyed.select("o_orderkey", F.col("id").cast("string").alias("id"),
                        number.alias("number"), F.unix_micros(instant).alias("micros"))
