"""Rules, suites, contracts, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import duplicated_keys, orphan_keys, orphan_sample
from ..quality import (
    TableContract,
    alerts_of,
    between,
    contract_counts,
    evaluate,
    exists,
    in_set,
    mark,
    not_null,
    row_count,
    unique,
)
from ..quality.quarantine import VIOLATIONS
from ..quality.rules import CRITICAL, WARNING, Rule
from ..schemas import RUNS_CONTRACT, STATION_CONTRACT
from ..sources import explode_payload
from .registry import Tables, query

OUTCOME = ["rule_name", "column_name", "checked", "unexpected", "success"]


def _outcome(df: DataFrame, *rules: Rule) -> DataFrame:
    return evaluate(df, rules).select(*OUTCOME)


def _rule_sql(rule: str, column: str, checked: str, bad: str, source: str,
              success: str | None = None) -> str:
    return f"""SELECT '{rule}' AS rule_name, '{column}' AS column_name,
        CAST({checked} AS BIGINT) AS checked, CAST({bad} AS BIGINT) AS unexpected,
        {success or f'{bad} = 0'} AS success FROM {source}"""


def _gapped_orders(tables: Tables) -> DataFrame:
    """orders without the lowest priority, and with NaN prices."""
    return tables("orders").select(
        "o_orderkey", "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("price"))


@query("rules_exists", "SELECT * FROM ("
       + _rule_sql("expect_column_to_exist", "o_orderkey", "count(*)", "0", "orders", "true")
       + " UNION ALL SELECT 'expect_column_to_exist', 'o_comment', NULL, NULL, false)")
def rules_exists(tables: Tables) -> DataFrame:
    return _outcome(tables("orders"), exists("o_orderkey"), exists("o_comment"))


@query("rules_not_null", " UNION ALL ".join([
    _rule_sql("expect_column_values_to_not_be_null", "priority",
              "count(*) FILTER (o_orderpriority <> '5-LOW')",
              "count(*) FILTER (o_orderpriority = '5-LOW')", "orders"),
    _rule_sql("expect_column_values_to_not_be_null", "price",
              "count(*) FILTER (o_orderstatus <> 'P')",
              "count(*) FILTER (o_orderstatus = 'P')", "orders"),
    _rule_sql("expect_column_values_to_not_be_null", "o_orderkey", "count(*)", "0", "orders")]))
def rules_not_null(tables: Tables) -> DataFrame:
    return _outcome(_gapped_orders(tables), not_null("priority"), not_null("price"),
                    not_null("o_orderkey"))


@query("rules_between", " UNION ALL ".join([
    _rule_sql("expect_column_values_to_be_between", "l_quantity", "count(l_quantity)",
              "count(*) FILTER (l_quantity NOT BETWEEN 0 AND 40)", "lineitem"),
    _rule_sql("expect_column_values_to_be_between", "l_discount", "count(l_discount)",
              "count(*) FILTER (l_discount NOT BETWEEN 0 AND 0.1)", "lineitem")]))
def rules_between(tables: Tables) -> DataFrame:
    return _outcome(tables("lineitem"), between("l_quantity", 0, 40),
                    between("l_discount", 0.0, 0.1))


@query("rules_in_set", " UNION ALL ".join([
    _rule_sql("expect_column_values_to_be_in_set", "o_orderstatus", "count(*)",
              "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", "orders"),
    _rule_sql("expect_column_values_to_be_in_set", "priority",
              "count(nullif(o_orderpriority, '5-LOW'))",
              "count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW'))",
              "orders")]))
def rules_in_set(tables: Tables) -> DataFrame:
    return _outcome(_gapped_orders(tables), in_set("o_orderstatus", ["F", "O"]),
                    in_set("priority", ["1-URGENT", "2-HIGH"]))


def _unique_sql(column: str, table: str) -> str:
    return _rule_sql("expect_column_values_to_be_unique", column, "coalesce(sum(n), 0)",
                     "coalesce(sum(n) FILTER (n > 1), 0)",
                     f"(SELECT {column}, count(*) AS n FROM {table} "
                     f"WHERE {column} IS NOT NULL GROUP BY {column})")


@query("rules_unique", _unique_sql("l_orderkey", "lineitem") + " UNION ALL "
       + _unique_sql("l_partkey", "lineitem"))
def rules_unique(tables: Tables) -> DataFrame:
    return _outcome(tables("lineitem"), unique("l_orderkey"), unique("l_partkey"))


def _count_sql(table: str, low: int, high: int) -> str:
    inside = f"count(*) BETWEEN {low} AND {high}"
    return _rule_sql("expect_table_row_count_to_be_between", "table", "count(*)",
                     f"CASE WHEN {inside} THEN 0 ELSE count(*) END", table, inside)


@query("rules_row_count", _count_sql("lineitem", 1, 1000) + " UNION ALL "
       + _count_sql("lineitem", 1, 10**15))
def rules_row_count(tables: Tables) -> DataFrame:
    return _outcome(tables("lineitem"), row_count(1, 1000), row_count(1, 10**15))


@query("rules_row_count_per_snapshot", """
    SELECT 'expect_table_row_count_to_be_between' AS rule_name, 'table' AS column_name,
           CAST(sum(n) AS BIGINT) AS checked,
           CAST(coalesce(sum(n) FILTER (n NOT BETWEEN 1 AND 30), 0) AS BIGINT) AS unexpected,
           count(*) FILTER (n NOT BETWEEN 1 AND 30) = 0 AS success
    FROM (SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY l_shipdate)""")
def rules_row_count_per_snapshot(tables: Tables) -> DataFrame:
    """Each ship date is a snapshot; each must have an acceptable number of rows."""
    return evaluate(tables("lineitem"), [row_count(1, 30)], snapshot="l_shipdate").select(*OUTCOME)


@query("rules_row_count_empty_snapshot", """
    SELECT 'expect_table_row_count_to_be_between' AS rule_name, 'table' AS column_name,
           CAST(sum(n) AS BIGINT) AS checked,
           CAST(coalesce(sum(n) FILTER (n NOT BETWEEN 1 AND 3), 0) AS BIGINT) AS unexpected,
           count(*) FILTER (n NOT BETWEEN 1 AND 3) = 0 AS success
    FROM (SELECT count(*) FILTER (event_type = 'error') AS n FROM events GROUP BY event_id // 5)
    UNION ALL
    SELECT 'expect_table_row_count_to_be_between', 'table', count(*), 0, true
    FROM events WHERE event_type = 'error'""")
def rules_row_count_empty_snapshot(tables: Tables) -> DataFrame:
    """Documents of the errors among five events; most of them are empty, and count as such.

    Where a snapshot may be empty, the second rule holds.
    """
    error = F.when(F.col("event_type") == "error", F.struct(F.col("event_id").alias("id")))
    packed = tables("events").groupBy(F.floor(F.col("event_id") / 5).alias("chunk")).agg(
        F.collect_list(error).alias("stations"))
    documents = packed.select("chunk", F.to_json(F.struct(F.struct("stations").alias("data")))
                              .alias("payload"))
    elements = explode_payload(documents, "payload", keep_empty=True)
    return evaluate(elements, [row_count(1, 3), row_count(0, 5)], snapshot="chunk",
                    element="pos").select(*OUTCOME)


LINE_RULES = [
    exists("l_orderkey", reason="identifies the order"),
    not_null("l_partkey", reason="refers to the part"),
    between("l_quantity", 0, 40, reason="more than the largest shelf"),
    between("l_tax", 0.0, 0.05, CRITICAL, reason="no region's rate is higher"),
    in_set("l_returnflag", ["A", "N"], reason="returns are handled elsewhere"),
    unique("l_orderkey", WARNING, reason="one line per order"),
    exists("l_comment", WARNING, reason="shown to staff"),
    not_null("l_comment", WARNING, reason="shown to staff"),
    row_count(1, 10**15, reason="an empty delivery"),
]

SUITE_SQL = " UNION ALL ".join([
    "SELECT 1 AS rule_no, 'CRITICAL' AS severity, * FROM ("
    + _rule_sql("expect_column_to_exist", "l_orderkey", "count(*)", "0", "lineitem", "true") + ")",
    "SELECT 2, 'CRITICAL', * FROM (" + _rule_sql(
        "expect_column_values_to_not_be_null", "l_partkey", "count(l_partkey)",
        "count(*) FILTER (l_partkey IS NULL)", "lineitem") + ")",
    "SELECT 3, 'WARNING', * FROM (" + _rule_sql(
        "expect_column_values_to_be_between", "l_quantity", "count(l_quantity)",
        "count(*) FILTER (l_quantity NOT BETWEEN 0 AND 40)", "lineitem") + ")",
    "SELECT 4, 'CRITICAL', * FROM (" + _rule_sql(
        "expect_column_values_to_be_between", "l_tax", "count(l_tax)",
        "count(*) FILTER (l_tax NOT BETWEEN 0 AND 0.05)", "lineitem") + ")",
    "SELECT 5, 'WARNING', * FROM (" + _rule_sql(
        "expect_column_values_to_be_in_set", "l_returnflag", "count(l_returnflag)",
        "count(*) FILTER (l_returnflag NOT IN ('A', 'N'))", "lineitem") + ")",
    "SELECT 6, 'WARNING', * FROM (" + _unique_sql("l_orderkey", "lineitem") + ")",
    "SELECT 7, 'WARNING', 'expect_column_to_exist', 'l_comment', NULL, NULL, false",
    "SELECT 8, 'WARNING', 'expect_column_values_to_not_be_null', 'l_comment', NULL, NULL, false",
    "SELECT 9, 'CRITICAL', * FROM (" + _count_sql("lineitem", 1, 10**15) + ")",
])


@query("suite_results", f"SELECT rule_no::BIGINT AS rule_no, severity, {', '.join(OUTCOME)} "
                        f"FROM ({SUITE_SQL})")
def suite_results(tables: Tables) -> DataFrame:
    return evaluate(tables("lineitem"), LINE_RULES).select("rule_no", "severity", *OUTCOME)


@query("suite_tally", f"""
    SELECT count(*) AS nb_expectations, count(*) FILTER (success) AS nb_successful,
           count(*) FILTER (NOT success) AS nb_failed, bool_and(success) AS success
    FROM ({SUITE_SQL})""")
def suite_tally(tables: Tables) -> DataFrame:
    return evaluate(tables("lineitem"), LINE_RULES).agg(
        F.count(F.lit(1)).alias("nb_expectations"), F.count_if("success").alias("nb_successful"),
        F.count_if(~F.col("success")).alias("nb_failed"), F.bool_and("success").alias("success"))


REASONS_SQL = "CASE rule_no " + " ".join(
    f"WHEN {i} THEN '{r.reason.replace(chr(39), chr(39) * 2)}'"
    for i, r in enumerate(LINE_RULES, 1)) + " END"

ALERTS_SQL = f"""
    SELECT TIMESTAMP '2024-01-31 00:00:00' AS detected_at, 'nightly' AS dag_id,
           'line_suite' AS suite_name, column_name, rule_name, severity,
           {REASONS_SQL} AS detail, false AS resolved
    FROM ({SUITE_SQL}) WHERE NOT success"""


def line_alerts(tables: Tables) -> DataFrame:
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return alerts_of(evaluate(tables("lineitem"), LINE_RULES), "line_suite", "nightly", at)


@query("suite_alerts", ALERTS_SQL)
def suite_alerts(tables: Tables) -> DataFrame:
    return line_alerts(tables)


LINE_CONTRACT = TableContract(
    name="lineitem", required=["l_orderkey", "l_linenumber"],
    not_null=["l_orderkey", "l_shipdate"], not_blank=["l_returnflag"],
    checks=["l_quantity >= 2", "l_discount BETWEEN 0 AND 0.05"],
    max_length={"l_linestatus": 1}, digits={"l_extendedprice": (7, 2)},
    unique=[["l_orderkey", "l_linenumber"]],
    foreign_keys={"l_suppkey": ("supplier", "s_suppkey")})


@query("contract_keys", """
    SELECT 'not_null(l_orderkey)' AS constraint_name,
           count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
    UNION ALL SELECT 'not_null(l_shipdate)', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'not_blank(l_returnflag)', count(*) FILTER (trim(l_returnflag) = '')
        FROM lineitem
    UNION ALL SELECT 'check(l_quantity >= 2)', count(*) FILTER (l_quantity < 2) FROM lineitem
    UNION ALL SELECT 'check(l_discount BETWEEN 0 AND 0.05)',
        count(*) FILTER (l_discount < 0 OR l_discount > 0.05) FROM lineitem
    UNION ALL SELECT 'max_length(l_linestatus, 1)', count(*) FILTER (length(l_linestatus) > 1)
        FROM lineitem
    UNION ALL SELECT 'digits(l_extendedprice, 7, 2)',
        count(*) FILTER (abs(round(l_extendedprice, 2)) >= 100000) FROM lineitem
    UNION ALL SELECT 'unique(l_orderkey, l_linenumber)', CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
              HAVING count(*) > 1)
    UNION ALL SELECT 'foreign_key(l_suppkey -> supplier.s_suppkey)', count(DISTINCT l_suppkey)
        FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier
                                              WHERE s_acctbal > 0)""")
def contract_keys(tables: Tables) -> DataFrame:
    """The parent table is that of the solvent suppliers."""
    parents = {"supplier": tables("supplier").filter("s_acctbal > 0")}
    return contract_counts(tables("lineitem"), LINE_CONTRACT, parents).select(
        F.col("constraint").alias("constraint_name"), "violations")


@query("contract_full", """
    WITH runs AS (
        SELECT CASE WHEN event_id % 11 <> 0 THEN event_type END AS dag_id,
               repeat('r', event_id % 13 * 20) AS run_id,
               repeat('s', user_id % 30) AS status FROM events),
    stations AS (
        SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_partkey END AS id_station,
               repeat('c', p_size) AS code_station,
               CASE WHEN p_partkey % 5 <> 0 THEN p_name ELSE ' ' END AS nom,
               CASE WHEN p_size > 10 THEN p_size - 15 END AS capacite FROM part)
    SELECT 'pipeline_runs' AS contract, 'not_null(dag_id)' AS constraint_name,
           count(*) FILTER (dag_id IS NULL) AS violations FROM runs
    UNION ALL SELECT 'pipeline_runs', 'not_null(run_id)', 0
    UNION ALL SELECT 'pipeline_runs', 'not_null(start_time)', 0
    UNION ALL SELECT 'pipeline_runs', 'not_null(status)', 0
    UNION ALL SELECT 'pipeline_runs', 'max_length(dag_id, 100)', 0
    UNION ALL SELECT 'pipeline_runs', 'max_length(run_id, 200)',
        count(*) FILTER (length(run_id) > 200) FROM runs
    UNION ALL SELECT 'pipeline_runs', 'max_length(status, 20)',
        count(*) FILTER (length(status) > 20) FROM runs
    UNION ALL SELECT 'pipeline_runs', 'unique(dag_id, run_id)',
        CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM runs GROUP BY dag_id, run_id HAVING count(*) > 1)
    UNION ALL SELECT 'station', 'not_null(id_station)', count(*) FILTER (id_station IS NULL)
        FROM stations
    UNION ALL SELECT 'station', 'not_null(nom)', 0
    UNION ALL SELECT 'station', 'not_null(capacite)', count(*) FILTER (capacite IS NULL)
        FROM stations
    UNION ALL SELECT 'station', 'not_blank(nom)', count(*) FILTER (trim(nom) = '') FROM stations
    UNION ALL SELECT 'station', 'check(capacite >= 0)', count(*) FILTER (capacite < 0)
        FROM stations
    UNION ALL SELECT 'station', 'max_length(code_station, 30)',
        count(*) FILTER (length(code_station) > 30) FROM stations
    UNION ALL SELECT 'station', 'unique(id_station)', CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM stations GROUP BY id_station HAVING count(*) > 1)""")
def contract_full(tables: Tables) -> DataFrame:
    """Two whole contracts over rows that break nearly all of their constraints."""
    runs = tables("events").select(
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("dag_id"),
        F.expr("repeat('r', int(event_id % 13 * 20))").alias("run_id"),
        F.col("ts").alias("start_time"),
        F.expr("repeat('s', int(user_id % 30))").alias("status"))
    stations = tables("part").select(
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_partkey")).alias("id_station"),
        F.expr("repeat('c', int(p_size))").alias("code_station"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).otherwise(" ").alias("nom"),
        F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        F.when(F.col("p_size") > 10, F.col("p_size") - 15).alias("capacite"))
    counts = [contract_counts(df, contract).select(
        F.lit(contract.name).alias("contract"), F.col("constraint").alias("constraint_name"),
        "violations") for df, contract in ((runs, RUNS_CONTRACT), (stations, STATION_CONTRACT))]
    return counts[0].unionByName(counts[1])


@query("duplicate_keys", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(tables: Tables) -> DataFrame:
    return duplicated_keys(tables("lineitem"), ["l_orderkey", "l_linenumber"])


def _orphans(tables: Tables) -> DataFrame:
    """Users whose account is not in credit have been removed from the dimension."""
    solvent = tables("customer").filter("c_acctbal >= 0")
    return orphan_keys(tables("events"), solvent, "user_id", "c_custkey")


ORPHANS_SQL = """SELECT DISTINCT user_id FROM events e WHERE NOT EXISTS (
    SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal >= 0)"""


@query("orphan_keys", ORPHANS_SQL)
def all_orphans(tables: Tables) -> DataFrame:
    return _orphans(tables)


@query("orphans", ORPHANS_SQL + " ORDER BY user_id LIMIT 10")
def orphans(tables: Tables) -> DataFrame:
    """What an error message would list: the first ten."""
    return orphan_sample(_orphans(tables), "user_id")


QUARANTINE_RULES = [between("l_quantity", 0, 40), between("l_tax", 0.0, 0.05),
                    in_set("l_returnflag", ["A", "N"]), not_null("l_partkey")]


@query("quarantine_split", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
           concat_ws(';',
               CASE WHEN l_quantity NOT BETWEEN 0 AND 40
                    THEN 'expect_column_values_to_be_between(l_quantity)' END,
               CASE WHEN l_tax NOT BETWEEN 0 AND 0.05
                    THEN 'expect_column_values_to_be_between(l_tax)' END,
               CASE WHEN l_returnflag NOT IN ('A', 'N')
                    THEN 'expect_column_values_to_be_in_set(l_returnflag)' END) AS violations,
           l_quantity BETWEEN 0 AND 40 AND l_tax BETWEEN 0 AND 0.05
               AND l_returnflag IN ('A', 'N') AS accepted
    FROM lineitem""")
def quarantine_split(tables: Tables) -> DataFrame:
    marked = mark(tables("lineitem"), QUARANTINE_RULES)
    return marked.select("l_orderkey", "l_linenumber", "l_partkey",
                         F.concat_ws(";", VIOLATIONS).alias("violations"),
                         (F.size(VIOLATIONS) == 0).alias("accepted"))
