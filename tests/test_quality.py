import json
from datetime import datetime

import pytest
from feeds import rows

from snapledger.quality import (
    ContractViolation,
    QualityGateError,
    TableContract,
    between,
    contract_counts,
    exists,
    fetch_results,
    in_set,
    mark,
    not_null,
    rejected,
    row_count,
    unique,
    valid,
    validate,
    verify,
)
from snapledger.quality.suites import bronze_suite, gold_suite, reading_suite, station_suite

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, 5.0, "a", "7"), (2, NAN, "b", "x"), (2, None, None, None), (3, 50.0, "c", "70"),
         (None, -1.0, "a", " 8 ")], "id int, d double, s string, n string")


def outcome(df, rule, **kw):
    r = fetch_results(df, [rule], **kw)[0]
    return r.checked, r.unexpected, r.success


@pytest.mark.parametrize("rule, expected", [
    (exists("id"), (5, 0, True)),
    (exists("zz"), (None, None, False)),
    (not_null("zz"), (None, None, False)),
    (unique("zz"), (None, None, False)),
    (not_null("id"), (4, 1, False)),
    (not_null("d"), (3, 2, False)),            # NaN counts as missing
    (between("d", 0, 10), (3, 2, False)),      # missing values are not judged
    (between("d", -1.0, 50.0), (3, 0, True)),  # bounds are inclusive
    (between("n", 0, 10), (4, 2, False)),      # text is read as a number, 'x' cannot be
    (in_set("s", ["a", "b"]), (4, 1, False)),
    (in_set("id", [1, 2, 3]), (4, 0, True)),
    (unique("id"), (4, 2, False)),             # both members of the pair
    (unique("d"), (3, 0, True)),
    (row_count(1, 5), (5, 0, True)),
    (row_count(6, 9), (5, 5, False)),
])
def test_rules(df, rule, expected):
    assert outcome(df, rule) == expected


def test_rules_on_an_empty_frame(df):
    empty = df.limit(0)
    assert outcome(empty, not_null("id")) == (0, 0, True)
    assert outcome(empty, unique("id")) == (0, 0, True)
    assert outcome(empty, row_count(1, 5)) == (0, 0, False)
    assert outcome(empty, row_count(0, 5)) == (0, 0, True)
    assert outcome(empty, row_count(1, 5), snapshot="s") == (0, 0, False)


def test_row_count_per_snapshot(spark):
    many = spark.createDataFrame([(f, i) for f, n in (("a", 3), ("b", 3), ("c", 9))
                                  for i in range(n)], "f string, i int")
    assert outcome(many, row_count(1, 3)) == (15, 15, False)
    assert outcome(many, row_count(1, 3), snapshot="f") == (15, 9, False)
    assert outcome(many, row_count(3, 9), snapshot="f") == (15, 0, True)
    assert outcome(many, between("i", 0, 7), snapshot="f") == (15, 1, False)


def test_suite_sizes():
    assert len(bronze_suite()) == 6
    assert (len(station_suite()), len(station_suite(variant="full"))) == (7, 9)
    assert len(reading_suite()) == 11
    assert (len(gold_suite()), len(gold_suite(variant="full"))) == (7, 12)


class Log:
    def __init__(self):
        self.events = []

    def validations(self, rows_):
        self.events.append(("validations", rows_))

    def alerts(self, df):
        self.events.append(("alerts", [r.asDict() for r in df.collect()]))


RULES = [not_null("id", reason="it's the \\ key"), between("d", 0, 10, reason="range"),
         in_set("s", ["a", "b", "c"])]


def test_results_and_alerts_are_saved_before_the_gate_closes(spark, df):
    log, at = Log(), datetime(2026, 1, 1)
    with pytest.raises(QualityGateError, match="not_be_null"):
        validate(spark, df, RULES, "s", "dag", at, log)
    (first, [row]), (second, alerts) = log.events
    assert (first, second) == ("validations", "alerts")
    assert (row["success"], row["nb_expectations"], row["nb_successful"], row["nb_failed"]) == \
        (False, 3, 1, 2)
    assert json.loads(row["details"])["rules"][1]["unexpected"] == 2
    # Each alert carries its own rule's severity and reason.
    assert [(a["rule_name"], a["column_name"], a["severity"], a["detail"], a["resolved"])
            for a in alerts] == [
        ("expect_column_values_to_not_be_null", "id", "CRITICAL", "it's the \\ key", False),
        ("expect_column_values_to_be_between", "d", "WARNING", "range", False)]


def test_warnings_and_open_gates_do_not_stop(spark, df):
    log = Log()
    validate(spark, df, RULES[1:], "s", "dag", datetime(2026, 1, 1), log)
    validate(spark, df, RULES, "s", "dag", datetime(2026, 1, 1), log, stop_on_critical=False)
    assert [name for name, _ in log.events] == ["validations", "alerts"] * 2
    validate(spark, df, RULES[2:], "s", "dag", datetime(2026, 1, 1), log)
    assert log.events[-1][0] == "validations" and log.events[-1][1][0]["success"]


CONTRACT = TableContract(
    name="t", required=["id", "s"], not_null=["id"], not_blank=["s"], checks=["d >= 0"],
    max_length={"s": 3}, digits={"d": (4, 2)}, unique=[["id", "s"]],
    foreign_keys={"id": ("parent", "pk")})


@pytest.mark.parametrize("data, broken", [
    ([(1, "a", 1.0), (2, "a", None)], None),
    ([(None, " ", -1.0)], "not_null"),
    ([(1, " ", -1.0)], "not_blank"),
    ([(1, "aaaa", -1.0)], "check"),
    ([(1, "aaaa", 100.0)], "max_length"),
    ([(1, "a", 99.995), (1, "a", 1.0)], "digits"),
    ([(1, "a", 99.994), (1, "a", 1.0)], "unique"),
    ([(i, "a", 1.0) for i in range(1, 20)], "foreign_key"),
])
def test_contract_reports_the_first_violation(spark, data, broken):
    df = spark.createDataFrame(data, "id int, s string, d double")
    parent = {"parent": spark.createDataFrame([(1,), (2,)], "pk int")}
    if broken is None:
        verify(df, CONTRACT, parent)
        return
    with pytest.raises(ContractViolation) as caught:
        verify(df, CONTRACT, parent)
    assert broken in str(caught.value)
    if broken == "foreign_key":
        assert "17 keys" in str(caught.value)
        assert str(list(range(3, 13))) in str(caught.value)


def test_contract_names_missing_columns(spark):
    with pytest.raises(ContractViolation, match=r"missing columns \['s'\]"):
        contract_counts(spark.range(1), CONTRACT)


def test_quarantine_splits_without_loss(df):
    rules = [not_null("id"), between("d", 0, 10), in_set("s", ["a", "b"]), unique("id")]
    marked = mark(df, rules)
    both = valid(marked).unionByName(rejected(marked).drop("_violations"))
    assert str(rows(both)) == str(rows(df))
    assert {tuple(r._violations) for r in rejected(marked).collect()} == {
        ("expect_column_values_to_be_between(d)", "expect_column_values_to_be_in_set(s)"),
        ("expect_column_values_to_not_be_null(id)", "expect_column_values_to_be_between(d)")}


def test_empty_snapshot_breaks_the_row_count(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", None, None)],
                               "file string, pos int, v int")
    rules = [row_count(1, 5), not_null("v"), unique("v"), exists("v")]
    got = [(r.checked, r.unexpected, r.success)
           for r in fetch_results(df, rules, snapshot="file", element="pos")]
    assert got == [(2, 0, False), (2, 0, True), (2, 2, False), (2, 0, True)]
    assert fetch_results(df, [row_count(0, 5)], snapshot="file", element="pos")[0].success
