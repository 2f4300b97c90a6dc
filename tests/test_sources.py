import json
import os

import pytest
from feeds import STATIONS, STATUS_1, rows, write
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapledger.sources import (
    element_profile,
    entity_columns,
    feed_profile,
    json_key_profile,
    land,
    latest_file,
    present_columns,
    project_required,
    read_envelope,
    stage_columns,
    staging,
)
from snapledger.sources.envelope import MissingColumns
from snapledger.sources.landing import LANDED_GLOB


def test_envelope(spark, tmp_path):
    write(tmp_path, "info", "20260101_080000", STATIONS)
    write(tmp_path, "info", "20260101_080500", STATIONS[:1])
    df = read_envelope(spark, str(tmp_path))
    assert df.count() == 7
    first = entity_columns(df.filter("file LIKE '%080500%'"), ["station_id", "lat", "capacity"])
    assert rows(first, "pos", "station_id", "lat", "capacity") == [(0, "101", "48.86", "16")]


def test_empty_document_leaves_a_row(spark, tmp_path):
    write(tmp_path, "s", "1", [])
    write(tmp_path, "s", "2", [{"a": 1}])
    df = entity_columns(read_envelope(spark, str(tmp_path)), ["a"])
    assert rows(df, "pos", "a") == [(0, "1"), (None, None)]


def test_nested_values_arrive_as_text_and_booleans_too(spark, tmp_path):
    write(tmp_path, "s", "1", [{"a": [{"x": 1}, 5], "b": True, "c": None, "d": "é\n"}])
    df = entity_columns(read_envelope(spark, str(tmp_path)), ["a", "b", "c", "d"])
    assert rows(df, "a", "b", "c", "d") == [('[{"x":1},5]', "true", None, "é\n")]


@pytest.mark.parametrize("text", ['{"data": {"stations": [', '{"data": {}}', "[]",
                                  '{"data": {"stations": [1]}}'])
def test_damaged_document_fails(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_envelope(spark, str(tmp_path)).collect()


def test_missing_field_differs_from_null(spark, tmp_path):
    write(tmp_path, "s", "1", [{"a": 1, "b": None}, {"a": 2}])
    df = read_envelope(spark, str(tmp_path))
    assert present_columns(df, ["a", "b", "c"]) == ["a", "b"]
    with staging(spark) as stage:
        staged = stage_columns(stage, df, ["a", "b", "c"])
        assert staged.columns == ["file", "file_time", "pos", "a", "b"]
        with pytest.raises(MissingColumns, match="'c'"):
            project_required(staged, ["a", "c"])


def test_staged_tables_are_removed(spark, tmp_path):
    with staging(spark) as stage:
        folder = stage(spark.range(3)).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(folder)
    assert not os.path.exists(folder)


def test_latest_file(spark, tmp_path):
    old = write(tmp_path, "b", "20260101_090000", [])
    new = write(tmp_path, "a", "20260101_080000", [])
    (tmp_path / "ignored.xsd").write_text("{}")
    (tmp_path / "_ignored.json").write_text("{}")
    os.utime(old, (1000, 1000))
    os.utime(new, (2000, 2000))
    assert latest_file(spark, str(tmp_path)).endswith("a_20260101_080000.json")
    os.utime(old, (2000, 2000))  # a tie goes to the greatest path
    assert latest_file(spark, str(tmp_path)).endswith("b_20260101_090000.json")
    with pytest.raises(FileNotFoundError):
        latest_file(spark, str(tmp_path), "*.xml")


def test_landing_keeps_every_payload_whole(spark, tmp_path):
    payloads = [json.dumps({"data": {"stations": [{"n": i, "t": "a b"}]}}, indent=2)
                for i in range(5)]
    df = spark.createDataFrame([(p, "f", "2026-01-01 08:00:00") for p in payloads],
                               "payload string, feed string, at string").coalesce(1) \
        .withColumn("at", F.col("at").cast("timestamp"))
    land(df, str(tmp_path / "l"), "feed", "at", "payload")
    texts = spark.read.text(str(tmp_path / "l" / "feed=f" / "day=2026-01-01" / "batch_ts=20260101_080000"),
                            wholetext=True)
    assert sorted(r.value.rstrip("\n") for r in texts.collect()) == sorted(payloads)
    back = read_envelope(spark, str(tmp_path / "l"), glob=LANDED_GLOB)
    assert rows(entity_columns(back, ["n"]), "n") == [(str(i),) for i in range(5)]


def test_profiles(spark):
    documents = [json.dumps({"data": {"stations": s}, "ttl": 1}) for s in (STATUS_1, [])]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, doc string")
    got = {r.i: r for r in feed_profile(df, "doc").collect()}
    assert got[0].document_keys == ["data", "ttl"] and got[0].parent_keys == ["stations"]
    assert (got[0].element_count, got[1].element_count) == (3, 0)
    assert json.loads(got[0].first_element)["station_id"] == 101
    assert got[1].first_element is None
    elements = {r.key: r for r in element_profile(df, "doc").collect()}
    assert set(elements) == set(STATUS_1[0])
    assert (elements["last_reported"].occurrences, elements["last_reported"].nulls) == (3, 1)
    flat = spark.createDataFrame([('{"k": 1}',), ('{"k": null, "z": "a"}',)], "p string")
    assert rows(json_key_profile(flat, "p"), "key", "occurrences", "nulls") == [
        ("k", 2, 1), ("z", 1, 0)]


def test_profiles_count_what_cannot_be_read(spark):
    flat = spark.createDataFrame(
        [('{"k": 1}',), ('{"k": ',), ("[1]",), ("{}",), (None,), ("",)], "p string")
    got = {r.key: r for r in json_key_profile(flat, "p").collect()}
    assert set(got) == {"k", None}
    assert (got["k"].occurrences, got[None].occurrences) == (1, 3)
    documents = spark.createDataFrame([('{"data": {}}',), ('{"data',)], "d string")
    assert rows(feed_profile(documents, "d"), "element_count") == [(None,), (None,)]
