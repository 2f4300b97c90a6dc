"""Tables over time: packing, retention, pruning by the days that occur, looking back."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from feeds import BOUNDS, STATIONS, STATUS_1, STATUS_2, at, rows, status, write
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators import insert_new, latest
from snapledger.plans.bikeshare import network_view
from snapledger.plans.medallion import NETWORK_VIEW, Settings, Warehouse, check_freshness, run_batch, run_latest
from snapledger.plans.monitoring import recent
from snapledger.sources import (
    AppendTable,
    VersionedTable,
    document_structure,
    drift,
    land,
    latest_file,
    latest_snapshot,
    read_documents,
    read_envelope,
    sort_out,
)
from snapledger.sources import landing
from snapledger.sources.tables import ConcurrentWrite, Folder
from snapledger.streaming import latest_state, replay, start_current, start_feed, start_freshness, start_latest

SETTINGS = Settings(rows=BOUNDS)
LOG = T.StructType([T.StructField("t", T.TimestampNTZType(), False), T.StructField("v", T.LongType(), False)])


def log(spark, entries):
    return spark.createDataFrame(entries, LOG)


def files(folder):
    return sorted(str(p) for p in folder.rglob("*.parquet"))


def opened(df):
    """Files that the scans of a frame open when it runs."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def small_files(spark, tmp_path, days=3, each=12, **kw):
    table = AppendTable(spark, str(tmp_path / "log"), LOG, "t", **kw)
    for k in range(each):
        table.append(log(spark, [(datetime(2026, 1, 1 + d, 0, 5 * k), 100 * d + k) for d in range(days)]))
    return table


def test_closed_days_are_packed(spark, tmp_path):
    table = small_files(spark, tmp_path)
    before, reader = rows(table.read()), table.read()
    assert opened(table.read()) == 36
    assert table.compact(date(2026, 1, 3)) == [date(2026, 1, 1), date(2026, 1, 2)]
    assert rows(table.read()) == before
    assert opened(table.read()) == 2 + 12
    assert opened(table.read(date(2026, 1, 2), date(2026, 1, 2))) == 1
    assert rows(reader) == before  # one that began before finds all its files
    assert table.compact(date(2026, 1, 3)) == []
    # A straggler of a packed day is kept, and packed with the rest the next time.
    table.append(log(spark, [(datetime(2026, 1, 1, 9), 999)]))
    assert set(rows(table.read())) == {*before, (datetime(2026, 1, 1, 9), 999)}
    assert table.compact(date(2026, 1, 3)) == [date(2026, 1, 1)]
    assert opened(table.read(until=date(2026, 1, 1))) == 1
    assert table.read().count() == 37


def test_a_packing_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    table = small_files(spark, tmp_path, days=2, each=3)
    before = rows(table.read())
    with monkeypatch.context() as patch:
        patch.setattr(table.markers, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.compact(date(2026, 1, 3))
    assert rows(table.read()) == before
    table.append(log(spark, [(datetime(2026, 1, 1, 9), 999)]))
    assert table.read().count() == 7
    assert table.compact(date(2026, 1, 3)) == [date(2026, 1, 1), date(2026, 1, 2)]
    assert table.read().count() == 7 and opened(table.read()) == 2


def test_two_packers_at_once(spark, tmp_path, monkeypatch):
    one, two = small_files(spark, tmp_path, days=1, each=3), None
    two = AppendTable(spark, one.path, LOG, "t")
    write_one = one._write

    def slow(rows_, pack):
        written = write_one(rows_, pack)
        two.markers.commit(1, json.dumps({}))
        return written

    monkeypatch.setattr(one, "_write", slow)
    with pytest.raises(ConcurrentWrite):
        one.compact(date(2026, 1, 3))


def test_packed_files_go_after_their_time(spark, tmp_path):
    table = small_files(spark, tmp_path, days=1, each=4, keep=timedelta(0))
    table.compact(date(2026, 1, 2))
    assert len(files(tmp_path)) == 5
    assert table.compact(date(2026, 1, 2)) == [] and len(files(tmp_path)) == 1
    assert table.read().count() == 4


def test_a_straggler_opens_its_own_day(spark, tmp_path):
    """A year of days, a batch of the newest and of one a year ago: two days are read."""
    table = AppendTable(spark, str(tmp_path / "t"), LOG, "t")
    first = datetime(2025, 1, 1, 12)
    table.append(log(spark, [(first + timedelta(days=d), d) for d in range(366)]))
    batch = log(spark, [(first, 0), (first + timedelta(hours=1), 1000), (first + timedelta(days=365), 365)])
    hit = table.colliding(batch)
    text = hit._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert rows(hit) == [(first, 0), (first + timedelta(days=365), 365)]
    assert opened(table.colliding(batch)) == 2
    assert rows(insert_new(hit, batch, ["t", "v"])) == [(first + timedelta(hours=1), 1000)]


def test_looking_back_opens_few_days(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), LOG, "t")
    assert table.newest(3).count() == 0
    table.append(log(spark, [(datetime(2026, 1, 1 + d, h), 10 * d + h) for d in range(20) for h in range(5)]))
    newest = table.newest(4)
    assert opened(newest) == 1
    assert rows(recent(newest, "t", 4, "v"), "v") == [(191,), (192,), (193,), (194,)]
    assert opened(table.newest(12)) == 4  # one, two, four days
    rare = table.newest(2, F.col("v") <= 1)
    assert rows(rare, "v") == [(0,), (1,)]
    assert table.newest(1000).count() == 100


def test_versions_last_as_long_as_readers_may(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType())])
    table = VersionedTable(spark, str(tmp_path / "t"), schema)
    table.replace(spark.createDataFrame([(0,)], schema))
    reader = table.read()
    for k in range(1, 9):
        table.replace(spark.createDataFrame([(k,)], schema))
    assert rows(reader) == [(0,)] and rows(table.read()) == [(8,)]
    old = tmp_path / "t" / "_committed"
    for marker in sorted(old.glob("0*"))[:5]:
        os.utime(marker, (1000, 1000))  # these took over long ago
    table.replace(spark.createDataFrame([(9,)], schema))
    # The fifth took over long ago, but was replaced just now.
    assert [int(v[2:10]) for v in table.versions()] == [5, 6, 7, 8, 9, 10]


def test_ties_of_a_hot_key_are_dealt_out(spark):
    hot = spark.range(100_000).selectExpr("1L AS k", "timestamp'2026-01-02' AS t", "id")
    others = spark.range(5_000).selectExpr("id % 50 + 2 AS k", "timestamp_seconds(id) AS t", "id")
    older = spark.range(9).selectExpr("1L AS k", "timestamp'2026-01-01' AS t", "id")
    nulls = spark.sql("SELECT CAST(NULL AS BIGINT) AS k, timestamp'2026-01-02' AS t, 1L AS id")
    df = hot.unionByName(others).unionByName(older).unionByName(nulls).repartition(8)
    found = latest(df, ["k"], "t", spread=16)
    assert found.columns == ["k", "t", "id"]
    assert rows(found.groupBy("k").agg(F.count("*"), F.sum("id"))) == rows(
        latest(df, ["k"], "t").groupBy("k").agg(F.count("*"), F.sum("id")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r[0] for r in latest(df, ["k"], "t", spread=16).filter("k = 1").groupBy(
            F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 100_000 and max(sizes) < 40_000 and len(sizes) > 4
    dimension = spark.createDataFrame([(1, "one"), (3, "three"), (99, "none")], "k long, name string")
    joined = latest(df, ["k"], "t", within=dimension, spread=4)
    assert rows(joined.groupBy("k", "name").count()) == [(1, "one", 100_000), (3, "three", 1)]


# landing

def test_landed_is_what_the_run_reads(spark, tmp_path):
    """Landed by Spark, consumed with the default pattern, along one branch of the folders."""
    day = lambda d: f"2026-01-{d:02d} 08:00:00"
    document = lambda s: json.dumps({"data": {"stations": s}})
    entries = [("station_information", day(1), document(STATIONS))]
    entries += [("station_status", day(d), document([status(101, "1", d, 1, [], 0)])) for d in range(1, 21)]
    df = spark.createDataFrame(entries, "feed string, at string, payload string").withColumn(
        "at", F.col("at").cast("timestamp"))
    land(df, str(tmp_path / "b"), "feed", "at", "payload")
    zone = f"{tmp_path}/b/feed=station_status"
    listed = []
    found = landing._newest(Folder(spark, zone), landing.LANDED_GLOB, listed)
    assert "day=2026-01-20" in found[1] and len(listed) == 3  # feed, day, stamp
    assert latest_snapshot(spark, zone).endswith("/day=2026-01-20/batch_ts=20260120_080000")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_latest(wh, f"{tmp_path}/b/feed=station_information", zone, at(9, day=20), SETTINGS)
    assert rows(wh.current.read(), "id_station", "velos_disponibles") == [(101, 20)]


def test_undated_folders_and_files_compete_by_time(spark, tmp_path):
    for name, time in (("b/x.json", 5), ("a/y.json", 9), ("z.json", 7), ("_tmp/w.json", 99)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (time, time))
    assert latest_file(spark, str(tmp_path)).endswith("a/y.json")
    (tmp_path / "2026-01-02").mkdir()  # empty: the search goes on
    assert latest_file(spark, str(tmp_path)).endswith("a/y.json")


# damaged documents

def test_damaged_documents_are_set_apart(spark):
    sound = json.dumps({"data": {"stations": [{"a": 1}]}})
    entries = [("1", sound), ("2", sound[:-3]), ("3", '{"data": {}}'), ("4", ""), ("5", None), ("6", "[1]"),
               ("7", '{"data": {"stations": []}}'), ("8", '{"data": {"stations": "no"}}'), ("9", "text")]
    good, bad = sort_out(spark.createDataFrame(entries, "file string, payload string"))
    assert rows(good, "file") == [("1",), ("7",)]
    assert rows(bad, "file", "reason") == [
        ("2", "malformed document"), ("3", "document without data.stations"), ("4", "empty document"),
        ("5", "empty document"), ("6", "malformed document"), ("8", "malformed document"),
        ("9", "malformed document")]
    assert rows(bad, "file", "payload")[0] == ("2", sound[:-3])


def test_a_feed_goes_on_past_a_damaged_document(spark, tmp_path):
    write(tmp_path, "information", "20260101_080000", STATIONS)
    write(tmp_path, "status", "20260101_080000", STATUS_1)
    damaged = write(tmp_path, "status", "20260101_080500", STATUS_2)
    with open(damaged, encoding="utf-8") as file:
        whole = file.read()
    with open(damaged, "w", encoding="utf-8") as file:
        file.write(whole[:-20])
    strict, wh = (Warehouse(spark, str(tmp_path / n)) for n in ("strict", "wh"))

    def drain(wh, name, **kw):
        start_feed(wh, f"{tmp_path}/information", f"{tmp_path}/status", f"{tmp_path}/{name}", SETTINGS,
                   **kw).awaitTermination()

    with pytest.raises(StreamingQueryException):
        drain(strict, "c1")
    for _ in range(2):  # the second start finds nothing new
        drain(wh, "c2", dead_letters=True, max_files=1)
    assert wh.reading.read().count() == 3
    [letter] = wh.damaged.read().collect()
    assert letter.payload == whole[:-20] and letter.reason == "malformed document"
    assert letter.file.endswith("status_20260101_080500.json")
    information = read_envelope(spark, f"{tmp_path}/information")
    for _ in range(2):
        replay(wh, information, wh.damaged.read().withColumn("payload", F.lit(whole)), at(9), SETTINGS)
    assert wh.reading.read().count() == 4
    assert rows(wh.current.read(), "id_station", "velos_disponibles")[0] == (101, 0)


# freshness by the clock

def test_both_feeds_are_reported_without_a_batch(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    check_freshness(wh, at(8))
    assert wh.log.freshness_table.read().count() == 0  # nothing was ever read
    write(tmp_path, "information", "20260101_080000", STATIONS)
    write(tmp_path, "status", "20260101_080500", STATUS_1)
    run_latest(wh, f"{tmp_path}/information", f"{tmp_path}/status", at(8, 6), SETTINGS)
    check_freshness(wh, at(12))
    logged = wh.log.freshness_table.read().filter("checked_at > '2026-01-01 09:00:00'")
    assert rows(logged.selectExpr("source_name", "cast(delay_minutes as int)", "is_fresh")) == [
        ("station_information", 240, False), ("station_status", 235, False)]
    query = start_freshness(wh, f"{tmp_path}/timer", interval="1 second")
    try:
        for _ in range(60):
            query.awaitTermination(1)
            ticks = wh.log.freshness_table.read().filter("checked_at > '2026-02-01'")
            if ticks.select("source_name").distinct().count() == 2:
                break
    finally:
        query.stop()
    assert {r.source_name for r in ticks.collect()} == {"station_information", "station_status"}


# a view that follows

def test_other_sessions_see_each_publication(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    write(tmp_path, "information", "20260101_080000", STATIONS)
    other, seen = spark.newSession(), []
    for stamp, elements in (("20260101_080000", STATUS_1), ("20260101_080500", STATUS_2)):
        write(tmp_path, "status", stamp, elements)
        run_latest(wh, f"{tmp_path}/information", f"{tmp_path}/status", at(8, 6), SETTINGS)
        seen.append(tuple(other.table(NETWORK_VIEW).first()))
        assert seen[-1] == tuple(network_view(wh.current.read()).first())
    assert seen[0] != seen[1]


# state streams

def test_latest_state_over_triggers_and_restarts(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("t", T.TimestampNTZType(), False),
                           T.StructField("v", T.LongType(), False)])
    table = VersionedTable(spark, str(tmp_path / "t"), schema)
    noon = datetime(2026, 1, 5, 12)
    deliveries = [
        [(1, noon, 10), (2, noon, 20), (1, noon - timedelta(hours=1), 11)],
        [(1, noon - timedelta(days=300), 12), (3, noon, 30), (2, noon + timedelta(hours=1), 21)],  # late, new, newer
        [(1, noon, 5), (1, noon, 50)],  # ties: the smallest v stays
    ]
    expected = [[(1, noon, 10), (2, noon, 20)], [(1, noon, 10), (2, noon + timedelta(hours=1), 21), (3, noon, 30)],
                [(1, noon, 5), (2, noon + timedelta(hours=1), 21), (3, noon, 30)]]
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    states = []
    for entries, want in zip(deliveries, expected):
        spark.createDataFrame([*entries, (None, noon, 1), (9, None, 1)], loose).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(loose).parquet(str(tmp_path / "in"))
        query = start_latest(latest_state(stream, ["k"], "t", first=["v"]), table, ["k"], str(tmp_path / "c"))
        query.awaitTermination()
        states.append(query.lastProgress.stateOperators[0].numRowsTotal)
        assert rows(table.read()) == want
    assert states[0] < states[1] == states[2]  # one state for a key, however many rows
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and "Python" not in plan


def test_current_by_state_equals_the_batch(spark, tmp_path):
    write(tmp_path, "information", "20260101_080000", STATIONS)
    write(tmp_path, "status", "20260101_080500", STATUS_2)
    batch, stream = (Warehouse(spark, str(tmp_path / n)) for n in ("batch", "stream"))
    information = read_envelope(spark, f"{tmp_path}/information")
    run_batch(stream, information, read_envelope(spark, f"{tmp_path}/status"), at(9), SETTINGS)
    write(tmp_path, "status", "20260101_080000", STATUS_1)  # older, and landed later
    run_batch(batch, information, read_envelope(spark, f"{tmp_path}/status"), at(9), SETTINGS)
    stream.current = VersionedTable(spark, str(tmp_path / "current"), stream.current.schema)
    for _ in range(2):
        start_current(stream, f"{tmp_path}/status", str(tmp_path / "c"), max_files=1).awaitTermination()
    assert rows(stream.current.read()) == rows(batch.current.read())


# drift

def test_drift_between_snapshots(spark):
    snap = lambda *e: json.dumps({"data": {"stations": list(e)}})
    entries = [("f", 1, snap({"a": 1, "b": "x"}, {"a": None, "c": True})), ("f", 2, snap()),
               ("f", 3, "damaged"), ("f", 4, snap({"a": None, "b": 2.5, "d": {"e": 1}})), ("g", 1, snap({"a": "1"})),
               ("f", 5, snap({"a": "7", "b": 3.25, "d": {"e": 2}}))]
    df = spark.createDataFrame(entries, "feed string, at int, doc string")
    structures = document_structure(df, "doc")
    assert {(r.feed, r.at): r.structure for r in structures.collect()}["f", 1] == {
        "a": "BIGINT", "b": "STRING", "c": "BOOLEAN"}
    changes = drift(structures, ["feed"], ["at"])
    assert rows(changes, "feed", "at", "key", "change", "before", "after") == [
        ("f", 4, "b", "type", "STRING", "DOUBLE"), ("f", 4, "c", "removed", "BOOLEAN", None),
        ("f", 4, "d", "added", None, "OBJECT<e: BIGINT>")]
    assert drift(document_structure(df.filter("false"), "doc"), ["feed"], ["at"]).count() == 0


def test_documents_are_whole(spark, tmp_path):
    path = write(tmp_path, "status", "20260101_080000", STATUS_1)
    [found] = read_documents(spark, str(tmp_path / "status")).collect()
    with open(path, encoding="utf-8") as file:
        assert found.payload == file.read()
