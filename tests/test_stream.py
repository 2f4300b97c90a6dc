import pytest
from feeds import BOUNDS, STATIONS, STATUS_1, STATUS_2, at, rows, status, write

from pyspark.sql import functions as F

from snapledger.plans import medallion
from snapledger.plans.bikeshare import STATUS_COLUMNS, build_readings, file_instant, origin_instant
from snapledger.plans.medallion import Settings, Warehouse, run_batch
from snapledger.sources import entity_columns, explode_payload, read_envelope
from snapledger.streaming import start_feed
from snapledger.streaming.feed import elements
from pyspark.errors import StreamingQueryException

SETTINGS = Settings(rows=BOUNDS)


@pytest.fixture
def feed(tmp_path):
    write(tmp_path, "information", "20260101_080000", STATIONS)
    write(tmp_path, "status", "20260101_080000", STATUS_1)
    write(tmp_path, "status", "20260101_080500", STATUS_2)
    return tmp_path


def drain(wh, folder, **kw):
    start_feed(wh, f"{folder}/information", f"{folder}/status", f"{folder}/checkpoint",
               SETTINGS, **kw).awaitTermination()


def contents(wh):
    return (rows(wh.station.read()), rows(wh.reading.read()), rows(wh.current.read()),
            rows(wh.hourly.read()))


def test_stream_equals_batch(spark, feed):
    batch, one, many = (Warehouse(spark, str(feed / n)) for n in ("batch", "one", "many"))
    run_batch(batch, read_envelope(spark, f"{feed}/information"),
              read_envelope(spark, f"{feed}/status"), at(9), SETTINGS)
    drain(one, feed)
    (feed / "checkpoint").rename(feed / "checkpoint-one")
    drain(many, feed, max_files=1)
    assert contents(one) == contents(many) == contents(batch)
    assert many.log.validation_table.read().filter("suite_name = 'bronze_suite'").count() == 2
    # A second start finds nothing new; a new document alone is consumed.
    drain(many, feed)
    assert contents(many) == contents(batch)
    write(feed, "status", "20260101_081000", [status(103, "16109", 2, 2, [], 0)])
    drain(many, feed)
    assert many.reading.read().count() == 5


def test_latest_only_skips_older_documents(spark, feed):
    wh = Warehouse(spark, str(feed / "wh"))
    drain(wh, feed, latest_only=True)
    assert rows(wh.reading.read(), "id_station", "velos_disponibles") == [(101, 0)]


def test_a_failed_batch_is_repeated_without_effect(spark, feed, monkeypatch):
    wh, whole = (Warehouse(spark, str(feed / n)) for n in ("wh", "whole"))
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "build_hourly", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            drain(wh, feed)
    assert wh.reading.read().count() == 4  # silver was done before gold failed
    silver = (rows(wh.log.validation_table.read()), rows(wh.log.freshness_table.read()),
              rows(wh.log.alert_table.read()))
    drain(wh, feed)
    validations = wh.log.validation_table.read()
    assert (rows(validations.filter("suite_name <> 'gold_suite'")),
            rows(wh.log.freshness_table.read())) == silver[:2]
    assert validations.count() == len(silver[0]) + 1
    alerts = wh.log.alert_table.read()
    assert rows(alerts.filter("suite_name <> 'gold_suite'")) == silver[2]
    assert alerts.count() == alerts.select("id").distinct().count()
    attempts = wh.log.run_table.read()
    assert sorted((r.dag_id == medallion.GOLD_DAG, r.status) for r in attempts.collect()) == [
        (False, "success"), (True, "failed"), (True, "success")]
    assert attempts.select("run_id").distinct().count() == 1
    run_batch(whole, read_envelope(spark, f"{feed}/information"),
              read_envelope(spark, f"{feed}/status"), at(9), SETTINGS)
    assert contents(wh) == contents(whole)


def test_instant_is_read_once_for_each_document(spark):
    """The stamp of a path costs two patterns: that is for documents, not for their elements."""
    payload = '{"data": {"stations": [%s]}}' % ", ".join(
        '{"station_id": %d, "stationCode": "a", "num_bikes_available": 1, "num_docks_available": 2,'
        ' "num_bikes_available_types": [], "is_installed": 1, "is_returning": 1, "is_renting": 1,'
        ' "last_reported": 1704067200}' % i for i in range(3))
    documents = spark.createDataFrame(
        [("bronze/batch_ts=20240101_080500/part-0.txt", "2024-01-02 00:00:00", payload),
         ("bronze/plain.json", "2024-01-03 00:00:00", payload)],
        "file string, file_time string, payload string").withColumn("file_time", F.col("file_time").cast("timestamp"))
    fed = entity_columns(elements(documents), STATUS_COLUMNS)
    plain = entity_columns(explode_payload(documents, "payload", keep_empty=True), STATUS_COLUMNS)
    rows = build_readings(fed, origin_instant(fed))
    assert sorted(rows.collect()) == sorted(build_readings(plain, file_instant()).collect())
    assert sorted({str(r.date_collecte) for r in rows.collect()}) == ["2024-01-01 08:05:00", "2024-01-03 00:00:00"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "batch_ts" not in above and "batch_ts" in below
