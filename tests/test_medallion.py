from datetime import date, datetime
from decimal import Decimal

import pytest
from feeds import BOUNDS, STATIONS, STATUS_1, STATUS_2, at, rows, station, status, types, write

from snapledger.plans import medallion
from snapledger.plans.medallion import (
    GOLD_DAG,
    NETWORK_VIEW,
    SILVER_DAG,
    Settings,
    Warehouse,
    run_batch,
    run_gold,
    run_latest,
)
from snapledger.plans.monitoring import (
    latest_validations,
    open_alerts_by_severity,
    recent_open_alerts,
    run_history,
)
from snapledger.quality import ContractViolation, QualityGateError
from snapledger.sources import read_envelope
from snapledger.sources.envelope import MissingColumns

SETTINGS = Settings(rows=BOUNDS)
B1, B2 = datetime(2026, 1, 1, 8, 0), datetime(2026, 1, 1, 8, 5)


def cycle(wh, folder, when, settings=SETTINGS, **kw):
    run_latest(wh, f"{folder}/information", f"{folder}/status", when, settings, **kw)


def single(spark, tmp_path, stations, readings, settings=SETTINGS):
    """One cycle in a warehouse of its own."""
    write(tmp_path, "information", "20260101_080000", stations)
    write(tmp_path, "status", "20260101_080000", readings)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    return wh, lambda: cycle(wh, tmp_path, at(8, 1), settings)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two cycles of the golden feed."""
    folder = tmp_path_factory.mktemp("golden")
    wh = Warehouse(spark, str(folder / "wh"))
    write(folder, "information", "20260101_080000", STATIONS)
    write(folder, "status", "20260101_080000", STATUS_1)
    cycle(wh, folder, at(8, 1))
    write(folder, "status", "20260101_080500", STATUS_2)
    cycle(wh, folder, at(8, 6))
    return folder, wh


def contents(wh):
    return (rows(wh.station.read()), rows(wh.reading.read()), rows(wh.current.read()),
            rows(wh.hourly.read()))


def test_station_dimension(loaded):
    _, wh = loaded
    assert rows(wh.station.read()) == [
        (101, "16107", "Alpha", 48.86, 2.27, 16, None),
        (102, "16108", "Beta", 48.87, 2.28, 3, None),
        (103, "16109", "Gamma", 48.88, 2.29, 0, None)]


def test_readings(loaded):
    _, wh = loaded
    got = rows(wh.reading.read(), "id_station", "date_collecte", "velos_disponibles",
               "bornes_disponibles", "velos_mecaniques", "velos_electriques", "est_installee",
               "dernier_signalement")
    assert got == [
        (101, B1, 1, 15, 1, 0, 1, datetime(2026, 1, 1, 7, 53, 20)),
        (101, B2, 0, 16, 0, 0, 1, datetime(2026, 1, 1, 7, 58, 20)),
        (102, B1, 5, 0, 2, 3, 1, None),
        (103, B1, 0, 4, 0, 0, 1, None)]


def test_current_state(loaded):
    _, wh = loaded
    got = rows(wh.current.read(), "id_station", "velos_disponibles", "bornes_disponibles",
               "taux_disponibilite", "est_vide", "est_pleine", "derniere_collecte")
    assert got == [(101, 0, 16, Decimal("0.000"), True, False, B2),
                   (102, 5, 0, Decimal("1.000"), False, True, B1),
                   (103, 0, 4, Decimal("0.000"), True, False, B1)]


def test_hourly_trend(loaded):
    _, wh = loaded
    assert rows(wh.hourly.read()) == [
        (101, "Alpha", 8, Decimal("0.50"), Decimal("0.031"), 1, 2),
        (102, "Beta", 8, Decimal("5.00"), Decimal("1.667"), 0, 1),
        (103, "Gamma", 8, Decimal("0.00"), Decimal("0.000"), 1, 1)]


def test_network_view(spark, loaded):
    loaded[1].define_views()
    assert tuple(spark.table(NETWORK_VIEW).first()) == (3, 2, 1, Decimal("0.333"), 5, 20, B2)


def test_monitoring(loaded):
    _, wh = loaded
    assert wh.log.validation_table.read().count() == 8
    assert {(r.suite_name, r.success) for r in
            latest_validations(wh.log.validation_table.read()).collect()} == {
        ("bronze_suite", True), ("silver_station_suite", True), ("silver_releve_suite", True),
        ("gold_suite", True)}
    assert wh.log.alert_table.read().count() == 0
    history = {r.dag_id: r for r in run_history(wh.log.runs()).collect()}
    assert history[SILVER_DAG].runs == 2 and history[SILVER_DAG].failures == 0
    assert history[SILVER_DAG].records == 4 and history[GOLD_DAG].records == 6
    assert history[GOLD_DAG].last_status == "success"
    assert rows(wh.log.freshness_table.read(), "source_name", "delay_minutes", "is_fresh") == [
        ("station_information", Decimal("1.00"), True), ("station_information", Decimal("6.00"), True),
        ("station_status", Decimal("1.00"), True), ("station_status", Decimal("1.00"), True)]


def test_empty_snapshot_stops_the_run(spark, tmp_path):
    """One full and one empty status document."""
    write(tmp_path, "information", "20260101_080000", STATIONS)
    write(tmp_path, "status", "20260101_080000", STATUS_1)
    write(tmp_path, "status", "20260101_080500", [])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(QualityGateError):
        run_batch(wh, read_envelope(spark, f"{tmp_path}/information"),
                  read_envelope(spark, f"{tmp_path}/status"), at(8, 6), SETTINGS)
    assert wh.reading.read().count() == 0
    assert wh.log.open_alerts().count() == 1
    wh.log.resolve(wh.log.open_alerts(), at(9))
    assert wh.log.open_alerts().count() == 0
    assert rows(wh.log.all_alerts(), "resolved") == [(True,)]


def test_silent_feed_is_reported(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, STATUS_1)
    run()
    medallion.check_freshness(wh, at(12), SETTINGS)
    assert rows(wh.log.freshness_table.read(), "delay_minutes", "is_fresh") == [
        (Decimal("1.00"), True)] * 2 + [(Decimal("240.00"), False)] * 2


def test_replay_changes_nothing(loaded):
    folder, wh = loaded
    before = contents(wh)
    cycle(wh, folder, at(8, 7))
    assert contents(wh) == before


def test_run_time_stamping_adds_readings(spark, tmp_path):
    """Stamped with the time of the run, a repeated document counts again."""
    wh, run = single(spark, tmp_path, STATIONS, STATUS_1)
    for minute in (1, 2):
        cycle(wh, tmp_path, at(8, minute), instant=at(8, minute))
    assert wh.reading.read().count() == 6


def test_null_bikes_stop_before_anything_is_merged(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, [status(101, "c", None, 1, [], 0)])
    with pytest.raises(QualityGateError, match="bronze_suite"):
        run()
    assert wh.log.validation_table.read().count() == 1
    alert = wh.log.alert_table.read().collect()
    assert [(a.column_name, a.severity, a.resolved) for a in alert] == [
        ("num_bikes_available", "CRITICAL", False)]
    assert wh.reading.read().count() == wh.station.read().count() == 0
    assert [(r.status, r.dag_id) for r in wh.log.runs().collect()] == [("failed", SILVER_DAG)]
    assert "bronze_suite" in wh.log.runs().first().error_message


def test_too_many_bikes_only_warn(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, [status(101, "c", 250, 1, [], 0)])
    run()
    alerts = wh.log.alert_table.read()
    assert {(a.suite_name, a.severity) for a in alerts.collect()} == {
        (s, "WARNING") for s in ("bronze_suite", "silver_releve_suite", "gold_suite")}
    assert rows(open_alerts_by_severity(alerts), "severity", "open_alerts") == [("WARNING", 3)]
    assert [a.suite_name for a in recent_open_alerts(alerts, 2).collect()] == \
        ["bronze_suite", "gold_suite"]
    assert wh.reading.read().count() == 1


def test_negative_bikes_warn_and_are_then_fatal(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, [status(101, "c", -1, 1, [], 0)])
    with pytest.raises(ContractViolation, match="velos_disponibles >= 0"):
        run()
    assert {a.severity for a in wh.log.alert_table.read().collect()} == {"WARNING"}
    assert wh.reading.read().count() == wh.station.read().count() == 0


def test_corrupt_position_and_flag_warn(spark, tmp_path):
    wh, run = single(spark, tmp_path, [station(101, "c", "A", 0, 2.3, 5)],
                     [status(101, "c", 1, 1, [], 0, is_installed=2)])
    run()
    got = {(a.suite_name, a.column_name) for a in wh.log.alert_table.read().collect()}
    assert got == {("silver_station_suite", "latitude"), ("silver_releve_suite", "est_installee"),
                   ("gold_suite", "latitude")}


def test_orphan_reading_is_fatal(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, [status(999, "c", 1, 1, [], 0)])
    with pytest.raises(ContractViolation, match="999"):
        run()
    assert wh.station.read().count() == 0
    # unless the station is known from before and that is accepted
    wh.station.replace(spark.createDataFrame(
        [(999, "c", "Old", 48.5, 2.5, 4, None)], wh.station.schema))
    with pytest.raises(ContractViolation, match="999"):
        run()
    cycle(wh, tmp_path, at(8, 2), Settings(rows=BOUNDS, known_stations=True))
    assert rows(wh.current.read(), "id_station", "nom") == [(999, "Old")]


def test_missing_field_fails_two_rules_without_a_crash(spark, tmp_path):
    row = {k: v for k, v in STATUS_1[0].items() if k != "station_id"}
    wh, run = single(spark, tmp_path, STATIONS, [row])
    with pytest.raises(QualityGateError):
        run()
    got = [(a.rule_name, a.column_name) for a in wh.log.alert_table.read().collect()]
    assert sorted(got) == [("expect_column_to_exist", "station_id"),
                           ("expect_column_values_to_not_be_null", "station_id")]


def test_field_without_a_rule_is_required_too(spark, tmp_path):
    rows_ = [{k: v for k, v in r.items() if k != "is_renting"} for r in STATUS_1]
    wh, run = single(spark, tmp_path, STATIONS, rows_)
    with pytest.raises(MissingColumns, match="is_renting"):
        run()


def test_incomplete_snapshot_stops(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, STATUS_1, Settings(rows=(5, 10)))
    with pytest.raises(QualityGateError, match="row_count"):
        run()


def test_values_read_as_zero_are_reported(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, [status(101, "c", 1, "?", [], 0)])
    run()
    details = wh.log.validation_table.read().filter("suite_name = 'silver_releve_suite'")
    assert '"num_docks_available": 1' in details.first().details


def test_gold_failures_alert_but_do_not_stop(spark, tmp_path):
    wh, run = single(spark, tmp_path, STATIONS, STATUS_1)
    run()
    run_gold(wh, at(9), Settings(rows=(50, 60), variant="full"))
    alerts = wh.log.alert_table.read().filter("suite_name = 'gold_suite'").collect()
    assert [(a.rule_name, a.severity) for a in alerts] == [
        ("expect_table_row_count_to_be_between", "CRITICAL")]


def test_quarantine_sets_rows_aside(spark, tmp_path):
    stations = [*STATIONS, station(104, "c", "Far", 0, 2.3, 5)]
    readings = [*STATUS_1, status(104, "c", -1, 1, [], 0, is_installed=2)]
    wh, run = single(spark, tmp_path, stations, readings, Settings(rows=BOUNDS, quarantine=True))
    run()
    run()  # a repeat sets nothing aside twice
    assert rows(wh.reading.read(), "id_station") == [(101,), (102,), (103,)]
    assert rows(wh.rejected.read(), "id_station", "_violations") == [(104, [
        "expect_column_values_to_be_between(velos_disponibles)",
        "expect_column_values_to_be_in_set(est_installee)"])]
    assert rows(wh.suspect.read(), "id_station") == [(104,)]
    assert wh.station.read().count() == 4  # suspect, but kept


ARRIVAL = [0, 2, 1]  # the second snapshot arrives last


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Three days with a changing dimension, vanishing stations and a late snapshot; and the
    tables after each arrival, gold being rebuilt from all readings every time."""
    folder = tmp_path_factory.mktemp("history")
    for i, (stamp, capacity) in enumerate([("20260101_235500", 10), ("20260102_000500", 12),
                                           ("20260103_080000", 20)]):
        write(folder, f"information{i}", stamp,
              [station(k, f"c{k}", f"n{k}", 48.5, 2.5, capacity + k) for k in range(5 - i)])
        write(folder, f"status{i}", stamp, [
            status(k, f"c{k}", (k * 7 + i * 3) % 11, k % 2, types(k, i), 1767254000 + i)
            for k in range(5 - i)])
    wh, after = Warehouse(spark, str(folder / "full")), []
    for i in ARRIVAL:
        batch(wh, folder, i, Settings(rows=BOUNDS, incremental=False))
        after.append(contents(wh))
    return folder, after


def batch(wh, folder, i, settings):
    run_batch(wh, read_envelope(wh.spark, f"{folder}/information{i}"),
              read_envelope(wh.spark, f"{folder}/status{i}"), at(8, i, day=4), settings)


def test_incremental_gold_equals_full_gold(spark, tmp_path, history):
    """With sums that settle after a day and late data for a settled day."""
    folder, after = history
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for i, expected in zip(ARRIVAL, after):
        batch(wh, folder, i, Settings(rows=BOUNDS, settle_days=1))
        assert contents(wh) == expected
    assert wh.current.read().count() == 5  # vanished stations stay
    assert rows(wh.settled.read().select("through").distinct()) == [(date(2026, 1, 2),)]


def test_next_cycle_makes_up_for_a_failed_gold_step(spark, tmp_path, history, monkeypatch):
    folder, after = history
    wh, settings = Warehouse(spark, str(tmp_path / "wh")), Settings(rows=BOUNDS)
    batch(wh, folder, ARRIVAL[0], settings)
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "build_current", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batch(wh, folder, ARRIVAL[1], settings)
    batch(wh, folder, ARRIVAL[2], settings)
    assert contents(wh) == after[-1]
    assert run_history(wh.log.runs()).filter(f"dag_id = '{GOLD_DAG}'").first().failures == 1


def test_settled_sums_advance_with_the_days(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    write(tmp_path, "information", "20260101_080000",
          [station(k, "c", f"n{k}", 48.5, 2.5, 10) for k in range(2)])
    for day in range(1, 5):
        write(tmp_path, "status", f"2026010{day}_080000",
              [status(k, "c", day + k, 1, [], 0) for k in range(2)])
        cycle(wh, tmp_path, at(8, 1, day=day), Settings(rows=BOUNDS, settle_days=1))
    # Days 1 and 2 lie before the newest day less one; the others are added up on demand.
    assert rows(wh.settled.read(), "id_station", "total", "observations") == [
        (0, 3, 2), (1, 5, 2)]
    assert rows(wh.hourly.read(), "id_station", "moy_velos_disponibles",
                "moy_taux_disponibilite", "nb_observations") == [
        (0, Decimal("2.50"), Decimal("0.250"), 4), (1, Decimal("3.50"), Decimal("0.350"), 4)]
