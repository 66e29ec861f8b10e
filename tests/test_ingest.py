"""The mock streams end to end, replay, failure isolation, ageing, names and streaming."""

from __future__ import annotations

import datetime as dt

import pytest
from fixtures import LSST, PARAMS, ZTF, alert, by_id, contract, mjd_datetime, objects, staged
from pyspark.sql import functions as F

from skyflow.operators import clock, upsert
from skyflow.plans import ingest as plan
from skyflow.sources import state as store_module


def _run(spark, surveys, state=None):
    readers = [(name, lambda rows=rows: contract(spark, rows)) for name, rows in surveys]
    return plan.multi_survey_ingest(state or store_module.empty_state(spark), readers, PARAMS)


@pytest.fixture(scope="module")
def mock_run(spark):
    run = _run(spark, [("lsst", LSST), ("ztf", ZTF)])
    assert not run.failed
    return run


def test_three_objects(mock_run):
    got = by_id(mock_run.state.objects)
    assert sorted(got) == [1, 2, 3]
    one = got[1]
    assert (one["ra"], one["dec"], one["jdmin"], one["jdmax"], one["jd_obs_trigger"]) == (33.25, -12.5, 61003.0, 61058.0, 61047.0)
    assert one["latest_mags"] == {"g_lsst": 19.75, "i_lsst": 19.25, "z_lsst": 18.5, "g_ztf": 19.5, "r_ztf": 19.0}
    assert one["n_sources"] == {"g_lsst": 14, "i_lsst": 2, "z_lsst": 6, "g_ztf": 4, "r_ztf": 7}
    assert [got[i]["last_survey_id"] for i in (1, 2, 3)] == [2, 1, 2]
    assert all(r["active"] and r["sync_pending"] for r in got.values())


def test_ids_follow_the_newest_first_order(spark):
    # Without an order of their own, 7207 (61052) leads before 7100 (61047).
    rows = contract(spark, LSST).drop("input_row")
    result = plan.ingest_batch(store_module.empty_state(spark), rows, PARAMS)
    assert {i: r["ra"] for i, r in by_id(result.created).items()} == {1: 48.5, 2: 33.25}


def test_names_nights_and_native_ids(mock_run):
    assert {r["name"][-3:] for r in mock_run.state.objects.collect()} == {"aaa", "aab", "aac"}
    assert {tuple(r) for r in mock_run.state.nights.collect()} == {(1, 61046), (1, 61051), (2, 61057), (2, 61051)}
    native = {(r["survey_id"], r["native_id"]) for r in mock_run.state.native_names.collect()}
    assert native == {(1, "7100"), (1, "7207"), (2, "ZTF25north"), (2, "ZTF25south")}


def test_event_counts(mock_run):
    counts = {r["event_type"]: r["count"] for r in mock_run.events.groupBy("event_type").count().collect()}
    assert counts == {"alert": 4, "created": 3, "selected": 4}


def test_replay_changes_no_object(spark, mock_run):
    again = _run(spark, [("lsst", LSST), ("ztf", ZTF)], mock_run.state)
    assert by_id(again.state.objects) == by_id(mock_run.state.objects)
    counts = {r["event_type"]: r["count"] for r in again.events.groupBy("event_type").count().collect()}
    assert counts == {"alert": 4}


def test_failed_survey_does_not_stop_the_others(spark):
    def broken():
        raise ConnectionError("no broker")

    run = plan.multi_survey_ingest(
        store_module.empty_state(spark), [("lsst", broken), ("ztf", lambda: contract(spark, ZTF))], PARAMS)
    assert list(run.failed) == ["lsst"]
    assert run.state.objects.count() == 2
    assert {r["survey_id"] for r in run.state.nights.collect()} == {2}


def test_manual_submission_events(spark):
    params = plan.IngestParams(now=PARAMS.now, submitted_by="a person")
    result = plan.ingest_batch(store_module.empty_state(spark), contract(spark, [alert("TNS1", 9)]), params)
    kinds = {(r["event_type"], r["submitted_by"]) for r in result.events.collect()}
    assert ("manual_submission", "a person") in kinds and not any(k == "alert" for k, _ in kinds)


def test_report(spark, mock_run):
    off = mock_run.state.objects.filter("false")
    created = mock_run.results["lsst"].created.unionByName(mock_run.results["ztf"].created)
    text = plan.report_text(created, mock_run.results["ztf"].updated, off)
    assert "new: 3, updated: 1, deactivated: 0" in text
    assert "_No changes" in plan.report_text(off, off, off)


def _upserted(spark, old, *rows):
    return by_id(upsert.upsert_objects(objects(spark, old), staged(spark, *rows), PARAMS.now_column))[old["object_id"]]


STORED = {"object_id": 1, "latest_mags": {"g": 20.0, "r": 21.0}, "latest_mjd": {"g": 61050.0, "r": 61040.0},
          "n_sources": {"g": 5, "r": 5}}


def test_only_newer_bands_change_and_counts_follow_the_stored_dates(spark):
    new = alert(jdmax=61055.0, mjd={"g": 61055.0, "r": 61030.0}, mag={"g": 19.0, "r": 18.0}, n={"g": 6, "r": 6, "i": 9})
    got = _upserted(spark, STORED, (1, 0) + new)
    assert got["latest_mags"] == {"g": 19.0, "r": 21.0}
    assert got["latest_mjd"] == {"g": 61055.0, "r": 61040.0}
    assert got["n_sources"] == {"g": 6, "r": 5}     # r is older, i has no date
    assert got["new_detection"] and got["updated"] == PARAMS.now


def test_older_alert_widens_and_fills_but_does_not_wake(spark):
    old = {**STORED, "active": False, "sync_pending": False}
    new = alert(survey_id=2, jdmin=60900.0, jdmax=61049.0, mjd={"i": 61049.0}, mag={"i": 22.0}, n={"i": 1})
    got = _upserted(spark, old, (1, 0) + new)
    assert (got["jdmin"], got["jdmax"], got["last_survey_id"]) == (60900.0, 61050.0, 1)
    assert got["latest_mags"] == {"g": 20.0, "r": 21.0, "i": 22.0}
    assert not got["active"] and not got["sync_pending"] and got["updated"] == mjd_datetime(61050.0)


def test_newer_alert_wakes_an_inactive_object(spark):
    got = _upserted(spark, {**STORED, "active": False, "sync_pending": False}, (1, 0) + alert(jdmax=61051.0))
    assert got["active"] and got["sync_pending"] and not got["old_active"] and got["new_detection"]


def test_only_the_newest_row_gives_bands(spark):
    newest = alert("n", jdmax=61056.0, mjd={"g": 61056.0}, mag={"g": 19.0})
    older = alert("o", jdmin=60000.0, jdmax=61054.0, mjd={"z": 61054.0}, mag={"z": 18.0})
    got = _upserted(spark, STORED, (1, 0) + newest, (1, 1) + older)
    assert "z" not in got["latest_mags"] and got["jdmin"] == 60000.0


def test_first_batch_names_win(spark):
    old = spark.createDataFrame([(1, 1, "first")], "object_id bigint, survey_id int, native_id string")
    new = spark.createDataFrame([(1, 1, "second"), (1, 2, "other")], old.schema)
    both, added = upsert.insert_if_absent(old, new, ["object_id", "survey_id"])
    assert {tuple(r) for r in both.collect()} == {(1, 1, "first"), (1, 2, "other")} and added.count() == 1


@pytest.mark.parametrize("n_later, off", [(10, False), (11, True)])
def test_more_than_ten_later_nights(spark, n_later, off):
    nights = spark.createDataFrame([(1, 61049 + i) for i in range(n_later + 1)] + [(2, 70000)], "survey_id int, night int")
    obj = objects(spark, {"object_id": 1, "latest_mags": {"g": 20.0}})
    got = by_id(clock.deactivate_objects(obj, nights, 61100.0))[1]
    assert got["nights_since"] == n_later
    assert got["active"] is not off and got["deactivation_reason"] == ("stale_10d" if off else None)


def test_nights_with_gaps_before_and_after(spark):
    nights = spark.createDataFrame([(1, 100), (1, 105), (1, 110)], "survey_id int, night int")
    days = [99, 100, 102, 105, 109, 110, 300]
    objs = objects(spark, *[{"object_id": d, "jdmax": d + 0.75} for d in days])
    got = {k: v["nights_since"] for k, v in by_id(clock.nights_since_detection(objs, nights, 0.0)).items()}
    assert got == {d: float(sum(n > d for n in (100, 105, 110))) for d in days}


def test_unknown_survey_uses_days_and_faint_rule(spark):
    nights = spark.createDataFrame([(1, 61049)], "survey_id int, night int")
    objs = objects(
        spark,
        {"object_id": 1, "last_survey_id": None, "latest_mags": {"g": 20.0}},
        {"object_id": 2, "latest_mags": {"g": 22.6, "r": 23.0}},
        {"object_id": 3, "latest_mags": {"g": 22.6, "r": 22.5}},
        {"object_id": 4, "latest_mags": {}},
        {"object_id": 5, "latest_mags": {"g": 30.0}, "active": False, "sync_pending": False},
    )
    got = {k: v["deactivation_reason"] for k, v in by_id(clock.deactivate_objects(objs, nights, 61060.5)).items()}
    assert got == {1: "stale_10d", 2: "faint_alert", 3: None, 4: None, 5: None}


def test_names_restart_with_the_year_and_end(spark):
    objs = objects(spark, {"object_id": 7, "name": "SKY25abc"})
    assert upsert.name_state(objs, "SKY", "25") == upsert.NameState(8, 29, "SKY", "25")
    assert upsert.name_state(objs, "SKY", "26").next_name == 0
    with pytest.raises(ValueError):
        upsert.check_names_left(upsert.NameState(1, 12_355_000, "SKY", "26"), 929)


def test_now_mjd():
    assert plan.IngestParams(now=dt.datetime(2024, 1, 1)).now_mjd == 60310.0
    assert F is not None
