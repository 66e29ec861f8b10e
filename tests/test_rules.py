"""Normalising, validation, selection, outbox, facility, host and history rules on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from fixtures import by_id, mjd_datetime, objects
from pyspark.sql import functions as F

from skyflow.functions import bands, scalars
from skyflow.operators import facility, history, hosts, normalize, outbox, selection, validate
from skyflow.sources import alerts, dimensions, facility as facility_source

INF, NAN = float("inf"), float("nan")


# ---------------------------------------------------------------- normalising

def test_lsst_rows(spark):
    big = 170028485034020999
    rows = [
        (big, 1.0, 2.0, 61000.0, 61050.0, 3630.78, 61050.0, 5.9, 0.0, 61050.0, None),
        (2, 1.0, 2.0, None, 61050.0, -5.0, 61050.0, NAN, NAN, 61050.0, 3.0),
        (3, 1.0, 2.0, None, 61050.0, 100.0, None, 2.0, INF, 61049.0, 1.0),
    ]
    raw = spark.createDataFrame(
        rows, "diaObjectId bigint, ra double, decl double, firstDiaSourceMjdTai double, lastDiaSourceMjdTai double, "
        "g_psfFlux double, g_latestMJD double, ngSources double, r_psfFlux double, r_latestMJD double, nrSources double")
    got = by_id(normalize.normalize_lsst(raw, 5), "native_id")
    one = got[str(big)]
    assert one["latest_mag"] == {"g_lsst": 22.5} and one["latest_filter"] == {"g_lsst": 61050.0}
    assert one["n_sources"] == {"g_lsst": 5, "r_lsst": 0, "i_lsst": 0, "z_lsst": 0}
    assert (one["survey_id"], one["pipeline_id"], one["dec"]) == (1, 5, 2.0)
    assert got["2"]["latest_mag"] == {} and got["2"]["n_sources"]["g_lsst"] == 0 and got["2"]["n_sources"]["r_lsst"] == 3
    assert got["3"]["latest_mag"] == {} and got["3"]["n_sources"]["g_lsst"] == 2


def test_lsst_dec_column_and_missing_columns(spark):
    raw = spark.createDataFrame([(1, 7.5)], "diaObjectId bigint, dec double")
    row = normalize.normalize_lsst(raw, 1).first()
    assert row["dec"] == 7.5 and row["ra"] is None and row["latest_mag"] == {}


def test_ztf_rows(spark):
    raw = spark.createDataFrame(
        [("Z1", 2461000.5, 2461050.5, "g", 20.12345), ("Z2", None, 2461050.5, "i", 20.0), ("Z3", None, 2461050.5, "r", NAN),
         ("Z4", None, NAN, "r", 20.0), ("Z5", None, 2461050.5, None, 20.0)],
        "objectId string, first_jd double, latest_jd double, latestFilter string, latestMag double")
    got = by_id(normalize.normalize_ztf(raw, 1), "native_id")
    assert got["Z1"]["latest_mag"] == {"g_ztf": 20.1235} and got["Z1"]["latest_filter"] == {"g_ztf": 61050.0}
    assert got["Z1"]["n_sources"] == {"g_ztf": 1} and got["Z1"]["jdmin"] == 61000.0
    assert all(got[z]["latest_mag"] == {} and got[z]["n_sources"] == {} for z in ("Z2", "Z3", "Z4", "Z5"))


def test_ztf_two_band_rows(spark):
    raw = spark.createDataFrame([("A", 2461050.5, 19.0, 18.0), ("B", 2461050.5, None, 18.0), ("C", 2461050.5, NAN, None)],
                                "objectId string, latest_jd double, gmag double, rmag double")
    got = {k: v["latest_mag"] for k, v in by_id(normalize.normalize_ztf(raw, 1), "native_id").items()}
    assert got == {"A": {"g_ztf": 19.0}, "B": {"r_ztf": 18.0}, "C": {}}


def test_newest_alert_treats_nan_as_missing(spark):
    raw = spark.createDataFrame([(1, NAN, 1), (1, 5.0, 2), (1, 7.0, 3), (1, 7.0, 4), (2, None, 5)], "id int, t double, o int")
    got = {r["id"]: r["o"] for r in normalize.latest_alert_per_object(raw, "id", "t", "o").collect()}
    assert got == {1: 4, 2: 5}


def test_hot_ids_are_reduced_before_the_shuffle(spark):
    raw = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").cast("double").alias("t"))
    plan = normalize.latest_alert_per_object(raw, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# ---------------------------------------------------------------- validation

GOOD = {"native_id": "a", "survey_id": 1.0, "pipeline_id": 1.0, "ra": 10.0, "dec": 0.0, "jdmin": None, "jdmax": 61050.0,
        "latest_filter": "{}", "latest_mag": "{}", "n_sources": "{}"}
CASES = [
    ({}, None), ({"ra": 0.0, "dec": -90.0}, None), ({"dec": 90.0}, None), ({"latest_mag": '{"g":"21.5"}'}, None),
    ({"latest_mag": '{"g": true}'}, None),
    ({"native_id": None}, "native id missing"),
    ({"ra": NAN}, "ra is no finite number"), ({"dec": None}, "dec is no finite number"),
    ({"jdmax": INF}, "jdmax is no finite number"), ({"survey_id": None}, "survey_id is no finite number"),
    ({"pipeline_id": None}, "pipeline_id is no finite number"), ({"ra": None, "jdmax": 1.0}, "ra is no finite number"),
    ({"ra": 360.0}, "position outside the sky"), ({"ra": -0.1}, "position outside the sky"), ({"dec": 90.01}, "position outside the sky"),
    ({"jdmax": 2461000.5}, "jdmax 2461000.5 lies outside the accepted dates"), ({"jdmax": 40000.0}, "jdmax 40000.0 lies outside the accepted dates"),
    ({"jdmax": 61062.01}, "jdmax 61062.01 lies outside the accepted dates"), ({"jdmax": 61062.0}, None),
    ({"latest_mag": "{bad"}, "latest_mag cannot be read as JSON"), ({"latest_mag": None}, "latest_mag cannot be read as JSON"),
    ({"latest_mag": "[1]"}, "latest_mag holds values that are no finite numbers"), ({"latest_mag": '{"g":NaN}'}, "latest_mag holds values that are no finite numbers"),
    ({"latest_mag": '{"g":-Infinity}'}, "latest_mag holds values that are no finite numbers"),
    ({"latest_mag": '{"g":null}'}, "latest_mag holds values that are no finite numbers"), ({"n_sources": '{"g":"x"}'}, "n_sources holds values that are no finite numbers"),
    ({"latest_filter": "nope", "latest_mag": "{bad"}, "latest_filter cannot be read as JSON"),
]


def test_first_failing_reason(spark):
    schema = ("n int, native_id string, survey_id double, pipeline_id double, ra double, dec double, jdmin double, jdmax double, "
              "latest_filter string, latest_mag string, n_sources string")
    rows = [tuple([i] + [{**GOOD, **change}[c] for c in GOOD]) for i, (change, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, schema)
    got = {r["n"]: r["reject_reason"] for r in validate.check_alerts(df, 61061.0).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}
    assert validate.validate_alerts(df, 61061.0).count() + validate.alert_rejects(df, 61061.0).count() == len(CASES)
    typed = {r["n"]: r["latest_mag"] for r in validate.validate_alerts(df, 61061.0).collect()}
    assert typed[3] == {"g": 21.5} and typed[4] == {"g": 1.0}


def test_map_columns_are_checked_unless_known_good(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0, 1.0, None, 61050.0, {"g": NAN}, {}, {})], validate_schema())
    assert validate.alert_rejects(df, 61061.0).first()["reject_reason"] == "latest_filter holds values that are no finite numbers"


def validate_schema():
    from skyflow.schemas import CONTRACT

    return CONTRACT


def test_messages(spark):
    texts = ['{"id": 1}', "{bad", "[1]", '{"x": 1}', '{"id": null}', "null", '"s"', '{"id": "a", "y": NaN}']
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, offset int")
    skipped = {r["offset"]: r["skip_reason"] for r in alerts.skipped_messages(df, "id").collect()}
    assert skipped == {1: "not JSON", 2: "not an object", 3: "no id", 4: "no id", 5: "not an object", 6: "not an object"}
    from pyspark.sql.types import StringType, StructField, StructType

    got = alerts.parse_alerts(df, StructType([StructField("id", StringType())]), "id").collect()
    assert {(r["offset"], r["id"]) for r in got} == {(0, "1"), (7, "a")}


# ---------------------------------------------------------------- scalars

def test_base26_names(spark):
    idx = [0, 25, 26, 17575, 17576, 474551, 474552, 12355927]
    df = spark.createDataFrame([(i,) for i in idx], "i bigint").select("i", scalars.base26_name(F.col("i")).alias("s"))
    got = {r["i"]: r["s"] for r in df.collect()}
    assert got == {0: "aaa", 25: "aaz", 26: "aba", 17575: "zzz", 17576: "aaaa", 474551: "zzzz", 474552: "aaaaa", 12355927: "zzzzz"}
    assert [scalars.parse_base26(got[i]) for i in idx] == idx
    with pytest.raises(Exception, match="no name left"):
        spark.createDataFrame([(12355928,)], "i bigint").select(scalars.base26_name(F.col("i"))).collect()


def test_dates_and_jd(spark):
    row = spark.range(1).select(
        scalars.mjd_to_jd(F.lit(None).cast("double")).alias("none"), scalars.mjd_to_jd(F.lit(61000.0)).alias("jd"),
        scalars.night_to_date(F.lit(0)).alias("d"), scalars.observing_night(F.lit(61050.4)).alias("n"),
        scalars.ra_wrap(F.lit(-0.5)).alias("ra"), scalars.ra_wrap(F.lit(359.999999999)).alias("top"),
        scalars.merge_patch(F.lit('{"is_active": false, "a": 1}'), F.lit('{"a": 2, "b": [1]}')).alias("p")).first()
    assert (row["none"], row["jd"], row["d"], row["n"]) == (0.0, 2461000.5, dt.date(1858, 11, 17), 61049)
    assert (row["ra"], row["top"]) == (359.5, 359.99999999)
    import json

    assert json.loads(row["p"]) == {"is_active": False, "a": 2, "b": [1]}
    with pytest.raises(Exception, match="JD outside"):
        spark.range(1).select(scalars.mjd_to_jd(F.lit(50000.0))).collect()


def test_latest_detection_and_milestones(spark):
    objs = objects(
        spark,
        {"object_id": 1, "latest_mags": {"g_lsst": 20.0, "r_ztf": 19.0}, "latest_mjd": {"g_lsst": 5.0, "r_ztf": 5.0}},
        {"object_id": 2, "latest_mags": {"g_lsst": 56.4, "u_lsst": 20.0}, "latest_mjd": {"g_lsst": 5.0, "u_lsst": 6.0}},
        {"object_id": 3, "latest_mags": {"g_lsst": 20.0}, "latest_mjd": {}},
        {"object_id": 4, "latest_mags": {"g_lsst": 20.0, "r_ztf": 19.0}, "latest_mjd": {"g_lsst": 6.0, "r_ztf": 5.0}})
    det = bands.latest_detection(F.col("latest_mags"), F.col("latest_mjd"))
    got = {r["object_id"]: r["d"] and (r["d"]["band"], r["d"]["mag"]) for r in objs.select("object_id", det.alias("d")).collect()}
    assert got == {1: ("r_ztf", 19.0), 2: None, 3: None, 4: ("g_lsst", 20.0)}
    cases = [(17.9, 19.0, True), (17.9, 17.95, False), (16.5, 17.5, True), (18.0, 18.1, True), (14.9, 15.0, False), (18.0, None, True)]
    df = spark.createDataFrame(cases, "m double, s double, due boolean").select(
        bands.milestone_due(F.col("m"), F.col("s")).alias("got"), "due")
    assert all(r["got"] == r["due"] for r in df.collect())


# ---------------------------------------------------------------- selection

LC_SCHEMA = "objectId string, jd double, fid int, nid int, magpsf double, sigmapsf double, candid long"


def test_lightcurve_rules(spark):
    good = [("A", 1.0, 1, 1, 22.0, 0.1, 1), ("A", 2.0, 2, 2, 22.0, 0.1, 2), ("A", 3.0, 3, 2, 23.0, 0.1, 3)]
    bad = [("B", 1.0, 1, 1, 21.0, 0.5, 1), ("B", 2.0, 2, 2, 21.0, 0.1, 2), ("B", 3.0, 3, 2, 21.0, 0.1, 3)]
    late = [("C", 1.0, 1, 1, 23.0, 0.1, 1), ("C", 2.0, 2, 2, 23.0, 0.1, 2), ("C", 3.0, 3, 2, 23.0, 0.1, 3),
            ("C", 4.0, 3, 3, 22.5, None, None), ("C", 5.0, 1, 4, 24.0, 0.9, 5)]
    lc = spark.createDataFrame(good + bad + late, LC_SCHEMA)
    names = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "objectId string")
    c = selection.LightcurveCriteria()
    assert {r[0]: r[1] for r in selection.lightcurve_select(lc, names, c).collect()} == {"A": True, "B": False, "C": True, "D": False}
    # C reaches the limit with a non-detection at 4, so the first detection date that passes is 5.
    assert {r[0]: r[1] for r in selection.lightcurve_first_pass(lc, c).collect()} == {"A": 3.0, "C": 5.0}


# ---------------------------------------------------------------- outbox

@pytest.mark.parametrize("method, status, body, error, want", [
    ("POST", 201, "[]", None, "ok"), ("PATCH", 299, '{"a":1}', None, "ok"), ("GET", 404, "x", None, "rejected"),
    ("POST", 422, "{}", None, "rejected"), ("POST", None, None, "timeout", "ambiguous"), ("POST", 500, "x", None, "ambiguous"),
    ("POST", 200, "<html>", None, "ambiguous"), ("POST", 200, "null", None, "ambiguous"), ("POST", 401, "{}", None, "retry"),
    ("POST", 429, "{}", None, "retry"), ("PATCH", None, None, "timeout", "retry"), ("GET", 500, "x", None, "retry"),
    ("PATCH", 200, "<html>", None, "retry"), ("GET", None, None, "unencodable", "rejected"), ("POST", 302, "{}", None, "ambiguous"),
])
def test_outcomes(spark, method, status, body, error, want):
    df = spark.createDataFrame([(method, status, body, error)], "m string, s int, b string, e string")
    assert df.select(outbox.classify_response(F.col("m"), F.col("s"), F.col("b"), F.col("e"))).first()[0] == want


def test_payload_refusals(spark):
    ok = {"latest_mags": {"g_lsst": 21.1234}, "latest_mjd": {"g_lsst": 61000.0}}
    objs = objects(
        spark, {"object_id": 1, "dec": 40.0, "ra": -0.5, **ok}, {"object_id": 2, "dec": 40.00001, **ok},
        {"object_id": 3, "latest_mags": {"g_lsst": 56.4}, "latest_mjd": {"g_lsst": 1.0}}, {"object_id": 4, "ra": NAN, **ok},
        {"object_id": 5, "dec": -90.0, **ok})
    got = by_id(outbox.build_target_payload(objs))
    assert {i: r["refusal"] and r["refusal"].split()[0] + " " + r["refusal"].split()[-1] for i, r in got.items()} == {
        1: None, 2: "dec limit", 3: "no sent", 4: "position unknown", 5: "dec limit"}
    import json

    p = json.loads(got[1]["payload"])
    assert (p["ra"], p["dec"], p["mag"], p["mag_type"], p["cadence"], p["is_active"]) == (359.5, 40.0, 21.123, "LSST_g_AB", 1048576, True)
    assert p["name"] == "SKY26x1" and p["uploadedfor_survey_id"] == 15 and len(p) == 23


def _answers(spark, *rows):
    return spark.createDataFrame(rows, "batch_id bigint, status_code int, body string, error_kind string")


def _found(spark, rows):
    return spark.createDataFrame(rows, "object_id bigint, id bigint, name string, subsurvey string, ra double, dec double, mag double, is_active boolean")


def test_downtime_sequence(spark):
    ok = {"latest_mags": {"g_lsst": 21.0}, "latest_mjd": {"g_lsst": 61000.0}}
    state = objects(spark, *[{"object_id": i, "ra": 100.0 + i, **ok} for i in (1, 2, 3)])

    def send(state, answer):
        ready = outbox.build_target_payload(outbox.new_targets(state)).filter("refusal IS NULL")
        batches = outbox.request_batches(ready)
        assert batches.count() == 1
        sent = ready.select(F.lit(0).cast("long").alias("batch_id"), "object_id", "name", F.lit(21.0).alias("mag"))
        flying = outbox.mark_in_flight(state, ready)
        return outbox.apply_create_results(flying, outbox.apply_create_responses(sent, answer)).drop("was_created")

    def looked_up(state, found):
        asked = state.filter("sync_state = 'ambiguous'").select("object_id", "name", "ra", "dec", F.lit(False).alias("has_next"))
        return outbox.reconcile_ambiguous(state, outbox.reconcile_by_lookup(asked, found))

    down = send(state, _answers(spark, (0, None, None, "timeout")))
    rows = by_id(down)
    assert all(r["sync_state"] == "ambiguous" and r["sync_pending"] and r["facility_id"] is None and r["sync_attempts"] == 1 for r in rows.values())
    assert outbox.new_targets(down).count() == 0          # never sent again unseen
    none = looked_up(down, _found(spark, []))
    assert all(r["sync_state"] is None for r in by_id(none).values())
    lost = send(none.drop("was_adopted"), _answers(spark, (0, None, None, "connection reset")))
    there = _found(spark, [(i, 900 + i, f"SKY26x{i}", "sky-sn", 100.0 + i, 2.0, 21.0, True) for i in (1, 2, 3)])
    end = by_id(looked_up(lost, there))
    assert all(r["facility_id"] == 900 + i and r["sync_state"] is None and not r["sync_pending"] and r["was_adopted"] for i, r in end.items())


def test_rejected_batches_are_split(spark):
    batches = spark.createDataFrame([(0, [1, 2], ["a", "b"], '[{"name":"a","mag":1.5},{"name":"b"}]'), (1, [3], ["c"], "[{}]"), (2, [4, 5], ["d", "e"], "[{},{}]")],
                                    "batch_id bigint, object_ids array<bigint>, names array<string>, payload string")
    outcomes = spark.createDataFrame([(0, "rejected"), (1, "rejected"), (2, "ok")], "batch_id bigint, outcome string")
    assert {tuple(r) for r in outbox.split_rejected_batches(batches, outcomes).collect()} == {(0, 1, "a", '{"name":"a","mag":1.5}'), (0, 2, "b", '{"name":"b"}')}


def test_create_answers_by_name(spark):
    objs = objects(spark, *[{"object_id": i, "sync_state": "ambiguous"} for i in (1, 2, 3, 4)])
    sent = spark.createDataFrame([(0, 1, "SKY26x1", 20.0), (0, 2, "SKY26x2", 20.0), (1, 3, "SKY26x3", 20.0)],
                                 "batch_id bigint, object_id bigint, name string, mag double")
    answers = _answers(spark, (0, 201, '[{"name": "SKY26x1", "id": 7}, {"name": "SKY26x2"}]', None), (1, 400, '{"e": 1}', None))
    got = by_id(outbox.apply_create_results(objs, outbox.apply_create_responses(sent, answers)))
    assert (got[1]["facility_id"], got[1]["facility_mag"], got[1]["sync_pending"], got[1]["was_created"]) == (7, 20.0, False, True)
    assert got[2]["sync_state"] == "ambiguous" and "no target of this name" in got[2]["sync_last_error"]
    assert got[3]["sync_state"] == "failed" and got[3]["sync_attempts"] == 1
    assert got[4]["sync_attempts"] == 0 and got[4]["sync_state"] == "ambiguous"


def test_lookup_verdicts(spark):
    near, far = 2.0 + 0.9 / 3600, 2.0 + 1.1 / 3600
    asked = spark.createDataFrame([(i, f"n{i}", 150.0, 2.0, i == 6) for i in range(1, 8)],
                                  "object_id bigint, name string, ra double, dec double, has_next boolean")
    found = _found(spark, [
        (2, 20, "n2", "sky-sn", 150.0, near, 19.0, True), (3, 30, "n3", "sky-sn", 150.0, far, 19.0, True),
        (4, 40, "n4", "sky-sn", 150.0, 2.0, 19.0, True), (4, 41, "n4", "sky-sn", 150.0, 2.0, 19.0, True),
        (5, 50, "zz", "sky-sn", 150.0, 2.0, 19.0, True), (6, 60, "n6", "sky-sn", 150.0, 2.0, 19.0, True),
        (7, 70, "n7", "source", 150.0, 2.0, 19.0, True)])
    got = {r["object_id"]: r["verdict"] for r in outbox.reconcile_by_lookup(asked, found).collect()}
    assert got == {1: "resend", 2: "adopt", 3: "conflict", 4: "conflict", 5: "foreign", 6: "conflict", 7: "foreign"}


def test_patch_answers(spark):
    objs = objects(spark, *[{"object_id": i, "facility_id": i, "facility_mag": 19.0} for i in (1, 2, 3, 4)])
    answers = spark.createDataFrame(
        [(1, 200, '{"is_active": true, "mag": 17.5}', None), (2, 200, '{"is_active": false, "mag": 19}', None),
         (3, 404, "gone", None), (4, None, None, "timeout")],
        "object_id bigint, status_code int, body string, error_kind string")
    got = by_id(outbox.apply_active_results(objs, answers))
    assert [got[i]["sync_state"] for i in (1, 2, 3, 4)] == [None, "failed", "failed", None]
    assert [got[i]["sync_pending"] for i in (1, 2, 3, 4)] == [False, True, True, True]
    sent = spark.createDataFrame([(i, 17.5) for i in (1, 2, 3, 4)], "object_id bigint, mag double")
    mags = by_id(outbox.apply_mag_results(objs, sent, answers))
    assert [mags[i]["facility_mag"] for i in (1, 2, 3, 4)] == [17.5, 19.0, 19.0, 19.0]
    assert mags[2]["sync_state"] is None and mags[2]["sync_last_error"].startswith("magnitude update ok")


def test_rejection_back_off(spark):
    now = mjd_datetime(61000.0)
    log = spark.createDataFrame(
        [([1, 2], "PATCH", "rejected", '{"mag": 17}', now - dt.timedelta(days=6)), ([3], "PATCH", "rejected", '{"mag": 17}', now - dt.timedelta(days=8)),
         ([4], "PATCH", "rejected", '{"is_active": true}', now), ([5], "POST", "rejected", '{"mag": 17}', now)],
        "object_ids array<bigint>, method string, outcome string, payload string, request_time timestamp")
    objs = objects(spark, *[{"object_id": i} for i in range(1, 6)])
    kept = outbox.without_recent_rejection(objs, log, F.lit(now))
    assert {r["object_id"] for r in kept.collect()} == {3, 4, 5}


def test_hand_switches(spark):
    objs = objects(spark, {"object_id": 1, "sync_state": "failed", "sync_pending": False}, {"object_id": 2, "sync_state": "failed"})
    chosen = spark.createDataFrame([(1,)], "object_id bigint")
    assert {i: r["sync_state"] for i, r in by_id(outbox.release_failed(objs, chosen)).items()} == {1: None, 2: "failed"}
    off = by_id(outbox.switch_by_hand(objs, chosen, False))
    assert (off[1]["active"], off[1]["sync_pending"], off[2]["active"]) == (False, True, True)


# ---------------------------------------------------------------- facility tables

def test_flatten_targets(spark):
    bodies = ['[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]', '{"count": 1, "next": null, "results": [{"id": 3, "name": "c"}]}',
              '[{"count": 1, "next": "u", "results": [{"id": 4, "name": "d"}]}]', '{"id": 5, "name": "e"}', "[]"]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {(r["id"], r["name"]) for r in facility_source.flatten_targets(pages).collect()} == {(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")}


def test_ingestion_merge(spark):
    objs = objects(spark, {"object_id": 1, "facility_id": 10, "date_ingested": mjd_datetime(60000.0)}, {"object_id": 2, "facility_id": 11}, {"object_id": 3})
    targets = spark.createDataFrame(
        [(10, 100, 7, "bad date", 1), (10, 101, 8, "bad date", 2), (11, None, 7, "2026-01-01", 3), (None, 5, 5, None, 4)],
        "id bigint, ostd_targ_id bigint, ostd_u_obj_id bigint, date_ingested string, n int")
    merged = facility.ingestion_merge(objs, targets, F.col("n"))
    got = by_id(merged)
    assert (got[1]["ostd_targ_id"], got[1]["ostd_u_obj_id"], got[1]["date_ingested"]) == (101, 8, None)
    assert got[2]["ostd_targ_id"] is None and len(got) == 3
    assert by_id(facility.ingestion_merge(merged, targets, F.col("n"))) == got


def test_watermark(spark):
    objs = objects(spark, {"object_id": 1, "date_ingested": dt.datetime(2026, 9, 10)}, {"object_id": 2})
    assert facility.incremental_watermark(objs, "2026-08-01").first()[0] == dt.datetime(2026, 9, 7)
    assert facility.incremental_watermark(objs, "2026-08-01", True).first()[0] == dt.datetime(2026, 8, 1)
    assert facility.incremental_watermark(objs.filter("false"), "2026-08-01").first()[0] == dt.datetime(2026, 8, 1)
    assert facility.incremental_watermark(objs.filter("false"), "2026-08-01", True).first()[0] == dt.datetime(2026, 8, 1)


def test_admin(spark):
    objs = objects(spark, *[{"object_id": i, "facility_id": 10 + i} for i in (1, 2, 3, 4)])
    results = spark.createDataFrame([(11, 200), (12, 404), (13, 500)], "key bigint, status_code int")
    got = by_id(facility.admin_apply(objs, results, "deactivate", "pk", F.lit(mjd_datetime(61001.0))))
    assert [(got[i]["active"], got[i]["facility_id"]) for i in (1, 2, 3, 4)] == [(False, 11), (False, None), (True, 13), (True, 14)]
    gone = by_id(facility.admin_apply(objs, results, "delete", "pk", F.lit(mjd_datetime(61001.0))))
    assert gone[1]["facility_id"] is None and gone[1]["updated"] == mjd_datetime(61001.0) and gone[4]["sync_pending"]
    assert facility.admin_select(objs, "object_id > 2").count() == 2
    assert facility.admin_select(objs, query="SELECT object_id, facility_id, name FROM objects WHERE facility_id = 11").count() == 1
    with pytest.raises(ValueError, match="name"):
        facility.admin_select(objs, query="SELECT object_id, facility_id FROM objects")


# ---------------------------------------------------------------- hosts, history, dimensions

def test_host_queue(spark):
    now = 61100.0
    objs = objects(
        spark, {"object_id": 1, "jdmax": now - 60}, {"object_id": 2, "active": False, "jdmax": now - 60},
        {"object_id": 3, "active": False, "jdmax": now - 5, "latest_mags": {"g_lsst": 24.5, "r_lsst": 25.0, "r_ztf": 18.0}},
        {"object_id": 4, "active": False, "jdmax": now - 5, "latest_mags": {"g_lsst": 21.0, "r_lsst": 24.5}},
        {"object_id": 5, "active": False, "jdmax": now - 5, "latest_mags": {"r_ztf": 25.0}}, {"object_id": 6})
    assoc = spark.createDataFrame([(i, i, i == 6, False) for i in range(1, 7)],
                                  "association_id bigint, object_id bigint, active boolean, sync_pending boolean")
    got = {r["object_id"]: (r["active"], r["sync_pending"]) for r in hosts.host_queue_rule(assoc, objs, now).collect()}
    assert got == {1: (False, False), 2: (True, True), 3: (True, True), 4: (False, False), 5: (False, False), 6: (False, True)}


def test_four_objects_share_one_host(spark):
    empty = spark.createDataFrame([], "host_id bigint, host_name string, ra double, dec double, mag double")
    four = spark.createDataFrame([("GAL1", 1.0, 2.0, 18.0)] * 4, "host_name string, ra double, dec double, mag double")
    assert hosts.host_catalog(empty, four, 1).collect()[0].asDict() == {"host_id": 1, "host_name": "GAL1", "ra": 1.0, "dec": 2.0, "mag": 18.0}


def test_active_set_as_of(spark):
    t = mjd_datetime
    ev = spark.createDataFrame(
        [(1, 1, "created", t(1)), (2, 1, "deactivated", t(2)), (3, 1, "activated", t(3)), (4, 2, "created", t(1)), (5, 2, "deactivated", t(1)),
         (6, 3, "created", t(9)), (7, 2, "alert", t(4))], "event_id bigint, object_id bigint, event_type string, event_time timestamp")

    def at(mjd):
        return {r["object_id"] for r in history.active_set_as_of(ev, F.lit(t(mjd))).collect()}

    assert (at(1), at(2), at(3), at(9)) == ({1}, set(), {1}, {1, 3})


def test_dimensions(spark):
    pipes = dimensions.seed_pipelines(spark)
    new = spark.createDataFrame([("manual", "v1.0"), ("lsst-default", "v1.1")], "pipeline_name string, version string")
    more = dimensions.add_pipelines(pipes, new)
    assert more.count() == 12 and dimensions.pipeline_id_of(more, "lsst-default", "v1.1") == 12
    with pytest.raises(ValueError):
        dimensions.pipeline_id_of(pipes, "lsst-default", "v9")


# ---------------------------------------------------------------- input that must not stop or lose a batch

def test_messages_with_repeated_keys_and_nan_in_text_are_read(spark):
    texts = ['{"diaObjectId": 6, "sherlock_classifications": "odd: NaN, see note"}', '{"diaObjectId": 7, "ra": 1, "ra": 2}',
             '{"diaObjectId": 8, "ra": NaN}', '[{"diaObjectId": 9}]', '{"ra": 1}', "{bad", None]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    assert {r.diaObjectId for r in alerts.parse_alerts(messages, alerts.LSST_ALERT, "diaObjectId").collect()} == {6, 7, 8}
    assert alerts.skipped_messages(messages, "diaObjectId").count() == 4


def test_bad_values_refuse_one_row_only(spark):
    schema = "native_id string, survey_id string, pipeline_id string, ra string, dec string, jdmin string, jdmax string, " \
        "latest_filter string, latest_mag string, n_sources string"
    good = ("a", "1", "1", "10.5", "2", "61000", "61050", '{"g": 61050}', '{"g": 20}', '{"g": 3}')
    rows = [good, ("b", "1", "1", "abc", *good[4:]), ("c", *good[1:9], '{"g": 1e30}'), ("d", "one", *good[2:])]
    df = spark.createDataFrame(rows, schema)
    assert {r.native_id for r in validate.validate_alerts(df, 61061.0).collect()} == {"a", "c"}
    assert {(r.native_id, r.reject_reason) for r in validate.alert_rejects(df, 61061.0).collect()} == {
        ("b", "ra is no finite number"), ("d", "survey_id is no finite number")}


def test_a_host_listed_twice_takes_one_rank(spark):
    objs = spark.createDataFrame([(1, 10.0, 0.0)], "object_id bigint, ra double, dec double")
    rows = [("A", "galaxy", 10.0001, 0.0), ("A", "galaxy", 10.0001, 0.0), ("A", "galaxy", 10.0002, 0.0), ("B", "galaxy", 10.0003, 0.0)]
    gal = spark.createDataFrame(rows, "host_name string, object_type string, ra double, dec double")
    got = {r["rank"]: r["host_name"] for r in hosts.host_crossmatch(objs, gal, 5.0).collect()}
    assert got == {1: "A", 2: "B"}
