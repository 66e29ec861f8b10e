"""The stored state, runs over streams, the outbox run, host associations and the facility sync."""

from __future__ import annotations

import json
import os

import pytest
from fixtures import LSST, PARAMS, ZTF, alert, by_id, contract, mjd_datetime, objects
from pyspark.sql import functions as F

from skyflow.operators import hosts, normalize
from skyflow.plans import ingest as plan, outbox_run as outbox_plan
from skyflow.plans.facility_sync import facility_sync_run
from skyflow.schemas import OBJECTS, REQUEST_LOG
from skyflow.sources import accepted, alerts, dimensions, state as tables
from skyflow.sources.buckets import BucketStore
from skyflow.streaming.ingest import SurveyStream, read_dead_letters, start_stream_ingest, stream_run
from skyflow.streaming.report import report_table


def _files(root, table="objects"):
    return {os.path.join(folder, n) for folder, _, names in os.walk(f"{root}/{table}") for n in names if n.endswith(".parquet")}


def _all_sky(spark, n=200):
    """Alerts all over the sky, one object each."""
    rows = [alert(f"a{i}", 1, ra=(i * 37.7) % 360, dec=-80 + (i * 7.31) % 160, mjd={"g_lsst": 61050.0}, mag={"g_lsst": 20.0}, n={"g_lsst": 1}) for i in range(n)]
    return contract(spark, rows)


@pytest.fixture(scope="module")
def sky(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sky"))
    store = BucketStore(spark, root)
    plan.ingest_into(store, _all_sky(spark), PARAMS)
    return store


def test_a_batch_at_one_place_leaves_other_files_alone(spark, sky):
    before = {t: _files(sky.root, t) for t in ("objects", "native_names", "selections")}
    assert len(before["objects"]) > 100
    old = by_id(sky.load().objects)
    near = [alert("b1", 2, ra=old[5]["ra"], dec=old[5]["dec"] + 0.0001, jdmax=61055.0, mjd={"r_ztf": 61055.0}, mag={"r_ztf": 19.0}, n={"r_ztf": 1})]
    result = plan.ingest_into(sky, contract(spark, near), PARAMS)
    assert result.resolution.n_new == 0
    for table, files in before.items():
        after = _files(sky.root, table)
        assert len(after - files) == 1 and len(after & files) >= 0.9 * len(files), table
    now = by_id(sky.load().objects)
    assert now[5]["latest_mags"] == {"g_lsst": 20.0, "r_ztf": 19.0}
    assert {k: v for k, v in now.items() if k != 5} == {k: v for k, v in old.items() if k != 5}


def test_only_the_zones_around_a_batch_are_read(spark, sky):
    target = by_id(sky.load().objects)[7]
    points = spark.createDataFrame([(target["ra"], target["dec"])], "ra double, dec double")
    near = sky.near(points).objects
    assert len(near.inputFiles()) == 1 < len(sky.load().objects.inputFiles()) / 100
    assert {r["object_id"] for r in near.collect()} >= {7}
    edge = spark.createDataFrame([(0.00001, 0.0)], "ra double, dec double")     # an RA and a declination edge
    assert len(sky.zones_near(edge)) == 4


def test_ids_and_names_go_on_from_the_pointer(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path))
    plan.ingest_into(store, contract(spark, LSST), PARAMS)
    pointer = store.pointer()
    assert (pointer["next_object_id"], pointer["next_name"], pointer["stage"]) == (3, 2, None)
    plan.ingest_into(store, contract(spark, ZTF), PARAMS)
    got = by_id(store.load().objects)
    assert sorted(got) == [1, 2, 3] and got[3]["name"].endswith("aac")
    frames = plan.multi_survey_ingest(
        tables.empty_state(spark), [("lsst", lambda: contract(spark, LSST)), ("ztf", lambda: contract(spark, ZTF))], PARAMS).state
    for name in ("objects", "native_names", "selections", "nights"):
        one, two = (sorted(map(str, getattr(s, name).collect())) for s in (frames, store.load()))
        assert one == two, name
    with pytest.raises(ValueError):
        BucketStore(spark, str(tmp_path), zone_deg=1.0).pointer()


def test_a_merge_cut_short_is_finished_by_the_next_access(spark, tmp_path, monkeypatch):
    store = BucketStore(spark, str(tmp_path))
    plan.ingest_into(store, contract(spark, LSST), PARAMS)
    before = by_id(store.load().objects)

    def die(self, stage, name):
        if name != "selections":
            return whole(self, stage, name)
        raise RuntimeError("lost")

    whole = BucketStore._overwrite
    monkeypatch.setattr(BucketStore, "_overwrite", die)
    with pytest.raises(RuntimeError):
        plan.ingest_into(store, contract(spark, ZTF), PARAMS, applied={"ztf": 1})
    monkeypatch.setattr(BucketStore, "_overwrite", whole)
    again = BucketStore(spark, str(tmp_path))
    state = again.load()
    assert len(before) == 2 and sorted(by_id(state.objects)) == [1, 2, 3] and state.selections.count() == 4
    assert again.pointer()["applied"] == {"ztf": 1} and again.pointer()["stage"] is None
    assert again.pointer()["next_object_id"] == 4


def test_the_slower_of_two_writers_fails(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path))
    old = store.pointer()
    store.record(note=1)
    with pytest.raises(Exception, match="(?i)exist"):
        store._write_pointer(old)


def test_ageing_writes_only_zones_with_deactivations(spark, sky):
    params = plan.IngestParams(now=mjd_datetime(61100.0), code_version="test", run_id="age", faint_mag=99.0)
    files = _files(sky.root)
    assert plan.age_out_into(sky, params).count() == 0 and _files(sky.root) == files      # nights stand still: nobody is stale
    faint = plan.IngestParams(now=mjd_datetime(61100.0), run_id="age", faint_mag=99.0)
    stale = by_id(sky.load().objects)[9]
    nights = spark.createDataFrame([(1, 61049 + i) for i in range(15)], "survey_id int, night int")
    sky.merge(sky.load().with_tables(nights=nights), spark.createDataFrame([(9, stale["ra"], stale["dec"])], "object_id bigint, ra double, dec double"))
    off = plan.age_out_into(sky, faint)
    assert off.count() == 199                                                             # all but the one that was seen by the other survey
    assert sky.load().objects.filter("active").count() == 1


# ---------------------------------------------------------------- streams

def _lsst_message(i, mjd, ra=None, **more):
    return json.dumps({"diaObjectId": 170028485034020999 + i, "ra": 10.0 + i if ra is None else ra, "decl": 1.0, "firstDiaSourceMjdTai": mjd - 1,
                       "lastDiaSourceMjdTai": mjd, "g_psfFlux": 3630.78, "g_latestMJD": mjd, "ngSources": 2, **more})


def _ztf_message(i, mjd):
    return json.dumps({"objectId": f"ZTF{i}", "ra": 10.0 + i, "decl": 1.0001, "first_jd": mjd + 2400000.5, "latest_jd": mjd + 2400000.5, "latestFilter": "r", "latestMag": 19.5})


def _to_lsst(raw, pipeline_id):
    return normalize.normalize_lsst(normalize.latest_alert_per_object(raw, "diaObjectId", "lastDiaSourceMjdTai"), pipeline_id)


def _to_ztf(raw, pipeline_id):
    return normalize.normalize_ztf(normalize.latest_alert_per_object(raw, "objectId", "latest_jd"), pipeline_id)


@pytest.fixture
def streams(spark, tmp_path):
    (tmp_path / "lsst").mkdir()
    (tmp_path / "ztf").mkdir()
    (tmp_path / "lsst" / "a.json").write_text("\n".join(
        [_lsst_message(0, 61050.0), _lsst_message(0, 61049.0), "{bad", "[1]", '{"x": 1}', _lsst_message(1, 61050.0), _lsst_message(2, 61050.0, ra=400.0),
         _lsst_message(3, 61050.0, nrSources="many")]))
    (tmp_path / "ztf" / "a.json").write_text("\n".join([_ztf_message(0, 61052.0), _ztf_message(7, 61052.0), '{"objectId": null}']))

    def make(name, checkpoint="c1", pipeline=None):
        schema, id_key, to = (alerts.LSST_ALERT, "diaObjectId", _to_lsst) if name == "lsst" else (alerts.ZTF_ALERT, "objectId", _to_ztf)
        return SurveyStream(name, alerts.stream_alert_files(spark, str(tmp_path / name)), schema, id_key, to, str(tmp_path / f"{checkpoint}-{name}"),
                            pipeline or (f"{name}-default", "v1.0"))

    return make


@pytest.fixture
def store(spark, tmp_path):
    return BucketStore(spark, str(tmp_path / "state"))


def test_a_run_over_two_streams(spark, tmp_path, streams, store):
    history, letters = str(tmp_path / "history"), str(tmp_path / "letters")
    run = stream_run([streams("lsst"), streams("ztf")], store, PARAMS, dimensions.seed_pipelines(spark), history, letters)
    assert not run.failed and run.deactivated.count() == 0
    got = by_id(store.load().objects)
    assert len(got) == 4
    both = next(o for o in got.values() if o["ra"] == 10.0)
    assert both["latest_mags"] == {"g_lsst": 22.5, "r_ztf": 19.5} and both["last_survey_id"] == 2
    assert {r["native_id"] for r in store.load().native_names.collect()} == {"170028485034020999", "170028485034021000", "170028485034021002", "ZTF0", "ZTF7"}
    dead = read_dead_letters(spark, letters).collect()
    assert sorted((r["batch"], r["stage"], r["reason"]) for r in dead) == [
        ("lsst-0-0", "rejected", "position outside the sky"), ("lsst-0-0", "skipped", "no diaObjectId"), ("lsst-0-0", "skipped", "not JSON"),
        ("lsst-0-0", "skipped", "not an object"), ("ztf-0-0", "skipped", "no objectId")]
    assert {r["content"] for r in dead if r["reason"] == "not JSON"} == {"{bad"}
    assert [r["native_id"] for r in dead if r["stage"] == "rejected"] == ["170028485034021001"]
    rows = [r.asDict() for r in report_table(spark, run.reports).drop("millis").collect()]
    assert rows == [
        {"stream": "lsst", "batch_id": 0, "messages": 8, "skipped": 3, "alerts": 4, "rejected": 1, "staged": 3, "created": 3, "updated": 0, "input_rows": 8},
        {"stream": "ztf", "batch_id": 0, "messages": 3, "skipped": 1, "alerts": 2, "rejected": 0, "staged": 2, "created": 1, "updated": 1, "input_rows": 3}]
    text = run.reports[0].text()
    assert "staged: 3" in text and "170028485034020999" in text

    # the same state as the frames give
    (tmp_path / "ztf" / "b.json").write_text(_ztf_message(0, 61053.0))
    again = stream_run([streams("lsst"), streams("ztf")], store, PARAMS, dimensions.seed_pipelines(spark), history, letters)
    assert [len(r.counts) for r in again.reports] == [0, 1] and "_Nothing came._" in again.reports[0].text()
    readers = []
    for name in ("lsst", "ztf"):
        schema, key, to = (alerts.LSST_ALERT, "diaObjectId", _to_lsst) if name == "lsst" else (alerts.ZTF_ALERT, "objectId", _to_ztf)
        raw = alerts.parse_alerts(alerts.read_alert_files(spark, str(tmp_path / name)), schema, key)
        readers.append((name, lambda raw=raw, to=to, i=len(readers) + 1: to(raw, i)))
    frames = plan.multi_survey_ingest(tables.empty_state(spark), readers, PARAMS)
    assert by_id(frames.state.objects) == by_id(store.load().objects)
    ids = [r["event_id"] for r in spark.read.parquet(history).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_a_failing_stream_is_listed_and_the_others_go_on(spark, streams, store):
    def broken(raw, pipeline_id):
        raise ConnectionError("no survey")

    one = streams("lsst")
    bad = SurveyStream(one.name, one.messages, one.schema, one.id_key, broken, one.checkpoint, one.pipeline)
    run = stream_run([bad, streams("ztf"), streams("lsst", "c2", ("lsst-default", "v9"))], store, PARAMS, dimensions.seed_pipelines(spark))
    assert list(run.failed) == ["lsst"] and "no pipeline" in str(run.failed["lsst"])
    assert store.load().objects.count() == 2 and {r["survey_id"] for r in store.load().nights.collect()} == {2}
    assert list(store.pointer()["applied"]) == ["ztf"]
    mended = stream_run([one], store, PARAMS, dimensions.seed_pipelines(spark))      # the batch is read again
    assert not mended.failed and store.load().objects.count() == 4


def test_repeated_batches_and_new_checkpoints(spark, tmp_path, streams, store):
    pipelines, history = dimensions.seed_pipelines(spark), str(tmp_path / "history")

    def drain(checkpoint):
        start_stream_ingest(streams("lsst", checkpoint), store, PARAMS, pipelines, history).awaitTermination()

    drain("c1")
    first, number, events = by_id(store.load().objects), store.pointer()["number"], spark.read.parquet(history).count()
    drain("c1")                                   # nothing new
    assert store.pointer()["number"] == number
    drain("c2")                                   # the same messages as batch 0 of a new checkpoint: known by number and fingerprint
    assert store.pointer()["number"] == number and spark.read.parquet(history).count() == events
    (tmp_path / "lsst" / "c.json").write_text(_lsst_message(5, 61050.0))
    drain("c3")                                   # batch 0 again, with more in it: ingested under a new generation
    assert store.pointer()["applied"]["lsst"]["generation"] == 1
    assert len(by_id(store.load().objects)) == 4 and {k: v for k, v in by_id(store.load().objects).items() if k in first} == first
    assert spark.read.parquet(history).count() > events


def test_batches_bounded_by_accepted_messages(spark, tmp_path):
    folder, log, out = tmp_path / "in", str(tmp_path / "log"), []
    folder.mkdir()

    def write(name, low, high):
        lines = [x for i in range(low, high) for x in ([json.dumps({"objectId": f"Z{i}", "ra": 1.0})] + ["{bad"] * (i % 3))]
        (folder / name).write_text("\n".join(lines))

    def sequence():
        accepted.start_log(alerts.stream_alert_files(spark, str(folder)), log, str(tmp_path / "c0"), alerts.ZTF_ALERT, "objectId", str(tmp_path / "skipped")).awaitTermination()

    def run():
        def take(batch, batch_id):
            out.append((batch_id, sorted(r["number"] for r in batch.collect()), {json.loads(r["value"])["objectId"] for r in batch.collect()}))

        accepted.stream_accepted(spark, log, 40).writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination()

    write("a.json", 0, 50)
    sequence()
    run()
    write("b.json", 50, 100)
    sequence()
    for _ in range(4):
        run()
    assert [(b, len(n)) for b, n, _ in out] == [(0, 40), (1, 40), (2, 20)]
    assert [x for _, n, _ in out for x in n] == list(range(100))
    assert set().union(*(ids for _, _, ids in out)) == {f"Z{i}" for i in range(100)}
    assert spark.read.parquet(str(tmp_path / "skipped")).count() == sum(i % 3 for i in range(100))


def test_text_in_numbers_is_refused_not_fatal(spark):
    lsst = spark.createDataFrame([("x12", 1.0, 1.0, 61050.0), ("7", 1.0, 1.0, 61050.0)], "diaObjectId string, ra double, decl double, lastDiaSourceMjdTai double")
    assert [r["native_id"] for r in normalize.normalize_lsst(lsst, 1).collect()] == [None, "7"]
    ztf = spark.createDataFrame([("Z", "r", "abc", 2461050.5), ("Y", "r", "19.5", 2461050.5)], "objectId string, latestFilter string, latestMag string, latest_jd double")
    assert [r["latest_mag"] for r in normalize.normalize_ztf(ztf, 2).collect()] == [{}, {"r_ztf": 19.5}]


# ---------------------------------------------------------------- outbox

_OK = {"latest_mags": {"g_lsst": 21.0}, "latest_mjd": {"g_lsst": 61000.0}}


class _FakeFacility:
    """Keeps targets between runs; can be down, or lose its answers."""

    def __init__(self, spark):
        self.spark, self.targets, self.down, self.silent, self.refuse, self.seen = spark, {}, False, False, set(), []

    def __call__(self, requests):
        rows = []
        for r in requests.collect():
            self.seen.append((r["method"], r["url"], tuple(r["object_ids"])))
            rows.append((r["request_id"], *self.answer(r)))
        return self.spark.createDataFrame(rows, "request_id string, status_code int, body string, error_kind string")

    def answer(self, r):
        if self.down:
            return None, None, "timeout"
        if r["method"] == "GET":
            name = r["url"].split("name=")[1].split("&")[0]
            return 200, json.dumps({"next": None, "results": [t for t in self.targets.values() if t["name"] == name]}), None
        payload = json.loads(r["payload"])
        if r["method"] == "PATCH":
            target = self.targets[int(r["url"].rstrip("/").split("/")[-1])]
            target.update(payload)
            return 200, json.dumps(target), None
        items = payload if isinstance(payload, list) else [payload]
        if any(i["name"] in self.refuse for i in items):
            return 400, '{"error": "bad target"}', None
        made = []
        for i in items:
            made.append({**i, "id": 900 + len(self.targets)})
            self.targets[made[-1]["id"]] = made[-1]
        if self.silent:
            return None, None, "connection reset"
        return 201, json.dumps(made if isinstance(payload, list) else made[0]), None


def _outbox_run(spark, state, client, mode="live"):
    params = outbox_plan.OutboxParams(PARAMS.now, "https://facility.example/t/", code_version="test", run_id="r")
    return outbox_plan.outbox_run(state, spark.createDataFrame([], REQUEST_LOG), params, client, mode)


def test_outbox_through_an_outage(spark):
    facility = _FakeFacility(spark)
    state = objects(spark, *[{"object_id": i, "ra": 100.0 + i, **_OK} for i in (1, 2, 3)])
    facility.down = True
    down = _outbox_run(spark, state, facility)
    assert all(r["sync_state"] == "ambiguous" and r["sync_pending"] and r["sync_attempts"] == 1 for r in by_id(down.objects).values())
    assert [(r["method"], r["outcome"], r["object_ids"]) for r in down.requests.collect()] == [("POST", "ambiguous", [1, 2, 3])] and down.events.count() == 0
    facility.down, facility.silent = False, True
    lost = _outbox_run(spark, down.objects, facility)
    assert len(facility.targets) == 3 and {r["sync_state"] for r in by_id(lost.objects).values()} == {"ambiguous"}
    facility.silent = False
    end = _outbox_run(spark, lost.objects, facility)
    rows = by_id(end.objects)
    assert len(facility.targets) == 3 and all(r["sync_state"] is None and not r["sync_pending"] and r["facility_id"] >= 900 for r in rows.values())
    events = end.events.collect()
    assert {(r["event_type"], r["reason"]) for r in events} == {("facility_created", "adopted_after_ambiguous_post")} and len(events) == 3
    assert {json.loads(r["details"])["facility_id"] for r in events} == {900, 901, 902}
    quiet = _outbox_run(spark, end.objects, facility)
    assert quiet.requests.count() == 0 and by_id(quiet.objects) == rows


def test_outbox_steps_follow_one_another(spark):
    facility = _FakeFacility(spark)
    facility.refuse = {"SKY26x2"}
    facility.targets[500] = {"id": 500, "name": "SKY26x4", "is_active": True}
    state = objects(
        spark, *[{"object_id": i, **_OK} for i in (1, 2, 3)], {"object_id": 4, "facility_id": 500, "active": False, **_OK},
        {"object_id": 5, "active": False, **_OK}, {"object_id": 6, "dec": 80.0, **_OK},
        {"object_id": 7, "facility_id": 501, "facility_mag": 19.0, "sync_pending": False, "latest_mags": {"r_ztf": 16.5}, "latest_mjd": {"r_ztf": 61000.0}})
    facility.targets[501] = {"id": 501, "name": "SKY26x7", "is_active": True}
    run = _outbox_run(spark, state, facility)
    got = by_id(run.objects)
    assert got[1]["facility_id"] and got[3]["facility_id"] and got[1]["facility_mag"] == 21.0
    assert (got[2]["sync_state"], got[2]["sync_attempts"]) == ("failed", 1) and "bad target" in got[2]["sync_last_error"]
    assert not got[4]["sync_pending"] and not got[5]["sync_pending"] and got[6]["sync_state"] == "not_submittable" and got[7]["facility_mag"] == 16.5
    assert [s[0] for s in facility.seen] == ["POST", "POST", "POST", "POST", "PATCH", "PATCH"]
    assert facility.targets[500]["is_active"] is False and facility.targets[501]["mag_type"] == "SDSS_r_AB"
    singles = {r["object_ids"][0]: json.loads(r["payload"]) for r in run.requests.collect() if r["method"] == "POST" and len(r["object_ids"]) == 1}
    assert sorted(singles) == [1, 2, 3] and singles[2]["name"] == "SKY26x2" and singles[2]["mag"] == 21.0
    assert {(r["event_type"], r["object_id"]) for r in run.events.collect()} == {("facility_created", 1), ("facility_created", 3), ("facility_mag_update", 7)}
    assert [r["object_id"] for r in run.patched.collect()] == [4] and {r["object_id"] for r in run.created.collect()} == {1, 3}


def test_outbox_dry_run_and_off(spark):
    facility = _FakeFacility(spark)
    state = objects(spark, {"object_id": 1, **_OK}, {"object_id": 2, "active": False, **_OK}, {"object_id": 3, "dec": 80.0, **_OK},
                    {"object_id": 4, "facility_id": 500, **_OK}, {"object_id": 5, "sync_state": "ambiguous", **_OK})
    dry = _outbox_run(spark, state, None, "dry_run")
    got = by_id(dry.objects)
    assert got[1]["sync_pending"] and got[1]["sync_state"] is None and not got[2]["sync_pending"] and got[3]["sync_state"] == "not_submittable"
    logged = {(r["method"], r["url"].rsplit("/t/")[1], r["outcome"], tuple(r["object_ids"])) for r in dry.requests.collect()}
    assert logged == {("POST", "", "dry_run", (1,)), ("PATCH", "500/", "dry_run", (4,))} and dry.events.count() == 0 and not facility.seen
    off = _outbox_run(spark, state, facility, "off")
    assert by_id(off.objects) == by_id(state) and off.requests.count() == 0
    with pytest.raises(ValueError):
        _outbox_run(spark, state, None)


def test_switch_by_hand_writes_events(spark):
    state = objects(spark, {"object_id": 1, "sync_pending": False}, {"object_id": 2})
    params = outbox_plan.OutboxParams(PARAMS.now, "u")
    after, events = outbox_plan.switch_run(state, state.filter("object_id = 1"), False, params, "a person", "a star")
    assert not by_id(after)[1]["active"] and by_id(after)[1]["sync_pending"] and by_id(after)[2]["active"]
    assert [(r["object_id"], r["event_type"], r["reason"], r["submitted_by"]) for r in events.collect()] == [(1, "deactivated", "manual", "a person")]


# ---------------------------------------------------------------- hosts, facility

def test_hosts_are_associated_once(spark, tmp_path):
    path = str(tmp_path / "galaxies")
    galaxies = spark.createDataFrame(
        [("G1", "galaxy", 150.0, 2.0, 17.0), ("G2", "galaxy", 150.0005, 2.0, 18.0), ("S", "star", 150.0, 2.0, 12.0), ("far", "galaxy", 10.0, -60.0, 19.0), ("G1", "galaxy", 150.0, 2.0, 17.0)],
        "host_name string, object_type string, ra double, dec double, mag double")
    hosts.store_galaxies(galaxies, path)
    sky = objects(spark, *[{"object_id": i} for i in range(1, 5)], {"object_id": 5, "ra": 300.0}, {"object_id": 6, "active": False})
    none, catalog = spark.createDataFrame([], hosts.ASSOCIATION), spark.createDataFrame([], "host_id bigint, host_name string, ra double, dec double, mag double")
    first = hosts.host_associate(sky, none, catalog, path, 10, 5.0)
    rows = first.associations.orderBy("association_id").collect()
    assert [(r["object_id"], r["rank"], r["host_id"]) for r in rows] == [(i, k, k) for i in range(1, 5) for k in (1, 2)]
    assert [r["association_id"] for r in rows] == list(range(1, 9)) and json.loads(rows[0]["metadata"]) == {"separation_arcsec": 0.0}
    assert [r["host_name"] for r in first.catalog.orderBy("host_id").collect()] == ["G1", "G2"]
    again = hosts.host_associate(sky, first.associations, first.catalog, path, 10, 5.0)
    assert again.added.count() == 0 and sorted(map(str, again.associations.collect())) == sorted(map(str, rows)) and again.catalog.count() == 2
    other = hosts.host_associate(sky, first.associations, first.catalog, path, 11, 5.0, sent_objects=0)     # by shuffle, another pipeline
    assert other.added.count() == 8 and other.associations.count() == 16


def test_the_catalogue_is_neither_read_whole_nor_shuffled(spark, tmp_path):
    path = str(tmp_path / "galaxies")
    rows = [(f"G{i}", "galaxy", (i * 17.3) % 360, -80.0 + i % 160, 17.0) for i in range(500)]
    hosts.store_galaxies(spark.createDataFrame(rows, "host_name string, object_type string, ra double, dec double, mag double"), path)
    new = spark.createDataFrame([(1, 17.3, -79.0)], "object_id bigint, ra double, dec double")
    near = hosts.galaxies_near(spark, path, new, 5 / 3600)
    pairs = hosts.sky_pairs(new, near, "object_id", "host_name", 5 / 3600, known_rows=1, cells_per_radius=4, send_rows=True)
    plan_text = pairs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [zone" in plan_text or "PartitionFilters: [isnotnull(zone" in plan_text
    assert "hashpartitioning" not in plan_text and "BroadcastHashJoin" in plan_text
    assert [r["host_name"] for r in pairs.collect()] == ["G1"]


def test_facility_sync_moves_its_mark_with_the_merge(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path))
    state = objects(spark, *[{"object_id": i, "facility_id": 10 + i, "ra": 30.0 * i} for i in (1, 2, 3)])
    store.merge(tables.empty_state(spark).with_tables(objects=state), state)
    asked = []

    def read(rows):
        def dump(since):
            asked.append(since)
            return spark.createDataFrame(rows, "id bigint, ostd_targ_id bigint, ostd_u_obj_id bigint, date_ingested string, subsurvey string")

        return dump

    first = [(11, 1, 1, "2026-09-10T00:00:00", "sky-sn"), (12, 2, 2, "2026-09-12T00:00:00", "source"), (13, None, 3, "2026-09-13T00:00:00", "sky-sn")]
    one = facility_sync_run(store, read(first), "sky-sn", "2026-08-01")
    assert (one.since, one.changed) == ("2026-08-01", 1)
    files = _files(str(tmp_path))
    second = [first[0], (12, 2, 2, "2026-09-12T00:00:00", "sky-sn"), (12, 5, 5, "soon", "sky-sn")]
    two = facility_sync_run(store, read(second), "sky-sn", "2026-08-01")
    assert two.changed == 1 and asked[-1] == "2026-09-07T00:00:00.000000Z"
    assert len(files & _files(str(tmp_path))) == 2                          # only the zone of object 2 was written
    got = by_id(store.load().objects)
    assert [got[i]["ostd_targ_id"] for i in (1, 2, 3)] == [1, 2, None] and got[1]["updated"] == state.first()["updated"]
    number = store.pointer()["number"]
    three = facility_sync_run(store, read(second), "sky-sn", "2026-08-01")
    assert three.changed == 0 and three.mark == two.mark and store.pointer()["number"] == number and asked[-1] == "2026-09-09T00:00:00.000000Z"
    assert facility_sync_run(store, read([]), "sky-sn", "2026-08-01", force_full=True).since == "2026-08-01"
    assert len(OBJECTS.names) == len(state.columns)


def test_turning_points_between_detections(spark):
    from skyflow.operators.selection import LightcurveCriteria, lightcurve_first_pass

    c = LightcurveCriteria(significance=5.0, min_bands=1, min_nights=1, mag_limit=20.0)
    rows = [
        ("a", 1.0, 1, 1, 21.0, 0.1, 11), ("a", 1.2, 1, 1, 19.0, 0.1, None), ("a", 1.4, 1, 1, 21.0, 0.1, 12), ("a", 1.9, 1, 1, 21.0, 0.1, 13),     # bright without a detection
        ("b", 1.0, 1, 1, 19.0, 0.1, 21), ("c", 1.0, 1, 1, 21.0, 0.1, 31), ("d", 1.0, 2, 1, 19.0, 0.9, 41), ("d", 2.0, 1, 2, 19.0, 0.1, 42),
        ("e", 1.0, 1, 1, 19.0, 0.1, None), ("e", 3.0, 1, 3, 22.0, None, 51)]
    df = spark.createDataFrame(rows, "objectId string, jd double, fid int, nid int, magpsf double, sigmapsf double, candid bigint")
    assert {r["objectId"]: r["first_pass_jd"] for r in lightcurve_first_pass(df, c).collect()} == {"a": 1.4, "b": 1.0, "d": 2.0, "e": 3.0}
    assert F is not None
