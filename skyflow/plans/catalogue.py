"""Every registered query: (spark, sf_dir) -> DataFrame, reading the given tables whole."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import bands as B, scalars as S, sky
from ..operators import clock, facility, history, hosts, normalize, outbox, selection, skymatch, upsert, validate
from ..operators.lineage import materialize, new_dir
from ..operators.numbering import write_row_index
from ..schemas import CONTRACT, OBJECTS
from ..sources import alerts, dimensions, facility as facility_source, state as state_source
from ..sources.buckets import BucketStore
from ..streaming.ingest import StreamRun, SurveyStream, read_dead_letters, start_stream_ingest, stream_run
from ..streaming.report import report_table
from ..sources.accepted import start_log, stream_accepted
from . import adapters as A
from .facility_sync import facility_sync_run
from .outbox_run import OutboxParams, OutboxRun, outbox_run, switch_run
from .ingest import (
    EVENT_RANKS, IngestParams, RunResult, age_out, ingest_batch, multi_survey_ingest, run_report,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_A = IngestParams(now=dt.datetime(2024, 1, 16), code_version="v1", run_id="run-a")   # MJD 60325
RUN_B = IngestParams(now=dt.datetime(2024, 2, 1), code_version="v1", run_id="run-b")    # MJD 60341


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


# ---------------------------------------------------------------- shared inputs

def _flat(df: DataFrame, mags: str, mjds: str | None, counts: str | None) -> DataFrame:
    """Band maps as one column per band, which compare in any engine."""
    extra = {}
    for prefix, name in (("mag", mags), ("mjd", mjds), ("n", counts)):
        if name is not None:
            for b in A.CONTRACT_BANDS:
                extra[f"{prefix}_{b}"] = F.try_element_at(F.col(name), F.lit(b))
    keep = [c for c in df.columns if c not in (mags, mjds, counts)]
    return df.select(*keep, *[v.alias(k) for k, v in extra.items()])


def _flat_contract(df: DataFrame) -> DataFrame:
    return _flat(df, "latest_mag", "latest_filter", "n_sources")


def _flat_objects(df: DataFrame) -> DataFrame:
    return _flat(df, "latest_mags", "latest_mjd", "n_sources")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alert of both surveys as a contract row with its event_id."""
    ev = A.events(spark, sf_dir)
    return normalize.normalize_lsst(A.lsst_raw(ev), A.PIPELINE_LSST, ["event_id"]).unionByName(
        normalize.normalize_ztf(A.ztf_raw(ev), A.PIPELINE_ZTF, ["event_id"]))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid alerts of both surveys."""
    return validate.validate_alerts(_alerts(spark, sf_dir), A.NOW_MJD)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid alerts already attached to objects (one per source user); stage_row = event_id is a total order."""
    return _valid(spark, sf_dir).withColumns({
        "object_id": F.regexp_extract("native_id", r"(\d+)$", 1).cast("long") % 1_000_000_000 + 1,
        "stage_row": F.col("event_id"),
    })


def _early(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("jdmax") < A.BATCH_SPLIT_MJD)


def _late(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("jdmax") >= A.BATCH_SPLIT_MJD)


def _before(staged: DataFrame, split: float) -> tuple[DataFrame, DataFrame]:
    """Two batches; after an early split the second one brings much that the first lacks."""
    return staged.filter(F.col("jdmax") < split), staged.filter(F.col("jdmax") >= split)


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per source user with alerts in the early batch, made from the newest of them."""
    newest = upsert.newest_per_object(_early(_staged(spark, sf_dir)))
    named = newest.select("stage_row", "object_id", F.concat(F.lit("SKY24x"), F.col("object_id")).alias("name"))
    made = upsert.create_objects(newest.drop("object_id"), named, RUN_A.now_column)
    return made.withColumn("active", F.col("object_id") % 3 != 0).withColumn("sync_pending", F.col("object_id") % 2 == 0)


def _object_columns(df: DataFrame) -> DataFrame:
    return _flat_objects(df.select(
        "object_id", "name", "ra", "dec", "jdmin", "jdmax", "jd_obs_trigger", "latest_mags", "latest_mjd", "n_sources",
        "last_survey_id", "active", "sync_pending", F.date_format("updated", "yyyy-MM-dd").alias("updated_day"),
    ))


def _readers(ev: DataFrame) -> list[tuple[str, Callable[[], DataFrame]]]:
    """The two surveys in ingest order, each as newest alert per id in contract form."""
    def lsst() -> DataFrame:
        raw = normalize.latest_alert_per_object(A.lsst_raw(ev), "diaObjectId", "lastDiaSourceMjdTai", "event_id")
        return normalize.normalize_lsst(raw, A.PIPELINE_LSST)

    def ztf() -> DataFrame:
        raw = normalize.latest_alert_per_object(A.ztf_raw(ev), "objectId", "latest_jd", "event_id")
        return normalize.normalize_ztf(raw, A.PIPELINE_ZTF)

    return [("lsst", lsst), ("ztf", ztf)]


def _run_a(spark: SparkSession, sf_dir: str) -> RunResult:
    ev = A.events(spark, sf_dir).filter(F.col("mjd") < A.BATCH_SPLIT_MJD)
    return multi_survey_ingest(state_source.empty_state(spark), _readers(ev), RUN_A)


def _run_b(spark: SparkSession, sf_dir: str, after: RunResult) -> RunResult:
    ev = A.events(spark, sf_dir).filter(F.col("mjd") >= A.BATCH_SPLIT_MJD)
    return multi_survey_ingest(after.state, _readers(ev), RUN_B)


def _checked(run: RunResult) -> RunResult:
    if run.failed:
        raise RuntimeError(f"surveys failed: {run.failed}")
    return run


def _iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------- sources and sinks

_MESSAGES = {
    "lsst": (A.lsst_messages, alerts.LSST_ALERT, "diaObjectId"),
    "ztf": (A.ztf_messages, alerts.ZTF_ALERT, "objectId"),
}


@query
def src_alert_json(spark, sf_dir):
    """The messages of both surveys; a column that a survey lacks is NULL."""
    ev, parsed = A.events(spark, sf_dir), []
    for name, (messages, schema, id_key) in _MESSAGES.items():
        path = new_dir(spark, "messages")
        messages(ev).select("value").write.text(path)
        parsed.append(alerts.parse_alerts(alerts.read_alert_files(spark, path), schema, id_key).withColumn("survey", F.lit(name)))
    return parsed[0].unionByName(parsed[1], allowMissingColumns=True)


@query
def src_skip_malformed(spark, sf_dir):
    ev, skipped = A.events(spark, sf_dir), []
    for messages, _, id_key in _MESSAGES.values():
        skipped.append(alerts.skipped_messages(materialize(messages(ev), "messages"), id_key).select("event_id", "skip_reason"))
    return skipped[0].unionByName(skipped[1])


@query
def src_bounded_batch(spark, sf_dir):
    """Message files of both surveys drained two per trigger: accepted messages and micro-batches of each."""
    ev, counted = A.events(spark, sf_dir), []
    for name, (messages, schema, id_key) in _MESSAGES.items():
        path, out = new_dir(spark, "messages"), new_dir(spark, "batches")
        messages(ev).select("value").repartition(8).write.text(path)
        parsed = alerts.parse_alerts(alerts.stream_alert_files(spark, path, 2), schema, id_key)

        def store(batch, batch_id, out=out):
            batch.agg(F.count(F.lit(1)).alias("accepted")).withColumn("batch_id", F.lit(batch_id)).write.mode(
                "overwrite").parquet(f"{out}/run={batch_id}")

        parsed.writeStream.foreachBatch(store).option("checkpointLocation", new_dir(spark, "checkpoint")).trigger(
            availableNow=True).start().awaitTermination()
        counted.append(spark.read.schema("accepted bigint, batch_id bigint").parquet(f"{out}/run=*").agg(
            F.sum("accepted").alias("accepted"), F.count(F.lit(1)).alias("batches")).withColumn("survey", F.lit(name)))
    return counted[0].unionByName(counted[1])


@query
def src_bounded_accepted(spark, sf_dir):
    """The accepted messages of both surveys in batches bounded by accepted messages, three of each; one row a batch."""
    ev, drained = A.events(spark, sf_dir), []
    for name, (messages, schema, id_key) in _MESSAGES.items():
        path, log, out, checkpoint = (new_dir(spark, label) for label in ("messages", "accepted", "batches", "checkpoint"))
        messages(ev).select("value").write.text(path)
        start_log(alerts.stream_alert_files(spark, path), log, new_dir(spark, "checkpoint"), schema, id_key).awaitTermination()
        bound = spark.read.parquet(f"{log}/data").count() // 3 + 1

        def store(batch, batch_id, out=out):
            batch.agg(F.count(F.lit(1)).alias("accepted"), F.min("number").alias("first"), F.max("number").alias("last")).withColumn(
                "batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/run={batch_id}")

        for _ in range(3):                  # three runs from one checkpoint
            stream_accepted(spark, log, bound).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
                availableNow=True).start().awaitTermination()
        drained.append(spark.read.schema("accepted bigint, first bigint, last bigint, batch_id bigint").parquet(f"{out}/run=*").withColumn("survey", F.lit(name)))
    return drained[0].unionByName(drained[1])


@query
def sink_commit_after_state(spark, sf_dir):
    """The files of both surveys read twice by fresh checkpoints: the second pass leaves the objects as they were."""
    store, paths = _stored(spark), _write_messages(spark, A.events(spark, sf_dir))
    for _ in range(2):
        for stream in _streams(spark, paths):
            start_stream_ingest(stream, store, RUN_B, dimensions.seed_pipelines(spark), new_dir(spark, "history")).awaitTermination()
    return _object_columns(store.load().objects).drop("updated_day")


@query
def multi_survey_ingest_query(spark, sf_dir):
    run = _checked(_run_b(spark, sf_dir, _checked(_run_a(spark, sf_dir))))
    return _object_columns(run.state.objects)


@query
def stage_contract(spark, sf_dir):
    order = [F.col("jdmax").desc(), F.col("event_id")]
    return _flat_contract(upsert.stage_contract(_valid(spark, sf_dir), *order))


@query
def src_manual_submission(spark, sf_dir):
    """Rows handed in by people through the ingest; the events carry who it was."""
    given = validate.validate_alerts(A.submissions(A.events(spark, sf_dir)), A.NOW_MJD)
    newest = normalize.latest_alert_per_object(given, "native_id", "jdmax", "event_id").drop("event_id")
    params = IngestParams(now=RUN_B.now, submitted_by="observer", code_version="v1")
    result = ingest_batch(state_source.empty_state(spark), newest, params)
    mag = F.get_json_object("details", "$.latest_mag.r_lsst").cast("double")
    return result.events.filter(F.col("event_type") == "manual_submission").select(
        "event_type", "survey_id", "survey_object_id", "pipeline_id", "submitted_by", mag.alias("mag"))


@query
def src_id_list(spark, sf_dir):
    path = new_dir(spark, "ids")
    A.ztf_raw(A.events(spark, sf_dir)).select("objectId").distinct().write.text(path)
    return alerts.read_id_list(spark, path)


@query
def sink_append_history(spark, sf_dir):
    """Two batches of events appended to date partitions, then read back."""
    rows = A.history(A.events(spark, sf_dir)).withColumn("event_rank", F.lit(1))
    rows = rows.withColumns({"code_version": F.lit("v1"), "run_id": F.lit("r1")}).drop("event_id", "event_mjd")
    path, split = new_dir(spark, "history"), F.lit("2024-01-16").cast("timestamp")
    next_id = state_source.append_history(rows.filter(F.col("event_time") < split), path, 1)
    state_source.append_history(rows.filter(F.col("event_time") >= split), path, 2, next_id)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("event_date").cast("string").alias("event_date"), "code_version", "run_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def _stored(spark: SparkSession) -> BucketStore:
    return BucketStore(spark, new_dir(spark, "state"), zone_deg=30.0)      # few objects: 55 zones


def _store_objects(spark: SparkSession, objects: DataFrame) -> BucketStore:
    store, objects = _stored(spark), materialize(objects, "objects")
    store.merge(state_source.empty_state(spark).with_tables(objects=objects), objects)
    return store


def _merge_staged(store: BucketStore, staged: DataFrame) -> None:
    """Alerts that are attached to stored objects already: the zones around them are read, those of changed objects written."""
    around = store.near(staged)
    changes = materialize(upsert.upsert_objects(around.objects, staged, RUN_B.now_column), "changes")
    store.merge(around.with_tables(objects=changes.select(*OBJECTS.names)), changes.filter("touched"))


@query
def sink_state_snapshot(spark, sf_dir):
    """Objects stored, then the late alerts merged: the store gives back the second state."""
    store = _store_objects(spark, _objects(spark, sf_dir))
    _merge_staged(store, materialize(_late(_staged(spark, sf_dir)), "staged"))
    return _object_columns(store.load().objects)


@query
def state_bucket_merge(spark, sf_dir):
    """Objects stored, then the late alerts of one strip of the sky merged; zones without one keep their files."""
    store = _store_objects(spark, _objects(spark, sf_dir))
    _merge_staged(store, materialize(_late(_staged(spark, sf_dir)).filter(F.col("dec").between(-10.0, 10.0)), "staged"))
    return _object_columns(store.load().objects)


@query
def src_facility_targets(spark, sf_dir):
    """Targets as paged, listed and single JSON answers, flattened to one row each."""
    t = A.targets(spark, sf_dir)
    item = F.to_json(F.struct(*[c for c in t.columns if c != "c_custkey"]))
    page = F.floor(F.col("c_custkey") / 40)
    bodies = t.groupBy(page.alias("page")).agg(F.array_join(F.sort_array(F.collect_list(item)), ",").alias("items"))
    listed = F.concat(F.lit("["), F.col("items"), F.lit("]"))
    paged = F.concat(F.lit('{"count": 40, "next": null, "results": '), listed, F.lit("}"))
    body = (
        F.when(F.col("page") % 3 == 0, listed).when(F.col("page") % 3 == 1, paged)
        .otherwise(F.concat(F.lit("["), paged, F.lit("]")))
    )
    singles = t.filter("id IS NULL").select(item.alias("body"))
    pages = bodies.select(body.alias("body")).unionByName(singles)
    return facility_source.flatten_targets(pages).select(
        "id", "name", "ra", "dec", "subsurvey", "mag", "is_active", "date_submitted", "date_ingested", "ostd_targ_id")


@query
def dim_surveys(spark, sf_dir):
    seen = A.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("NETWORK"), F.col("s_nationkey").cast("string")).alias("survey_name"),
        F.col("s_nationkey").alias("survey_id"))
    return dimensions.add_surveys(dimensions.seed_surveys(spark), seen)


@query
def dim_selection_versions(spark, sf_dir):
    seen = A.events(spark, sf_dir).select(
        F.when(F.col("survey_id") == 1, F.lit("lsst-default")).otherwise(F.lit("ztf-default")).alias("pipeline_name"),
        F.concat(F.lit("v1."), (F.floor("mjd") % 3).cast("string")).alias("version"))
    return dimensions.add_pipelines(dimensions.seed_pipelines(spark), seen)


# ---------------------------------------------------------------- projections, filters, predicates

@query
def normalize_lsst(spark, sf_dir):
    raw = A.lsst_raw(A.events(spark, sf_dir))
    return _flat_contract(normalize.normalize_lsst(raw, A.PIPELINE_LSST, ["event_id"]))


@query
def normalize_ztf(spark, sf_dir):
    raw = A.ztf_raw(A.events(spark, sf_dir))
    return _flat_contract(normalize.normalize_ztf(raw, A.PIPELINE_ZTF, ["event_id"]))


@query
def normalize_ztf_two_bands(spark, sf_dir):
    raw = A.ztf_two_band_raw(A.events(spark, sf_dir))
    return _flat_contract(normalize.normalize_ztf(raw, A.PIPELINE_ZTF, ["event_id"]))


@query
def validate_alerts(spark, sf_dir):
    good = validate.validate_alerts(A.submissions(A.events(spark, sf_dir)), A.NOW_MJD)
    value = {c: F.try_element_at(F.col(c), F.lit("r_lsst")) for c in ("latest_filter", "latest_mag", "n_sources")}
    return good.select("event_id", "native_id", "ra", "dec", "jdmin", "jdmax", *[v.alias(c) for c, v in value.items()])


@query
def alert_rejects(spark, sf_dir):
    bad = validate.alert_rejects(A.submissions(A.events(spark, sf_dir)), A.NOW_MJD)
    # The MJD in the text is printed differently by each engine.
    reason = F.regexp_replace("reject_reason", r"jdmax \S+ lies", "jdmax lies")
    return bad.select("event_id", reason.alias("reject_reason"))


def _selection_tables(spark, sf_dir):
    latest = normalize.latest_alert_per_object(
        A.lsst_raw(A.events(spark, sf_dir)), "diaObjectId", "lastDiaSourceMjdTai", "event_id")
    sigmas = [f"{b}_psfFluxSigma" for b in A.BANDS]
    return (
        latest.drop(*sigmas, "sherlock_classifications", "event_id"),
        latest.select("diaObjectId", *sigmas),
        latest.select("diaObjectId", F.col("sherlock_classifications").alias("classification")),
    )


@query
def selection_function(spark, sf_dir):
    return selection.selection_function(*_selection_tables(spark, sf_dir))


def _deactivated(spark, sf_dir, days, faint):
    objects = _objects(spark, sf_dir)
    staged = _staged(spark, sf_dir)
    nights = staged.select("survey_id", S.observing_night(F.col("jdmax")).alias("night")).distinct()
    return clock.deactivate_objects(objects, nights, A.NOW_MJD, days, faint).filter(
        F.col("deactivation_reason").isNotNull()
    ).select("object_id", "active", "sync_pending", "deactivation_reason", "nights_since")


@query
def deactivate_stale(spark, sf_dir):
    return _deactivated(spark, sf_dir, 15.0, 99.0)


@query
def deactivate_faint(spark, sf_dir):
    return _deactivated(spark, sf_dir, 1000.0, clock.FAINT_LIMIT_MAG)


_OUTBOX_STATE = ["object_id", "active", "sync_pending", "sync_state", "sync_attempts", "sync_last_error", "facility_id", "facility_mag"]


@query
def outbox_clear_unregistered(spark, sf_dir):
    return outbox.clear_unregistered(A.outbox(spark, sf_dir)).select("object_id", "sync_pending")


@query
def outbox_new_targets(spark, sf_dir):
    return outbox.new_targets(A.outbox(spark, sf_dir)).select("object_id", "name")


@query
def outbox_active_changes(spark, sf_dir):
    return outbox.active_changes(A.outbox(spark, sf_dir))


def _log_now() -> Column:
    return F.lit("1998-08-01").cast("timestamp")


@query
def outbox_mag_milestones(spark, sf_dir):
    return outbox.magnitude_milestones(A.outbox(spark, sf_dir), A.request_log(spark, sf_dir), _log_now())


@query
def build_target_payload(spark, sf_dir):
    rows = outbox.build_target_payload(A.outbox(spark, sf_dir))
    p = F.from_json("payload", "name string, ra double, dec double, mag double, mag_type string, is_active boolean, "
                    "cadence bigint, epoch int, t_exp_b double, classification string, subsurvey string")
    reason = F.regexp_replace("refusal", r"dec -?[\d.]+ ", "dec ")
    return rows.select("object_id", reason.alias("refusal"), p.alias("p")).select("object_id", "refusal", "p.*")


@query
def latest_detection(spark, sf_dir):
    det = B.latest_detection(F.col("latest_mags"), F.col("latest_mjd"))
    return A.outbox(spark, sf_dir).select("object_id", det.alias("d")).select("object_id", "d.band", "d.mag", "d.mjd")


def _associations(spark, sf_dir) -> DataFrame:
    """Host associations of the outbox objects: up to three per object, ranked."""
    return A.outbox(spark, sf_dir).select(
        F.explode(F.filter(F.array(*[F.lit(i) for i in (1, 2, 3)]), lambda r: r <= F.col("object_id") % 4)).alias("rank"),
        "object_id",
    ).select(
        (F.col("object_id") * 10 + F.col("rank")).alias("association_id"), "object_id",
        (F.col("object_id") * 3 % 1000 + F.col("rank")).alias("host_id"), "rank",
        F.lit(10).alias("pipeline_id"), (F.col("object_id") % 5 == 0).alias("active"), F.lit(False).alias("sync_pending"),
    )


@query
def host_queue_rule(spark, sf_dir):
    ruled = hosts.host_queue_rule(_associations(spark, sf_dir), A.outbox(spark, sf_dir), A.NOW_MJD)
    return ruled.select("association_id", "object_id", "active", "sync_pending")


@query
def admin_select(spark, sf_dir):
    return facility.admin_select(A.outbox(spark, sf_dir), "active = true AND sync_attempts > 0 AND dec < 0")


@query
def admin_select_by_date(spark, sf_dir):
    return facility.admin_select_by_date(A.targets(spark, sf_dir), "2024-04-15T12:00:00", inclusive=True).select(
        "name", "id", "date_submitted")


@query
def facility_target_scope(spark, sf_dir):
    return facility.target_scope(A.targets(spark, sf_dir), "sky-sn").select("name", "id", "subsurvey")


# ---------------------------------------------------------------- joins

def _points(df: DataFrame) -> DataFrame:
    return df.select("stage_row", "ra", "dec")


@query
def sky_match_nearest(spark, sf_dir):
    """Every valid alert against the objects made from the early batch."""
    points = materialize(_points(_staged(spark, sf_dir)), "points")
    objects = materialize(_objects(spark, sf_dir).select("object_id", "ra", "dec"), "objects")
    found = skymatch.sky_match_nearest(points, objects)
    return found.select("stage_row", "object_id", F.round("separation_arcsec", 6).alias("separation_arcsec"))


def _ordered_points(spark, sf_dir) -> DataFrame:
    valid = _valid(spark, sf_dir).select("jdmax", "event_id", "ra", "dec")
    return materialize(write_row_index(valid, [F.col("jdmax").desc(), F.col("event_id")], "stage_row")[0], "points").select(
        "stage_row", "ra", "dec")


@query
def sky_new_leaders(spark, sf_dir):
    return skymatch.sky_new_leaders(_ordered_points(spark, sf_dir)).select("stage_row")


@query
def sky_resolve_batch(spark, sf_dir):
    """All valid alerts in one batch without any deduplication, starting from no objects."""
    points = _ordered_points(spark, sf_dir)
    none = points.filter(F.lit(False)).select(F.col("stage_row").alias("object_id"), "ra", "dec")
    return skymatch.sky_resolve_batch(points, none).assignments


@query
def update_join(spark, sf_dir):
    """What the late batch does to each object it touches: the row before and after."""
    changes = upsert.upsert_objects(_objects(spark, sf_dir), _late(_staged(spark, sf_dir)), RUN_B.now_column)
    return changes.filter("touched").select(
        "object_id", "old_active", "active", "new_detection", "batch_survey_id", "batch_native_id")


@query
def nights_since_detection(spark, sf_dir):
    objects = _objects(spark, sf_dir).withColumn(
        "last_survey_id", F.when(F.col("object_id") % 7 != 0, F.col("last_survey_id")))
    nights = _staged(spark, sf_dir).select("survey_id", S.observing_night(F.col("jdmax")).alias("night")).distinct()
    return clock.nights_since_detection(objects, nights, A.NOW_MJD).select("object_id", "last_survey_id", "nights_since")


@query
def selection_join(spark, sf_dir):
    joined = selection.selection_join(*_selection_tables(spark, sf_dir))
    return joined.select("diaObjectId", "latest_psfFlux", "g_psfFluxSigma", "z_psfFluxSigma", "sherlock_classifications")


_CRITERIA = selection.LightcurveCriteria(significance=5.0, min_bands=3, min_nights=2, mag_limit=22.5)


@query
def attach_selection_result(spark, sf_dir):
    lc = A.lightcurves(A.events(spark, sf_dir))
    tested = lc.filter(F.col("sigmapsf").isNotNull())
    results = selection.lightcurve_select(tested, tested, _CRITERIA)
    return selection.attach_selection_result(lc.select("objectId", "jd"), results)


@query
def recent_rejection_anti_join(spark, sf_dir):
    kept = outbox.without_recent_rejection(A.outbox(spark, sf_dir), A.request_log(spark, sf_dir), _log_now())
    return kept.select("object_id")


@query
def history_joins(spark, sf_dir):
    """Events with the object's and the selection version's name."""
    ev = A.history(A.events(spark, sf_dir))
    objects = A.outbox(spark, sf_dir).select("object_id", "name")
    return ev.join(objects, "object_id").join(dimensions.seed_pipelines(spark), "pipeline_id").select(
        "event_id", "name", "pipeline_name", "version", "event_type")


def _ready(spark, sf_dir) -> DataFrame:
    built = outbox.build_target_payload(outbox.new_targets(A.outbox(spark, sf_dir)))
    return built.filter(F.col("refusal").isNull())


def _create_answers(batches: DataFrame) -> DataFrame:
    """An answer per request batch: every kind of failure, and successes that leave some names out."""
    status = F.element_at(F.array(*[F.lit(s) for s in (201, 400, 500, 429, None, 200, 200)]), (F.col("batch_id") % 7 + 1).cast("int"))
    items = F.transform(
        F.filter(F.arrays_zip("object_ids", "names"), lambda x: x["object_ids"] % 10 != 3),
        lambda x: F.struct((x["object_ids"] + 800000).alias("id"), x["names"].alias("name")),
    )
    return batches.select(
        "batch_id", status.cast("int").alias("status_code"),
        F.when(F.col("batch_id") % 7 == 5, F.lit("<html>Internal error</html>"))
        .when(status.isin(200, 201), F.to_json(items)).otherwise(F.lit("refused")).alias("body"),
        F.when(status.isNull(), F.lit("timeout")).alias("error_kind"),
    )


def _sent(batches: DataFrame) -> DataFrame:
    mags = F.from_json("payload", "array<struct<mag:double>>")
    return batches.select("batch_id", F.explode(F.arrays_zip("object_ids", "names", mags.alias("p"))).alias("x")).select(
        "batch_id", F.col("x.object_ids").alias("object_id"), F.col("x.names").alias("name"), F.col("x.p.mag").alias("mag"))


def _answered(spark, sf_dir) -> DataFrame:
    batches = materialize(outbox.request_batches(_ready(spark, sf_dir)), "batches")
    return outbox.apply_create_responses(_sent(batches), _create_answers(batches))


@query
def apply_create_responses(spark, sf_dir):
    return _answered(spark, sf_dir).select("batch_id", "object_id", "outcome", "item_id")


def _lookups(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Name lookups of the ambiguous objects: none, one near, one far, two, or a foreign target found."""
    rows = A.outbox(spark, sf_dir).filter(F.col("sync_state") == "ambiguous")
    asked = rows.select("object_id", "name", "ra", "dec", (F.col("object_id") % 11 == 5).alias("has_next"))
    kind = F.col("object_id") % 6
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    found = rows.select("object_id", "name", "ra", "dec", "active", F.explode(copies).alias("i")).select(
        "object_id", (F.col("object_id") + 800000 + F.col("i")).alias("id"),
        F.when(kind == 4, F.lit("other")).otherwise(F.col("name")).alias("name"),
        F.when(kind == 5, F.lit("source")).otherwise(F.lit("sky-sn")).alias("subsurvey"),
        "ra", (F.col("dec") + F.when(kind == 2, F.lit(2.0) / 3600.0).otherwise(F.lit(0.5) / 3600.0)).alias("dec"),
        (F.lit(15.0) + F.col("object_id") % 9).alias("mag"), (F.col("object_id") % 4 == 1).alias("is_active"))
    return asked, found


@query
def reconcile_by_lookup(spark, sf_dir):
    return outbox.reconcile_by_lookup(*_lookups(spark, sf_dir)).select("object_id", "verdict", "n_found")


@query
def ingestion_merge(spark, sf_dir):
    t = A.targets(spark, sf_dir)
    objects = A.outbox(spark, sf_dir).withColumns({
        "ostd_targ_id": F.lit(None).cast("long"), "ostd_u_obj_id": F.lit(None).cast("long"),
        "date_ingested": F.lit("2024-01-01").cast("timestamp")})
    merged = facility.ingestion_merge(objects, t, F.col("c_custkey"))
    return merged.select("object_id", "facility_id", "ostd_targ_id", "ostd_u_obj_id", _iso("date_ingested").alias("date_ingested"))


@query
def admin_apply(spark, sf_dir):
    """Deactivate by facility id and delete by name, each with accepted, refused and gone targets."""
    t = A.targets(spark, sf_dir)
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 201, 204, 404, 500)]), (F.col("c_custkey") % 5 + 1).cast("int"))
    objects = A.outbox(spark, sf_dir).withColumn("updated", F.lit("2024-01-01").cast("timestamp"))
    by_id = t.filter((F.col("id").isNotNull()) & F.col("is_active")).select(F.col("id").alias("key"), status.alias("status_code"))
    by_name = t.filter(~F.col("is_active")).select(F.col("name").alias("key"), status.alias("status_code"))
    once = facility.admin_apply(objects, by_id, "deactivate", "pk", F.lit("2024-02-01").cast("timestamp"))
    twice = facility.admin_apply(once, by_name, "delete", "name", F.lit("2024-02-02").cast("timestamp"))
    return twice.select("object_id", "active", "sync_pending", "facility_id", F.date_format("updated", "yyyy-MM-dd").alias("updated_day"))


@query
def semi_join_changed(spark, sf_dir):
    staged = _late(_staged(spark, sf_dir))
    off = _deactivated(spark, sf_dir, 15.0, clock.FAINT_LIMIT_MAG)
    return facility.semi_join_changed(_objects(spark, sf_dir), staged, off).select("object_id", "name")


@query
def unmatched_hosts(spark, sf_dir):
    return hosts.unmatched_hosts(A.outbox(spark, sf_dir), _associations(spark, sf_dir), 10).select("object_id", "name")


@query
def host_crossmatch(spark, sf_dir):
    objects = materialize(_objects(spark, sf_dir).select("object_id", "ra", "dec"), "objects")
    matched = hosts.host_crossmatch(objects, A.galaxies(spark, sf_dir), 10.0)
    return matched.select("object_id", "host_name", F.round("separation_arcsec", 6).alias("separation_arcsec"), "rank")


def _catalog(spark, sf_dir) -> DataFrame:
    old = A.galaxies(spark, sf_dir).filter(F.col("object_type") == "star").select(
        F.substring("host_name", 4, 20).cast("long").alias("host_id"), "host_name", "ra", "dec", "mag")
    return hosts.host_catalog(old, A.galaxies(spark, sf_dir).unionByName(A.galaxies(spark, sf_dir)), 1_000_000_000)


@query
def host_catalog_insert(spark, sf_dir):
    """The galaxies twice over, added to a catalogue that has some of them: each name once."""
    return _catalog(spark, sf_dir).select("host_id", "host_name", "mag")


@query
def host_report_join(spark, sf_dir):
    catalog = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("host_id"), F.concat(F.lit("GAL"), F.col("c_custkey").cast("string")).alias("host_name"))
    report = hosts.host_report_join(_associations(spark, sf_dir), A.outbox(spark, sf_dir), catalog)
    return report.select("association_id", "object_id", "rank", "active", "object_name", "host_name")


# ---------------------------------------------------------------- aggregations

@query
def batch_span_per_object(spark, sf_dir):
    return upsert.batch_span_per_object(_staged(spark, sf_dir))


@query
def survey_heartbeat(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    nights = _early(staged).select("survey_id", S.observing_night(F.col("jdmax")).alias("night")).distinct()
    return clock.survey_heartbeat(_late(staged), nights)[0]


@query
def first_selections(spark, sf_dir):
    first, second = _before(_staged(spark, sf_dir), A.FIRST_SPLIT_MJD)
    old = first.select("object_id", "survey_id", "pipeline_id").distinct().withColumn("selection_time", RUN_A.now_column)
    added = upsert.first_selections(second, old, RUN_B.now_column)[1]
    return added.select("object_id", "survey_id", "pipeline_id")


def _selections(spark, sf_dir) -> DataFrame:
    ev = A.history(A.events(spark, sf_dir))
    return ev.groupBy("object_id", "survey_id", "pipeline_id").agg(F.min("event_time").alias("selection_time"))


@query
def selection_counts(spark, sf_dir):
    counted = history.selection_counts(_selections(spark, sf_dir), dimensions.seed_pipelines(spark))
    return counted.select("pipeline_name", "version", "survey_id", "n", _iso("first").alias("first"), _iso("last").alias("last"))


@query
def multi_survey_objects(spark, sf_dir):
    found = history.multi_survey_objects(A.history(A.events(spark, sf_dir)))
    return found.select("object_id", F.array_join("surveys", ",").alias("surveys"))


@query
def outbox_health(spark, sf_dir):
    return history.outbox_health(A.outbox(spark, sf_dir))


@query
def request_outcomes_daily(spark, sf_dir):
    daily = history.request_outcomes_daily(A.request_log(spark, sf_dir), _log_now())
    return daily.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "method", "outcome", "n")


@query
def survey_clock_summary(spark, sf_dir):
    nights = _staged(spark, sf_dir).select("survey_id", S.observing_night(F.col("jdmax")).alias("night")).distinct()
    return clock.survey_clock_summary(nights).withColumn("last_night", F.col("last_night").cast("string"))


@query
def lightcurve_select(spark, sf_dir):
    lc = A.lightcurves(A.events(spark, sf_dir))
    names = A.outbox(spark, sf_dir).select(F.concat(F.lit("ZTF"), F.col("object_id").cast("string")).alias("objectId"))
    return selection.lightcurve_select(lc, names.unionByName(lc.select("objectId")), _CRITERIA)


@query
def active_counts(spark, sf_dir):
    return history.active_counts(A.outbox(spark, sf_dir))


@query
def incremental_watermark(spark, sf_dir):
    t = A.targets(spark, sf_dir).select(S.iso_timestamp(F.col("date_ingested")).alias("date_ingested"))
    since = facility.incremental_watermark(t, "2024-01-01")
    none = facility.incremental_watermark(t.filter("date_ingested IS NULL"), "2024-01-01")
    full = facility.incremental_watermark(t, "2024-01-01", force_full=True)
    rows = [f.select(F.lit(n).alias("run"), S.format_utc(F.col("since")).alias("since"))
            for n, f in (("incremental", since), ("empty", none), ("forced", full))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def run_report_query(spark, sf_dir):
    first = _checked(_run_a(spark, sf_dir))
    runs = [first, _checked(_run_b(spark, sf_dir, first))]
    results = [r for run in runs for r in run.results.values()]
    made, updated, off = (reduce(DataFrame.unionByName, frames) for frames in (
        [r.created for r in results], [r.updated for r in results], [run.deactivated for run in runs]))
    return run_report(made, updated, off)


@query
def event_span(spark, sf_dir):
    span = history.event_span(A.history(A.events(spark, sf_dir)))
    return span.select(_iso("first").alias("first"), _iso("last").alias("last"), "n")


@query
def band_map_build(spark, sf_dir):
    ev = A.lsst_raw(A.events(spark, sf_dir))
    made = B.build_map([(b, f"{b}_psfFlux") for b in A.BANDS], "double")
    return ev.select("event_id", F.explode(made).alias("band", "flux"))


# ---------------------------------------------------------------- top row per group, sequences

@query
def latest_alert_per_object(spark, sf_dir):
    raw = A.lsst_raw(A.events(spark, sf_dir))
    newest = normalize.latest_alert_per_object(raw, "diaObjectId", "lastDiaSourceMjdTai", "event_id")
    return newest.select("diaObjectId", "lastDiaSourceMjdTai", "ra", "decl", "event_id")


@query
def newest_per_object(spark, sf_dir):
    newest = upsert.newest_per_object(_staged(spark, sf_dir))
    return newest.select("object_id", "stage_row", "survey_id", "native_id", "jdmax")


@query
def native_names(spark, sf_dir):
    """The second batch's names inserted after the first one's: the first batch wins."""
    first, second = _before(_staged(spark, sf_dir), A.FIRST_SPLIT_MJD)
    return upsert.insert_if_absent(upsert.native_names(first), upsert.native_names(second), ["object_id", "survey_id"])[0]


@query
def active_set_as_of(spark, sf_dir):
    events = A.history(A.events(spark, sf_dir))
    return history.active_set_as_of(events, F.lit("2024-01-20 12:00:00").cast("timestamp"))


@query
def lightcurve_first_pass(spark, sf_dir):
    return selection.lightcurve_first_pass(A.lightcurves(A.events(spark, sf_dir)), _CRITERIA)


@query
def host_rank(spark, sf_dir):
    """Galaxies ranked per object, brightest first."""
    g = A.galaxies(spark, sf_dir).withColumn("object_id", F.floor(F.col("ra") / 10).cast("long"))
    return hosts.host_rank(g, F.col("mag"), F.col("host_name")).select("object_id", "host_name", "rank")


@query
def request_batches(spark, sf_dir):
    batches = outbox.request_batches(_ready(spark, sf_dir))
    n_items = F.size(F.from_json("payload", "array<struct<name:string>>"))
    return batches.select("batch_id", F.size("object_ids").alias("n"), F.element_at("object_ids", 1).alias("first_id"),
                          F.element_at("object_ids", -1).alias("last_id"), n_items.alias("n_items"))


@query
def assign_ids_names(spark, sf_dir):
    """The leaders of all valid alerts named in stage order, going on after 17,570 names of the year: three and four letters."""
    leaders = skymatch.sky_new_leaders(_ordered_points(spark, sf_dir))
    state = upsert.NameState(17_571, 17_570, "SKY", "24")
    numbered, _ = write_row_index(leaders, [F.col("stage_row")], "object_id", state.next_object_id)
    return upsert.assign_names(numbered, state).select("stage_row", "object_id", "name")


# ---------------------------------------------------------------- sorts, limits, sets

@query
def recent_requests(spark, sf_dir):
    return history.recent_requests(A.request_log(spark, sf_dir)).select("log_id", "method", "status_code", "outcome", "response_text")


@query
def recent_deactivations(spark, sf_dir):
    off = history.recent_deactivations(A.history(A.events(spark, sf_dir)), A.outbox(spark, sf_dir))
    return off.select("event_id", "object_id", "name", "reason")


@query
def object_history(spark, sf_dir):
    return history.object_events(A.history(A.events(spark, sf_dir)), 8).select(
        "event_id", "event_type", "reason", "survey_id", "survey_object_id", "pipeline_id", "submitted_by", "details")


@query
def object_request_history(spark, sf_dir):
    return history.object_requests(A.request_log(spark, sf_dir), 8).select("log_id", "method", "outcome", "payload", "response")


@query
def needs_human(spark, sf_dir):
    return history.needs_human(A.outbox(spark, sf_dir))


@query
def insert_if_absent(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    keys = ["object_id", "survey_id"]
    old = _before(staged, A.FIRST_SPLIT_MJD)[0].select(*keys).distinct().withColumn("origin", F.lit("old"))
    new = staged.select(*keys).distinct().withColumn("origin", F.lit("new"))
    return upsert.insert_if_absent(old, new, keys)[0]


@query
def updated_minus_new(spark, sf_dir):
    objects = _objects(spark, sf_dir)
    changes = upsert.upsert_objects(objects, _late(_staged(spark, sf_dir)), RUN_B.now_column)
    created = objects.filter(F.col("ra") < 180.0)
    return upsert.updated_minus_new(changes, created).select("object_id", "new_detection")


@query
def accumulate_new_rows(spark, sf_dir):
    """The new objects of every pass of one batch, with the pass that made them."""
    points = _ordered_points(spark, sf_dir)
    none = points.filter(F.lit(False)).select(F.col("stage_row").alias("object_id"), "ra", "dec")
    return skymatch.sky_resolve_batch(points, none).leaders


@query
def native_ids_of_object(spark, sf_dir):
    return history.native_ids_of_object(A.history(A.events(spark, sf_dir)), 8)


# ---------------------------------------------------------------- scalar functions

@query
def scalar_flux_to_mag(spark, sf_dir):
    return A.events(spark, sf_dir).select("event_id", S.flux_to_mag(F.when(F.col("k") < 0, -F.col("flux")).otherwise(F.col("flux"))).alias("mag"))


@query
def scalar_mjd_jd(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    mjd = F.when(F.col("k") >= 0, F.col("mjd"))
    return ev.select("event_id", S.jd_to_mjd(F.col("mjd") + 2400000.5).alias("mjd"), S.mjd_to_jd(mjd).alias("jd"))


@query
def scalar_observing_night(spark, sf_dir):
    return A.events(spark, sf_dir).select("event_id", S.observing_night(F.col("mjd")).alias("night"))


@query
def scalar_night_to_date(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    ts = F.timestamp_micros(F.round((F.col("mjd") - 40587.0) * 86400000000.0).cast("long"))
    return ev.select("event_id", S.night_to_date(S.observing_night(F.col("mjd"))).cast("string").alias("night_date"),
                     F.round(S.timestamp_to_mjd(ts), 6).alias("now_mjd"))


@query
def scalar_angular_sep_arcsec(spark, sf_dir):
    sep = sky.angular_sep_arcsec(F.col("ra"), F.col("dec"), F.col("ra") + F.col("value") / 3600.0, F.col("dec") + 0.0001)
    return A.events(spark, sf_dir).select("event_id", F.round(sep, 5).alias("sep"))


@query
def scalar_is_finite_number(spark, sf_dir):
    text = F.element_at(F.array(*[F.lit(t) for t in ("1.5", "-3", "1e3", "NaN", "Infinity", "abc", "true", "", "21.5")]), (F.col("event_id") % 9 + 1).cast("int"))
    payload = S.payload_number(text)
    ok = S.is_finite(text.try_cast("double"))
    return A.events(spark, sf_dir).select("event_id", ok.alias("is_number"), payload.alias("number"))


@query
def scalar_parse_band_map(spark, sf_dir):
    rows = A.submissions(A.events(spark, sf_dir)).select("event_id", B.parse_band_map(F.col("latest_mag")).alias("m"))
    return rows.select("event_id", F.try_element_at("m", F.lit("r_lsst")).alias("r_lsst"), F.try_element_at("m", F.lit("k")).alias("k"), F.size("m").alias("n"))


@query
def scalar_merge_bands(spark, sf_dir):
    ev, columns = A.events(spark, sf_dir), ["event_id", "latest_mag", "latest_filter"]
    raw = normalize.normalize_lsst(A.lsst_raw(ev), A.PIPELINE_LSST, ["event_id"]).select(*columns).unionByName(
        normalize.normalize_ztf(A.ztf_raw(ev), A.PIPELINE_ZTF, ["event_id"]).select(*columns))
    stored = B.build_map([("g_lsst", "20.0"), ("r_lsst", "21.0")], "double")
    stored_mjd = B.build_map([("g_lsst", "60320.0"), ("r_lsst", "60312.0")], "double")
    merged = B.merge_band_maps(stored, stored_mjd, F.col("latest_mag"), F.col("latest_filter"))
    return raw.select("event_id", merged.alias("m")).select(
        "event_id", *[F.try_element_at("m", F.lit(b)).alias(b) for b in A.CONTRACT_BANDS])


@query
def scalar_json_details(spark, sf_dir):
    details = F.to_json(F.struct(F.col("jdmin"), F.col("jdmax"), F.col("latest_mag")))
    rows = _alerts(spark, sf_dir).select("event_id", details.alias("d"))
    return rows.select("event_id", F.get_json_object("d", "$.jdmin").cast("double").alias("jdmin"),
                       F.get_json_object("d", "$.jdmax").cast("double").alias("jdmax"),
                       F.get_json_object("d", "$.latest_mag.g_lsst").cast("double").alias("mag_g_lsst"))


@query
def scalar_payload_unpack(spark, sf_dir):
    return history.payload_unpack(A.request_log(spark, sf_dir)).select("log_id", "position", "name", "mag", "mag_type", "dec")


@query
def scalar_band_label(spark, sf_dir):
    letter = F.expr("CASE k WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'z' ELSE 'u' END")
    band = F.concat(letter, F.when(F.col("survey_id") == 1, F.lit("_lsst")).otherwise(F.lit("_ztf")))
    return A.events(spark, sf_dir).select("event_id", band.alias("band"), B.band_label(band).alias("label"))


@query
def scalar_base26_name(spark, sf_dir):
    index = F.col("o_orderkey") * 31 % S.NAMES_PER_YEAR
    return A.table(spark, sf_dir, "orders").select("o_orderkey", S.base26_name(index).alias("letters"))


@query
def scalar_truncate_text(spark, sf_dir):
    """Whole document texts cut to the stored lengths."""
    return A.table(spark, sf_dir, "documents").select("doc_id", *[
        F.length(S.truncate_text(F.col("text"), n)).alias(f"len_{n}") for n in (200, 1000, 4000)
    ], F.md5(S.truncate_text(F.col("text"), 200)).alias("hash_200"))


@query
def scalar_least_greatest(spark, sf_dir):
    late = F.when(F.col("k") > 0, F.col("mjd"))
    return A.events(spark, sf_dir).select("event_id", F.least(F.lit(60315.0), late).alias("first"), F.greatest(F.lit(60315.0), late).alias("last"))


@query
def scalar_ra_wrap(spark, sf_dir):
    return A.outbox(spark, sf_dir).select("object_id", S.ra_wrap(F.col("ra")).alias("ra"))


@query
def scalar_iso_timestamp(spark, sf_dir):
    parsed = S.iso_timestamp(F.col("date_ingested"))
    return A.targets(spark, sf_dir).select("name", S.format_utc(parsed).alias("date_ingested"))


@query
def scalar_merge_patch(spark, sf_dir):
    """Event properties laid over the fixed patch."""
    patched = S.merge_patch(F.lit('{"is_active": false, "k": 0}'), F.col("props"))
    return A.events(spark, sf_dir).select("event_id", F.get_json_object(patched, "$.is_active").alias("is_active"),
                                          F.get_json_object(patched, "$.k").cast("int").alias("k"))


# ---------------------------------------------------------------- stateful upserts

@query
def create_objects(spark, sf_dir):
    """The flagship slice: newest alert per id, validated, resolved survey by survey from an empty state on, new objects."""
    (_, lsst), (_, ztf) = _readers(A.events(spark, sf_dir))
    first = ingest_batch(state_source.empty_state(spark), lsst(), RUN_B)
    return _object_columns(first.created.unionByName(ingest_batch(first.state, ztf(), RUN_B).created))


@query
def upsert_objects(spark, sf_dir):
    changes = upsert.upsert_objects(_objects(spark, sf_dir), _late(_staged(spark, sf_dir)), RUN_B.now_column)
    return _object_columns(changes)


@query
def merge_band_maps(spark, sf_dir):
    """Each late alert's maps merged into its object's early ones, one band per row."""
    staged = _staged(spark, sf_dir)
    old = _objects(spark, sf_dir).select("object_id", F.col("latest_mags").alias("o_mag"), F.col("latest_mjd").alias("o_mjd"))
    rows = _late(staged).join(old, "object_id").withColumn(
        "m", B.merge_band_maps(F.col("o_mag"), F.col("o_mjd"), F.col("latest_mag"), F.col("latest_filter")))
    return rows.select("stage_row", *[F.try_element_at("m", F.lit(b)).alias(b) for b in A.CONTRACT_BANDS])


@query
def ingest_batch_query(spark, sf_dir):
    """The early alerts of both surveys into an empty state, then the late ones, without ageing."""
    ev, state = A.events(spark, sf_dir), state_source.empty_state(spark)
    early = F.col("mjd") < A.BATCH_SPLIT_MJD
    for part, params in ((ev.filter(early), RUN_A), (ev.filter(~early), RUN_B)):
        for _, read in _readers(part):
            state = ingest_batch(state, read(), params).state
    return _object_columns(state.objects)


@query
def batch_events(spark, sf_dir):
    run_a = _checked(_run_a(spark, sf_dir))
    events = run_a.events.unionByName(_checked(_run_b(spark, sf_dir, run_a)).events)
    return events.select("run_id", "object_id", "event_type", "reason", "survey_id", "survey_object_id", "pipeline_id")


@query
def deactivate_objects(spark, sf_dir):
    """Ageing after the late alerts, which follow the early run: every object with its reason, if any."""
    state = _checked(_run_a(spark, sf_dir)).state
    for _, read in _readers(A.events(spark, sf_dir).filter(F.col("mjd") >= A.BATCH_SPLIT_MJD)):
        state = ingest_batch(state, read(), RUN_B).state
    aged = clock.deactivate_objects(state.objects, state.nights, RUN_B.now_mjd)
    return aged.select("object_id", "active", "sync_pending", "deactivation_reason", "nights_since")


@query
def replay_noop(spark, sf_dir):
    """Batches of both surveys ingested twice: the objects after the second time."""
    state, later = state_source.empty_state(spark), IngestParams(now=RUN_B.now + dt.timedelta(days=1))
    for params in (IngestParams(now=RUN_B.now), later):
        for _, read in _readers(A.events(spark, sf_dir)):
            state = ingest_batch(state, read(), params).state
    return _object_columns(state.objects)


# ---------------------------------------------------------------- outbox state machine

_URL = "https://facility.example/transients/"


@query
def classify_response(spark, sf_dir):
    outcome = outbox.classify_response(F.col("method"), F.col("status_code"), F.col("body"), F.col("error_kind"))
    return A.responses(spark, sf_dir).select("response_id", outcome.alias("outcome"))


@query
def mark_in_flight(spark, sf_dir):
    return outbox.mark_in_flight(A.outbox(spark, sf_dir), _ready(spark, sf_dir)).select("object_id", "sync_state")


@query
def apply_create_results(spark, sf_dir):
    flying = outbox.mark_in_flight(A.outbox(spark, sf_dir), _ready(spark, sf_dir))
    return outbox.apply_create_results(flying, _answered(spark, sf_dir)).select(*_OUTBOX_STATE, "was_created")


@query
def split_rejected_batches(spark, sf_dir):
    batches = materialize(outbox.request_batches(_ready(spark, sf_dir)), "batches")
    answers = _create_answers(batches)
    outcomes = answers.select("batch_id", outbox.classify_response(
        F.lit("POST"), F.col("status_code"), F.col("body"), F.col("error_kind")).alias("outcome"))
    single = F.from_json("payload", "name string, mag double")
    return outbox.split_rejected_batches(batches, outcomes).select("batch_id", "object_id", "name", single["name"].alias("sent_name"), single["mag"].alias("sent_mag"))


@query
def reconcile_ambiguous(spark, sf_dir):
    verdicts = outbox.reconcile_by_lookup(*_lookups(spark, sf_dir))
    return outbox.reconcile_ambiguous(A.outbox(spark, sf_dir), verdicts).select(*_OUTBOX_STATE, "was_adopted")


def _patch_answers(spark, sf_dir, body: Column) -> DataFrame:
    """An answer for every registered object: echoed, not echoed, refused, failed."""
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 404, 500, 200, None)]), (F.col("object_id") % 5 + 1).cast("int"))
    return A.outbox(spark, sf_dir).filter("sync_pending AND facility_id IS NOT NULL AND sync_state IS NULL").select(
        "object_id", status.cast("int").alias("status_code"), body.alias("body"),
        F.when(status.isNull(), F.lit("timeout")).alias("error_kind"))


@query
def apply_active_results(spark, sf_dir):
    echoed = F.when(F.col("object_id") % 3 == 0, ~F.col("active")).otherwise(F.col("active"))
    answers = _patch_answers(spark, sf_dir, F.to_json(F.struct(echoed.alias("is_active"))))
    return outbox.apply_active_results(A.outbox(spark, sf_dir), answers).select(*_OUTBOX_STATE)


@query
def apply_mag_results(spark, sf_dir):
    sent = outbox.magnitude_milestones(A.outbox(spark, sf_dir), A.request_log(spark, sf_dir), _log_now())
    answer = F.when(F.col("object_id") % 3 == 0, F.col("mag") + 0.5).otherwise(F.col("mag"))
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 404, 500, 200, None)]), (F.col("object_id") % 5 + 1).cast("int"))
    answers = sent.select(
        "object_id", status.cast("int").alias("status_code"), F.to_json(F.struct(answer.alias("mag"))).alias("body"),
        F.when(status.isNull(), F.lit("timeout")).alias("error_kind"))
    done = outbox.apply_mag_results(A.outbox(spark, sf_dir), sent, answers)
    noted = F.substring_index("sync_last_error", ":", 1)
    return done.select("object_id", F.round("facility_mag", 4).alias("facility_mag"), noted.alias("noted"), "mag_updated")


@query
def mark_not_submittable(spark, sf_dir):
    marked = outbox.mark_not_submittable(A.outbox(spark, sf_dir))
    error = F.regexp_replace("sync_last_error", r"dec -?[\d.]+ ", "dec ")
    return marked.select("object_id", "sync_state", "sync_attempts", error.alias("sync_last_error"))


@query
def request_log_append(spark, sf_dir):
    """One appended log row per create request with its judged answer."""
    batches = materialize(outbox.request_batches(_ready(spark, sf_dir)), "batches")
    requests = batches.withColumns({"method": F.lit("POST"), "url": F.lit(_URL)})
    rows = outbox.request_log_rows(requests, _create_answers(batches), _log_now(), "v1", "r1")
    path = new_dir(spark, "requests")
    state_source.append_requests(rows, path, 1)
    stored = spark.read.parquet(path)
    return stored.select(
        F.element_at("object_ids", 1).alias("first_id"), F.size("object_ids").alias("n"), "method", "status_code",
        "outcome", F.length("response_text").alias("response_chars"), "code_version")


@query
def dry_run_requests(spark, sf_dir):
    requests = outbox.request_batches(_ready(spark, sf_dir)).withColumns({"method": F.lit("POST"), "url": F.lit(_URL)})
    rows = outbox.dry_run_requests(requests, _log_now(), "v1", "r1")
    return rows.select(F.element_at("object_ids", 1).alias("first_id"), F.size("object_ids").alias("n"), "method", "url", "outcome")


@query
def release_failed(spark, sf_dir):
    objects = A.outbox(spark, sf_dir)
    chosen = objects.filter((F.col("sync_state") == "failed") & (F.col("dec") < 0))
    return outbox.release_failed(objects, chosen).select("object_id", "sync_state")


@query
def switch_by_hand(spark, sf_dir):
    objects = A.outbox(spark, sf_dir)
    return outbox.switch_by_hand(objects, objects.filter(F.col("dec") > 20), False).select("object_id", "active", "sync_pending")


@query
def switch_by_hand_events(spark, sf_dir):
    """The events of objects that a person switched on."""
    objects = _as_objects(A.outbox(spark, sf_dir))
    params = OutboxParams(dt.datetime(1998, 8, 1), _URL, code_version="v1", run_id="r1")
    events = switch_run(objects, objects.filter("NOT active AND dec < -60"), True, params, "observer", "still bright")[1]
    return events.select("object_id", "event_type", "reason", "submitted_by", F.get_json_object("details", "$.why").alias("why"))


def _as_objects(df: DataFrame) -> DataFrame:
    """Rows with the columns of the object table; those that they lack are NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in OBJECTS.fields])


def _facility_client(objects: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Answers to an outbox run's requests, of every kind, by the first object of a request or the number of a batch."""
    def pick(n: Column, *values) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("int") for v in values]), (n % len(values) + 1).cast("int"))

    def client(requests: DataFrame) -> DataFrame:
        step = F.substring_index("request_id", "-", 1)
        number = F.substring_index("request_id", "-", -1).cast("bigint")
        single = F.col("request_id").startswith("create-one-")
        rows = requests.withColumns({"_step": step, "_n": number, "_one": single, "_id": F.element_at("object_ids", 1)}).join(
            objects.select(F.col("object_id").alias("_id"), "name", "ra", "dec", "active"), "_id")
        n, kind = F.col("_n"), F.col("_n") % 6
        status = (
            F.when(step == "find", F.when(n % 13 == 0, 500).otherwise(200)).when(F.col("_one"), pick(n, 201, 400, 500, 429))
            .when(step == "create", pick(n, 201, 400, 500, 429, None, 200, 200)).otherwise(pick(n, 200, 404, 500, 200, None)))
        target = lambda i: F.struct(
            (n + 800000 + i).alias("id"), F.when(kind == 4, F.lit("other")).otherwise(F.col("name")).alias("name"), F.col("ra"),
            (F.col("dec") + F.when(kind == 2, F.lit(2.0) / 3600.0).otherwise(F.lit(0.5) / 3600.0)).alias("dec"),
            F.when(kind == 5, F.lit("source")).otherwise(F.lit("sky-sn")).alias("subsurvey"), (F.lit(15.0) + n % 9).alias("mag"), (n % 4 == 1).alias("is_active"))
        found = F.when(kind == 0, F.filter(F.array(target(0)), lambda _: F.lit(False))).when(kind == 3, F.array(target(0), target(1))).otherwise(F.array(target(0)))
        page = F.to_json(F.struct(F.when(n % 11 == 5, F.lit("page 2")).alias("next"), found.alias("results")))
        made = F.to_json(F.transform(
            F.filter(F.arrays_zip("object_ids", "names"), lambda x: x["object_ids"] % 10 != 3),
            lambda x: F.struct((x["object_ids"] + 800000).alias("id"), x["names"].alias("name")))) if "names" in requests.columns else F.lit(None).cast("string")
        one = F.to_json(F.struct((n + 800000).alias("id"), F.col("name").alias("name")))
        active = F.to_json(F.struct(F.when(n % 3 == 0, ~F.col("active")).otherwise(F.col("active")).alias("is_active")))
        sent = F.try_variant_get(F.try_parse_json("payload"), "$.mag", "double")
        mag = F.to_json(F.struct(F.when(n % 3 == 0, sent + 0.5).otherwise(sent).alias("mag")))
        body = (
            F.when(step == "find", page).when((step == "create") & ~F.col("_one") & (n % 7 == 5), F.lit("<html>Internal error</html>"))
            .when(F.col("_one"), F.when(status == 201, one).otherwise(F.lit("refused"))).when(step == "create", F.when(status.isin(200, 201), made).otherwise(F.lit("refused")))
            .when(step == "active", active).otherwise(mag))
        return rows.select("request_id", status.cast("int").alias("status_code"), body.alias("body"), F.when(status.isNull(), F.lit("timeout")).alias("error_kind"))

    return client


def _outbox_run(spark, sf_dir) -> OutboxRun:
    objects = materialize(_as_objects(A.outbox(spark, sf_dir)), "objects")
    params = OutboxParams(dt.datetime(1998, 8, 1), _URL, code_version="v1", run_id="r1")
    return outbox_run(objects, A.request_log(spark, sf_dir), params, _facility_client(objects))


@query
def outbox_run_query(spark, sf_dir):
    """The objects after a whole run against a facility that gives every kind of answer."""
    error = F.substring_index(F.regexp_replace("sync_last_error", r"dec -?[\d.]+ ", "dec "), ":", 1)
    return _outbox_run(spark, sf_dir).objects.select(*_OUTBOX_STATE[:5], error.alias("sync_last_error"), "facility_id", F.round("facility_mag", 4).alias("facility_mag"))


@query
def outbox_events(spark, sf_dir):
    """What the run recorded about objects."""
    detail = lambda key, kind: F.try_variant_get(F.try_parse_json("details"), f"$.{key}", kind)
    return _outbox_run(spark, sf_dir).events.select(
        "object_id", "event_type", "reason", detail("facility_id", "bigint").alias("facility_id"), detail("mag", "double").alias("mag"), "run_id")


@query
def outbox_requests(spark, sf_dir):
    """Every request of the run with its outcome: lookups, batches, single rows of refused batches, flags and magnitudes."""
    payload = F.try_parse_json("payload")
    return _outbox_run(spark, sf_dir).requests.select(
        F.element_at("object_ids", 1).alias("first_id"), F.size("object_ids").alias("n"), "method", "url", "status_code", "outcome",
        F.try_variant_get(payload, "$.is_active", "boolean").alias("is_active"),
        F.coalesce(F.try_variant_get(payload, "$.name", "string"), F.try_variant_get(payload, "$[0].name", "string")).alias("first_name"),
        F.when(F.col("method") == "PATCH", F.try_variant_get(payload, "$.mag", "double")).alias("mag"))


@query
def host_associate(spark, sf_dir):
    """Two runs over a stored catalogue: the second finds nothing new. Associations with the galaxy's name."""
    path = new_dir(spark, "galaxies")
    hosts.store_galaxies(A.galaxies(spark, sf_dir), path)
    objects = materialize(_objects(spark, sf_dir).select("object_id", "ra", "dec", "active"), "objects")
    associations = spark.createDataFrame([], hosts.ASSOCIATION)
    catalog = spark.createDataFrame([], "host_id bigint, host_name string, ra double, dec double, mag double")
    for _ in range(2):
        run = hosts.host_associate(objects, associations, catalog, path, 10, 10.0)
        associations, catalog = run.associations, run.catalog
    separation = F.get_json_object("metadata", "$.separation_arcsec").cast("double")
    return associations.join(catalog.select("host_id", "host_name", "mag"), "host_id").select(
        "association_id", "object_id", "rank", "pipeline_id", "host_id", "host_name", "mag", separation.alias("separation_arcsec"), "active")


@query
def facility_sync_run_query(spark, sf_dir):
    """Two dumps that overlap, the second one twice, into stored objects: their ids and dates, and the mark."""
    store = _store_objects(spark, _as_objects(A.outbox(spark, sf_dir)))

    def read(until: str) -> Callable[[str], DataFrame]:
        ingested = S.iso_timestamp(F.col("date_ingested"))
        return lambda since: A.targets(spark, sf_dir).filter((ingested > F.lit(since).cast("timestamp")) & (ingested <= F.lit(until).cast("timestamp")))

    runs = [facility_sync_run(store, read(until), "sky-sn", "2024-01-01") for until in ("2024-07-15T12:00:00", "2024-08-01T00:00:00", "2024-08-01T00:00:00")]
    if runs[-1].changed:
        raise RuntimeError("a repeated run changed objects")
    return store.load().objects.select("object_id", "facility_id", "ostd_targ_id", "ostd_u_obj_id", _iso("date_ingested").alias("date_ingested")).withColumns({
        "since": F.lit(runs[-1].since), "mark": F.lit(runs[-1].mark)})


# ---------------------------------------------------------------- streaming

def _write_messages(spark, ev: DataFrame, paths: dict[str, str] | None = None) -> dict[str, str]:
    """The messages of both surveys as files, added to what the folders hold."""
    paths = paths or {name: new_dir(spark, f"messages-{name}") for name in _MESSAGES}
    for name, (messages, _, _) in _MESSAGES.items():
        messages(ev).select("value").write.mode("append").text(paths[name])
    return paths


def _streams(spark, paths: dict[str, str]) -> list[SurveyStream]:
    """Both surveys in ingest order, with fresh checkpoints."""
    def lsst(raw: DataFrame, pipeline_id: int) -> DataFrame:
        return normalize.normalize_lsst(normalize.latest_alert_per_object(raw, "diaObjectId", "lastDiaSourceMjdTai", "ra"), pipeline_id)

    def ztf(raw: DataFrame, pipeline_id: int) -> DataFrame:
        return normalize.normalize_ztf(normalize.latest_alert_per_object(raw, "objectId", "latest_jd", "ra"), pipeline_id)

    return [
        SurveyStream(name, alerts.stream_alert_files(spark, paths[name]), _MESSAGES[name][1], _MESSAGES[name][2], to_contract, new_dir(spark, "checkpoint"), (f"{name}-default", "v1.0"))
        for name, to_contract in (("lsst", lsst), ("ztf", ztf))]


def _both_stream_runs(spark, sf_dir) -> tuple[BucketStore, list[StreamRun], str, str]:
    """The early messages of both surveys in one run, the late ones in the next, with ageing after each."""
    ev, store = A.events(spark, sf_dir), _stored(spark)
    early = F.col("mjd") < A.BATCH_SPLIT_MJD
    paths = _write_messages(spark, ev.filter(early))
    streams, pipelines = _streams(spark, paths), dimensions.seed_pipelines(spark)
    history, letters = new_dir(spark, "history"), new_dir(spark, "dead-letters")
    runs = [stream_run(streams, store, RUN_A, pipelines, history, letters)]
    _write_messages(spark, ev.filter(~early), paths)
    runs.append(stream_run(streams, store, RUN_B, pipelines, history, letters))
    for run in runs:
        if run.failed:
            raise RuntimeError(f"streams failed: {run.failed}")
    return store, runs, history, letters


@query
def stream_ingest(spark, sf_dir):
    """The messages of both surveys, drained into one state."""
    store, paths = _stored(spark), _write_messages(spark, A.events(spark, sf_dir))
    for stream in _streams(spark, paths):
        start_stream_ingest(stream, store, RUN_B, dimensions.seed_pipelines(spark)).awaitTermination()
    return _object_columns(store.load().objects).drop("updated_day")


@query
def stream_run_query(spark, sf_dir):
    """The objects after two runs over the streams of both surveys."""
    return _object_columns(_both_stream_runs(spark, sf_dir)[0].load().objects)


@query
def stream_rejects(spark, sf_dir):
    """What both runs set aside, by stream, stage and reason."""
    letters = read_dead_letters(spark, _both_stream_runs(spark, sf_dir)[3])
    return letters.groupBy(F.substring_index("batch", "-", 1).alias("stream"), "stage", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_report(spark, sf_dir):
    """What each micro-batch of both runs read and did."""
    reports = [report for run in _both_stream_runs(spark, sf_dir)[1] for report in run.reports]
    return report_table(spark, reports).drop("millis")


@query
def late_data_merge(spark, sf_dir):
    """The late batch first and the early one after it: old alerts only fill what is missing."""
    staged = _staged(spark, sf_dir)
    newest = upsert.newest_per_object(_late(staged))
    named = newest.select("stage_row", "object_id", F.concat(F.lit("SKY24x"), F.col("object_id")).alias("name"))
    objects = upsert.create_objects(newest.drop("object_id"), named, RUN_A.now_column).withColumn("active", F.lit(False))
    return _object_columns(upsert.upsert_objects(objects, _early(staged), RUN_B.now_column))


@query
def survey_clock(spark, sf_dir):
    """The state's nights after both runs."""
    run_a = _checked(_run_a(spark, sf_dir))
    return _checked(_run_b(spark, sf_dir, run_a)).state.nights
