"""One run of the outbox: everything owed to the facility is asked, sent and folded back, step by step, as frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import outbox
from ..operators.lineage import materialize
from ..schemas import EVENTS, OBJECTS, REQUEST_LOG
from ..sources.facility import flatten_targets

# Fixed values.
CREATED, MAG_UPDATED = "facility_created", "facility_mag_update"
ADOPTED = "adopted_after_ambiguous_post"
OFF, DRY_RUN, LIVE = "off", "dry_run", "live"

#: requests (request_id, method, url, object_ids, payload) -> answers (request_id, status_code, body, error_kind)
Client = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class OutboxParams:
    now: dt.datetime
    url: str
    facility: outbox.Facility = outbox.Facility()
    code_version: str = "unknown"
    run_id: str | None = None

    @property
    def now_column(self) -> Column:
        return F.timestamp_micros(F.lit(round(self.now.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)))


@dataclass
class OutboxRun:
    """
    `objects` after the run, its `requests` as log rows and its `events`; `created` (object_id, facility_id) and `patched` (object_id, active) for the
    report. All are written out.
    """

    objects: DataFrame
    requests: DataFrame
    events: DataFrame
    created: DataFrame
    patched: DataFrame


@dataclass
class _Fold:
    """The state as the steps leave it, with what they have logged so far."""

    objects: DataFrame
    params: OutboxParams
    client: Client | None
    log: list[DataFrame] = field(default_factory=list)
    events: list[DataFrame] = field(default_factory=list)

    def keep(self, objects: DataFrame, label: str) -> DataFrame:
        """`objects` (with flags of the step) written out; they are the state that the next step reads."""
        kept = materialize(objects, label)
        self.objects = kept.select(*OBJECTS.names)
        return kept

    def ask(self, requests: DataFrame) -> DataFrame:
        """The requests with what was answered: written down before the client sees them, logged with their outcome."""
        p = self.params
        requests = materialize(requests, "requests")
        if self.client is None:
            self.log.append(outbox.dry_run_requests(requests, p.now_column, p.code_version, p.run_id))
            return requests.withColumns({"status_code": F.lit(None).cast("int"), "body": F.lit(None).cast("string"), "error_kind": F.lit(None).cast("string")}).filter(F.lit(False))
        answers = materialize(self.client(requests).select("request_id", "status_code", "body", "error_kind"), "answers")
        answered = requests.join(answers, "request_id")      # a request that the client says nothing of was not sent
        outcome = outbox.classify_response(F.col("method"), F.col("status_code"), F.col("body"), F.col("error_kind"))
        self.log.append(answered.select(
            p.now_column.alias("request_time"), "object_ids", "method", "url", "payload", "status_code", outcome.alias("outcome"),
            outbox.truncate_text(F.coalesce("error_kind", "body"), outbox.RESPONSE_CHARS).alias("response_text"),
            F.lit(p.code_version).alias("code_version"), F.lit(p.run_id).alias("run_id")))
        return answered.withColumn("outcome", outcome)

    def event(self, rows: DataFrame, event_type: str, details: Column, reason: str | None = None) -> None:
        """An event for each of the rows (object_id)."""
        values = {
            "event_time": self.params.now_column, "object_id": F.col("object_id"), "event_type": F.lit(event_type), "reason": F.lit(reason), "details": details,
            "code_version": F.lit(self.params.code_version), "run_id": F.lit(self.params.run_id)}
        self.events.append(rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS.fields]))


def _patch_url(base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), F.col("facility_id").cast("string"), F.lit("/"))


def _reconcile(fold: _Fold) -> None:
    """Rows whose create request may or may not have arrived are looked up by name; those found exactly are adopted."""
    p = fold.params
    rows = fold.objects.filter("sync_state = 'ambiguous'").select("object_id", "name", "ra", "dec")
    url = F.concat(F.lit(p.url.rstrip("/") + "/?name="), F.url_encode("name"), F.lit(f"&subsurvey={p.facility.subsurvey}"))
    answered = fold.ask(rows.select(
        F.concat(F.lit("find-"), F.col("object_id")).alias("request_id"), F.lit("GET").alias("method"), url.alias("url"),
        F.array("object_id").alias("object_ids"), F.lit(None).cast("string").alias("payload")))
    pages = answered.filter("outcome = 'ok'").select(F.element_at("object_ids", 1).alias("object_id"), "body")
    more = F.try_variant_get(F.try_parse_json("body"), "$.next", "string").isNotNull()
    asked = rows.join(pages.select("object_id", more.alias("has_next")), "object_id")
    verdicts = materialize(outbox.reconcile_by_lookup(asked, flatten_targets(pages), p.facility), "verdicts")
    kept = fold.keep(outbox.reconcile_ambiguous(fold.objects, verdicts), "reconciled")
    fold.event(kept.filter("was_adopted"), CREATED, F.to_json(F.struct("facility_id")), ADOPTED)


def _create(fold: _Fold) -> DataFrame:
    """New targets in batches; a refused batch is sent again row by row, with the same payloads. Returns (object_id, facility_id) of the created."""
    p = fold.params
    fold.keep(outbox.mark_not_submittable(fold.objects, p.facility), "checked")
    built = outbox.build_target_payload(outbox.new_targets(fold.objects), p.facility).filter("refusal IS NULL")
    ready = materialize(built.select("object_id", "name", "payload"), "ready")
    batches = outbox.request_batches(ready, ready.count())
    if fold.client is not None:
        fold.keep(outbox.mark_in_flight(fold.objects, ready), "in-flight")
    post = lambda requests: fold.ask(requests.withColumns({"method": F.lit("POST"), "url": F.lit(p.url)}))
    answered = post(batches.select(F.concat(F.lit("create-"), F.col("batch_id")).alias("request_id"), "batch_id", "object_ids", "names", "payload"))
    if fold.client is None:
        return ready.select("object_id", F.lit(None).cast("bigint").alias("facility_id")).filter(F.lit(False))
    single = materialize(outbox.split_rejected_batches(answered, answered.select("batch_id", "outcome")), "split")
    again = post(single.select(
        F.concat(F.lit("create-one-"), F.col("object_id")).alias("request_id"), F.col("object_id").alias("batch_id"), F.array("object_id").alias("object_ids"),
        F.array("name").alias("names"), "payload"))
    mags = ready.select("object_id", F.try_variant_get(F.try_parse_json("payload"), "$.mag", "double").alias("mag"))
    folded = []
    for part in (answered.filter("NOT (outcome = 'rejected' AND size(object_ids) > 1)"), again):
        sent = part.select("batch_id", F.explode(F.arrays_zip("object_ids", "names")).alias("_x")).select(
            "batch_id", F.col("_x.object_ids").alias("object_id"), F.col("_x.names").alias("name")).join(mags, "object_id")
        folded.append(outbox.apply_create_responses(sent, part.select("batch_id", "status_code", "body", "error_kind")))
    kept = fold.keep(outbox.apply_create_results(fold.objects, folded[0].unionByName(folded[1])), "created")
    made = kept.filter("was_created")
    fold.event(made, CREATED, F.to_json(F.struct("facility_id")))
    return made.select("object_id", "facility_id")


def _patch_active(fold: _Fold) -> DataFrame:
    """The active flags that the facility doesn't have. Returns (object_id, active) of those it confirmed."""
    p = fold.params
    owed = outbox.active_changes(fold.objects)
    answered = fold.ask(owed.select(
        F.concat(F.lit("active-"), F.col("object_id")).alias("request_id"), F.lit("PATCH").alias("method"), _patch_url(p.url).alias("url"),
        F.array("object_id").alias("object_ids"), "payload"))
    if fold.client is None:
        return fold.objects.select("object_id", "active").filter(F.lit(False))
    before = fold.objects
    one = F.element_at("object_ids", 1).alias("object_id")
    kept = fold.keep(outbox.apply_active_results(fold.objects, answered.select(one, "status_code", "body", "error_kind")), "active-sent")
    was = before.filter("sync_pending").select("object_id").join(answered.select(one), "object_id")
    return kept.filter("NOT sync_pending").join(was, "object_id", "left_semi").select("object_id", "active")


def _patch_magnitudes(fold: _Fold, request_log: DataFrame) -> None:
    """Brightenings past a milestone."""
    p = fold.params
    due = materialize(outbox.magnitude_milestones(fold.objects, request_log, p.now_column), "milestones")
    answered = fold.ask(due.select(
        F.concat(F.lit("mag-"), F.col("object_id")).alias("request_id"), F.lit("PATCH").alias("method"), _patch_url(p.url).alias("url"),
        F.array("object_id").alias("object_ids"), F.to_json(F.struct("mag", "mag_type")).alias("payload")))
    if fold.client is None:
        return
    answers = answered.select(F.element_at("object_ids", 1).alias("object_id"), "status_code", "body", "error_kind")
    kept = fold.keep(outbox.apply_mag_results(fold.objects, due, answers), "magnitudes-sent")
    done = kept.filter("mag_updated").select("object_id").join(due, "object_id")
    fold.event(done, MAG_UPDATED, F.to_json(F.struct("mag", "mag_type")))


def outbox_run(objects: DataFrame, request_log: DataFrame, params: OutboxParams, client: Client | None, mode: str = LIVE) -> OutboxRun:
    """
    An ordered fold over the object table that yields state, requests and events together:

    1. live only: rows in doubt are looked up by name, and adopted, sent again or put before a person;
    2. inactive rows that were never registered are no longer pending;
    3. new targets are created, 50 a request; the members of a refused request are sent one by one;
    4. active flags are sent, and count when the answer confirms them;
    5. magnitudes past a milestone are sent.

    Each step reads the state that the one before left. `client` gets a step's requests as one frame, already written out, and returns answers
    (request_id, status_code, body, error_kind); a request without an answer row is as good as not sent: the next run asks again. Rows are
    marked as in doubt before a create request goes out, so that an answer that is lost leads to a lookup and not to a second target.

    `dry_run` builds and logs the requests of steps 3 to 5 and sends none; only steps 2 and 3's refusals change the state. `off` does nothing.
    """
    if mode not in (OFF, DRY_RUN, LIVE):
        raise ValueError(f"unknown mode {mode!r}")
    spark = objects.sparkSession
    fold = _Fold(objects.select(*OBJECTS.names), params, client if mode == LIVE else None)
    if mode == LIVE and client is None:
        raise ValueError("a live run needs a client")
    none = spark.createDataFrame([], "object_id bigint, facility_id bigint, active boolean")
    created, patched = none.select("object_id", "facility_id"), none.select("object_id", "active")
    if mode != OFF:
        if mode == LIVE:
            _reconcile(fold)
        fold.objects = outbox.clear_unregistered(fold.objects)
        created = _create(fold)
        patched = _patch_active(fold)
        _patch_magnitudes(fold, request_log)
    log = reduce(DataFrame.unionByName, fold.log, spark.createDataFrame([], REQUEST_LOG))
    events = reduce(DataFrame.unionByName, fold.events, spark.createDataFrame([], EVENTS))
    return OutboxRun(materialize(fold.objects, "objects"), materialize(log, "request-log"), materialize(events, "events"), created, patched)


def switch_run(objects: DataFrame, chosen: DataFrame, active: bool, params: OutboxParams, who: str, why: str) -> tuple[DataFrame, DataFrame]:
    """The chosen objects switched on or off by a person, and an event for each of them that says who did it and why."""
    hit = objects.join(chosen.select("object_id").distinct(), "object_id", "left_semi").select("object_id")
    values = {
        "event_time": params.now_column, "object_id": F.col("object_id"), "event_type": F.lit("activated" if active else "deactivated"), "reason": F.lit("manual"),
        "submitted_by": F.lit(who), "details": F.to_json(F.struct(F.lit(why).alias("why"))), "code_version": F.lit(params.code_version), "run_id": F.lit(params.run_id)}
    events = hit.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS.fields])
    return outbox.switch_by_hand(objects, hit, active), events


__all__ = ["ADOPTED", "CREATED", "MAG_UPDATED", "Client", "OutboxParams", "OutboxRun", "outbox_run", "switch_run"]
