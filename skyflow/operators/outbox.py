"""
The outbox: changes owed to an observing facility, as request tables, and responses folded back into state.

Requests and responses are tables. Sending is left to whatever client reads the requests; every step
here is set-based and returns new frames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import MILESTONES, band_label, latest_detection, milestone_due
from ..functions.scalars import is_finite, json_object, ra_wrap, truncate_text
from ..functions.sky import angular_sep_arcsec
from .numbering import with_row_index

# Fixed values.
BATCH_SIZE = 50
REJECT_BACKOFF_DAYS = 7
REJECTED_CODES = [400, 404, 409, 422]
NOT_SENT_CODES = [401, 403, 429]
ADOPT_RADIUS_ARCSEC = 1.0
DEC_MIN, DEC_MAX = -89.99999999, 40.0
ERROR_CHARS, BODY_CHARS, RESPONSE_CHARS = 1000, 500, 4000
TARGET_DEFAULTS = {
    "pmra": 0.0,
    "pmdec": 0.0,
    "epoch": 2000,
    "resolution": 1,
    "cadence": 1048576,
    "extent_flag": 0,
    "extent_parameter": 0,
    "extent_index": 0,
    "t_exp_d": 38.0,
    "t_exp_g": 38.0,
    "t_exp_b": 4300.0,
    "t_exp_s": 4300.0,
    "classification": "TRA",
}


@dataclass(frozen=True)
class Facility:
    """What identifies our programme at the facility."""

    survey_id: int = 15
    subsurvey: str = "sky-sn"
    template: str = "supernova-template.fits"
    ruleset: str = "supernova-rules"


# ---------------------------------------------------------------- what is owed

def _open_state() -> Column:
    return F.col("sync_state").isNull() | (F.col("sync_state") == "not_submittable")


def clear_unregistered(objects: DataFrame) -> DataFrame:
    """Inactive and never registered: nothing to tell the facility, so nothing stays pending."""
    idle = F.col("sync_pending") & ~F.col("active") & F.col("facility_id").isNull() & _open_state()
    return objects.withColumn("sync_pending", F.col("sync_pending") & ~idle)


def new_targets(objects: DataFrame) -> DataFrame:
    """Pending active objects the facility does not know yet, by id."""
    return objects.filter(
        F.col("sync_pending") & F.col("active") & F.col("facility_id").isNull() & _open_state()
    ).orderBy("object_id")


def active_changes(objects: DataFrame) -> DataFrame:
    """(object_id, facility_id, payload): the is_active value owed for each pending registered object."""
    due = objects.filter(F.col("sync_pending") & F.col("facility_id").isNotNull() & F.col("sync_state").isNull())
    return due.select(
        "object_id", "facility_id", F.to_json(F.struct(F.col("active").alias("is_active"))).alias("payload")
    )


def recently_rejected(request_log: DataFrame, now: Column, days: int = REJECT_BACKOFF_DAYS) -> DataFrame:
    """Distinct object ids with a refused magnitude update in the last `days` days."""
    refused = request_log.filter(
        (F.col("method") == "PATCH") & (F.col("outcome") == "rejected")
        & (F.col("request_time") > now - F.make_dt_interval(F.lit(days)))
        & F.array_contains(F.map_keys(json_object(F.try_parse_json("payload"))), "mag")
    )
    return refused.select(F.explode("object_ids").alias("object_id")).distinct()


def without_recent_rejection(objects: DataFrame, request_log: DataFrame, now: Column) -> DataFrame:
    return objects.join(recently_rejected(request_log, now), "object_id", "left_anti")


def magnitude_milestones(objects: DataFrame, request_log: DataFrame, now: Column) -> DataFrame:
    """(object_id, facility_id, mag, mag_type) of the brightenings past a milestone the facility has not heard of."""
    registered = objects.filter(
        F.col("active") & F.col("facility_id").isNotNull() & F.col("sync_state").isNull()
        & (F.col("facility_mag").isNull() | (F.col("facility_mag") > MILESTONES[-1]))
    )
    detected = registered.withColumn("_det", latest_detection(F.col("latest_mags"), F.col("latest_mjd")))
    due = detected.filter(milestone_due(F.col("_det.mag"), F.col("facility_mag")))
    return without_recent_rejection(due, request_log, now).select(
        "object_id", "facility_id", F.round("_det.mag", 3).alias("mag"), band_label(F.col("_det.band")).alias("mag_type")
    )


def build_target_payload(objects: DataFrame, facility: Facility = Facility()) -> DataFrame:
    """`objects` plus `refusal` (why it cannot be submitted, or NULL) and `payload` (JSON, NULL when refused)."""
    ra, dec = F.col("ra"), F.col("dec")
    det = latest_detection(F.col("latest_mags"), F.col("latest_mjd"))
    rows = objects.withColumn("_det", det)
    refusal = (
        F.when(~(is_finite(ra) & is_finite(dec)), F.lit("position unknown"))
        .when(dec > DEC_MAX, F.concat(F.lit("dec "), F.format_string("%.5f", dec), F.lit(" beyond the northern limit")))
        .when(dec < DEC_MIN, F.concat(F.lit("dec "), F.format_string("%.8f", dec), F.lit(" beyond the southern limit")))
        .when(F.col("_det").isNull(), F.lit("no detection that can be sent"))
    )
    fixed = {**TARGET_DEFAULTS, "subsurvey": facility.subsurvey, "template": facility.template,
             "ruleset": facility.ruleset, "uploadedfor_survey_id": facility.survey_id, "is_active": True}
    payload = F.to_json(F.struct(
        *[F.lit(v).alias(k) for k, v in fixed.items()],
        F.col("name"), ra_wrap(ra).alias("ra"), dec.alias("dec"),
        F.round("_det.mag", 3).alias("mag"), band_label(F.col("_det.band")).alias("mag_type"),
    ))
    return rows.withColumn("refusal", refusal).withColumn(
        "payload", F.when(F.col("refusal").isNull(), payload)
    ).drop("_det")


def mark_not_submittable(objects: DataFrame, facility: Facility = Facility()) -> DataFrame:
    """Pending new targets whose payload is refused get the state, the reason and one more attempt."""
    checked = build_target_payload(objects, facility)
    tried = F.col("sync_pending") & F.col("active") & F.col("facility_id").isNull() & _open_state()
    refused = tried & F.col("refusal").isNotNull()
    return checked.withColumns({
        "sync_state": F.when(refused, F.lit("not_submittable")).otherwise(F.col("sync_state")),
        "sync_attempts": F.col("sync_attempts") + refused.cast("int"),
        "sync_last_error": F.when(refused, truncate_text(F.col("refusal"), ERROR_CHARS)).otherwise(
            F.col("sync_last_error")
        ),
    }).drop("refusal", "payload")


# ---------------------------------------------------------------- requests

def request_batches(ready: DataFrame, known_rows: int | None = None, size: int = BATCH_SIZE) -> DataFrame:
    """
    (batch_id, object_ids, names, payload): rows in id order, `size` to a request, payload a JSON array.

    A batch is a group of at most `size` rows, so collecting it is bounded.
    """
    numbered = with_row_index(ready.select("object_id", "name", "payload"), [F.col("object_id")], "_row", known_rows)
    items = F.sort_array(F.collect_list(F.struct("object_id", "name", "payload")))
    grouped = numbered.groupBy(F.floor(F.col("_row") / size).alias("batch_id")).agg(items.alias("_items"))
    return grouped.select(
        "batch_id",
        F.col("_items.object_id").alias("object_ids"),
        F.col("_items.name").alias("names"),
        F.concat(F.lit("["), F.array_join(F.col("_items.payload"), ","), F.lit("]")).alias("payload"),
    )


def split_rejected_batches(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One request per row of every refused batch with more than one row: (batch_id, object_id, name, payload), the payload one JSON object."""
    refused = outcomes.filter(F.col("outcome") == "rejected").select("batch_id")
    many = requests.filter(F.size("object_ids") > 1).join(refused, "batch_id", "left_semi")
    items = F.from_json("payload", "array<string>").alias("payloads")      # the text of each item
    return many.select("batch_id", F.explode(F.arrays_zip("object_ids", "names", items)).alias("_one")).select(
        "batch_id", F.col("_one.object_ids").alias("object_id"), F.col("_one.names").alias("name"), F.col("_one.payloads").alias("payload")
    )


def mark_in_flight(objects: DataFrame, sent: DataFrame) -> DataFrame:
    """Write-ahead: rows about to be sent count as ambiguous until the answer is clear."""
    flagged = objects.join(sent.select("object_id", F.lit(True).alias("_sent")), "object_id", "left")
    return flagged.withColumn(
        "sync_state", F.when(F.col("_sent"), F.lit("ambiguous")).otherwise(F.col("sync_state"))
    ).drop("_sent")


def dry_run_requests(requests: DataFrame, now: Column, code_version: str, run_id: str) -> DataFrame:
    """The log rows of a dry run: requests (object_ids, method, url, payload) that would have been sent."""
    return requests.select(
        now.alias("request_time"), "object_ids", "method", "url",
        "payload", F.lit(None).cast("int").alias("status_code"), F.lit("dry_run").alias("outcome"),
        F.lit(None).cast("string").alias("response_text"),
        F.lit(code_version).alias("code_version"), F.lit(run_id).alias("run_id"),
    )


def request_log_rows(requests: DataFrame, responses: DataFrame, now: Column, code_version: str, run_id: str) -> DataFrame:
    """One log row per answered request: requests (batch_id, object_ids, method, url, payload) by batch_id."""
    answered = requests.join(
        responses.select("batch_id", "status_code", "body", "error_kind"), "batch_id", "left"
    )
    return answered.select(
        now.alias("request_time"), "object_ids", "method", "url", "payload", "status_code",
        classify_response(F.col("method"), F.col("status_code"), F.col("body"), F.col("error_kind")).alias("outcome"),
        truncate_text(F.coalesce("error_kind", "body"), RESPONSE_CHARS).alias("response_text"),
        F.lit(code_version).alias("code_version"), F.lit(run_id).alias("run_id"),
    )


# ---------------------------------------------------------------- answers

def has_json_body(body: Column) -> Column:
    parsed = F.try_parse_json(body)
    return parsed.isNotNull() & (F.schema_of_variant(parsed) != "VOID")


def classify_response(method: Column, status: Column, body: Column, error_kind: Column) -> Column:
    """ok | rejected | ambiguous | retry. error_kind is 'unencodable' or any network error, NULL when answered."""
    is_post = method == "POST"
    return (
        F.when(error_kind == "unencodable", F.lit("rejected"))
        .when(error_kind.isNotNull() | status.isNull(), F.when(is_post, F.lit("ambiguous")).otherwise(F.lit("retry")))
        .when((status >= 200) & (status < 300) & F.coalesce(has_json_body(body), F.lit(False)), F.lit("ok"))
        .when(status.isin(REJECTED_CODES), F.lit("rejected"))
        .when(is_post & ~status.isin(NOT_SENT_CODES), F.lit("ambiguous"))
        .otherwise(F.lit("retry"))
    )


def response_items(responses: DataFrame) -> DataFrame:
    """(batch_id, name, item_id): the items of a response body (object or array) that carry an id, last one per name."""
    body = F.trim("body")
    as_array = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    items = responses.select(
        "batch_id", F.posexplode(F.from_json(as_array, "array<struct<id:bigint,name:string>>")).alias("_pos", "_item")
    ).filter(F.col("_item.id").isNotNull())
    return items.groupBy("batch_id", F.col("_item.name").alias("name")).agg(
        F.max_by("_item.id", "_pos").alias("item_id")
    )


def apply_create_responses(sent: DataFrame, responses: DataFrame) -> DataFrame:
    """
    sent (batch_id, object_id, name, mag) with what the facility said: `outcome`, `body`, `item_id`.
    Items are matched by name within their own response.
    """
    judged = responses.select(
        "batch_id", "body",
        classify_response(F.lit("POST"), F.col("status_code"), F.col("body"), F.col("error_kind")).alias("outcome"),
    )
    items = response_items(judged.filter(F.col("outcome") == "ok"))
    return sent.join(judged, "batch_id").join(items, ["batch_id", "name"], "left")


def _shown_body(body: Column) -> Column:
    """The begin of an answer for an error text."""
    return F.coalesce(truncate_text(body, BODY_CHARS), F.lit("no answer"))


def apply_create_results(objects: DataFrame, answered: DataFrame) -> DataFrame:
    """Fold create answers into the objects; adds `was_created` for the event."""
    a = answered.select(
        "object_id", F.col("outcome").alias("_outcome"), F.col("item_id").alias("_item"),
        F.col("mag").alias("_mag"), F.col("body").alias("_body"),
    )
    rows = objects.join(a, "object_id", "left")
    outcome = F.col("_outcome")
    created = F.coalesce((outcome == "ok") & F.col("_item").isNotNull(), F.lit(False))
    problem = outcome.isNotNull() & ~created
    error = (
        F.when(outcome == "ok", F.lit("accepted, but the answer has no target of this name"))
        .when(outcome == "retry", F.concat(F.lit("create request refused for now, sent again later: "), _shown_body(F.col("_body"))))
        .otherwise(F.concat(F.lit("create request "), outcome, F.lit(": "), _shown_body(F.col("_body"))))
    )
    state = (
        F.when(created, F.lit(None).cast("string"))
        .when(outcome.isin("ok", "ambiguous"), F.lit("ambiguous"))
        .when(outcome == "rejected", F.lit("failed"))
        .otherwise(F.col("sync_state"))
    )
    return rows.withColumns({
        "sync_state": state,
        "sync_pending": F.col("sync_pending") & ~created,
        "sync_attempts": F.when(created, F.lit(0)).otherwise(F.col("sync_attempts") + problem.cast("int")),
        "sync_last_error": F.when(created, F.lit(None).cast("string"))
        .when(problem, truncate_text(error, ERROR_CHARS)).otherwise(F.col("sync_last_error")),
        "facility_id": F.when(created, F.col("_item")).otherwise(F.col("facility_id")),
        "facility_mag": F.when(created, F.coalesce("_mag", "facility_mag")).otherwise(F.col("facility_mag")),
        "was_created": created,
    }).drop("_outcome", "_item", "_mag", "_body")


def reconcile_by_lookup(ambiguous: DataFrame, found: DataFrame, facility: Facility = Facility()) -> DataFrame:
    """
    One verdict per looked-up row. `ambiguous`: (object_id, name, ra, dec, has_next) of lookups that were
    answered; `found`: (object_id, id, name, subsurvey, ra, dec, mag, is_active), the targets in the answer.
    verdict: resend (none found) | adopt (exactly ours) | foreign (filter not applied) | conflict.
    """
    f = found.select(
        "object_id", F.col("id").alias("f_id"), F.col("name").alias("f_name"), F.col("subsurvey").alias("f_sub"),
        F.col("ra").alias("f_ra"), F.col("dec").alias("f_dec"), F.col("mag").alias("f_mag"),
        F.col("is_active").alias("f_active"),
    )
    pairs = ambiguous.join(f, "object_id", "left")
    ours = F.col("f_name").eqNullSafe(F.col("name")) & F.col("f_sub").eqNullSafe(F.lit(facility.subsurvey))
    any_row = F.col("f_id").isNotNull() | F.col("f_name").isNotNull()
    near = angular_sep_arcsec(F.col("ra"), F.col("dec"), F.col("f_ra"), F.col("f_dec")) <= ADOPT_RADIUS_ARCSEC
    seen = pairs.groupBy("object_id", "name", "has_next").agg(
        F.count_if(any_row).alias("n_found"),
        F.count_if(any_row & ~ours).alias("n_foreign"),
        F.count_if(any_row & F.coalesce(near, F.lit(False))).alias("n_near"),
        F.max("f_id").alias("f_id"), F.max("f_mag").alias("f_mag"), F.max("f_active").alias("f_active"),
        F.sort_array(F.collect_set("f_id")).alias("found_ids"),        # of one answer
    )
    verdict = (
        F.when(F.col("n_foreign") > 0, F.lit("foreign"))
        .when(F.col("n_found") == 0, F.lit("resend"))
        .when((F.col("n_found") == 1) & ~F.col("has_next") & (F.col("n_near") == 1), F.lit("adopt"))
        .otherwise(F.lit("conflict"))
    )
    return seen.select("object_id", "n_found", verdict.alias("verdict"), "f_id", "f_mag", "f_active", "found_ids")


def reconcile_ambiguous(objects: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Fold lookup verdicts into the ambiguous objects; adds `was_adopted` for the event."""
    v = verdicts.select("object_id", "verdict", "n_found", "f_id", "f_mag", "f_active", "found_ids")
    rows = objects.join(v, "object_id", "left")
    verdict = F.when(F.col("sync_state") == "ambiguous", F.col("verdict"))
    adopt, conflict = verdict == "adopt", verdict == "conflict"
    error = (
        F.when(verdict == "foreign", F.lit("lookup gave targets of other names"))
        .when(verdict == "resend", F.lit("lookup found nothing, to be created again"))
        .when(conflict, F.concat(F.col("n_found").cast("string"), F.lit(" targets have the name "), F.col("name"),
                                 F.lit(" or lie elsewhere: "), F.array_join(F.col("found_ids").cast("array<string>"), ", ")))
    )
    return rows.withColumns({
        "facility_id": F.when(adopt, F.col("f_id")).otherwise(F.col("facility_id")),
        "facility_mag": F.when(adopt, F.col("f_mag")).otherwise(F.col("facility_mag")),
        "sync_state": F.when(verdict.isin("adopt", "resend"), F.lit(None).cast("string"))
        .when(conflict, F.lit("conflict")).otherwise(F.col("sync_state")),
        "sync_pending": F.when(adopt, F.col("active") != F.coalesce("f_active", F.lit(False))).otherwise(
            F.col("sync_pending")),
        "sync_attempts": F.col("sync_attempts") + F.coalesce(verdict.isin("foreign", "conflict").cast("int"), F.lit(0)),
        "sync_last_error": F.when(adopt, F.lit(None).cast("string")).when(verdict.isNotNull(), error).otherwise(
            F.col("sync_last_error")),
        "was_adopted": F.coalesce(adopt, F.lit(False)),
    }).drop("verdict", "n_found", "f_id", "f_mag", "f_active", "found_ids")


def _patch_answers(answers: DataFrame) -> DataFrame:
    outcome = classify_response(F.lit("PATCH"), F.col("status_code"), F.col("body"), F.col("error_kind"))
    return answers.select("object_id", outcome.alias("_outcome"), F.col("body").alias("_body"))


def apply_active_results(objects: DataFrame, answers: DataFrame) -> DataFrame:
    """answers (object_id, status_code, body, error_kind): the active flag counts only when echoed back."""
    rows = objects.join(_patch_answers(answers), "object_id", "left")
    outcome = F.col("_outcome")
    echoed = F.try_variant_get(F.try_parse_json("_body"), "$.is_active", "boolean")
    synced = F.coalesce((outcome == "ok") & (echoed == F.col("active")), F.lit(False))
    problem = outcome.isNotNull() & ~synced
    shown = _shown_body(F.col("_body"))
    error = (
        F.when(outcome == "ok", F.concat(F.lit("answer does not confirm the active flag: "), shown))
        .when(outcome == "rejected", F.concat(F.lit("active flag refused: "), shown))
        .otherwise(F.concat(F.lit("active flag not delivered, sent again later: "), shown))
    )
    return rows.withColumns({
        "sync_pending": F.col("sync_pending") & ~synced,
        "sync_state": F.when(synced, F.lit(None).cast("string"))
        .when(problem & outcome.isin("ok", "rejected"), F.lit("failed")).otherwise(F.col("sync_state")),
        "sync_attempts": F.when(synced, F.lit(0)).otherwise(F.col("sync_attempts") + problem.cast("int")),
        "sync_last_error": F.when(synced, F.lit(None).cast("string"))
        .when(problem, truncate_text(error, ERROR_CHARS)).otherwise(F.col("sync_last_error")),
    }).drop("_outcome", "_body")


def apply_mag_results(objects: DataFrame, sent: DataFrame, answers: DataFrame) -> DataFrame:
    """sent (object_id, mag): an echoed magnitude is stored; anything else is only noted. Adds `mag_updated`."""
    rows = objects.join(
        _patch_answers(answers).join(sent.select("object_id", F.col("mag").alias("_mag")), "object_id"), "object_id", "left"
    )
    outcome = F.col("_outcome")
    echoed = F.try_variant_get(F.try_parse_json("_body"), "$.mag", "double")
    done = F.coalesce((outcome == "ok") & (F.abs(echoed - F.col("_mag")) < 1e-3), F.lit(False))
    error = F.concat(F.lit("magnitude update "), outcome, F.lit(": "), _shown_body(F.col("_body")))
    return rows.withColumns({
        "facility_mag": F.when(done, F.col("_mag")).otherwise(F.col("facility_mag")),
        "sync_last_error": F.when(outcome.isNotNull() & ~done, truncate_text(error, ERROR_CHARS)).otherwise(
            F.col("sync_last_error")),
        "mag_updated": done,
    }).drop("_outcome", "_body", "_mag")


# ---------------------------------------------------------------- by hand

def release_failed(objects: DataFrame, chosen: DataFrame) -> DataFrame:
    """A person looked at these ids: back to the normal state, so that the next run tries again."""
    flagged = objects.join(chosen.select("object_id", F.lit(True).alias("_chosen")), "object_id", "left")
    return flagged.withColumn("sync_state", F.when(F.col("_chosen").isNull(), F.col("sync_state"))).drop("_chosen")


def switch_by_hand(objects: DataFrame, chosen: DataFrame, active: bool) -> DataFrame:
    """Set `active` on the chosen ids and owe the facility the change."""
    flagged = objects.join(chosen.select("object_id", F.lit(True).alias("_chosen")), "object_id", "left")
    hit = F.col("_chosen").isNotNull()
    return flagged.withColumns({
        "active": F.when(hit, F.lit(active)).otherwise(F.col("active")),
        "sync_pending": F.col("sync_pending") | hit,
    }).drop("_chosen")
