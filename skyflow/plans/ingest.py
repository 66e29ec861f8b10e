"""The ingest: contract rows of one survey into the state, several surveys in order, and the ageing after them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sky import MATCH_RADIUS_DEG
from ..operators.clock import DEACTIVATE_AFTER_DAYS, FAINT_LIMIT_MAG, deactivate_objects, survey_heartbeat
from ..operators.lineage import materialize
from ..operators.skymatch import Resolution, sky_resolve_batch
from ..operators.upsert import (
    NameState, assign_names, check_names_left, create_objects, first_selections, insert_if_absent, name_state, native_names,
    number_rows, updated_minus_new, upsert_objects, year_of,
)
from ..operators.validate import alert_rejects, validate_alerts
from ..schemas import EVENTS, OBJECTS
from ..sources.buckets import BucketStore
from ..sources.state import SkyState, append_history

REPORT_ROWS = 200
# Order of the events of one batch and object at the same time.
EVENT_RANKS = {"alert": 1, "manual_submission": 1, "created": 2, "activated": 3, "selected": 4, "deactivated": 5}


@dataclass(frozen=True)
class IngestParams:
    now: dt.datetime
    name_prefix: str = "SKY"
    radius_deg: float = MATCH_RADIUS_DEG
    submitted_by: str | None = None
    code_version: str = "unknown"
    run_id: str | None = None
    deactivate_after_days: float = DEACTIVATE_AFTER_DAYS
    faint_mag: float = FAINT_LIMIT_MAG

    @property
    def now_mjd(self) -> float:
        return self.now.replace(tzinfo=dt.timezone.utc).timestamp() / 86400.0 + 40587.0

    @property
    def now_column(self) -> Column:
        micros = round(self.now.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
        return F.timestamp_micros(F.lit(micros))


@dataclass
class IngestResult:
    """The state after the batch (its objects written out), and what the batch did."""

    state: SkyState
    staged: DataFrame
    created: DataFrame
    changes: DataFrame
    events: DataFrame
    contract: DataFrame
    params: IngestParams
    resolution: Resolution

    @property
    def rejects(self) -> DataFrame:
        """The refused rows with their reasons."""
        return self.rejects_of(self.contract, self.params)

    @staticmethod
    def rejects_of(contract: DataFrame, params: IngestParams) -> DataFrame:
        return alert_rejects(contract, params.now_mjd)

    @property
    def updated(self) -> DataFrame:
        return updated_minus_new(self.changes, self.created)


def event_rows(rows: DataFrame, event_type: Column | str, params: IngestParams, **columns: Column) -> DataFrame:
    """Rows with an object_id as event rows; `columns` sets the other event columns."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    values = {
        "event_time": params.now_column, "object_id": F.col("object_id"), "event_type": kind,
        "code_version": F.lit(params.code_version), "run_id": F.lit(params.run_id), **columns,
    }
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS.fields])


def batch_events(
    staged: DataFrame, created: DataFrame, updated: DataFrame, new_selections: DataFrame, params: IngestParams
) -> DataFrame:
    """One event per staged alert, per created object, per revived object and per new selection."""
    details = F.to_json(F.struct("jdmin", "jdmax", "latest_mag"))
    alerts = event_rows(
        staged, "alert" if params.submitted_by is None else "manual_submission", params,
        survey_id=F.col("survey_id"), survey_object_id=F.col("native_id"), pipeline_id=F.col("pipeline_id"),
        submitted_by=F.lit(params.submitted_by), details=details,
    )
    revived = updated.filter(F.col("new_detection") & ~F.col("old_active") & F.col("active"))
    return (
        alerts
        .unionByName(event_rows(created, "created", params, survey_id=F.col("last_survey_id")))
        .unionByName(event_rows(
            revived, "activated", params, reason=F.lit("redetected"), survey_id=F.col("batch_survey_id"),
            survey_object_id=F.col("batch_native_id"),
        ))
        .unionByName(event_rows(
            new_selections, "selected", params, survey_id=F.col("survey_id"), pipeline_id=F.col("pipeline_id")
        ))
    )


@dataclass
class Batch:
    """The valid rows of a batch, written out, and their numbered positions."""

    contract: DataFrame
    valid: DataFrame
    points: DataFrame
    n_rows: int


def read_batch(contract: DataFrame, params: IngestParams) -> Batch:
    """Validate the contract rows and number them. Only keys and positions are sorted."""
    valid = materialize(
        validate_alerts(contract, params.now_mjd).withColumn("row_id", F.monotonically_increasing_id()), "valid"
    )
    n_rows = valid.count()
    return Batch(contract, valid, materialize(number_rows(valid, "row_id", n_rows), "points"), n_rows)


def ingest_batch(
    state: SkyState, contract: DataFrame | Batch, params: IngestParams, names: NameState | None = None
) -> IngestResult:
    """
    One survey's batch: validate, stage, resolve, create, update, names, selections, events, clock.
    Nothing of the given state changes; the caller makes the returned state current. `names` says where ids and
    names continue; without it that is read from all objects.
    """
    batch = contract if isinstance(contract, Batch) else read_batch(contract, params)
    valid, points = batch.valid, batch.points
    # Only keys and positions are resolved; the wide rows are joined once, at the end.
    names = names or name_state(state.objects, params.name_prefix, year_of(params.now))
    resolution = sky_resolve_batch(
        points, state.objects.select("object_id", "ra", "dec"), names.next_object_id, params.radius_deg, batch.n_rows
    )
    check_names_left(names, resolution.n_new)
    resolved = points.select("row_id", "stage_row").join(resolution.assignments, "stage_row")
    staged = materialize(valid.join(resolved, "row_id").drop("row_id"), "staged")
    created = create_objects(staged.drop("object_id"), assign_names(resolution.leaders, names), params.now_column)
    changes = materialize(
        upsert_objects(state.objects.unionByName(created), staged, params.now_column), "objects"
    )
    native, _ = insert_if_absent(state.native_names, native_names(staged), ["object_id", "survey_id"])
    selections, new_selections = first_selections(staged, state.selections, params.now_column)
    nights, _ = survey_heartbeat(staged, state.nights)
    events = batch_events(staged, created, updated_minus_new(changes, created), new_selections, params)
    new_state = SkyState(
        objects=changes.select(*OBJECTS.names),
        native_names=native,
        selections=selections,
        nights=nights,
    )
    return IngestResult(new_state, staged, created, changes, events, batch.contract, params, resolution)


def _ranked(events: DataFrame) -> DataFrame:
    rank = F.create_map(*[F.lit(x) for pair in EVENT_RANKS.items() for x in pair])
    return events.withColumn("event_rank", F.try_element_at(rank, F.col("event_type")))


def _stored_names(store: BucketStore, params: IngestParams) -> NameState:
    """Where ids and names continue, from the pointer; the names begin anew with the year."""
    pointer, year = store.pointer(), year_of(params.now)
    if "next_object_id" not in pointer:
        return name_state(store.load().objects, params.name_prefix, year)
    return NameState(pointer["next_object_id"], pointer["next_name"] if pointer["year"] == year else 0, params.name_prefix, year)


def ingest_into(
    store: BucketStore, contract: DataFrame, params: IngestParams, history_path: str | None = None, batch_key: str | None = None, **recorded
) -> IngestResult:
    """
    One survey's batch into the stored state. Only the zones around the batch's positions are read, and only those with an object
    that it made or changed are written. Its events go to the history under `batch_key`, so that a repeated batch replaces them;
    `recorded` is kept in the pointer together with the new state.
    """
    batch = read_batch(contract, params)
    names = _stored_names(store, params)
    result = ingest_batch(store.near(batch.points, params.radius_deg), batch, params, names)
    n_new = result.resolution.n_new
    recorded |= {"next_object_id": names.next_object_id + n_new, "next_name": names.next_name + n_new, "year": names.year}
    if history_path is not None:
        next_id = store.pointer().get("next_event_id", 1)
        recorded["next_event_id"] = append_history(_ranked(result.events), history_path, batch_key or f"{params.run_id}", next_id)
    store.merge(result.state, result.changes.filter("touched"), **recorded)
    return result


def age_out_into(store: BucketStore, params: IngestParams, history_path: str | None = None, batch_key: str | None = None, **recorded) -> DataFrame:
    """Switch off stale and faint objects in the stored state and return them. All zones are read, those with such an object are written."""
    state = store.load()
    aged = deactivate_objects(
        state.objects, materialize(state.nights, "nights"), params.now_mjd, params.deactivate_after_days, params.faint_mag)
    off = materialize(aged.filter(F.col("deactivation_reason").isNotNull()), "deactivated")
    if off.isEmpty():
        store.record(**recorded)
        return off
    if history_path is not None:
        events = event_rows(off, "deactivated", params, reason=F.col("deactivation_reason"))
        next_id = store.pointer().get("next_event_id", 1)
        recorded["next_event_id"] = append_history(_ranked(events), history_path, batch_key or f"ageing-{params.run_id}", next_id)
    around = store.load([r["zone"] for r in store.zoned(off.select("ra", "dec")).select("zone").distinct().collect()])
    others = around.objects.join(off.select("object_id"), "object_id", "left_anti")
    store.merge(around.with_tables(objects=others.unionByName(off.select(*OBJECTS.names))), off, **recorded)
    return off


def age_out(state: SkyState, params: IngestParams) -> tuple[SkyState, DataFrame, DataFrame]:
    """Switch off stale and faint objects: (state, deactivated rows, their events). Runs even with no alerts."""
    state = state.with_tables(nights=materialize(state.nights, "nights"))   # read three times below
    aged = materialize(
        deactivate_objects(
            state.objects, state.nights, params.now_mjd, params.deactivate_after_days, params.faint_mag
        ), "aged",
    )
    off = aged.filter(F.col("deactivation_reason").isNotNull())
    events = event_rows(off, "deactivated", params, reason=F.col("deactivation_reason"))
    return state.with_tables(objects=aged.select(*OBJECTS.names)), off, events


@dataclass
class RunResult:
    state: SkyState
    results: dict[str, IngestResult] = field(default_factory=dict)
    deactivated: DataFrame | None = None
    events: DataFrame | None = None
    failed: dict[str, Exception] = field(default_factory=dict)


def multi_survey_ingest(
    state: SkyState, surveys: list[tuple[str, Callable[[], DataFrame]]], params: IngestParams
) -> RunResult:
    """
    Surveys in the given order, each all or nothing: one that fails leaves the state as it was and does
    not stop the others. Ageing follows once, after all of them.
    """
    run = RunResult(state)
    for name, read in surveys:
        try:
            result = ingest_batch(run.state, read(), params)
        except Exception as error:   # reported to the caller; this survey's alerts are read again
            run.failed[name] = error
            continue
        run.results[name] = result
        run.state = result.state
        run.events = result.events if run.events is None else run.events.unionByName(result.events)
    run.state, run.deactivated, off_events = age_out(run.state, params)
    run.events = off_events if run.events is None else run.events.unionByName(off_events)
    return run


def run_report(created: DataFrame, updated: DataFrame, deactivated: DataFrame) -> DataFrame:
    """(section, n): the complete counts of a run."""
    def counted(rows: DataFrame, section: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(section).alias("section"), "n")

    return counted(created, "new").unionByName(counted(updated, "updated")).unionByName(
        counted(deactivated, "deactivated"))


def report_text(created: DataFrame, updated: DataFrame, deactivated: DataFrame, rows: int = REPORT_ROWS) -> str:
    """The counts and the first rows of each table by object id, as Markdown."""
    lines = ["# Ingest report", ""]
    counts = {r["section"]: r["n"] for r in run_report(created, updated, deactivated).collect()}
    lines.append(", ".join(f"{k}: {v}" for k, v in counts.items()) + f" (at most {rows} rows shown per table)")
    for title, frame in (("New", created), ("Updated", updated), ("Deactivated", deactivated)):
        shown = frame.orderBy("object_id").limit(rows).select("object_id", "facility_id", "name", "ra", "dec").collect()
        if shown:
            lines += ["", f"## {title}", "", "| object_id | facility_id | name | ra | dec |", "|---|---|---|---|---|"]
            lines += ["| " + " | ".join(str(v) for v in row) + " |" for row in shown]
    if not any(counts.values()):
        lines += ["", "_No changes to report._"]
    return "\n".join(lines)
