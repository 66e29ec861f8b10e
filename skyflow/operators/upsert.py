"""Stage, create and update: the replay-safe merge of a resolved batch into the object table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import merge_band_maps
from ..functions.scalars import NAMES_PER_YEAR, base26_name, parse_base26
from ..schemas import CONTRACT_COLUMNS, OBJECTS
from .numbering import with_row_index, write_row_index


def stage_order(valid: DataFrame) -> list[Column]:
    """
    The order that decides who leads and who gets the lower id: that of an `input_row` column where the
    rows have one, else newest first and then by native id.
    """
    if "input_row" in valid.columns:
        return [F.col("input_row")]
    return [F.col("jdmax").desc(), F.col("native_id"), F.col("survey_id")]


def number_rows(valid: DataFrame, row_id: str, known_rows: int) -> DataFrame:
    """(row_id, stage_row, ra, dec): the batch numbered 0..n-1 in stage order, without its wide columns."""
    order = [*stage_order(valid), F.col(row_id)]   # total, so that every evaluation numbers alike
    keys = [c for c in ("input_row", "jdmax", "native_id", "survey_id") if c in valid.columns]
    narrow = valid.select(row_id, "ra", "dec", *keys)
    return with_row_index(narrow, order, "stage_row", known_rows).select(row_id, "stage_row", "ra", "dec")


def stage_contract(valid: DataFrame, *order: Column) -> DataFrame:
    """The ten contract columns plus stage_row 0..n-1 in stage order, or in the total order given."""
    return write_row_index(valid, list(order) or stage_order(valid), "stage_row")[0].select("stage_row", *CONTRACT_COLUMNS)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(old plus the rows of `new` whose key it lacks, just those added rows)."""
    added = new.join(old.select(*keys), keys, "left_anti").select(*old.columns)
    return old.unionByName(added), added


def batch_span_per_object(staged: DataFrame) -> DataFrame:
    return staged.groupBy("object_id").agg(F.min("jdmin").alias("jdmin"), F.max("jdmax").alias("jdmax"))


def newest_per_object(staged: DataFrame) -> DataFrame:
    """The newest staged row of each object (ties: the earlier stage_row); reduced before the shuffle."""
    newest = Window.partitionBy("object_id").orderBy(F.col("jdmax").desc(), F.col("stage_row"))
    return staged.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def native_names(staged: DataFrame) -> DataFrame:
    """One native id per (object, survey): the newest staged one."""
    newest = Window.partitionBy("object_id", "survey_id").orderBy(F.col("jdmax").desc(), F.col("stage_row"))
    ranked = staged.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
    return ranked.select("object_id", "survey_id", "native_id")


def first_selections(staged: DataFrame, selections: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Insert (object, survey, pipeline) triples not seen before; returns (all selections, the new ones)."""
    keys = ["object_id", "survey_id", "pipeline_id"]
    seen = staged.select(*keys).distinct().withColumn("selection_time", now)
    return insert_if_absent(selections, seen, keys)


@dataclass(frozen=True)
class NameState:
    """Where ids and names continue: the next object id and the next name index of the year."""

    next_object_id: int
    next_name: int
    prefix: str
    year: str


def name_state(objects: DataFrame, prefix: str, year: str) -> NameState:
    """Read from the row with the highest id. The name counter restarts when its year is another one."""
    last = objects.agg(F.max("object_id").alias("id"), F.max_by("name", "object_id").alias("name")).first()
    if last["id"] is None:
        return NameState(1, 0, prefix, year)
    name = last["name"] or ""
    same_year = name[len(prefix):len(prefix) + 2] == year
    return NameState(last["id"] + 1, parse_base26(name[len(prefix) + 2:]) + 1 if same_year else 0, prefix, year)


def check_names_left(state: NameState, n_new: int) -> None:
    if state.next_name + n_new > NAMES_PER_YEAR:
        raise ValueError(
            f"{n_new} new names do not fit: {NAMES_PER_YEAR - state.next_name} left for year {state.year}"
        )


def assign_names(leaders: DataFrame, state: NameState) -> DataFrame:
    """`leaders` (object_id from state.next_object_id on) plus the object's name."""
    index = F.col("object_id") - state.next_object_id + state.next_name
    return leaders.withColumn("name", F.concat(F.lit(state.prefix + state.year), base26_name(index)))


def create_objects(stage: DataFrame, named_leaders: DataFrame, now: Column) -> DataFrame:
    """New object rows from their leader: its position, dates and maps; active and pending."""
    rows = stage.join(named_leaders.select("stage_row", "object_id", "name"), "stage_row")
    made = {
        "object_id": F.col("object_id"), "name": F.col("name"), "ra": F.col("ra"), "dec": F.col("dec"),
        "jdmin": F.col("jdmin"), "jdmax": F.col("jdmax"), "jd_obs_trigger": F.col("jdmax"),
        "latest_mags": F.col("latest_mag"), "latest_mjd": F.col("latest_filter"), "n_sources": F.col("n_sources"),
        "last_survey_id": F.col("survey_id"), "active": F.lit(True), "sync_pending": F.lit(True),
        "sync_attempts": F.lit(0), "created": now, "updated": now,
    }
    return rows.select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OBJECTS.fields]
    )


def upsert_objects(objects: DataFrame, staged: DataFrame, now: Column) -> DataFrame:
    """
    Every object after the batch, plus what the batch did to it: `touched`, `new_detection`,
    `old_active`, `batch_survey_id`, `batch_native_id`. The batch is reduced to one row per object
    first; then one projection computes all new values from the old ones. Dates only widen, bands
    only move to newer MJDs, and only a newer detection reactivates or moves `updated`, so a replay
    changes nothing.
    """
    newest = newest_per_object(staged).select(
        "object_id", F.col("survey_id").alias("n_survey"), F.col("native_id").alias("n_native"),
        F.col("latest_mag").alias("n_mag"), F.col("latest_filter").alias("n_mjd"), F.col("n_sources").alias("n_count"),
    )
    span = batch_span_per_object(staged).select(
        "object_id", F.col("jdmin").alias("n_jdmin"), F.col("jdmax").alias("n_jdmax")
    )
    # The stored dates under a name of their own: inside a lambda, `latest_mjd` would mean the column of
    # that name in the select below, that is, the dates already merged.
    rows = objects.withColumn("_stored_mjd", F.col("latest_mjd")).join(
        span.join(newest, "object_id"), "object_id", "left"
    )
    touched = F.col("n_jdmax").isNotNull()
    is_new = F.coalesce(F.col("n_jdmax") > F.col("jdmax"), F.lit(False))
    old_mjd, new_mjd = F.col("_stored_mjd"), F.col("n_mjd")

    def merged(name: str, new: str) -> Column:
        return F.when(touched, merge_band_maps(F.col(name), old_mjd, F.col(new), new_mjd)).otherwise(F.col(name))

    changed = {
        "jdmin": F.least("jdmin", "n_jdmin"),
        "jdmax": F.greatest("jdmax", "n_jdmax"),
        "latest_mags": merged("latest_mags", "n_mag"),
        "n_sources": merged("n_sources", "n_count"),
        "latest_mjd": merged("latest_mjd", "n_mjd"),
        "active": F.col("active") | is_new,
        "sync_pending": F.col("sync_pending") | (is_new & ~F.col("active")),
        "last_survey_id": F.when(is_new, F.col("n_survey")).otherwise(F.col("last_survey_id")),
        "updated": F.when(is_new, now).otherwise(F.col("updated")),
    }
    return rows.select(
        *[changed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in OBJECTS.fields],
        touched.alias("touched"), is_new.alias("new_detection"), F.col("active").alias("old_active"),
        F.col("n_survey").alias("batch_survey_id"), F.col("n_native").alias("batch_native_id"),
    )


def updated_minus_new(updated: DataFrame, created: DataFrame) -> DataFrame:
    """Objects the batch touched, without those it created."""
    return updated.filter("touched").join(created.select("object_id"), "object_id", "left_anti")


def year_of(now: dt.datetime) -> str:
    return f"{now.year % 100:02d}"
