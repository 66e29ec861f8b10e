"""The survey clock: observing nights with alerts, how long an object went unseen, and switching objects off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import all_fainter
from ..functions.scalars import night_to_date, observing_night
from .upsert import insert_if_absent

FAINT_LIMIT_MAG = 22.5        # fixed value
DEACTIVATE_AFTER_DAYS = 10.0


def survey_heartbeat(staged: DataFrame, nights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert the (survey, night) pairs of the batch's validated dates; returns (all nights, the new ones)."""
    seen = staged.select("survey_id", observing_night(F.col("jdmax")).alias("night")).distinct()
    return insert_if_absent(nights, seen, ["survey_id", "night"])


def later_nights(nights: DataFrame) -> DataFrame:
    """
    (survey_id, day, n_later): for every day from the survey's first night to its last, the nights
    after it. One row per survey and calendar day.
    """
    by_survey = Window.partitionBy("survey_id").orderBy("night")
    ranked = nights.select(
        "survey_id", "night",
        F.lead("night").over(by_survey).alias("next"),
        (F.row_number().over(Window.partitionBy("survey_id").orderBy(F.desc("night"))) - 1).alias("n_later"),
    )
    days = F.sequence(F.col("night"), F.coalesce(F.col("next") - 1, F.col("night")))
    return ranked.select("survey_id", F.explode(days).alias("day"), "n_later")


def nights_since_detection(objects: DataFrame, nights: DataFrame, now_mjd: float) -> DataFrame:
    """
    `objects` plus `nights_since`: nights of the object's last survey after its last detection, or
    calendar days when no survey is recorded. The range count is an equi-join on (survey, day).
    """
    # Validated dates lie in (40000, now + 1], so the calendar has at most some 20,000 days per survey; Spark
    # broadcasts it where its size allows.
    calendar = later_nights(nights).select(F.col("survey_id").alias("_s"), F.col("day").alias("_d"), "n_later")
    totals = nights.groupBy(F.col("survey_id").alias("_ts")).agg(F.count(F.lit(1)).alias("_total"), F.min("night").alias("_first"))
    day = observing_night(F.col("jdmax"))
    joined = (
        objects.withColumn("_day", day)
        .join(calendar, (F.col("last_survey_id") == F.col("_s")) & (F.col("_day") == F.col("_d")), "left")
        .join(totals, F.col("last_survey_id") == F.col("_ts"), "left")
    )
    counted = F.when(F.col("_day") < F.col("_first"), F.col("_total")).otherwise(F.coalesce(F.col("n_later"), F.lit(0)))
    age = F.when(F.col("last_survey_id").isNull(), F.lit(now_mjd) - F.col("jdmax")).otherwise(counted.cast("double"))
    return joined.withColumn("nights_since", age).drop("_day", "_s", "_d", "n_later", "_ts", "_total", "_first")


def stale_reason(days: float) -> str:
    return f"stale_{days:g}d"


def deactivation_reason(days: float = DEACTIVATE_AFTER_DAYS, faint_mag: float = FAINT_LIMIT_MAG) -> Column:
    """Why an active object (with nights_since) is switched off, or NULL. Stale wins over faint."""
    return F.when(
        F.col("active"),
        F.when(F.col("nights_since") > days, F.lit(stale_reason(days))).when(
            all_fainter(F.col("latest_mags"), faint_mag), F.lit("faint_alert")
        ),
    )


def deactivate_objects(
    objects: DataFrame, nights: DataFrame, now_mjd: float,
    days: float = DEACTIVATE_AFTER_DAYS, faint_mag: float = FAINT_LIMIT_MAG,
) -> DataFrame:
    """All objects with the stale and faint ones switched off and pending; adds `deactivation_reason`, `nights_since`."""
    aged = nights_since_detection(objects, nights, now_mjd).withColumn(
        "deactivation_reason", deactivation_reason(days, faint_mag)
    )
    off = F.col("deactivation_reason").isNotNull()
    return aged.withColumns({
        "active": F.col("active") & ~off, "sync_pending": F.col("sync_pending") | off,
    })


def survey_clock_summary(nights: DataFrame) -> DataFrame:
    """Last observing night (as a date) and number of nights per survey."""
    return nights.groupBy("survey_id").agg(
        night_to_date(F.max("night")).alias("last_night"), F.count(F.lit(1)).alias("nights")
    )
