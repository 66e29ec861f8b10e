"""Selection functions: the broker filter over object tables and the light-curve criteria."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .lineage import materialize

LSST_BANDS = ["g", "r", "i", "z"]
# Fixed values of the selection: magnitude 22.5 in nJy, 3 sigma, 2 nights, 3 bands, the accepted classes.
FLUX_LIMIT = 3630.78
MIN_SIGNIFICANCE = 3
MIN_NIGHTS = 2
MIN_BANDS = 3
CLASSES = ["SN", "NT", "ORPHAN", "UNCLEAR"]

SELECTED_COLUMNS = (
    ["diaObjectId", "ra", "decl", "lastDiaSourceMjdTai", "firstDiaSourceMjdTai", "latest_psfFlux"]
    + [f"{b}_{c}" for b in LSST_BANDS for c in ("psfFlux", "psfFluxSigma", "latestMJD")]
    + ["nPosDiaSources", "nPosDiaSourcesNights"]
    + [f"n{b}Sources" for b in LSST_BANDS]
    + ["sherlock_classifications"]
)


def selection_join(objects: DataFrame, extended: DataFrame, classes: DataFrame) -> DataFrame:
    """objects, their extension and their classification joined on the survey's object id."""
    sigmas = extended.select("diaObjectId", *[f"{b}_psfFluxSigma" for b in LSST_BANDS])
    named = classes.select("diaObjectId", F.col("classification").alias("sherlock_classifications"))
    return objects.join(sigmas, "diaObjectId").join(named, "diaObjectId")


def passes_selection() -> Column:
    """Seen on two nights, in three bands, bright and significant in one band, of an accepted class."""
    bands = sum((F.coalesce((F.col(f"n{b}Sources") >= 1).cast("int"), F.lit(0)) for b in LSST_BANDS), F.lit(0))
    bright = F.lit(False)
    for b in LSST_BANDS:
        flux, sigma = F.col(f"{b}_psfFlux"), F.col(f"{b}_psfFluxSigma")
        bright = bright | ((flux > FLUX_LIMIT) & (F.try_divide(flux, sigma) >= MIN_SIGNIFICANCE))
    return (
        (F.col("nPosDiaSourcesNights") >= MIN_NIGHTS) & (bands >= MIN_BANDS) & bright
        & F.col("sherlock_classifications").isin(CLASSES)
    )


def selection_function(objects: DataFrame, extended: DataFrame, classes: DataFrame) -> DataFrame:
    joined = selection_join(objects, extended, classes)
    return joined.filter(passes_selection()).select(*SELECTED_COLUMNS)


@dataclass(frozen=True)
class LightcurveCriteria:
    filters: list[int] = field(default_factory=lambda: [1, 2, 3])
    significance: float = 5.0
    min_bands: int = 3
    min_nights: int = 2
    mag_limit: float = 22.5


def _significant(c: LightcurveCriteria) -> Column:
    """The detection lies in a wanted filter with a signal of `significance` sigma (1.09 / magnitude error)."""
    return F.coalesce(
        F.col("fid").isin(c.filters) & (F.try_divide(F.lit(1.09), F.col("sigmapsf")) >= c.significance), F.lit(False)
    )


def lightcurve_select(detections: DataFrame, names: DataFrame, c: LightcurveCriteria) -> DataFrame:
    """(objectId, passed) for every name; an object without rows fails. The brightness rule looks at all rows."""
    sig = _significant(c)
    per_object = detections.groupBy("objectId").agg(
        # Sets bounded by the number of filters and of calendar nights.
        F.size(F.collect_set(F.when(sig, F.col("fid")))).alias("_bands"),
        F.size(F.collect_set(F.when(sig, F.col("nid")))).alias("_nights"),
        F.min("magpsf").alias("_brightest"),
    )
    passed = (
        (F.col("_bands") >= c.min_bands) & (F.col("_nights") >= c.min_nights) & (F.col("_brightest") <= c.mag_limit)
    )
    return (
        names.select("objectId").distinct().join(per_object, "objectId", "left")
        .select("objectId", F.coalesce(passed, F.lit(False)).alias("passed"))
    )


def lightcurve_first_pass(detections: DataFrame, c: LightcurveCriteria) -> DataFrame:
    """
    (objectId, first_pass_jd): the earliest detection date x at which the rows with jd <= x pass.

    Each criterion only ever turns from false to true as x grows, so the turning points are found by
    aggregation instead of replaying prefixes: the min_bands-th of the first significant dates per
    band, the min_nights-th of those per night, and the first date at the brightness limit. The detections
    are read once, into one row per object, band and night; all else follows from these rows. Only where a turning point
    falls between two detections of one band and night, and is none itself, are those detections looked at again.
    """
    sig, jd = _significant(c), F.col("jd")
    detected = F.col("candid").isNotNull()
    key = ["objectId", "fid", "nid"]
    groups = materialize(detections.groupBy(*key).agg(
        F.min(F.when(sig, jd)).alias("_sig"), F.min(F.when(F.col("magpsf") <= c.mag_limit, jd)).alias("_bright"),
        F.min(F.when(sig & detected, jd)).alias("_sure"), F.min(F.when(detected, jd)).alias("_low"), F.max(F.when(detected, jd)).alias("_high")), "nights")

    def nth_first(group: str, n: int, name: str) -> DataFrame:
        # Bounded per object: one date per band, or one per calendar night.
        firsts = groups.filter("_sig IS NOT NULL").groupBy("objectId", group).agg(F.min("_sig").alias("_first"))
        dates = F.sort_array(F.collect_list("_first"))
        return firsts.groupBy("objectId").agg(F.try_element_at(dates, F.lit(n)).alias(name))

    bright = groups.groupBy("objectId").agg(F.min("_bright").alias("_t_mag"))
    turning = (
        nth_first("fid", c.min_bands, "_t_band").join(nth_first("nid", c.min_nights, "_t_night"), "objectId")
        .join(bright, "objectId")
        .filter(F.col("_t_band").isNotNull() & F.col("_t_night").isNotNull() & F.col("_t_mag").isNotNull())
        .select("objectId", F.greatest("_t_band", "_t_night", "_t_mag").alias("_from"))
    )
    at = F.col("_from")
    known = F.when(F.col("_low") >= at, F.col("_low")).when((F.col("_sure") == at) | (F.col("_high") == at), at)
    tested = materialize(groups.join(turning, "objectId").select(*key, "_from", known.alias("_known"), (known.isNull() & (F.col("_high") > at)).alias("_between")), "turning")
    passed = tested.filter("_known IS NOT NULL").select("objectId", F.col("_known").alias("jd"))
    settled = tested.filter("_known = _from").select("objectId").distinct()
    between = tested.filter("_between").join(settled, "objectId", "left_anti").select(*key, "_from")
    if not between.isEmpty():
        again = detections.filter(detected).join(between, key).filter(jd >= at).select("objectId", "jd")
        passed = passed.unionByName(again)
    return passed.groupBy("objectId").agg(F.min("jd").alias("first_pass_jd"))


def attach_selection_result(alerts: DataFrame, results: DataFrame) -> DataFrame:
    """Alerts with the pass/fail of their object; NULL where it was not tested."""
    return alerts.join(results.select("objectId", F.col("passed")), "objectId", "left")
