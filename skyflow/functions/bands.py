"""Per-band maps (`<band>_<survey>` -> value): building, parsing, merging, reading."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import is_finite, json_number, json_object, json_variant, payload_number

# Band key -> label the facility accepts. Bands that are not listed are never sent.
BAND_LABELS = {
    "g_lsst": "LSST_g_AB",
    "r_lsst": "LSST_r_AB",
    "i_lsst": "LSST_i_AB",
    "z_lsst": "LSST_z_AB",
    "g_ztf": "SDSS_g_AB",
    "r_ztf": "SDSS_r_AB",
}
MAG_MIN, MAG_MAX = 3.0, 50.0
MILESTONES = [18.0, 17.0, 16.0, 15.0]
MAG_UNKNOWN = 99.0


# Set on band map columns that cannot hold a missing or non-finite value.
FINITE_VALUES = {"finite_values": True}


def build_map(entries: list[tuple[str, str]], value_type: str) -> Column:
    """map<string, value_type> of the (key, SQL expression) entries whose value is not NULL (no shuffle, no UDF)."""
    items = ", ".join(f"struct('{k}' AS k, CAST({v} AS {value_type}) AS v)" for k, v in entries)
    return F.expr(f"map_from_entries(filter(array({items}), e -> e.v IS NOT NULL))")


def parse_band_map(text: Column, value_type: str = "double") -> Column:
    """JSON text to a band map; NULL, empty or non-object text gives an empty map."""
    parsed = F.transform_values(json_object(json_variant(text)), lambda _, v: json_number(v).try_cast(value_type))
    return F.coalesce(parsed, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{value_type}>")))


def band_label(band: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in BAND_LABELS.items() for x in pair])
    return F.try_element_at(labels, band)


def merge_band_maps(old_values: Column, old_mjd: Column, new_values: Column, new_mjd: Column) -> Column:
    """
    The old map, with a band replaced or added only where the new map has it with an MJD later
    than the stored one (a band with no stored MJD counts as infinitely old).
    """
    fresh = F.map_filter(
        new_values,
        lambda band, _: F.coalesce(
            F.try_element_at(new_mjd, band)
            > F.coalesce(F.try_element_at(old_mjd, band), F.lit(float("-inf"))),
            F.lit(False),
        ),
    )
    return F.map_zip_with(old_values, fresh, lambda _, old, new: F.coalesce(new, old))


def all_fainter(mags: Column, limit: float) -> Column:
    """Some band is recorded and every recorded magnitude is fainter than `limit`."""
    return (F.size(mags) > 0) & F.forall(F.map_values(mags), lambda m: m > limit)


def latest_detection(mags: Column, mjds: Column) -> Column:
    """struct(mjd, mag, band) of the newest usable detection (ties: the brighter one), else NULL."""
    usable = F.filter(
        F.map_entries(mags),
        lambda e: band_label(e["key"]).isNotNull()
        & is_finite(e["value"]) & e["value"].between(MAG_MIN, MAG_MAX)
        & is_finite(F.try_element_at(mjds, e["key"])) & (F.try_element_at(mjds, e["key"]) > 0),
    )
    ranked = F.transform(
        usable,
        lambda e: F.struct(
            F.try_element_at(mjds, e["key"]).alias("mjd"), (-e["value"]).alias("neg_mag"), e["key"].alias("band")
        ),
    )
    best = F.array_max(ranked)
    return F.when(
        best.isNotNull(),
        F.struct(best["mjd"].alias("mjd"), (-best["neg_mag"]).alias("mag"), best["band"].alias("band")),
    )


def milestone_due(mag: Column, facility_mag: Column) -> Column:
    """The magnitude reached a milestone that is brighter than what the facility already has."""
    sent = F.when(is_finite(facility_mag), facility_mag).otherwise(F.lit(MAG_UNKNOWN))
    return F.coalesce(
        F.exists(F.array(*[F.lit(m) for m in MILESTONES]), lambda m: (mag <= m) & (m < sent)), F.lit(False)
    )


__all__ = [
    "BAND_LABELS", "MILESTONES", "all_fainter", "band_label", "build_map", "latest_detection",
    "merge_band_maps", "milestone_due", "parse_band_map", "payload_number",
]
