"""Survey rows to the alert contract. A survey plugin is one function: raw DataFrame -> contract DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import FINITE_VALUES, build_map
from ..functions.scalars import AB_ZERO_POINT_NJY, MJD_TO_JD, is_finite

SURVEY_LSST, SURVEY_ZTF = 1, 2
LSST_BANDS = ["g", "r", "i", "z"]
ZTF_BANDS = ["g", "r"]


def _column(df: DataFrame, name: str, kind: str = "double") -> str:
    """A column that a stream may lack (then NULL), as a SQL expression."""
    return f"TRY_CAST({name if name in df.columns else 'NULL'} AS {kind})"


def _declination(df: DataFrame) -> str:
    return _column(df, "decl" if "decl" in df.columns else "dec")


def _positive(x: str) -> str:
    """Finite and above zero; NaN sorts above infinity."""
    return f"({x} > 0 AND {x} < double('infinity'))"


def _finite(x: str) -> str:
    return f"({x} > double('-infinity') AND {x} < double('infinity'))"


def _contract(columns: dict[str, str], maps: dict[str, Column], keep: list[str] | None) -> list[Column]:
    plain = [F.expr(e).alias(c) for c, e in columns.items()]
    return plain + [m.alias(c, metadata=FINITE_VALUES) for c, m in maps.items()] + [F.col(c) for c in keep or []]


def latest_alert_per_object(raw: DataFrame, id_column: str, time_column: str, *ties: str) -> DataFrame:
    """
    Newest alert per native id. NaN dates count as missing and sort last. `ties` (for example the
    stream offset) make the choice total. Each map task keeps one row per id before the shuffle.
    """
    when = F.when(is_finite(F.col(time_column)), F.col(time_column))
    order = [when.desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in ties]
    newest = Window.partitionBy(id_column).orderBy(*order)
    return raw.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def normalize_lsst(raw: DataFrame, pipeline_id: int, keep: list[str] | None = None) -> DataFrame:
    """
    Wide flux rows to the contract. A band gets a magnitude and MJD only with a finite positive flux
    and date; counts exist for all four bands (0 when missing). The id stays an integer until it is text.
    """
    mags, dates, counts = [], [], []
    for band in LSST_BANDS:
        key = f"{band}_lsst"
        flux, mjd = _column(raw, f"{band}_psfFlux"), _column(raw, f"{band}_latestMJD")
        usable = f"{_positive(flux)} AND {_positive(mjd)}"
        mag = f"round(-2.5D * log10({flux}) + {AB_ZERO_POINT_NJY}D, 4)"
        n = _column(raw, f"n{band}Sources")
        mags.append((key, f"CASE WHEN {usable} THEN {mag} END"))
        dates.append((key, f"CASE WHEN {usable} THEN {mjd} END"))
        counts.append((key, f"coalesce(CASE WHEN {_finite(n)} THEN CAST({n} AS BIGINT) END, 0L)"))
    columns = {
        "native_id": f"CAST({_column(raw, 'diaObjectId', 'bigint')} AS STRING)",
        "survey_id": str(SURVEY_LSST),
        "pipeline_id": str(pipeline_id),
        "ra": _column(raw, "ra"),
        "dec": _declination(raw),
        "jdmin": _column(raw, "firstDiaSourceMjdTai"),
        "jdmax": _column(raw, "lastDiaSourceMjdTai"),
    }
    maps = {
        "latest_filter": build_map(dates, "double"),
        "latest_mag": build_map(mags, "double"),
        "n_sources": build_map(counts, "bigint"),
    }
    return raw.select(*_contract(columns, maps, keep))


def normalize_ztf(raw: DataFrame, pipeline_id: int, keep: list[str] | None = None) -> DataFrame:
    """
    One detection per row to the contract, JD to MJD. The band comes from latestFilter/latestMag when
    the stream has both columns, else from gmag if it is a number, else rmag. Only g and r are kept.
    """
    jd = _column(raw, "latest_jd")
    mjd = f"({jd} - {MJD_TO_JD}D)"
    if {"latestFilter", "latestMag"} <= set(raw.columns):
        mag = _column(raw, "latestMag")
        in_band = {b: f"latestFilter = '{b}'" for b in ZTF_BANDS}
    else:
        gmag, rmag = _column(raw, "gmag"), _column(raw, "rmag")
        has_g = f"coalesce({_finite(gmag)}, false)"
        mag = f"CASE WHEN {has_g} THEN {gmag} ELSE {rmag} END"
        in_band = {"g": has_g, "r": f"NOT {has_g}"}

    def single(value: str, kind: str) -> Column:
        return build_map(
            [(f"{b}_ztf", f"CASE WHEN {cond} AND {_finite(mag)} AND {_finite(jd)} THEN {value} END")
             for b, cond in in_band.items()], kind)

    columns = {
        "native_id": "CAST(objectId AS STRING)",
        "survey_id": str(SURVEY_ZTF),
        "pipeline_id": str(pipeline_id),
        "ra": _column(raw, "ra"),
        "dec": _declination(raw),
        "jdmin": f"{_column(raw, 'first_jd')} - {MJD_TO_JD}D",
        "jdmax": mjd,
    }
    maps = {
        "latest_filter": single(mjd, "double"),
        "latest_mag": single(f"round({mag}, 4)", "double"),
        "n_sources": single("1", "bigint"),
    }
    return raw.select(*_contract(columns, maps, keep))
