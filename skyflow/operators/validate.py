"""Validating contract rows: the first failing reason, the clean rows and the rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.bands import parse_band_map
from ..functions.scalars import is_finite, json_number, json_object, json_variant
from ..schemas import CONTRACT_COLUMNS

MJD_FLOOR = 40000.0   # fixed value: a JD or a placeholder never lies in (40000, now + 1]
_MAPS = ("latest_filter", "latest_mag", "n_sources")


def _is_map(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.MapType)


def _known_good(df: DataFrame, name: str) -> bool:
    """A survey plugin built the map without missing or non-finite values (column metadata)."""
    return _is_map(df, name) and bool(df.schema[name].metadata.get("finite_values"))


def _finite_values(df: DataFrame, name: str) -> Column:
    """The map, or the JSON object in the text, has finite values only; NULL or false for anything else."""
    if _is_map(df, name):
        return F.forall(F.map_values(F.col(name)), is_finite)
    return F.forall(F.map_values(json_object(json_variant(F.col(name)))), lambda v: is_finite(json_number(v)))


def _map_problem(df: DataFrame, name: str) -> Column:
    missing = F.col(name).isNull() if _is_map(df, name) else json_variant(F.col(name)).isNull()
    return F.when(missing, F.lit(f"{name} cannot be read as JSON")).when(
        ~F.coalesce(_finite_values(df, name), F.lit(False)), F.lit(f"{name} holds values that are no finite numbers")
    )


def is_valid(df: DataFrame, now_mjd: float) -> Column:
    """
    The row has no problem: plain comparisons, which reach the scan as pushed filters. NaN sorts above
    every number, so the upper bounds also refuse NaN and infinity.
    """
    ra, dec, jdmax = (F.col(c).try_cast("double") for c in ("ra", "dec", "jdmax"))
    fine = (
        F.col("native_id").isNotNull() & is_finite(F.col("survey_id")) & is_finite(F.col("pipeline_id"))
        & (ra >= 0.0) & (ra < 360.0) & (dec >= -90.0) & (dec <= 90.0)
        & (jdmax > MJD_FLOOR) & (jdmax <= now_mjd + 1.0)
    )
    for name in _MAPS:
        if not _known_good(df, name):
            fine = fine & _finite_values(df, name)
    return fine


def alert_problem(df: DataFrame, now_mjd: float) -> Column:
    """First failing reason of a contract row, NULL for a valid row. jdmin is not checked."""
    ra, dec, jdmax = (F.col(c).try_cast("double") for c in ("ra", "dec", "jdmax"))
    checks = [F.when(F.col("native_id").isNull(), F.lit("native id missing"))]
    for name in ("ra", "dec", "jdmax", "survey_id", "pipeline_id"):
        checks.append(F.when(~is_finite(F.col(name)), F.lit(f"{name} is no finite number")))
    checks.append(
        F.when(~((ra >= 0.0) & (ra < 360.0) & dec.between(-90.0, 90.0)), F.lit("position outside the sky"))
    )
    checks.append(
        F.when(
            ~((jdmax > MJD_FLOOR) & (jdmax <= now_mjd + 1.0)),
            F.concat(F.lit("jdmax "), jdmax.cast("string"), F.lit(" lies outside the accepted dates")),
        )
    )
    checks.extend(_map_problem(df, name) for name in _MAPS)
    return F.coalesce(*checks)


def check_alerts(df: DataFrame, now_mjd: float) -> DataFrame:
    """The input plus `reject_reason` (NULL = valid)."""
    return df.withColumn("reject_reason", alert_problem(df, now_mjd))


def validate_alerts(df: DataFrame, now_mjd: float) -> DataFrame:
    """The valid rows as typed contract rows (extra columns are kept)."""
    good = df.filter(is_valid(df, now_mjd))
    kinds = {"latest_filter": "double", "latest_mag": "double", "n_sources": "long"}
    typed = {
        "native_id": F.col("native_id").cast("string"),
        "survey_id": F.col("survey_id").try_cast("int"),
        "pipeline_id": F.col("pipeline_id").try_cast("int"),
        **{c: F.col(c).try_cast("double") for c in ("ra", "dec", "jdmin", "jdmax")},
    }
    for name, kind in kinds.items():
        is_map = isinstance(df.schema[name].dataType, T.MapType)
        typed[name] = F.col(name).try_cast(f"map<string,{kind}>") if is_map else parse_band_map(F.col(name), kind)
    extra = [c for c in df.columns if c not in CONTRACT_COLUMNS]
    return good.select(*[typed[c].alias(c) for c in CONTRACT_COLUMNS], *extra)


def alert_rejects(df: DataFrame, now_mjd: float) -> DataFrame:
    """The refused rows with their reason: the dead-letter side output."""
    return check_alerts(df.filter(~F.coalesce(is_valid(df, now_mjd), F.lit(False))), now_mjd)
