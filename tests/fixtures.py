"""Small contract frames with results worked out by hand (FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skyflow.plans.ingest import IngestParams
from skyflow.schemas import CONTRACT, OBJECTS


def mjd_datetime(mjd: float) -> dt.datetime:
    return dt.datetime(1858, 11, 17) + dt.timedelta(days=mjd)


PARAMS = IngestParams(now=mjd_datetime(61061.0), code_version="test", run_id="r")

# Two surveys with three places on the sky: the first rows of both are one source, 0.7" apart.
LSST = [
    ("7100", 1, 1, 33.25, -12.5, 61003.0, 61047.0,
     {"g_lsst": 61047.0, "i_lsst": 61031.5, "z_lsst": 61044.0}, {"g_lsst": 19.75, "i_lsst": 19.25, "z_lsst": 18.5},
     {"g_lsst": 14, "i_lsst": 2, "z_lsst": 6}),
    ("7207", 1, 1, 48.5, 21.75, 61052.0, 61052.0, {"r_lsst": 61052.0}, {"r_lsst": 20.25}, {"r_lsst": 3}),
]
ZTF = [
    ("ZTF25north", 2, 1, 33.25, -12.4998, 61012.0, 61058.0, {"g_ztf": 61056.0, "r_ztf": 61058.0},
     {"g_ztf": 19.5, "r_ztf": 19.0}, {"g_ztf": 4, "r_ztf": 7}),
    ("ZTF25south", 2, 1, 201.0, -33.0, 61040.0, 61052.0, {"g_ztf": 61052.0}, {"g_ztf": 18.25}, {"g_ztf": 5}),
]


def contract(spark: SparkSession, rows) -> DataFrame:
    """Contract rows that keep the order they are written in."""
    numbered = StructType(CONTRACT.fields + [StructField("input_row", LongType())])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], numbered)


def alert(native_id="a", survey_id=1, ra=150.0, dec=2.0, jdmin=61000.0, jdmax=61050.0, mjd=None, mag=None, n=None):
    return (native_id, survey_id, 1, ra, dec, jdmin, jdmax, mjd or {}, mag or {}, n or {})


def objects(spark: SparkSession, *rows: dict) -> DataFrame:
    """Object rows from partial dicts."""
    base = {
        "name": None, "ra": 150.0, "dec": 2.0, "jdmin": 61000.0, "jdmax": 61050.0, "jd_obs_trigger": 61050.0,
        "latest_mags": {}, "latest_mjd": {}, "n_sources": {}, "last_survey_id": 1, "active": True, "sync_pending": True,
        "sync_state": None, "sync_attempts": 0, "sync_last_error": None, "facility_id": None, "facility_mag": None,
        "ostd_targ_id": None, "ostd_u_obj_id": None, "date_ingested": None,
        "created": mjd_datetime(61050.0), "updated": mjd_datetime(61050.0),
    }
    full = [{**base, **r, "name": r.get("name") or f"SKY26x{r['object_id']}"} for r in rows]
    return spark.createDataFrame([tuple(r[f] for f in OBJECTS.names) for r in full], OBJECTS)


def staged(spark: SparkSession, *rows) -> DataFrame:
    """Contract rows with (object_id, stage_row) in front."""
    frames = spark.createDataFrame([r[2:] for r in rows], CONTRACT)
    ids = {i: r[:2] for i, r in enumerate(rows)}
    out = [tuple(x) for x in frames.collect()]
    schema = "object_id bigint, stage_row bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in CONTRACT.fields)
    return spark.createDataFrame([ids[i] + r for i, r in enumerate(out)], schema)


def by_id(df: DataFrame, key: str = "object_id") -> dict:
    return {r[key]: r.asDict() for r in df.collect()}


__all__ = ["LSST", "PARAMS", "ZTF", "F", "alert", "by_id", "contract", "mjd_datetime", "objects", "staged"]
