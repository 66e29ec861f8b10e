"""
Sky tables derived from the general test tables, which hold no sky data.

Every derived column is one SQL expression that Spark and DuckDB read alike, so a query and the SQL
it is checked against start from the same rows. All rows of the source table are used.

    events    -> survey 1 and 2 alerts, light curves, selection tables, object history
    customer  -> objects with outbox state, facility targets, galaxies
    orders    -> facility answers, the request log
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BANDS = ["g", "r", "i", "z"]
CONTRACT_BANDS = [f"{b}_lsst" for b in BANDS] + ["g_ztf", "r_ztf"]
OUTBOX_BANDS = ["g_lsst", "r_ztf", "u_lsst"]
BATCH_SPLIT_MJD = 60325.0
FIRST_SPLIT_MJD = 60310.5        # so early that the second part has objects that the first lacks
NOW_MJD = 60341.0
PIPELINE_LSST, PIPELINE_ZTF = 1, 2


class Dialect:
    """The few places where the two engines spell an expression differently."""

    def __init__(self, spark: bool):
        self.spark = spark

    def num(self, x: float) -> str:
        return f"{float(x)!r}D" if self.spark else f"{float(x)!r}::DOUBLE"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def micros(self, ts: str) -> str:
        return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {ts})" if self.spark else f"epoch_us({ts})"

    def text(self, x: str) -> str:
        return f"CAST({x} AS {'STRING' if self.spark else 'VARCHAR'})"


SPARK, DUCK = Dialect(True), Dialect(False)


def event_columns(d: Dialect) -> dict[str, str]:
    mjd = f"({d.micros('ts')} / {d.num(86400e6)} + {d.num(40587)})"
    jitter = f"((event_id * 37 % 11) - 5) * {d.num(0.14)} / {d.num(3600)}"
    return {
        "event_id": "event_id",
        "user_id": "user_id",
        "value": "value",
        "event_type": "event_type",
        "props": "props",
        "survey_id": "CAST(1 + event_id % 2 AS INT)",
        "k": "CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE -1 END",
        # Every fifth object is only seen in the first ten days: its dates are compressed, so it goes stale.
        "mjd": f"CASE WHEN user_id % 5 = 0 THEN {d.num(60310)} + ({mjd} - {d.num(60310)}) / {d.num(3)} ELSE {mjd} END",
        "ra": f"(user_id * 7919 % 360000) / {d.num(1000)} + {jitter}",
        "dec": f"(user_id * 104729 % 120000) / {d.num(1000)} - {d.num(80)}",
        "flux": f"value * CASE user_id % 4 WHEN 0 THEN {d.num(10)} WHEN 1 THEN {d.num(100)} "
                f"WHEN 2 THEN {d.num(1000)} ELSE {d.num(10000)} END",
    }


def lsst_columns(d: Dialect) -> dict[str, str]:
    """Survey 1 wide rows from the event columns (rows with survey_id = 1)."""
    half = d.div("event_id", "2")
    cols = {
        "diaObjectId": "170000000000000000 + user_id",
        "ra": "ra",
        "decl": "dec",
        "lastDiaSourceMjdTai": "mjd",
        "firstDiaSourceMjdTai": "mjd - event_id % 20",
        "latest_psfFlux": "flux",
    }
    for b, name in enumerate(BANDS):
        other = f"({half} + {b}) % 3 = 0"
        cols[f"{name}_psfFlux"] = (
            f"CASE WHEN k < 0 THEN {d.num(0) if b % 2 == 0 else 'NULL'} WHEN k = {b} THEN flux "
            f"WHEN {other} THEN flux * {d.num(0.5 + 0.25 * b)} END"
        )
        cols[f"{name}_psfFluxSigma"] = f"CASE WHEN k < 0 THEN {d.num(0)} ELSE flux / (1 + event_id % 9) END"
        cols[f"{name}_latestMJD"] = (
            f"CASE WHEN k = {b} THEN mjd" + (f" WHEN {other} THEN mjd - {d.num(1.5 * (b + 1))}" if b != 3 else "") + " END"
        )
    cols["nPosDiaSources"] = "1 + event_id % 11"
    cols["nPosDiaSourcesNights"] = f"1 + {half} % 4"
    for b, name in enumerate(BANDS):
        cols[f"n{name}Sources"] = (
            f"CASE WHEN k = {b} THEN 1 + {half} % 7 WHEN ({half} + {b}) % 3 = 0 THEN {half} % 3 "
            f"WHEN ({half} + {b}) % 3 = 1 THEN 1 END"
        )
    cols["sherlock_classifications"] = (
        "CASE user_id % 6 WHEN 0 THEN 'SN' WHEN 1 THEN 'NT' WHEN 2 THEN 'ORPHAN' WHEN 3 THEN 'UNCLEAR' WHEN 4 THEN 'AGN' ELSE 'VS' END"
    )
    cols["event_id"] = "event_id"
    return cols


def ztf_columns(d: Dialect) -> dict[str, str]:
    """Survey 2 rows from the event columns (rows with survey_id = 2)."""
    mag = f"-2.5 * log10(flux) + {d.num(31.4)}"
    return {
        "objectId": f"'ZTF' || {d.text('user_id')}",
        "ra": "ra",
        "decl": "dec",
        "first_jd": f"mjd + {d.num(2400000.5)} - event_id % 20",
        "latest_jd": f"mjd + {d.num(2400000.5)}",
        "latestFilter": "CASE k WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'z' END",
        "latestMag": f"CASE WHEN k >= 0 THEN {mag} END",
        "event_id": "event_id",
    }


def ztf_two_band_columns(d: Dialect) -> dict[str, str]:
    """The other survey 2 form: gmag and rmag instead of latestFilter and latestMag."""
    mag = f"-2.5 * log10(flux) + {d.num(31.4)}"
    cols = {k: v for k, v in ztf_columns(d).items() if k not in ("latestFilter", "latestMag")}
    return {**cols, "gmag": f"CASE WHEN k IN (0, 2) THEN {mag} END", "rmag": f"CASE WHEN k IN (1, 2) THEN {mag} - 1 END"}


def message_columns(d: Dialect) -> dict[str, str]:
    """How an event becomes a message: error events are broken in one of four ways."""
    return {
        "event_id": "event_id",
        "kind": f"CASE WHEN k >= 0 THEN 'ok' ELSE CASE {d.div('event_id', '2')} % 4 WHEN 0 THEN 'cut' WHEN 1 THEN 'array' "
                "WHEN 2 THEN 'no id' ELSE 'null id' END END",
    }


def submission_columns(d: Dialect) -> dict[str, str]:
    """Contract rows as people hand them in, JSON text maps, with every kind of mistake."""
    h = "(event_id % 37)"
    m = f"{d.text('CAST(14 + event_id % 9 AS INT)')}"
    day = d.text("CAST(60300 + event_id % 30 AS INT)")
    return {
        "event_id": "event_id",
        "native_id": f"CASE WHEN {h} = 1 THEN NULL ELSE 'MAN' || {d.text('user_id')} END",
        "survey_id": f"CASE WHEN {h} = 2 THEN NULL ELSE CAST(9 AS INT) END",
        "pipeline_id": f"CASE WHEN {h} = 3 THEN NULL ELSE CAST(11 AS INT) END",
        "ra": f"CASE {h} WHEN 4 THEN NULL WHEN 5 THEN {d.num(360)} WHEN 6 THEN {d.num(-0.1)} WHEN 7 THEN CAST('NaN' AS DOUBLE) ELSE ra END",
        "dec": f"CASE {h} WHEN 8 THEN NULL WHEN 9 THEN {d.num(90.01)} WHEN 10 THEN {d.num(90)} ELSE dec END",
        "jdmin": f"CASE WHEN {h} = 11 THEN NULL ELSE mjd - 1 END",
        "jdmax": f"CASE {h} WHEN 12 THEN {d.num(2461000.5)} WHEN 13 THEN {d.num(40000)} WHEN 14 THEN {d.num(NOW_MJD + 1.01)} "
                 f"WHEN 15 THEN CAST('Infinity' AS DOUBLE) ELSE mjd END",
        "latest_filter": f"CASE {h} WHEN 16 THEN NULL WHEN 17 THEN '[1]' ELSE '{{\"r_lsst\": ' || {day} || '.5}}' END",
        "latest_mag": f"CASE {h} WHEN 18 THEN '{{bad' WHEN 19 THEN '{{\"r_lsst\": null}}' WHEN 20 THEN '{{}}' "
                      f"WHEN 21 THEN '{{\"r_lsst\": \"21.5\"}}' WHEN 22 THEN '{{\"r_lsst\": \"x\"}}' WHEN 23 THEN props "
                      f"ELSE '{{\"r_lsst\": ' || {m} || '.25}}' END",
        "n_sources": f"CASE {h} WHEN 24 THEN 'none' WHEN 25 THEN '{{\"r_lsst\": {{\"n\": 1}}}}' ELSE '{{\"r_lsst\": ' || "
                     f"{d.text('CAST(event_id % 5 AS INT)')} || '}}' END",
    }


def lightcurve_columns(d: Dialect) -> dict[str, str]:
    return {
        "objectId": f"'ZTF' || {d.text('user_id')}",
        "jd": f"mjd + {d.num(2400000.5)}",
        "fid": "CAST(CASE WHEN k < 0 THEN 1 + event_id % 3 ELSE 1 + k END AS INT)",
        "nid": f"CAST(floor(mjd - {d.num(0.5)}) AS INT)",
        "magpsf": f"round(-2.5 * log10(flux) + {d.num(31.4)}, 4)",
        "sigmapsf": f"CASE WHEN k >= 0 THEN {d.num(1.09)} / (3.5 + event_id % 9) END",
        "candid": "CASE WHEN k >= 0 THEN event_id END",
    }


def history_columns(d: Dialect) -> dict[str, str]:
    """Object history from every event."""
    return {
        "event_id": "event_id",
        "object_id": "user_id + 1",
        "event_mjd": "mjd",
        "event_type": "CASE event_type WHEN 'click' THEN 'created' WHEN 'view' THEN 'activated' WHEN 'purchase' THEN 'deactivated' "
                      "WHEN 'signup' THEN 'manual_submission' ELSE 'alert' END",
        "reason": "CASE event_type WHEN 'view' THEN 'redetected' WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'stale_10d' ELSE 'faint_alert' END END",
        "survey_id": "CAST(1 + (event_id + user_id) % 3 AS INT)",
        "survey_object_id": f"'S' || {d.text('(event_id + user_id) % 3')} || '-' || {d.text('user_id')}",
        "pipeline_id": "CAST(1 + event_id % 12 AS INT)",
        "submitted_by": "CASE WHEN event_type = 'signup' THEN 'observer' END",
        "details": "props",
    }


def outbox_columns(d: Dialect) -> dict[str, str]:
    """Objects with outbox state from every customer."""
    mag = f"{d.num(14)} + (c_custkey * 31 % 1200) / {d.num(100)}"
    day = f"{d.num(60300)} + c_custkey % 40"
    return {
        "object_id": "c_custkey",
        "name": f"'SKY24' || {d.text('c_custkey')}",
        "ra": f"(c_custkey * 7919 % 400000) / {d.num(1000)} - {d.num(20)}",
        "dec": f"(c_custkey * 104729 % 150000) / {d.num(1000)} - {d.num(90)}",
        "jdmin": f"{day} - 30",
        "jdmax": f"{day} - CASE WHEN c_custkey % 3 = 0 THEN 60 ELSE 0 END",
        "active": "c_acctbal > 2000",
        "sync_pending": "c_nationkey % 4 <> 1",
        "sync_state": "CASE c_nationkey % 7 WHEN 1 THEN 'ambiguous' WHEN 2 THEN 'failed' WHEN 3 THEN 'conflict' WHEN 4 THEN 'not_submittable' END",
        "sync_attempts": "CAST(c_nationkey % 3 AS INT)",
        "sync_last_error": "CASE WHEN c_nationkey % 7 IN (2, 3, 4) THEN 'earlier error' END",
        "facility_id": "CASE WHEN c_nationkey % 3 <> 0 THEN 500000 + c_custkey END",
        "facility_mag": f"CASE WHEN c_custkey % 4 <> 0 THEN {d.num(14)} + (c_custkey % 60) / {d.num(10)} END",
        "last_survey_id": "CAST(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 1 + c_custkey % 2 END AS INT)",
        "mag_g_lsst": f"CASE WHEN c_custkey % 5 <> 0 THEN {mag} END",
        "mjd_g_lsst": f"CASE WHEN c_custkey % 5 <> 0 THEN {day} END",
        "mag_r_ztf": f"CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN {mag} - {d.num(0.5)} ELSE {d.num(56.4)} END",
        "mjd_r_ztf": f"CASE WHEN c_custkey % 3 <> 0 THEN {day} - c_custkey % 2 END",
        "mag_u_lsst": f"CASE WHEN c_custkey % 2 = 0 THEN {d.num(24.5)} END",
        "mjd_u_lsst": f"CASE WHEN c_custkey % 2 = 0 THEN {day} + 1 END",
    }


def target_columns(d: Dialect) -> dict[str, str]:
    """Targets as the facility lists them, one per customer, some of another programme or not ingested."""
    return {
        "id": "CASE WHEN c_custkey % 17 <> 0 THEN 500000 + c_custkey END",
        "name": f"'SKY24' || {d.text('c_custkey')}",
        "ra": f"(c_custkey * 7919 % 360000) / {d.num(1000)}",
        "dec": f"(c_custkey * 104729 % 150000) / {d.num(1000)} - {d.num(90)}",
        "subsurvey": "CASE WHEN c_nationkey % 5 = 0 THEN 'source' ELSE 'sky-sn' END",
        "mag": f"{d.num(14)} + (c_custkey % 80) / {d.num(10)}",
        "is_active": "c_acctbal > 1000",
        "date_submitted": f"'2024-0' || {d.text('CAST(1 + c_custkey % 6 AS INT)')} || '-1' || {d.text('CAST(c_custkey % 10 AS INT)')} || 'T12:00:00'",
        "date_ingested": f"CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'soon' ELSE '2024-07-1' || {d.text('CAST(c_custkey % 10 AS INT)')} || 'T06:00:00' END",
        "ostd_targ_id": "CASE WHEN c_custkey % 6 <> 0 THEN 900000 + c_custkey END",
        "ostd_u_obj_id": "700000 + c_custkey",
        "c_custkey": "c_custkey",
    }


def response_columns(d: Dialect) -> dict[str, str]:
    """Facility answers, one per order."""
    return {
        "response_id": "o_orderkey",
        "method": "CASE o_orderkey % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'PATCH' ELSE 'GET' END",
        "status_code": "CAST(CASE o_custkey % 13 WHEN 0 THEN 200 WHEN 1 THEN 201 WHEN 2 THEN 400 WHEN 3 THEN 401 WHEN 4 THEN 403 "
                       "WHEN 5 THEN 404 WHEN 6 THEN 409 WHEN 7 THEN 422 WHEN 8 THEN 429 WHEN 9 THEN 500 WHEN 10 THEN 299 WHEN 11 THEN NULL ELSE 302 END AS INT)",
        "body": "CASE o_custkey % 5 WHEN 0 THEN '{\"id\": 1}' WHEN 1 THEN '<html>Internal error</html>' WHEN 2 THEN 'null' WHEN 3 THEN '[]' END",
        "error_kind": "CASE WHEN o_custkey % 13 = 11 THEN 'timeout' WHEN o_orderkey % 19 = 0 THEN 'unencodable' END",
    }


def request_columns(d: Dialect) -> dict[str, str]:
    """The request log, one request per order; about half name two objects."""
    return {
        "log_id": "o_orderkey",
        "request_us": d.micros("o_orderdate") + " + o_orderkey % 86400 * 1000000",
        "first_id": "o_custkey",
        "second_id": "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 1 END",
        "method": "CASE o_orderkey % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'PATCH' ELSE 'GET' END",
        "outcome": "CASE o_custkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'rejected' WHEN 2 THEN 'ambiguous' WHEN 3 THEN 'retry' ELSE 'dry_run' END",
        "status_code": "CAST(CASE o_custkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 400 WHEN 2 THEN 500 WHEN 3 THEN 429 END AS INT)",
        "mag_text": d.text("CAST(14 + o_orderkey % 9 AS INT)") + " || '.5'",
        "has_mag": "o_custkey % 2 = 0 OR o_orderkey % 3 = 0",
        "response_text": "o_orderpriority || ' answer for ' || o_orderstatus",
    }


def galaxy_columns(d: Dialect) -> dict[str, str]:
    """Galaxies near the objects of `event_columns`, from customers joined with n_users (the number of users)."""
    user = "(c_custkey % n_users)"
    step = d.div("c_custkey", "n_users")
    return {
        "host_name": f"'GAL' || {d.text('c_custkey')}",
        "object_type": "CASE WHEN c_nationkey % 6 = 0 THEN 'star' ELSE 'galaxy' END",
        "ra": f"({user} * 7919 % 360000) / {d.num(1000)}",
        "dec": f"({user} * 104729 % 120000) / {d.num(1000)} - {d.num(80)} + ({step} % 3) * {d.num(3)} / {d.num(3600)}",
        "mag": f"{d.num(16)} + (c_custkey % 60) / {d.num(10)}",
    }


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), event_columns(SPARK))


def lsst_raw(ev: DataFrame) -> DataFrame:
    return _select(ev.filter("survey_id = 1"), lsst_columns(SPARK))


def ztf_raw(ev: DataFrame) -> DataFrame:
    return _select(ev.filter("survey_id = 2"), ztf_columns(SPARK))


def ztf_two_band_raw(ev: DataFrame) -> DataFrame:
    return _select(ev.filter("survey_id = 2"), ztf_two_band_columns(SPARK))


def _messages(rows: DataFrame, columns: dict[str, str], id_key: str) -> DataFrame:
    """(value, event_id): survey rows as JSON text, error events broken."""
    wide = _select(rows, {**columns, "kind": message_columns(SPARK)["kind"]})
    fields = [c for c in columns if c != "event_id"]
    rest = [c for c in fields if c != id_key]
    value = (
        F.when(F.col("kind") == "ok", F.to_json(F.struct(*fields)))
        .when(F.col("kind") == "cut", F.substring(F.to_json(F.struct(*fields)), 1, 40))
        .when(F.col("kind") == "array", F.concat(F.lit("["), F.to_json(F.struct(*fields)), F.lit("]")))
        .when(F.col("kind") == "no id", F.to_json(F.struct(*rest)))
        .otherwise(F.concat(F.lit(f'{{"{id_key}": null, '), F.substring(F.to_json(F.struct(*rest)), 2, 1_000_000)))
    )
    return wide.select(value.alias("value"), "event_id")


def lsst_messages(ev: DataFrame) -> DataFrame:
    return _messages(ev.filter("survey_id = 1"), lsst_columns(SPARK), "diaObjectId")


def ztf_messages(ev: DataFrame) -> DataFrame:
    return _messages(ev.filter("survey_id = 2"), ztf_columns(SPARK), "objectId")


def submissions(ev: DataFrame) -> DataFrame:
    return _select(ev, submission_columns(SPARK))


def lightcurves(ev: DataFrame) -> DataFrame:
    return _select(ev, lightcurve_columns(SPARK))


def history(ev: DataFrame) -> DataFrame:
    rows = _select(ev, history_columns(SPARK))
    micros = F.round((F.col("event_mjd") - 40587.0) * 86400000000.0).cast("long")
    return rows.withColumn("event_time", F.timestamp_micros(micros))


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _select(table(spark, sf_dir, "customer"), outbox_columns(SPARK))

    def banded(prefix: str):
        items = F.array(*[F.struct(F.lit(b).alias("k"), F.col(f"{prefix}_{b}").alias("v")) for b in OUTBOX_BANDS])
        return F.map_from_entries(F.filter(items, lambda e: e["v"].isNotNull()))

    return rows.withColumns({"latest_mags": banded("mag"), "latest_mjd": banded("mjd")}).drop(
        *[f"{p}_{b}" for p in ("mag", "mjd") for b in OUTBOX_BANDS]
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "customer"), target_columns(SPARK))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "orders"), response_columns(SPARK))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with ids as an array and a payload: one object, or for two ids an array of two."""
    rows = _select(table(spark, sf_dir, "orders"), request_columns(SPARK))

    def item(object_id: str):
        name = F.concat(F.lit('{"name": "SKY24'), F.col(object_id).cast("string"), F.lit('"'))
        mag = F.when(F.col("has_mag"), F.concat(F.lit(', "mag": '), F.col("mag_text"))).otherwise(F.lit(""))
        return F.concat(name, mag, F.lit("}"))

    pair = F.concat(F.lit("["), item("first_id"), F.lit(", "), item("second_id"), F.lit("]"))
    return rows.select(
        "log_id", F.timestamp_micros("request_us").alias("request_time"),
        F.filter(F.array("first_id", "second_id"), lambda x: x.isNotNull()).alias("object_ids"),
        "method", F.when(F.col("second_id").isNull(), item("first_id")).otherwise(pair).alias("payload"),
        "status_code", "outcome", "response_text",
    )


def galaxies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_users = table(spark, sf_dir, "events").agg(F.count_distinct("user_id").alias("n_users"))   # one row
    return _select(table(spark, sf_dir, "customer").withColumn("n_users", n_users.scalar()), galaxy_columns(SPARK))
