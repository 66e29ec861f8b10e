"""Common table expressions shared by the check queries (DuckDB). One plain row shape: bands are columns."""

from __future__ import annotations

import re

from skyflow.plans import adapters as A

D = A.DUCK
BANDS = A.CONTRACT_BANDS
R = "0.000277778::DOUBLE"
SPLIT = f"{A.BATCH_SPLIT_MJD}::DOUBLE"
NOW = f"{A.NOW_MJD}::DOUBLE"
CTES: dict[str, str] = {}


def sel(columns: dict[str, str], source: str, where: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source} {where}"


def hav(a: str, b: str) -> str:
    return (
        f"(pow(sin(radians({b}.dec - {a}.dec) / 2), 2) + cos(radians({a}.dec)) * cos(radians({b}.dec)) "
        f"* pow(sin(radians({b}.ra - {a}.ra) / 2), 2))"
    )


def near(a: str, b: str, r: str = R) -> str:
    return f"abs({a}.dec - {b}.dec) < {r} AND {hav(a, b)} < pow(sin(radians({r}) / 2), 2)"


def arcsec(h: str) -> str:
    return f"degrees(2 * asin(least(1.0::DOUBLE, sqrt({h})))) * 3600.0"


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` with every table expression it (transitively) names put in front."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql):
            if name in known and name not in order and name not in active:
                active.add(name)
                visit(known[name])
                active.discard(name)
                order.append(name)

    active: set[str] = set()
    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in order) + "\n" + body


def band_list(prefix: str, table: str = "") -> str:
    dot = f"{table}." if table else ""
    return ", ".join(f"{dot}{prefix}_{b}" for b in BANDS)


BAND_COLUMNS = ", ".join(band_list(p) for p in ("mag", "mjd", "n"))
CONTRACT = f"native_id, survey_id, pipeline_id, ra, dec, jdmin, jdmax, {BAND_COLUMNS}"

CTES["ev"] = sel(A.event_columns(D), "events")
CTES["lsst"] = sel(A.lsst_columns(D), "ev", "WHERE survey_id = 1")
CTES["ztf"] = sel(A.ztf_columns(D), "ev", "WHERE survey_id = 2")
CTES["ztf2"] = sel(A.ztf_two_band_columns(D), "ev", "WHERE survey_id = 2")


def _lsst_contract(source: str) -> str:
    cols = {
        "native_id": "CAST(diaObjectId AS VARCHAR)", "survey_id": "1", "pipeline_id": str(A.PIPELINE_LSST),
        "ra": "ra", "dec": "decl", "jdmin": "firstDiaSourceMjdTai", "jdmax": "lastDiaSourceMjdTai",
    }
    for b in BANDS:
        x, survey = b.split("_")
        usable = f"{x}_psfFlux > 0 AND {x}_latestMJD > 0"
        lsst = survey == "lsst"
        cols[f"mag_{b}"] = f"CASE WHEN {usable} THEN round(-2.5 * log10({x}_psfFlux) + 31.4::DOUBLE, 4) END" if lsst else "NULL::DOUBLE"
        cols[f"mjd_{b}"] = f"CASE WHEN {usable} THEN {x}_latestMJD END" if lsst else "NULL::DOUBLE"
        cols[f"n_{b}"] = f"coalesce(n{x}Sources, 0)" if lsst else "NULL::BIGINT"
    return sel({**cols, "event_id": "event_id"}, source)


def _ztf_contract(source: str, band: str, mag: str) -> str:
    cols = {
        "native_id": "objectId", "survey_id": "2", "pipeline_id": str(A.PIPELINE_ZTF), "ra": "ra", "dec": "decl",
        "jdmin": "first_jd - 2400000.5::DOUBLE", "jdmax": "latest_jd - 2400000.5::DOUBLE",
    }
    for b in BANDS:
        hit = f"{band} = '{b}' AND {mag} IS NOT NULL"
        ztf = b.endswith("_ztf")
        cols[f"mag_{b}"] = f"CASE WHEN {hit} THEN round({mag}, 4) END" if ztf else "NULL::DOUBLE"
        cols[f"mjd_{b}"] = f"CASE WHEN {hit} THEN latest_jd - 2400000.5::DOUBLE END" if ztf else "NULL::DOUBLE"
        cols[f"n_{b}"] = f"CASE WHEN {hit} THEN 1 END" if ztf else "NULL::BIGINT"
    return sel({**cols, "event_id": "event_id"}, source)


CTES["lsst_c"] = _lsst_contract("lsst")
CTES["ztf_c"] = _ztf_contract("ztf", "(latestFilter || '_ztf')", "latestMag")
CTES["ztf2_c"] = _ztf_contract("ztf2", "CASE WHEN gmag IS NOT NULL THEN 'g_ztf' ELSE 'r_ztf' END", "coalesce(gmag, rmag)")
CTES["alerts"] = "SELECT * FROM lsst_c UNION ALL SELECT * FROM ztf_c"
_VALID = f"ra >= 0 AND ra < 360 AND dec BETWEEN -90 AND 90 AND jdmax > 40000 AND jdmax <= {NOW} + 1"
CTES["valid"] = f"SELECT * FROM alerts WHERE {_VALID}"
CTES["staged"] = (
    "SELECT *, CAST(regexp_extract(native_id, '([0-9]+)$', 1) AS BIGINT) % 1000000000 + 1 AS object_id, "
    "event_id AS stage_row FROM valid"
)
CTES["early"] = f"SELECT * FROM staged WHERE jdmax < {SPLIT}"
CTES["late"] = f"SELECT * FROM staged WHERE jdmax >= {SPLIT}"
CTES["ordered"] = "SELECT *, row_number() OVER (ORDER BY jdmax DESC, event_id) - 1 AS stage_row FROM valid"


def newest(source: str) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY jdmax DESC, stage_row) = 1"
    )


OBJECT_COLUMNS = (
    "object_id, name, ra, dec, jdmin, jdmax, jd_obs_trigger, last_survey_id, active, sync_pending, updated_day, "
    + BAND_COLUMNS
)


def made_objects(source: str, active: str, pending: str) -> str:
    """Objects made from one row per object_id, before any merge."""
    return (
        f"SELECT object_id, 'SKY24x' || CAST(object_id AS VARCHAR) AS name, ra, dec, jdmin, jdmax, jdmax AS jd_obs_trigger, "
        f"survey_id AS last_survey_id, {active} AS active, {pending} AS sync_pending, '2024-01-16' AS updated_day, "
        f"{BAND_COLUMNS} FROM ({newest(source)})"
    )


CTES["objects0"] = made_objects("early", "object_id % 3 <> 0", "object_id % 2 = 0")


def merged(objects: str, staged: str, day: str) -> str:
    """Objects after a batch (object_id known), with what the batch did."""
    cols = []
    for b in BANDS:
        take = f"n.mjd_{b} IS NOT NULL AND (o.mjd_{b} IS NULL OR n.mjd_{b} > o.mjd_{b})"
        for prefix in ("mag", "mjd", "n"):
            cols.append(f"CASE WHEN {take} AND n.{prefix}_{b} IS NOT NULL THEN n.{prefix}_{b} ELSE o.{prefix}_{b} END AS {prefix}_{b}")
    newer = "coalesce(s.jdmax > o.jdmax, false)"
    return f"""
        SELECT o.object_id, o.name, o.ra, o.dec, least(o.jdmin, s.jdmin) AS jdmin, greatest(o.jdmax, s.jdmax) AS jdmax,
               o.jd_obs_trigger, CASE WHEN {newer} THEN n.survey_id ELSE o.last_survey_id END AS last_survey_id,
               o.active OR {newer} AS active, o.sync_pending OR ({newer} AND NOT o.active) AS sync_pending,
               CASE WHEN {newer} THEN '{day}' ELSE o.updated_day END AS updated_day, {', '.join(cols)},
               s.object_id IS NOT NULL AS touched, {newer} AS new_detection, o.active AS old_active,
               n.survey_id AS batch_survey_id, n.native_id AS batch_native_id
        FROM {objects} o
        LEFT JOIN (SELECT object_id, min(jdmin) AS jdmin, max(jdmax) AS jdmax FROM {staged} GROUP BY object_id) s
          ON s.object_id = o.object_id
        LEFT JOIN ({newest(staged)}) n ON n.object_id = o.object_id"""


CTES["changes"] = merged("objects0", "late", "2024-02-01")
CTES["nights_all"] = "SELECT DISTINCT survey_id, CAST(floor(jdmax - 0.5) AS INT) AS night FROM staged"


def aged(objects: str, nights: str, now: str, days: str, faint: str) -> str:
    mags = ", ".join(f"mag_{b}" for b in BANDS)
    brightest = f"least({mags})"
    age = (
        f"CASE WHEN o.last_survey_id IS NULL THEN {now} - o.jdmax ELSE (SELECT count(*) FROM {nights} k "
        f"WHERE k.survey_id = o.last_survey_id AND k.night > floor(o.jdmax - 0.5)) END"
    )
    return f"""
        SELECT * EXCLUDE (active, sync_pending), active AND reason IS NULL AS active,
               sync_pending OR reason IS NOT NULL AS sync_pending, reason AS deactivation_reason FROM (
            SELECT *, CASE WHEN active THEN CASE WHEN nights_since > {days} THEN 'stale_{float(days):g}d'
                           WHEN {brightest} > {faint} THEN 'faint_alert' END END AS reason
            FROM (SELECT o.*, CAST({age} AS DOUBLE) AS nights_since FROM {objects} o))"""


def name_sql(index: str) -> str:
    def letter(expr: str) -> str:
        return f"chr(CAST(97 + ({expr}) % 26 AS INT))"

    three = f"{letter(f'{index} // 676')} || {letter(f'{index} // 26')} || {letter(index)}"
    j = f"({index} - 17576)"
    four = f"{letter(f'{j} // 17576')} || {letter(f'{j} // 676')} || {letter(f'{j} // 26')} || {letter(j)}"
    k = f"({index} - 474552)"
    five = " || ".join(letter(f"{k} // {26 ** i}") for i in range(4, -1, -1))
    return f"CASE WHEN {index} < 17576 THEN {three} WHEN {index} < 474552 THEN {four} ELSE {five} END"


def resolve(prefix: str, stage: str, objects: str | None, next_id: str) -> dict[str, str]:
    """
    Two passes of match, lead, attach over `stage` (stage_row, ra, dec, ...). Enough wherever the rows of one
    place span less than three radii, as the derived alerts do. Ends in <prefix>_assign and <prefix>_lead.
    """
    p = prefix
    out: dict[str, str] = {}
    best = "QUALIFY row_number() OVER (PARTITION BY stage_row ORDER BY h, object_id) = 1"
    if objects:
        out[f"{p}_hit"] = (
            f"SELECT s.stage_row, o.object_id, {hav('s', 'o')} AS h FROM {stage} s JOIN {objects} o ON {near('s', 'o')} {best}"
        )
    else:
        out[f"{p}_hit"] = f"SELECT stage_row, 0::BIGINT AS object_id, 0.0::DOUBLE AS h FROM {stage} WHERE false"
    out[f"{p}_u1"] = f"SELECT stage_row, ra, dec FROM {stage} WHERE stage_row NOT IN (SELECT stage_row FROM {p}_hit)"
    for k in (1, 2):
        u = f"{p}_u{k}"
        out[f"{p}_b{k}"] = f"SELECT DISTINCT a.stage_row FROM {u} a JOIN {u} b ON {near('a', 'b')} AND b.stage_row < a.stage_row"
        start = next_id if k == 1 else f"(SELECT {next_id} + count(*) FROM {p}_l1)"
        out[f"{p}_l{k}"] = (
            f"SELECT stage_row AS leader_row, ra, dec, {start} + row_number() OVER (ORDER BY stage_row) - 1 AS object_id "
            f"FROM {u} WHERE stage_row NOT IN (SELECT stage_row FROM {p}_b{k})"
        )
        out[f"{p}_a{k}"] = (
            f"SELECT s.stage_row, o.object_id, {hav('s', 'o')} AS h FROM {u} s JOIN {p}_l{k} o ON {near('s', 'o')} {best}"
        )
        if k == 1:
            out[f"{p}_u2"] = f"SELECT * FROM {p}_u1 WHERE stage_row NOT IN (SELECT stage_row FROM {p}_a1)"
    out[f"{p}_assign"] = " UNION ALL ".join(
        f"SELECT stage_row, object_id, {n} AS match_pass FROM {p}_{t}" for n, t in ((0, "hit"), (1, "a1"), (2, "a2"))
    )
    out[f"{p}_lead"] = " UNION ALL ".join(
        f"SELECT leader_row AS stage_row, object_id, {k} AS match_pass FROM {p}_l{k}" for k in (1, 2)
    )
    return out


def ingest(prefix: str, contract: str, objects: str | None, day: str, now: str) -> dict[str, str]:
    """One survey batch: <prefix>_in (one row per id) -> <prefix>_stage, _lead, _at (staged), _new, _obj."""
    p = prefix
    valid = f"ra >= 0 AND ra < 360 AND dec BETWEEN -90 AND 90 AND jdmax > 40000 AND jdmax <= {now} + 1"
    out = {
        f"{p}_stage": f"SELECT *, row_number() OVER (ORDER BY jdmax DESC, native_id, survey_id) - 1 AS stage_row FROM {contract} WHERE {valid}"
    }
    next_id = f"(SELECT coalesce(max(object_id), 0) + 1 FROM {objects})" if objects else "1"
    out.update(resolve(p, f"{p}_stage", objects, next_id))
    out[f"{p}_at"] = f"SELECT s.*, a.object_id FROM {p}_stage s JOIN {p}_assign a ON a.stage_row = s.stage_row"
    out[f"{p}_new"] = (
        f"SELECT l.object_id, 'SKY24' || {name_sql('(l.object_id - 1)')} AS name, ra, dec, jdmin, jdmax, jdmax AS jd_obs_trigger, "
        f"survey_id AS last_survey_id, true AS active, true AS sync_pending, '{day}' AS updated_day, {BAND_COLUMNS} "
        f"FROM {p}_stage s JOIN {p}_lead l ON l.stage_row = s.stage_row"
    )
    before = f"{p}_new" if objects is None else f"(SELECT {OBJECT_COLUMNS} FROM {objects} UNION ALL SELECT {OBJECT_COLUMNS} FROM {p}_new)"
    out[f"{p}_chg"] = merged(before, f"{p}_at", day)
    out[f"{p}_obj"] = f"SELECT {OBJECT_COLUMNS} FROM {p}_chg"
    return out


def latest_input(name: str, contract: str, where: str, tie: str = "event_id DESC") -> dict[str, str]:
    return {name: f"SELECT * FROM {contract} WHERE {where} QUALIFY row_number() OVER (PARTITION BY native_id ORDER BY jdmax DESC, {tie}) = 1"}


def full_run(p: str = "", contracts: tuple[str, str] = ("lsst_c", "ztf_c"), tie: str = "event_id DESC") -> dict[str, str]:
    """Both runs: survey 1, survey 2, ageing; then the late alerts the same way. All names begin with `p`."""
    now_a, now_b = "60325.0::DOUBLE", "60341.0::DOUBLE"
    x: dict[str, str] = {}
    # The split is made on the event's own date, before a survey rounds it to JD.
    for tag, cmp in (("a", "<"), ("b", ">=")):
        x[f"{p}ev_{tag}"] = f"SELECT event_id FROM ev WHERE mjd {cmp} {SPLIT}"
        for survey, contract in zip(("lsst", "ztf"), contracts):
            x.update(latest_input(f"{p}in_{survey}_{tag}", contract, f"event_id IN (SELECT event_id FROM {p}ev_{tag})", tie))

    def nights(one: str, two: str) -> str:
        return f"SELECT DISTINCT survey_id, CAST(floor(jdmax - 0.5) AS INT) AS night FROM (SELECT survey_id, jdmax FROM {one} UNION ALL SELECT survey_id, jdmax FROM {two})"

    x.update(ingest(f"{p}i1", f"{p}in_lsst_a", None, "2024-01-16", now_a))
    x.update(ingest(f"{p}i2", f"{p}in_ztf_a", f"{p}i1_obj", "2024-01-16", now_a))
    x[f"{p}nights_a"] = nights(f"{p}i1_at", f"{p}i2_at")
    x[f"{p}aged_a"] = aged(f"{p}i2_obj", f"{p}nights_a", now_a, "10", "22.5")
    x[f"{p}state_a"] = f"SELECT {OBJECT_COLUMNS} FROM {p}aged_a"
    x.update(ingest(f"{p}i3", f"{p}in_lsst_b", f"{p}state_a", "2024-02-01", now_b))
    x.update(ingest(f"{p}i4", f"{p}in_ztf_b", f"{p}i3_obj", "2024-02-01", now_b))
    x[f"{p}nights_b"] = nights(f"{p}i3_at", f"{p}i4_at") + f" UNION SELECT * FROM {p}nights_a"
    x[f"{p}aged_b"] = aged(f"{p}i4_obj", f"{p}nights_b", now_b, "10", "22.5")
    return x


FULL = full_run()
# The same from messages: error events are broken there, and no event id tells equal dates apart.
CTES["lsst_m"] = "SELECT c.* FROM lsst_c c JOIN ev e ON e.event_id = c.event_id WHERE e.k >= 0"
CTES["ztf_m"] = "SELECT c.* FROM ztf_c c JOIN ev e ON e.event_id = c.event_id WHERE e.k >= 0"
FROM_MESSAGES = full_run("m", ("lsst_m", "ztf_m"), "ra DESC")

_OUT = A.outbox_columns(D)
CTES["ob"] = sel(_OUT, "customer")
CTES["ob_det"] = f"""
    SELECT object_id, band, mag, mjd FROM (
        SELECT object_id, 'g_lsst' AS band, mag_g_lsst AS mag, mjd_g_lsst AS mjd FROM ob
        UNION ALL SELECT object_id, 'r_ztf', mag_r_ztf, mjd_r_ztf FROM ob)
    WHERE mag BETWEEN 3 AND 50 AND mjd > 0
    QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY mjd DESC, mag, band DESC) = 1"""
CTES["tg"] = sel(A.target_columns(D), "customer")
CTES["resp"] = sel(A.response_columns(D), "orders")
CTES["req0"] = sel(A.request_columns(D), "orders")
CTES["req"] = "SELECT *, make_timestamp(request_us) AS request_time FROM req0"
CTES["hist0"] = sel(A.history_columns(D), "ev")
CTES["hist"] = "SELECT *, make_timestamp(CAST(round((event_mjd - 40587.0::DOUBLE) * 86400000000.0::DOUBLE) AS BIGINT)) AS event_time FROM hist0"
CTES["lc"] = sel(A.lightcurve_columns(D), "ev")
CTES["sub"] = sel(A.submission_columns(D), "ev")
CTES["gal"] = sel(A.galaxy_columns(D), "(SELECT *, (SELECT count(DISTINCT user_id) FROM events) AS n_users FROM customer)")
CTES["assoc"] = (
    "SELECT object_id * 10 + r AS association_id, object_id, object_id * 3 % 1000 + r AS host_id, CAST(r AS INT) AS rank, "
    "10 AS pipeline_id, object_id % 5 = 0 AS active, false AS sync_pending "
    "FROM ob, (VALUES (1), (2), (3)) t(r) WHERE r <= object_id % 4"
)
_OPEN = "(sync_state IS NULL OR sync_state = 'not_submittable')"
CTES["tried"] = f"SELECT * FROM ob WHERE sync_pending AND active AND facility_id IS NULL AND {_OPEN}"
CTES["refusals"] = """
    SELECT o.object_id, CASE WHEN o.dec > 40 THEN 'dec beyond the northern limit' WHEN o.dec < -89.99999999 THEN 'dec beyond the southern limit'
                             WHEN d.band IS NULL THEN 'no detection that can be sent' END AS refusal
    FROM ob o LEFT JOIN ob_det d ON d.object_id = o.object_id"""
CTES["ready"] = """
    SELECT t.object_id, t.name, round(d.mag, 3) AS mag, (row_number() OVER (ORDER BY t.object_id) - 1) // 50 AS batch_id
    FROM tried t JOIN ob_det d ON d.object_id = t.object_id JOIN refusals r ON r.object_id = t.object_id
    WHERE r.refusal IS NULL"""
CTES["ready_out"] = """
    SELECT *, CASE batch_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'rejected' WHEN 2 THEN 'ambiguous' WHEN 3 THEN 'retry'
                                WHEN 4 THEN 'ambiguous' WHEN 5 THEN 'ambiguous' ELSE 'ok' END AS outcome,
           CASE WHEN batch_id % 7 IN (0, 6) AND object_id % 10 <> 3 THEN object_id + 800000 END AS item_id
    FROM ready"""
