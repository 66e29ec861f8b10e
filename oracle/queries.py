"""The check query (DuckDB SQL) of every registered query that SQL can express."""

from __future__ import annotations

from skyflow.plans import adapters as A

from .base import BAND_COLUMNS, CONTRACT, D, FROM_MESSAGES, FULL, NOW, OBJECT_COLUMNS, R, aged, arcsec, band_list, hav, ingest, latest_input
from .base import made_objects, merged, name_sql, near, newest, resolve, with_ctes

SQL: dict[str, str] = {}


def add(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    SQL[name] = with_ctes(body, extra)


_LSST_FIELDS = [c for c in A.lsst_columns(D) if c != "event_id"]
_MESSAGE_KIND = A.message_columns(D)["kind"]
_NO_DAY = OBJECT_COLUMNS.replace("updated_day, ", "")
_LOG_NOW = "TIMESTAMP '1998-08-01'"

# ---------------------------------------------------------------- sources and sinks

_ZTF_FIELDS = [c for c in A.ztf_columns(D) if c != "event_id"]
_ALL_FIELDS = [*_LSST_FIELDS, *[c for c in _ZTF_FIELDS if c not in _LSST_FIELDS]]
add("src_alert_json", " UNION ALL ".join(
    f"SELECT {', '.join(('l.' + c if c in fields else 'NULL') + ' AS ' + c for c in _ALL_FIELDS)}, '{survey}' AS survey FROM {survey} l JOIN ev e ON e.event_id = l.event_id WHERE e.k >= 0"
    for survey, fields in (("lsst", _LSST_FIELDS), ("ztf", _ZTF_FIELDS))))
_SKIPPED = {"skipped": f"""
    SELECT event_id, survey_id, mjd, CASE kind WHEN 'cut' THEN 'not JSON' WHEN 'array' THEN 'not an object' ELSE CASE survey_id WHEN 1 THEN 'no diaObjectId' ELSE 'no objectId' END END AS skip_reason
    FROM (SELECT event_id, survey_id, mjd, {_MESSAGE_KIND} AS kind FROM ev) WHERE kind <> 'ok'"""}
add("src_skip_malformed", "SELECT event_id, skip_reason FROM skipped", _SKIPPED)
add("src_bounded_batch", "SELECT CASE survey_id WHEN 1 THEN 'lsst' ELSE 'ztf' END AS survey, count(*) AS accepted, 4 AS batches FROM ev WHERE k >= 0 GROUP BY survey_id")
add("src_bounded_accepted", """
    SELECT CASE survey_id WHEN 1 THEN 'lsst' ELSE 'ztf' END AS survey, b AS batch_id, least(n, (b + 1) * bound) - b * bound AS accepted, b * bound AS first,
           least(n, (b + 1) * bound) - 1 AS last
    FROM (SELECT survey_id, count(*) AS n, count(*) // 3 + 1 AS bound FROM ev WHERE k >= 0 GROUP BY survey_id), (VALUES (0), (1), (2)) t(b)""")
_STREAM = {
    **latest_input("in_all_lsst", "lsst_m", "true", "ra DESC"), **latest_input("in_all_ztf", "ztf_m", "true", "ra DESC"),
    **ingest("s1", "in_all_lsst", None, "2024-02-01", "60341.0::DOUBLE"), **ingest("s2", "in_all_ztf", "s1_obj", "2024-02-01", "60341.0::DOUBLE"),
}
for _name in ("stream_ingest", "sink_commit_after_state"):
    add(_name, f"SELECT {_NO_DAY} FROM s2_obj", _STREAM)
add("stream_run", f"SELECT {OBJECT_COLUMNS} FROM maged_b", FROM_MESSAGES)
_PARTS = [("lsst", 0, "mi1", "min_lsst_a"), ("ztf", 0, "mi2", "min_ztf_a"), ("lsst", 1, "mi3", "min_lsst_b"), ("ztf", 1, "mi4", "min_ztf_b")]
add("stream_rejects", """
    SELECT CASE survey_id WHEN 1 THEN 'lsst' ELSE 'ztf' END AS stream, 'skipped' AS stage, skip_reason AS reason, count(*) AS n FROM skipped GROUP BY ALL
    UNION ALL SELECT stream, 'rejected', reason, count(*) FROM (""" + " UNION ALL ".join(
        f"SELECT '{stream}' AS stream, CASE WHEN ra >= 0 AND ra < 360 AND dec BETWEEN -90 AND 90 THEN 'other' ELSE 'position outside the sky' END AS reason "
        f"FROM {given} WHERE native_id NOT IN (SELECT native_id FROM {p}_stage)" for stream, _, p, given in _PARTS) + ") GROUP BY ALL",
    {**FROM_MESSAGES, **_SKIPPED})


def _half(batch: int) -> str:
    return f"mjd {'<' if batch == 0 else '>='} {A.BATCH_SPLIT_MJD}::DOUBLE"


add("stream_report", " UNION ALL ".join(f"""
    SELECT '{stream}' AS stream, {batch} AS batch_id, m.n AS messages, m.bad AS skipped, g.n AS alerts, g.n - s.n AS rejected, s.n AS staged,
           (SELECT count(*) FROM {p}_new) AS created, (SELECT count(*) FROM {p}_chg WHERE touched AND object_id NOT IN (SELECT object_id FROM {p}_new)) AS updated, m.n AS input_rows
    FROM (SELECT count(*) AS n, count_if(k < 0) AS bad FROM ev WHERE survey_id = {1 if stream == 'lsst' else 2} AND {_half(batch)}) m,
         (SELECT count(*) AS n FROM {given}) g, (SELECT count(*) AS n FROM {p}_stage) s""" for stream, batch, p, given in _PARTS), FROM_MESSAGES)
add("multi_survey_ingest", f"SELECT {OBJECT_COLUMNS} FROM aged_b", FULL)
add("stage_contract", f"SELECT stage_row, {CONTRACT} FROM ordered")
_SUB_OK = f"""
    native_id IS NOT NULL AND isfinite(ra) AND isfinite(dec) AND isfinite(jdmax) AND survey_id IS NOT NULL AND pipeline_id IS NOT NULL
    AND ra >= 0 AND ra < 360 AND dec BETWEEN -90 AND 90 AND jdmax > 40000 AND jdmax <= {NOW} + 1
    AND event_id % 37 NOT IN (16, 17, 18, 19, 22, 24, 25)"""
add("src_manual_submission", f"""
    SELECT 'manual_submission' AS event_type, survey_id, native_id AS survey_object_id, pipeline_id, 'observer' AS submitted_by,
           TRY_CAST(json_extract_string(latest_mag, '$.r_lsst') AS DOUBLE) AS mag
    FROM sub WHERE {_SUB_OK} QUALIFY row_number() OVER (PARTITION BY native_id ORDER BY jdmax DESC, event_id DESC) = 1""")
add("src_id_list", "SELECT DISTINCT objectId FROM ztf")
add("sink_append_history", """
    SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, 'v1' AS code_version, 'r1' AS run_id, count(*) AS n,
           min(id) AS first_id, max(id) AS last_id
    FROM (SELECT *, row_number() OVER (ORDER BY event_time, object_id, survey_id, survey_object_id, pipeline_id) AS id FROM hist)
    GROUP BY 1""")
add("sink_state_snapshot", f"SELECT {OBJECT_COLUMNS} FROM changes")
_STRIP = {"late_strip": "SELECT * FROM late WHERE dec BETWEEN -10 AND 10"}
add("state_bucket_merge", f"SELECT {OBJECT_COLUMNS} FROM strip_changes", {**_STRIP, "strip_changes": merged("objects0", "late_strip", "2024-02-01")})
add("src_facility_targets", "SELECT id, name, ra, dec, subsurvey, mag, is_active, date_submitted, date_ingested, ostd_targ_id FROM tg "
    "UNION ALL SELECT id, name, ra, dec, subsurvey, mag, is_active, date_submitted, date_ingested, ostd_targ_id FROM tg WHERE id IS NULL")
_SURVEYS = "(VALUES ('LSST', 1), ('ZTF', 2), ('LS4', 3), ('FACILITY', 4), ('ATLAS', 5), ('GOTO', 6), ('HSC', 7), ('BlackGEM', 8), ('TNS', 9)) s(survey_name, survey_id)"
add("dim_surveys", f"""
    SELECT survey_name, survey_id FROM {_SURVEYS}
    UNION ALL SELECT DISTINCT 'NETWORK' || CAST(s_nationkey AS VARCHAR), s_nationkey FROM supplier
    WHERE s_nationkey NOT IN (SELECT survey_id FROM {_SURVEYS})""")
_PIPES = """(VALUES (1, 'lsst-default'), (2, 'ztf-default'), (3, 'ls4-default'), (4, 'facility-default'), (5, 'atlas-default'), (6, 'goto-default'),
    (7, 'hsc-default'), (8, 'blackgem-default'), (9, 'tns-default'), (10, 'host'), (11, 'manual')) p(pipeline_id, pipeline_name)"""
add("dim_selection_versions", f"""
    SELECT pipeline_id, pipeline_name, 'v1.0' AS version FROM {_PIPES}
    UNION ALL SELECT 11 + row_number() OVER (ORDER BY pipeline_name, version), pipeline_name, version FROM (
        SELECT DISTINCT CASE survey_id WHEN 1 THEN 'lsst-default' ELSE 'ztf-default' END AS pipeline_name,
               'v1.' || CAST(CAST(floor(mjd) AS BIGINT) % 3 AS VARCHAR) AS version FROM ev) WHERE version <> 'v1.0'""")

# ---------------------------------------------------------------- projections, filters, predicates

for _name, _cte in (("normalize_lsst", "lsst_c"), ("normalize_ztf", "ztf_c"), ("normalize_ztf_two_bands", "ztf2_c")):
    add(_name, f"SELECT {CONTRACT}, event_id FROM {_cte}")
add("validate_alerts", f"""
    SELECT event_id, native_id, ra, dec, jdmin, jdmax,
           TRY_CAST(json_extract_string(latest_filter, '$.r_lsst') AS DOUBLE) AS latest_filter,
           TRY_CAST(json_extract_string(latest_mag, '$.r_lsst') AS DOUBLE) AS latest_mag,
           TRY_CAST(json_extract_string(n_sources, '$.r_lsst') AS BIGINT) AS n_sources
    FROM sub WHERE {_SUB_OK}""")
_PROBLEM = [("native_id IS NULL", "native id missing")]
for _c in ("ra", "dec", "jdmax"):
    _PROBLEM.append((f"{_c} IS NULL OR NOT isfinite({_c})", f"{_c} is no finite number"))
for _c in ("survey_id", "pipeline_id"):
    _PROBLEM.append((f"{_c} IS NULL", f"{_c} is no finite number"))
_PROBLEM.append(("NOT (ra >= 0 AND ra < 360 AND dec BETWEEN -90 AND 90)", "position outside the sky"))
_PROBLEM.append((f"NOT (jdmax > 40000 AND jdmax <= {NOW} + 1)", "jdmax lies outside the accepted dates"))
for _c in ("latest_filter", "latest_mag", "n_sources"):
    _PROBLEM.append((f"{_c} IS NULL OR NOT json_valid({_c})", f"{_c} cannot be read as JSON"))
    _PROBLEM.append((
        f"json_type({_c}) <> 'OBJECT' OR coalesce(len(list_filter(json_keys({_c}), lambda k: TRY_CAST(json_extract_string({_c}, '$.' || k) AS DOUBLE) IS NULL)), 0) > 0",
        f"{_c} holds values that are no finite numbers"))
_REASON = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in _PROBLEM) + " END"
add("alert_rejects", f"SELECT event_id, reject_reason FROM (SELECT event_id, {_REASON} AS reject_reason FROM sub) WHERE reject_reason IS NOT NULL")
_SEL = {"latest_lsst": "SELECT * FROM lsst QUALIFY row_number() OVER (PARTITION BY diaObjectId ORDER BY lastDiaSourceMjdTai DESC, event_id DESC) = 1"}
_BRIGHT = " OR ".join(f"({b}_psfFlux > 3630.78 AND {b}_psfFluxSigma <> 0 AND {b}_psfFlux / {b}_psfFluxSigma >= 3)" for b in A.BANDS)
_COUNT = " + ".join(f"CASE WHEN n{b}Sources >= 1 THEN 1 ELSE 0 END" for b in A.BANDS)
add("selection_function", f"""
    SELECT {', '.join(c for c in _LSST_FIELDS)} FROM latest_lsst
    WHERE nPosDiaSourcesNights >= 2 AND {_COUNT} >= 3 AND ({_BRIGHT})
      AND sherlock_classifications IN ('SN', 'NT', 'ORPHAN', 'UNCLEAR')""", _SEL)
_OFF = "SELECT object_id, active, sync_pending, deactivation_reason, nights_since FROM off WHERE deactivation_reason IS NOT NULL"
add("deactivate_stale", _OFF, {"off": aged("objects0", "nights_all", NOW, "15", "99")})
add("deactivate_faint", _OFF, {"off": aged("objects0", "nights_all", NOW, "1000", "22.5")})
_OPEN = "(sync_state IS NULL OR sync_state = 'not_submittable')"
add("outbox_clear_unregistered", f"SELECT object_id, sync_pending AND NOT (NOT active AND facility_id IS NULL AND {_OPEN}) AS sync_pending FROM ob")
add("outbox_new_targets", "SELECT object_id, name FROM tried")
add("outbox_active_changes", """
    SELECT object_id, facility_id, '{"is_active":' || CASE WHEN active THEN 'true' ELSE 'false' END || '}' AS payload
    FROM ob WHERE sync_pending AND facility_id IS NOT NULL AND sync_state IS NULL""")
_REJECTED = {
    "refused": f"SELECT * FROM req WHERE method = 'PATCH' AND outcome = 'rejected' AND request_time > {_LOG_NOW} - INTERVAL 7 DAY "
               "AND has_mag AND second_id IS NULL",
    "refused_ids": "SELECT first_id AS object_id FROM refused UNION SELECT second_id FROM refused WHERE second_id IS NOT NULL",
}
_DUE = """
    SELECT o.object_id, o.facility_id, round(d.mag, 3) AS mag,
           CASE d.band WHEN 'g_lsst' THEN 'LSST_g_AB' WHEN 'r_ztf' THEN 'SDSS_r_AB' END AS mag_type
    FROM ob o JOIN ob_det d ON d.object_id = o.object_id
    WHERE o.active AND o.facility_id IS NOT NULL AND o.sync_state IS NULL AND (o.facility_mag IS NULL OR o.facility_mag > 15)
      AND EXISTS (SELECT 1 FROM (VALUES (18.0), (17.0), (16.0), (15.0)) m(s) WHERE d.mag <= m.s AND m.s < coalesce(o.facility_mag, 99))
      AND o.object_id NOT IN (SELECT object_id FROM refused_ids)"""
add("outbox_mag_milestones", _DUE, _REJECTED)
add("build_target_payload", """
    SELECT o.object_id, r.refusal,
           CASE WHEN r.refusal IS NULL THEN o.name END AS name,
           CASE WHEN r.refusal IS NULL THEN least(CASE WHEN o.ra < 0 THEN o.ra + 360.0::DOUBLE WHEN o.ra >= 360 THEN o.ra - 360.0::DOUBLE ELSE o.ra END, 359.99999999::DOUBLE) END AS ra,
           CASE WHEN r.refusal IS NULL THEN o.dec END AS dec,
           CASE WHEN r.refusal IS NULL THEN round(d.mag, 3) END AS mag,
           CASE WHEN r.refusal IS NULL THEN CASE d.band WHEN 'g_lsst' THEN 'LSST_g_AB' ELSE 'SDSS_r_AB' END END AS mag_type,
           CASE WHEN r.refusal IS NULL THEN true END AS is_active,
           CASE WHEN r.refusal IS NULL THEN 1048576 END AS cadence,
           CASE WHEN r.refusal IS NULL THEN 2000 END AS epoch,
           CASE WHEN r.refusal IS NULL THEN 4300.0::DOUBLE END AS t_exp_b,
           CASE WHEN r.refusal IS NULL THEN 'TRA' END AS classification,
           CASE WHEN r.refusal IS NULL THEN 'sky-sn' END AS subsurvey
    FROM ob o JOIN refusals r ON r.object_id = o.object_id LEFT JOIN ob_det d ON d.object_id = o.object_id""")
add("latest_detection", "SELECT o.object_id, d.band, d.mag, d.mjd FROM ob o LEFT JOIN ob_det d ON d.object_id = o.object_id")
add("host_queue_rule", f"""
    SELECT association_id, object_id, wanted AS active, active <> wanted AS sync_pending FROM (
        SELECT a.*, NOT o.active AND ({NOW} - o.jdmax > 50 OR (least(o.mag_g_lsst, o.mag_u_lsst) > 24 AND
               (o.mag_g_lsst IS NOT NULL OR o.mag_u_lsst IS NOT NULL))) IS TRUE AS wanted
        FROM assoc a JOIN ob o ON o.object_id = a.object_id)""")
add("admin_select", "SELECT object_id, facility_id, name FROM ob WHERE active AND sync_attempts > 0 AND dec < 0")
add("admin_select_by_date", "SELECT name, id, date_submitted FROM tg WHERE CAST(date_submitted AS TIMESTAMP) >= TIMESTAMP '2024-04-15 12:00:00'")
add("facility_target_scope", "SELECT name, id, subsurvey FROM tg WHERE subsurvey = 'sky-sn'")

# ---------------------------------------------------------------- joins

add("sky_match_nearest", f"""
    SELECT stage_row, object_id, round({arcsec('h')}, 6) AS separation_arcsec FROM (
        SELECT s.stage_row, o.object_id, {hav('s', 'o')} AS h FROM staged s JOIN objects0 o ON {near('s', 'o')})
    QUALIFY row_number() OVER (PARTITION BY stage_row ORDER BY h, object_id) = 1""")
add("sky_new_leaders", f"""
    SELECT stage_row FROM ordered WHERE stage_row NOT IN (
        SELECT a.stage_row FROM ordered a JOIN ordered b ON {near('a', 'b')} AND b.stage_row < a.stage_row)""")
_RESOLVED = resolve("r", "ordered", None, "1")
add("sky_resolve_batch", "SELECT stage_row, object_id, match_pass FROM r_assign", _RESOLVED)
add("accumulate_new_rows", "SELECT stage_row, object_id, match_pass FROM r_lead", _RESOLVED)
add("update_join", "SELECT object_id, old_active, active, new_detection, batch_survey_id, batch_native_id FROM changes WHERE touched")
add("nights_since_detection", f"""
    SELECT o.object_id, o.last_survey_id, CASE WHEN o.last_survey_id IS NULL THEN {NOW} - o.jdmax ELSE CAST((
               SELECT count(*) FROM nights_all k WHERE k.survey_id = o.last_survey_id AND k.night > floor(o.jdmax - 0.5)) AS DOUBLE) END AS nights_since
    FROM (SELECT object_id, jdmax, CASE WHEN object_id % 7 <> 0 THEN last_survey_id END AS last_survey_id FROM objects0) o""")
add("selection_join", "SELECT diaObjectId, latest_psfFlux, g_psfFluxSigma, z_psfFluxSigma, sherlock_classifications FROM latest_lsst", _SEL)


def _lightcurve(source: str) -> str:
    sig = "(fid IN (1, 2, 3) AND 1.09 / sigmapsf >= 5) IS TRUE"
    return f"""
        SELECT objectId, coalesce(count(DISTINCT fid) FILTER ({sig}) >= 3 AND count(DISTINCT nid) FILTER ({sig}) >= 2
                                  AND min(magpsf) <= 22.5, false) AS passed FROM {source} GROUP BY objectId"""


add("attach_selection_result", "SELECT l.objectId, l.jd, t.passed FROM lc l LEFT JOIN tested t ON t.objectId = l.objectId",
    {"tested": _lightcurve("(SELECT * FROM lc WHERE sigmapsf IS NOT NULL)")})
add("recent_rejection_anti_join", "SELECT object_id FROM ob WHERE object_id NOT IN (SELECT object_id FROM refused_ids)", _REJECTED)
add("history_joins", f"""
    SELECT h.event_id, o.name, p.pipeline_name, 'v1.0' AS version, h.event_type
    FROM hist h JOIN ob o ON o.object_id = h.object_id JOIN {_PIPES} ON p.pipeline_id = h.pipeline_id""")
add("apply_create_responses", "SELECT batch_id, object_id, outcome, item_id FROM ready_out")
_LOOKUP = {"verdicts": """
    SELECT object_id, CASE object_id % 6 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS n_found,
           CASE WHEN object_id % 6 IN (4, 5) THEN 'foreign' WHEN object_id % 6 = 0 THEN 'resend'
                WHEN object_id % 6 = 1 AND object_id % 11 <> 5 THEN 'adopt' ELSE 'conflict' END AS verdict
    FROM ob WHERE sync_state = 'ambiguous'"""}
add("reconcile_by_lookup", "SELECT object_id, verdict, n_found FROM verdicts", _LOOKUP)
add("ingestion_merge", """
    SELECT o.object_id, o.facility_id, t.ostd_targ_id, CASE WHEN t.id IS NOT NULL THEN t.ostd_u_obj_id END AS ostd_u_obj_id,
           CASE WHEN t.id IS NULL THEN '2024-01-01 00:00:00'
                ELSE strftime(TRY_CAST(t.date_ingested AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS date_ingested
    FROM ob o LEFT JOIN (SELECT * FROM tg WHERE id IS NOT NULL AND ostd_targ_id IS NOT NULL) t ON t.id = o.facility_id""")
add("admin_apply", """
    SELECT object_id, active AND NOT hit1 AND NOT hit2 AS active, sync_pending AND NOT hit1 AND NOT hit2 AS sync_pending,
           CASE WHEN NOT (hit2 OR (hit1 AND c % 5 = 3)) THEN facility_id END AS facility_id,
           CASE WHEN hit2 THEN '2024-02-02' WHEN hit1 THEN '2024-02-01' ELSE '2024-01-01' END AS updated_day
    FROM (SELECT o.*, t.c_custkey AS c,
                 coalesce(t.id = o.facility_id AND t.is_active AND t.c_custkey % 5 <> 4, false) AS hit1,
                 NOT t.is_active AND t.c_custkey % 5 NOT IN (1, 4) AS hit2
          FROM ob o JOIN tg t ON t.c_custkey = o.object_id)""")
add("semi_join_changed", """
    SELECT object_id, name FROM objects0 WHERE object_id IN (SELECT object_id FROM late)
       OR object_id IN (SELECT object_id FROM off WHERE deactivation_reason IS NOT NULL)""",
    {"off": aged("objects0", "nights_all", NOW, "15", "22.5")})
add("unmatched_hosts", "SELECT object_id, name FROM ob WHERE active AND object_id NOT IN (SELECT object_id FROM assoc)")
_HOST_R = "(10.0::DOUBLE / 3600.0)"
add("host_crossmatch", f"""
    SELECT object_id, host_name, round({arcsec('h')}, 6) AS separation_arcsec, CAST(rank AS INT) AS rank FROM (
        SELECT object_id, host_name, h, row_number() OVER (PARTITION BY object_id ORDER BY h, host_name) AS rank FROM (
            SELECT o.object_id, g.host_name, {hav('o', 'g')} AS h FROM objects0 o JOIN gal g ON g.object_type = 'galaxy' AND {near('o', 'g', _HOST_R)}))
    WHERE rank <= 3""")
add("host_catalog_insert", """
    SELECT CAST(substr(host_name, 4) AS BIGINT) AS host_id, host_name, mag FROM gal WHERE object_type = 'star'
    UNION ALL SELECT 1000000000 + row_number() OVER (ORDER BY host_name) - 1, host_name, mag FROM gal WHERE object_type <> 'star'""")
add("host_report_join", """
    SELECT a.association_id, a.object_id, a.rank, a.active, o.name AS object_name, 'GAL' || CAST(c.c_custkey AS VARCHAR) AS host_name
    FROM assoc a JOIN ob o ON o.object_id = a.object_id JOIN customer c ON c.c_custkey = a.host_id""")

# ---------------------------------------------------------------- aggregations

_TWO = {"first": f"SELECT * FROM staged WHERE jdmax < {A.FIRST_SPLIT_MJD}::DOUBLE", "second": f"SELECT * FROM staged WHERE jdmax >= {A.FIRST_SPLIT_MJD}::DOUBLE"}
add("batch_span_per_object", "SELECT object_id, min(jdmin) AS jdmin, max(jdmax) AS jdmax FROM staged GROUP BY object_id")
add("survey_heartbeat", "SELECT survey_id, night FROM nights_all")
add("first_selections", """
    SELECT DISTINCT object_id, survey_id, pipeline_id FROM second
    EXCEPT SELECT object_id, survey_id, pipeline_id FROM first""", _TWO)
add("selection_counts", f"""
    SELECT p.pipeline_name, 'v1.0' AS version, s.survey_id, count(*) AS n,
           strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last
    FROM (SELECT object_id, survey_id, pipeline_id, min(event_time) AS t FROM hist GROUP BY 1, 2, 3) s
    JOIN {_PIPES} ON p.pipeline_id = s.pipeline_id GROUP BY 1, 3""")
add("multi_survey_objects", """
    SELECT object_id, array_to_string(list_sort(list(DISTINCT survey_id)), ',') AS surveys FROM hist WHERE event_type = 'alert'
    GROUP BY object_id HAVING count(DISTINCT survey_id) > 1""")
add("outbox_health", "SELECT coalesce(sync_state, 'normal') AS state, count(*) AS n FROM ob WHERE sync_pending OR sync_state IS NOT NULL GROUP BY 1")
add("request_outcomes_daily", f"""
    SELECT strftime(date_trunc('day', request_time), '%Y-%m-%d') AS day, method, outcome, count(*) AS n
    FROM req WHERE request_time > {_LOG_NOW} - INTERVAL 7 DAY GROUP BY 1, 2, 3""")
add("survey_clock_summary", """
    SELECT survey_id, CAST(DATE '1858-11-17' + max(night) AS VARCHAR) AS last_night, count(*) AS nights FROM nights_all GROUP BY survey_id""")
add("lightcurve_select", """
    SELECT n.objectId, coalesce(t.passed, false) AS passed
    FROM (SELECT 'ZTF' || CAST(c_custkey AS VARCHAR) AS objectId FROM customer UNION SELECT objectId FROM lc) n LEFT JOIN tested t ON t.objectId = n.objectId""",
    {"tested": _lightcurve("lc")})
add("active_counts", "SELECT active, count(*) AS n FROM ob GROUP BY active")
add("incremental_watermark", """
    SELECT 'incremental' AS run, strftime(max(TRY_CAST(date_ingested AS TIMESTAMP)) - INTERVAL 3 DAY, '%Y-%m-%dT%H:%M:%S.%fZ') AS since FROM tg
    UNION ALL SELECT 'empty', '2024-01-01T00:00:00.000000Z' UNION ALL SELECT 'forced', '2024-01-01T00:00:00.000000Z'""")
add("run_report", f"""
    SELECT 'new' AS section, {' + '.join(f"(SELECT count(*) FROM i{i}_new)" for i in (1, 2, 3, 4))} AS n
    UNION ALL SELECT 'updated', {' + '.join(
        f"(SELECT count(*) FROM i{i}_chg WHERE touched AND object_id NOT IN (SELECT object_id FROM i{i}_new))" for i in (2, 3, 4))}
    UNION ALL SELECT 'deactivated', (SELECT count(*) FROM aged_a WHERE deactivation_reason IS NOT NULL)
        + (SELECT count(*) FROM aged_b WHERE deactivation_reason IS NOT NULL)""", FULL)
add("event_span", "SELECT strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS n FROM hist")
add("band_map_build", " UNION ALL ".join(
    f"SELECT event_id, '{b}' AS band, {b}_psfFlux AS flux FROM lsst WHERE {b}_psfFlux IS NOT NULL" for b in A.BANDS))

# ---------------------------------------------------------------- top row per group, sequences

add("latest_alert_per_object", "SELECT diaObjectId, lastDiaSourceMjdTai, ra, decl, event_id FROM latest_lsst", _SEL)
add("newest_per_object", f"SELECT object_id, stage_row, survey_id, native_id, jdmax FROM ({newest('staged')})")
_NAMES = {f"names_{t}": f"SELECT object_id, survey_id, native_id FROM {t} QUALIFY row_number() OVER (PARTITION BY object_id, survey_id ORDER BY jdmax DESC, stage_row) = 1"
          for t in ("first", "second")}
add("native_names", """
    SELECT * FROM names_first UNION ALL SELECT l.* FROM names_second l
    WHERE NOT EXISTS (SELECT 1 FROM names_first e WHERE e.object_id = l.object_id AND e.survey_id = l.survey_id)""", {**_TWO, **_NAMES})
add("active_set_as_of", """
    SELECT object_id, event_type FROM (
        SELECT * FROM hist WHERE event_type IN ('created', 'activated', 'deactivated') AND event_time <= TIMESTAMP '2024-01-20 12:00:00'
        QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY event_time DESC, event_id DESC) = 1) WHERE event_type <> 'deactivated'""")
# The prefix rule as it is stated: for every detection date, do the rows up to it pass?
add("lightcurve_first_pass", """
    SELECT objectId, min(jd) AS first_pass_jd FROM (
        SELECT x.objectId, x.jd FROM (SELECT DISTINCT objectId, jd FROM lc WHERE candid IS NOT NULL) x JOIN lc p ON p.objectId = x.objectId AND p.jd <= x.jd
        GROUP BY x.objectId, x.jd
        HAVING count(DISTINCT CASE WHEN p.fid IN (1, 2, 3) AND 1.09 / p.sigmapsf >= 5 THEN p.fid END) >= 3
           AND count(DISTINCT CASE WHEN p.fid IN (1, 2, 3) AND 1.09 / p.sigmapsf >= 5 THEN p.nid END) >= 2 AND min(p.magpsf) <= 22.5)
    GROUP BY objectId""")
add("host_rank", """
    SELECT object_id, host_name, CAST(rank AS INT) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY mag, host_name) AS rank
        FROM (SELECT *, CAST(floor(ra / 10) AS BIGINT) AS object_id FROM gal)) WHERE rank <= 3""")
add("request_batches", "SELECT batch_id, count(*) AS n, min(object_id) AS first_id, max(object_id) AS last_id, count(*) AS n_items FROM ready GROUP BY batch_id")
add("assign_ids_names", f"""
    SELECT stage_row, n + 17571 AS object_id, 'SKY24' || {name_sql('(n + 17570)')} AS name FROM (
        SELECT stage_row, row_number() OVER (ORDER BY stage_row) - 1 AS n FROM ordered WHERE stage_row NOT IN (
            SELECT a.stage_row FROM ordered a JOIN ordered b ON {near('a', 'b')} AND b.stage_row < a.stage_row))""")

# ---------------------------------------------------------------- sorts, limits, sets

add("recent_requests", "SELECT log_id, method, status_code, outcome, response_text FROM req ORDER BY log_id DESC LIMIT 20")
add("recent_deactivations", """
    SELECT h.event_id, h.object_id, o.name, h.reason FROM hist h JOIN ob o ON o.object_id = h.object_id
    WHERE h.event_type = 'deactivated' ORDER BY h.event_time DESC, h.event_id DESC LIMIT 20""")
add("object_history", "SELECT event_id, event_type, reason, survey_id, survey_object_id, pipeline_id, submitted_by, details FROM hist WHERE object_id = 8 ORDER BY event_time, event_id")
_ITEM = "'{{\"name\": \"SKY24' || CAST({0} AS VARCHAR) || '\"' || CASE WHEN has_mag THEN ', \"mag\": ' || mag_text ELSE '' END || '}}'"
add("object_request_history", f"""
    SELECT log_id, method, outcome, CASE WHEN second_id IS NULL THEN {_ITEM.format('first_id')}
           ELSE '[' || {_ITEM.format('first_id')} || ', ' || {_ITEM.format('second_id')} || ']' END AS payload, response_text AS response
    FROM req WHERE first_id = 8 OR second_id = 8""")
add("needs_human", "SELECT object_id, name, sync_state, sync_attempts, sync_last_error FROM ob WHERE sync_state IN ('failed', 'conflict')")
add("insert_if_absent", """
    SELECT object_id, survey_id, 'old' AS origin FROM (SELECT DISTINCT object_id, survey_id FROM first)
    UNION ALL SELECT object_id, survey_id, 'new' FROM (SELECT DISTINCT object_id, survey_id FROM staged EXCEPT SELECT object_id, survey_id FROM first)""", _TWO)
add("updated_minus_new", "SELECT object_id, new_detection FROM changes WHERE touched AND object_id NOT IN (SELECT object_id FROM objects0 WHERE ra < 180)")
add("native_ids_of_object", "SELECT DISTINCT survey_id, survey_object_id FROM hist WHERE object_id = 8 AND event_type IN ('alert', 'manual_submission')")

# ---------------------------------------------------------------- scalar functions

add("scalar_flux_to_mag", "SELECT event_id, CASE WHEN k >= 0 THEN round(-2.5 * log10(flux) + 31.4::DOUBLE, 4) END AS mag FROM ev")
add("scalar_mjd_jd", """
    SELECT event_id, (mjd + 2400000.5::DOUBLE) - 2400000.5::DOUBLE AS mjd, CASE WHEN k >= 0 THEN mjd + 2400000.5::DOUBLE ELSE 0.0 END AS jd FROM ev""")
add("scalar_observing_night", "SELECT event_id, CAST(floor(mjd - 0.5) AS INT) AS night FROM ev")
add("scalar_night_to_date", """
    SELECT event_id, CAST(DATE '1858-11-17' + CAST(floor(mjd - 0.5) AS INT) AS VARCHAR) AS night_date,
           round(round((mjd - 40587.0::DOUBLE) * 86400000000.0::DOUBLE) / 86400000000.0::DOUBLE + 40587.0::DOUBLE, 6) AS now_mjd FROM ev""")
add("scalar_angular_sep_arcsec", f"""
    SELECT a.event_id, round({arcsec(hav('a', 'b'))}, 5) AS sep
    FROM ev a JOIN (SELECT event_id, ra + value / 3600.0::DOUBLE AS ra, dec + 0.0001::DOUBLE AS dec FROM ev) b ON b.event_id = a.event_id""")
_TEXTS = "(VALUES (0, '1.5', 1.5), (1, '-3', -3), (2, '1e3', 1000), (3, 'NaN', NULL), (4, 'Infinity', NULL), (5, 'abc', NULL), (6, 'true', NULL), (7, '', NULL), (8, '21.5', 21.5)) t(i, txt, v)"
add("scalar_is_finite_number", f"SELECT event_id, v IS NOT NULL AS is_number, CAST(v AS DOUBLE) AS number FROM ev JOIN {_TEXTS} ON t.i = event_id % 9")
add("scalar_parse_band_map", """
    SELECT event_id, CASE WHEN json_valid(latest_mag) THEN TRY_CAST(json_extract_string(latest_mag, '$.r_lsst') AS DOUBLE) END AS r_lsst,
           CASE WHEN json_valid(latest_mag) THEN TRY_CAST(json_extract_string(latest_mag, '$.k') AS DOUBLE) END AS k,
           CASE WHEN json_valid(latest_mag) THEN len(json_keys(latest_mag)) ELSE 0 END AS n FROM sub""")
_STORED = {"g": ("20.0", "60320.0"), "r": ("21.0", "60312.0")}
add("scalar_merge_bands", "SELECT event_id, " + ", ".join(
    f"CASE WHEN mjd_{b} IS NOT NULL" + (f" AND mjd_{b} > {_STORED[b[0]][1]}" if b in ("g_lsst", "r_lsst") else "")
    + f" THEN mag_{b} ELSE {_STORED[b[0]][0] + '::DOUBLE' if b in ('g_lsst', 'r_lsst') else 'NULL'} END AS {b}" for b in A.CONTRACT_BANDS) + " FROM alerts")
add("scalar_json_details", "SELECT event_id, jdmin, jdmax, mag_g_lsst FROM alerts")
add("scalar_payload_unpack", """
    SELECT log_id, pos AS position, 'SKY24' || CAST(CASE pos WHEN 0 THEN first_id ELSE second_id END AS VARCHAR) AS name,
           CASE WHEN has_mag THEN mag_text END AS mag, NULL::VARCHAR AS mag_type, NULL::VARCHAR AS dec
    FROM req, (VALUES (0), (1)) p(pos) WHERE outcome = 'dry_run' AND (pos = 0 OR second_id IS NOT NULL)""")
add("scalar_band_label", """
    SELECT event_id, band, CASE WHEN band IN ('g_lsst', 'r_lsst', 'i_lsst', 'z_lsst') THEN 'LSST_' || band[1] || '_AB'
                                WHEN band IN ('g_ztf', 'r_ztf') THEN 'SDSS_' || band[1] || '_AB' END AS label
    FROM (SELECT event_id, CASE k WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'z' ELSE 'u' END || CASE survey_id WHEN 1 THEN '_lsst' ELSE '_ztf' END AS band FROM ev)""")
add("scalar_base26_name", f"SELECT o_orderkey, {name_sql('(o_orderkey * 31 % 12355928)')} AS letters FROM orders")
add("scalar_truncate_text", """
    SELECT doc_id, len(left(text, 200)) AS len_200, len(left(text, 1000)) AS len_1000, len(left(text, 4000)) AS len_4000, md5(left(text, 200)) AS hash_200 FROM documents""")
add("scalar_least_greatest", """
    SELECT event_id, least(60315.0::DOUBLE, CASE WHEN k > 0 THEN mjd END) AS first, greatest(60315.0::DOUBLE, CASE WHEN k > 0 THEN mjd END) AS last FROM ev""")
add("scalar_ra_wrap", "SELECT object_id, least(CASE WHEN ra < 0 THEN ra + 360.0::DOUBLE WHEN ra >= 360 THEN ra - 360.0::DOUBLE ELSE ra END, 359.99999999::DOUBLE) AS ra FROM ob")
add("scalar_iso_timestamp", "SELECT name, strftime(TRY_CAST(date_ingested AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%fZ') AS date_ingested FROM tg")
add("scalar_merge_patch", "SELECT event_id, 'false' AS is_active, CAST(json_extract(props, '$.k') AS INT) AS k FROM ev")

# ---------------------------------------------------------------- stateful upserts

_ALL_LSST = {**latest_input("in_all", "lsst_c", "true"), **ingest("s1", "in_all", None, "2024-02-01", "60341.0::DOUBLE")}
_ALL_BOTH = {
    **_ALL_LSST, **latest_input("in_ztf_all", "ztf_c", "true"), **ingest("s2", "in_ztf_all", "s1_obj", "2024-02-01", "60341.0::DOUBLE"),
}
add("create_objects", f"SELECT {OBJECT_COLUMNS} FROM s1_new UNION ALL SELECT {OBJECT_COLUMNS} FROM s2_new", _ALL_BOTH)
add("upsert_objects", f"SELECT {OBJECT_COLUMNS} FROM changes")
add("merge_band_maps", "SELECT l.stage_row, " + ", ".join(
    f"CASE WHEN l.mjd_{b} IS NOT NULL AND (o.mjd_{b} IS NULL OR l.mjd_{b} > o.mjd_{b}) THEN l.mag_{b} ELSE o.mag_{b} END AS {b}"
    for b in A.CONTRACT_BANDS) + " FROM late l JOIN objects0 o ON o.object_id = l.object_id")
_UNAGED = {
    **{name: FULL[name] for name in ("ev_a", "ev_b", "in_lsst_a", "in_lsst_b", "in_ztf_a", "in_ztf_b")},
    **ingest("i1", "in_lsst_a", None, "2024-01-16", "60325.0::DOUBLE"), **ingest("i2", "in_ztf_a", "i1_obj", "2024-01-16", "60325.0::DOUBLE"),
    **ingest("j3", "in_lsst_b", "i2_obj", "2024-02-01", "60341.0::DOUBLE"), **ingest("j4", "in_ztf_b", "j3_obj", "2024-02-01", "60341.0::DOUBLE"),
}
add("ingest_batch", f"SELECT {OBJECT_COLUMNS} FROM j4_obj", _UNAGED)


def _events(p: str, run: str) -> str:
    none = "NULL::VARCHAR"
    before = {"i1": None, "i2": "i1_at", "i3": "i1_at UNION ALL SELECT * FROM i2_at", "i4": "i1_at UNION ALL SELECT * FROM i2_at UNION ALL SELECT * FROM i3_at"}[p]
    fresh = f"SELECT DISTINCT object_id, survey_id, pipeline_id FROM {p}_at"
    if before:
        fresh += f" EXCEPT SELECT object_id, survey_id, pipeline_id FROM (SELECT * FROM {before})"
    return f"""
        SELECT '{run}' AS run_id, object_id, 'alert' AS event_type, {none} AS reason, survey_id, native_id AS survey_object_id, pipeline_id FROM {p}_at
        UNION ALL SELECT '{run}', object_id, 'created', {none}, last_survey_id, {none}, NULL FROM {p}_new
        UNION ALL SELECT '{run}', object_id, 'activated', 'redetected', batch_survey_id, batch_native_id, NULL FROM {p}_chg
                  WHERE touched AND new_detection AND NOT old_active AND active AND object_id NOT IN (SELECT object_id FROM {p}_new)
        UNION ALL SELECT '{run}', object_id, 'selected', {none}, survey_id, {none}, pipeline_id FROM ({fresh})"""


add("batch_events", " UNION ALL ".join([_events("i1", "run-a"), _events("i2", "run-a"), _events("i3", "run-b"), _events("i4", "run-b")] + [
    f"SELECT 'run-{t}', object_id, 'deactivated', deactivation_reason, NULL, NULL, NULL FROM aged_{t} WHERE deactivation_reason IS NOT NULL" for t in ("a", "b")]), FULL)
add("deactivate_objects", "SELECT object_id, active, sync_pending, deactivation_reason, nights_since FROM aged_b", FULL)
add("replay_noop", f"SELECT {OBJECT_COLUMNS} FROM s2_obj", _ALL_BOTH)

# ---------------------------------------------------------------- outbox state machine

add("classify_response", """
    SELECT response_id, CASE WHEN error_kind = 'unencodable' THEN 'rejected'
        WHEN error_kind IS NOT NULL THEN CASE method WHEN 'POST' THEN 'ambiguous' ELSE 'retry' END
        WHEN status_code BETWEEN 200 AND 299 AND body IN ('{"id": 1}', '[]') THEN 'ok'
        WHEN status_code IN (400, 404, 409, 422) THEN 'rejected'
        WHEN method = 'POST' AND status_code NOT IN (401, 403, 429) THEN 'ambiguous' ELSE 'retry' END AS outcome FROM resp""")
add("mark_in_flight", """
    SELECT object_id, CASE WHEN object_id IN (SELECT object_id FROM ready) THEN 'ambiguous' ELSE sync_state END AS sync_state FROM ob""")
add("apply_create_results", """
    SELECT o.object_id, o.active, o.sync_pending AND a.item_id IS NULL AS sync_pending,
           CASE WHEN a.item_id IS NOT NULL THEN NULL WHEN a.outcome IN ('ok', 'ambiguous', 'retry') THEN 'ambiguous' WHEN a.outcome = 'rejected' THEN 'failed' ELSE o.sync_state END AS sync_state,
           CASE WHEN a.item_id IS NOT NULL THEN 0 WHEN a.outcome IS NOT NULL THEN o.sync_attempts + 1 ELSE o.sync_attempts END AS sync_attempts,
           CASE WHEN a.item_id IS NOT NULL THEN NULL WHEN a.outcome IS NULL THEN o.sync_last_error
                WHEN a.outcome = 'ok' THEN 'accepted, but the answer has no target of this name'
                WHEN a.outcome = 'retry' THEN 'create request refused for now, sent again later: refused'
                ELSE 'create request ' || a.outcome || ': ' || CASE WHEN a.batch_id % 7 = 5 THEN '<html>Internal error</html>' ELSE 'refused' END END AS sync_last_error,
           coalesce(a.item_id, o.facility_id) AS facility_id,
           CASE WHEN a.item_id IS NOT NULL THEN a.mag ELSE o.facility_mag END AS facility_mag, a.item_id IS NOT NULL AS was_created
    FROM ob o LEFT JOIN ready_out a ON a.object_id = o.object_id""")
add("split_rejected_batches", """
    SELECT batch_id, object_id, name, name AS sent_name, mag AS sent_mag FROM ready_out
    WHERE outcome = 'rejected' AND batch_id IN (SELECT batch_id FROM ready GROUP BY batch_id HAVING count(*) > 1)""")
add("reconcile_ambiguous", """
    SELECT o.object_id, o.active,
           CASE WHEN v.verdict = 'adopt' THEN o.active <> (o.object_id % 4 = 1) ELSE o.sync_pending END AS sync_pending,
           CASE WHEN v.verdict IN ('adopt', 'resend') THEN NULL WHEN v.verdict = 'conflict' THEN 'conflict' ELSE o.sync_state END AS sync_state,
           o.sync_attempts + CASE WHEN v.verdict IN ('foreign', 'conflict') THEN 1 ELSE 0 END AS sync_attempts,
           CASE v.verdict WHEN 'adopt' THEN NULL WHEN 'foreign' THEN 'lookup gave targets of other names'
                WHEN 'resend' THEN 'lookup found nothing, to be created again'
                WHEN 'conflict' THEN CAST(v.n_found AS VARCHAR) || ' targets have the name ' || o.name || ' or lie elsewhere: ' || CAST(o.object_id + 800000 AS VARCHAR) || CASE WHEN v.n_found = 2 THEN ', ' || CAST(o.object_id + 800001 AS VARCHAR) ELSE '' END ELSE o.sync_last_error END AS sync_last_error,
           CASE WHEN v.verdict = 'adopt' THEN o.object_id + 800000 ELSE o.facility_id END AS facility_id,
           CASE WHEN v.verdict = 'adopt' THEN 15.0::DOUBLE + o.object_id % 9 ELSE o.facility_mag END AS facility_mag,
           coalesce(v.verdict = 'adopt', false) AS was_adopted
    FROM ob o LEFT JOIN verdicts v ON v.object_id = o.object_id""", _LOOKUP)
_PATCHED = {"patched": """
    SELECT object_id, CASE object_id % 5 WHEN 1 THEN 'rejected' WHEN 2 THEN 'retry' WHEN 4 THEN 'retry' ELSE 'ok' END AS outcome,
           '{"is_active":' || CASE WHEN (object_id % 3 = 0) <> active THEN 'true' ELSE 'false' END || '}' AS body
    FROM ob WHERE sync_pending AND facility_id IS NOT NULL AND sync_state IS NULL"""}
add("apply_active_results", """
    SELECT object_id, active, sync_pending AND NOT synced AS sync_pending,
           CASE WHEN synced THEN NULL WHEN outcome IN ('ok', 'rejected') THEN 'failed' ELSE sync_state END AS sync_state,
           CASE WHEN synced THEN 0 WHEN outcome IS NOT NULL THEN sync_attempts + 1 ELSE sync_attempts END AS sync_attempts,
           CASE WHEN synced THEN NULL WHEN outcome = 'ok' THEN 'answer does not confirm the active flag: ' || body WHEN outcome = 'rejected' THEN 'active flag refused: ' || body
                WHEN outcome = 'retry' THEN 'active flag not delivered, sent again later: ' || body ELSE sync_last_error END AS sync_last_error,
           facility_id, facility_mag
    FROM (SELECT o.*, p.outcome, p.body, coalesce(p.outcome = 'ok' AND o.object_id % 3 <> 0, false) AS synced
          FROM ob o LEFT JOIN patched p ON p.object_id = o.object_id)""", _PATCHED)
add("apply_mag_results", """
    SELECT o.object_id, round(CASE WHEN d.done THEN d.mag ELSE o.facility_mag END, 4) AS facility_mag,
           CASE WHEN d.object_id IS NOT NULL AND NOT d.done THEN 'magnitude update ' || d.outcome ELSE o.sync_last_error END AS noted,
           coalesce(d.done, false) AS mag_updated
    FROM ob o LEFT JOIN (SELECT *, CASE object_id % 5 WHEN 1 THEN 'rejected' WHEN 2 THEN 'retry' WHEN 4 THEN 'retry' ELSE 'ok' END AS outcome,
                                object_id % 5 IN (0, 3) AND object_id % 3 <> 0 AS done FROM due) d ON d.object_id = o.object_id""",
    {**_REJECTED, "due": _DUE})
add("mark_not_submittable", """
    SELECT o.object_id, CASE WHEN bad THEN 'not_submittable' ELSE sync_state END AS sync_state,
           sync_attempts + CASE WHEN bad THEN 1 ELSE 0 END AS sync_attempts, CASE WHEN bad THEN refusal ELSE sync_last_error END AS sync_last_error
    FROM (SELECT o.*, r.refusal, r.refusal IS NOT NULL AND o.object_id IN (SELECT object_id FROM tried) AS bad
          FROM ob o JOIN refusals r ON r.object_id = o.object_id) o""")
add("request_log_append", """
    SELECT min(object_id) AS first_id, count(*) AS n, 'POST' AS method,
           CASE batch_id % 7 WHEN 0 THEN 201 WHEN 1 THEN 400 WHEN 2 THEN 500 WHEN 3 THEN 429 WHEN 5 THEN 200 WHEN 6 THEN 200 END AS status_code,
           any_value(outcome) AS outcome,
           CASE WHEN batch_id % 7 = 4 THEN 7 WHEN batch_id % 7 = 5 THEN 27 WHEN batch_id % 7 IN (1, 2, 3) THEN 7
                ELSE least(4000, 2 + sum(len('{"id":' || CAST(item_id AS VARCHAR) || ',"name":"' || name || '"}') + 1) FILTER (item_id IS NOT NULL) - 1) END AS response_chars,
           'v1' AS code_version
    FROM ready_out GROUP BY batch_id""")
add("dry_run_requests", "SELECT min(object_id) AS first_id, count(*) AS n, 'POST' AS method, 'https://facility.example/transients/' AS url, 'dry_run' AS outcome FROM ready GROUP BY batch_id")
add("release_failed", "SELECT object_id, CASE WHEN sync_state = 'failed' AND dec < 0 THEN NULL ELSE sync_state END AS sync_state FROM ob")
add("switch_by_hand", "SELECT object_id, active AND NOT dec > 20 AS active, sync_pending OR dec > 20 AS sync_pending FROM ob")

add("switch_by_hand_events", """
    SELECT object_id, 'activated' AS event_type, 'manual' AS reason, 'observer' AS submitted_by, 'still bright' AS why FROM ob WHERE NOT active AND dec < -60""")

# The whole run, step by step: o1 after the lookups, o2 without idle rows, o3 after the creations, o4 after the flags, o5 after the magnitudes.
_PICK = "CASE object_id % 5 WHEN 1 THEN 'rejected' WHEN 2 THEN 'retry' WHEN 4 THEN 'retry' ELSE 'ok' END"
_RUN = {
    "found": """
        SELECT object_id, CASE object_id % 6 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS n_found,
               CASE WHEN object_id % 6 IN (4, 5) THEN 'foreign' WHEN object_id % 6 = 0 THEN 'resend' WHEN object_id % 6 = 1 AND object_id % 11 <> 5 THEN 'adopt' ELSE 'conflict' END AS verdict
        FROM ob WHERE sync_state = 'ambiguous' AND object_id % 13 <> 0""",
    "o1": """
        SELECT o.* EXCLUDE (sync_pending, sync_state, sync_attempts, sync_last_error, facility_id, facility_mag),
               CASE WHEN verdict = 'adopt' THEN active <> (o.object_id % 4 = 1) ELSE sync_pending END AS sync_pending,
               CASE WHEN verdict IN ('adopt', 'resend') THEN NULL WHEN verdict = 'conflict' THEN 'conflict' ELSE sync_state END AS sync_state,
               sync_attempts + CASE WHEN verdict IN ('foreign', 'conflict') THEN 1 ELSE 0 END AS sync_attempts,
               CASE verdict WHEN 'adopt' THEN NULL WHEN 'foreign' THEN 'lookup gave targets of other names' WHEN 'resend' THEN 'lookup found nothing, to be created again'
                    WHEN 'conflict' THEN CAST(n_found AS VARCHAR) || ' targets have the name ' || name || ' or lie elsewhere' ELSE sync_last_error END AS sync_last_error,
               CASE WHEN verdict = 'adopt' THEN o.object_id + 800000 ELSE facility_id END AS facility_id,
               CASE WHEN verdict = 'adopt' THEN 15.0::DOUBLE + o.object_id % 9 ELSE facility_mag END AS facility_mag, verdict
        FROM ob o LEFT JOIN found f ON f.object_id = o.object_id""",
    "o2": f"SELECT * EXCLUDE (sync_pending), sync_pending AND NOT (NOT active AND facility_id IS NULL AND {_OPEN}) AS sync_pending FROM o1",
    "new2": f"SELECT o.object_id, o.name, r.refusal FROM o2 o JOIN refusals r ON r.object_id = o.object_id WHERE sync_pending AND active AND facility_id IS NULL AND {_OPEN}",
    "ready2": """
        SELECT n.object_id, n.name, round(d.mag, 3) AS mag, (row_number() OVER (ORDER BY n.object_id) - 1) // 50 AS batch_id
        FROM new2 n JOIN ob_det d ON d.object_id = n.object_id WHERE n.refusal IS NULL""",
    "batch2": "SELECT batch_id, count(*) AS n, min(object_id) AS first_id, arg_min(name, object_id) AS first_name FROM ready2 GROUP BY batch_id",
    "posted": """
        SELECT r.*, b.batch_id % 7 = 1 AND b.n > 1 AS split,
               CASE WHEN b.batch_id % 7 = 1 AND b.n > 1 THEN CASE object_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'rejected' WHEN 2 THEN 'ambiguous' ELSE 'retry' END
                    ELSE CASE b.batch_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'rejected' WHEN 3 THEN 'retry' WHEN 6 THEN 'ok' ELSE 'ambiguous' END END AS outcome
        FROM ready2 r JOIN batch2 b ON b.batch_id = r.batch_id""",
    "made": "SELECT *, outcome = 'ok' AND (split OR object_id % 10 <> 3) AS done FROM posted",
    "o3": """
        SELECT o.* EXCLUDE (sync_pending, sync_state, sync_attempts, sync_last_error, facility_id, facility_mag), o.sync_pending AND done IS NOT TRUE AS sync_pending,
               CASE WHEN done THEN NULL WHEN outcome = 'rejected' THEN 'failed' WHEN outcome IS NOT NULL THEN 'ambiguous' WHEN n.refusal IS NOT NULL THEN 'not_submittable' ELSE o.sync_state END AS sync_state,
               CASE WHEN done THEN 0 ELSE o.sync_attempts + CASE WHEN outcome IS NOT NULL OR n.refusal IS NOT NULL THEN 1 ELSE 0 END END AS sync_attempts,
               CASE WHEN done THEN NULL WHEN outcome = 'ok' THEN 'accepted, but the answer has no target of this name' WHEN outcome = 'retry' THEN 'create request refused for now, sent again later'
                    WHEN outcome IS NOT NULL THEN 'create request ' || outcome WHEN n.refusal IS NOT NULL THEN n.refusal ELSE o.sync_last_error END AS sync_last_error,
               CASE WHEN done THEN o.object_id + 800000 ELSE o.facility_id END AS facility_id, CASE WHEN done THEN m.mag ELSE o.facility_mag END AS facility_mag, coalesce(done, false) AS created
        FROM o2 o LEFT JOIN new2 n ON n.object_id = o.object_id LEFT JOIN made m ON m.object_id = o.object_id""",
    "flags": f"SELECT object_id, facility_id, active, {_PICK} AS outcome, {_PICK} = 'ok' AND object_id % 3 <> 0 AS done FROM o3 WHERE sync_pending AND facility_id IS NOT NULL AND sync_state IS NULL",
    "o4": """
        SELECT o.* EXCLUDE (sync_pending, sync_state, sync_attempts, sync_last_error), sync_pending AND done IS NOT TRUE AS sync_pending,
               CASE WHEN done THEN NULL WHEN outcome IN ('ok', 'rejected') THEN 'failed' ELSE sync_state END AS sync_state,
               CASE WHEN done THEN 0 ELSE sync_attempts + CASE WHEN outcome IS NULL THEN 0 ELSE 1 END END AS sync_attempts,
               CASE WHEN done THEN NULL WHEN outcome = 'ok' THEN 'answer does not confirm the active flag' WHEN outcome = 'rejected' THEN 'active flag refused'
                    WHEN outcome = 'retry' THEN 'active flag not delivered, sent again later' ELSE sync_last_error END AS sync_last_error
        FROM o3 o LEFT JOIN flags f ON f.object_id = o.object_id""",
    "mags": f"SELECT *, {_PICK} AS outcome, {_PICK} = 'ok' AND object_id % 3 <> 0 AS done FROM ({_DUE.replace('FROM ob o', 'FROM o4 o')})",
    "o5": """
        SELECT o.* EXCLUDE (sync_last_error, facility_mag), CASE WHEN done THEN m.mag ELSE o.facility_mag END AS facility_mag,
               CASE WHEN m.object_id IS NOT NULL AND NOT done THEN 'magnitude update ' || outcome ELSE sync_last_error END AS sync_last_error
        FROM o4 o LEFT JOIN mags m ON m.object_id = o.object_id""",
    **_REJECTED,
}
add("outbox_run", """
    SELECT object_id, active, sync_pending, sync_state, sync_attempts, split_part(sync_last_error, ':', 1) AS sync_last_error, facility_id, round(facility_mag, 4) AS facility_mag FROM o5""", _RUN)
add("outbox_events", """
    SELECT object_id, 'facility_created' AS event_type, 'adopted_after_ambiguous_post' AS reason, facility_id, NULL::DOUBLE AS mag, 'r1' AS run_id FROM o1 WHERE verdict = 'adopt'
    UNION ALL SELECT object_id, 'facility_created', NULL, facility_id, NULL, 'r1' FROM o3 WHERE created
    UNION ALL SELECT object_id, 'facility_mag_update', NULL, NULL, mag, 'r1' FROM mags WHERE done""", _RUN)
_BASE = "'https://facility.example/transients/'"
add("outbox_requests", f"""
    SELECT object_id AS first_id, 1 AS n, 'GET' AS method, {_BASE} || '?name=' || name || '&subsurvey=sky-sn' AS url, CASE WHEN object_id % 13 = 0 THEN 500 ELSE 200 END AS status_code,
           CASE WHEN object_id % 13 = 0 THEN 'retry' ELSE 'ok' END AS outcome, NULL::BOOLEAN AS is_active, NULL::VARCHAR AS first_name, NULL::DOUBLE AS mag FROM ob WHERE sync_state = 'ambiguous'
    UNION ALL SELECT first_id, n, 'POST', {_BASE}, CASE batch_id % 7 WHEN 0 THEN 201 WHEN 1 THEN 400 WHEN 2 THEN 500 WHEN 3 THEN 429 WHEN 5 THEN 200 WHEN 6 THEN 200 END,
           CASE batch_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'rejected' WHEN 3 THEN 'retry' WHEN 6 THEN 'ok' ELSE 'ambiguous' END, CASE WHEN n = 0 THEN true END, first_name, NULL FROM batch2
    UNION ALL SELECT object_id, 1, 'POST', {_BASE}, CASE object_id % 4 WHEN 0 THEN 201 WHEN 1 THEN 400 WHEN 2 THEN 500 ELSE 429 END, outcome, true, name, NULL FROM posted WHERE split
    UNION ALL SELECT object_id, 1, 'PATCH', {_BASE} || CAST(facility_id AS VARCHAR) || '/', CASE object_id % 5 WHEN 1 THEN 404 WHEN 2 THEN 500 WHEN 4 THEN NULL ELSE 200 END, outcome, active, NULL, NULL FROM flags
    UNION ALL SELECT object_id, 1, 'PATCH', {_BASE} || CAST(facility_id AS VARCHAR) || '/', CASE object_id % 5 WHEN 1 THEN 404 WHEN 2 THEN 500 WHEN 4 THEN NULL ELSE 200 END, outcome, NULL, NULL, mag FROM mags""", _RUN)
add("host_associate", f"""
    SELECT row_number() OVER (ORDER BY object_id, rank) AS association_id, object_id, CAST(rank AS INT) AS rank, 10 AS pipeline_id,
           dense_rank() OVER (ORDER BY host_name) AS host_id, host_name, mag, round({arcsec('h')}, 6) AS separation_arcsec, false AS active FROM (
        SELECT object_id, host_name, mag, h, row_number() OVER (PARTITION BY object_id ORDER BY h, host_name) AS rank FROM (
            SELECT o.object_id, g.host_name, g.mag, {hav('o', 'g')} AS h FROM objects0 o JOIN gal g ON o.active AND g.object_type = 'galaxy' AND {near('o', 'g', _HOST_R)}))
    WHERE rank <= 3""")
_TAKEN = {"taken": """
    SELECT *, TRY_CAST(date_ingested AS TIMESTAMP) AS t FROM tg
    WHERE id IS NOT NULL AND ostd_targ_id IS NOT NULL AND subsurvey = 'sky-sn' AND TRY_CAST(date_ingested AS TIMESTAMP) > TIMESTAMP '2024-01-01'""",
    "marks": "SELECT max(t) AS t FROM taken JOIN ob ON ob.facility_id = taken.id"}
add("facility_sync_run", """
    SELECT o.object_id, o.facility_id, t.ostd_targ_id, t.ostd_u_obj_id AS ostd_u_obj_id, strftime(t.t, '%Y-%m-%d %H:%M:%S') AS date_ingested,
           strftime(m.t - INTERVAL 3 DAY, '%Y-%m-%dT%H:%M:%S.%fZ') AS since, epoch_us(m.t) AS mark
    FROM ob o LEFT JOIN taken t ON t.id = o.facility_id, marks m""", _TAKEN)

# ---------------------------------------------------------------- streaming

_LATE_FIRST = {
    "late_objects": made_objects("late", "false", "true"),
    "late_changes": merged("late_objects", "early", "2024-02-01"),
}
add("late_data_merge", f"SELECT {OBJECT_COLUMNS} FROM late_changes", _LATE_FIRST)
add("survey_clock", "SELECT survey_id, night FROM nights_b", FULL)
