"""Tables read from the facility: merging its ingestion state, and administrative changes to objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import iso_timestamp

RESCAN_DAYS = 3   # fixed value


def incremental_watermark(objects: DataFrame, start: str, force_full: bool = False) -> DataFrame:
    """One row, `since`: the latest date_ingested less RESCAN_DAYS, or `start` when there is none (or on force)."""
    start_ts = F.lit(start).cast("timestamp")
    if force_full:
        return objects.agg(F.any_value(start_ts).alias("since")).select(F.coalesce("since", start_ts).alias("since"))
    latest = F.max("date_ingested") - F.make_dt_interval(F.lit(RESCAN_DAYS))
    return objects.agg(F.coalesce(latest, start_ts).alias("since"))


def target_scope(targets: DataFrame, subsurvey: str) -> DataFrame:
    """The survey id is shared with another programme: only our subsurvey's rows are ours."""
    return targets.filter(F.col("subsurvey") == subsurvey)


def ingestion_merge(objects: DataFrame, targets: DataFrame, *order: Column) -> DataFrame:
    """
    Target ids and ingestion date by facility id; targets without id or target id are skipped. Of
    several rows for one id the last in `order` counts. `updated` stays; a bad date is stored as NULL.
    """
    usable = targets.filter(F.col("id").isNotNull() & F.col("ostd_targ_id").isNotNull())
    position = F.struct(*(order or [F.col("ostd_targ_id")]))
    last = usable.groupBy("id").agg(
        F.max_by(
            F.struct("ostd_targ_id", "ostd_u_obj_id", iso_timestamp(F.col("date_ingested")).alias("date_ingested")),
            position,
        ).alias("_new")
    ).withColumnRenamed("id", "facility_id")
    rows = objects.join(last, "facility_id", "left")
    hit = F.col("_new").isNotNull()
    return rows.withColumns({
        c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in ("ostd_targ_id", "ostd_u_obj_id", "date_ingested")
    }).drop("_new").select(*objects.columns)


def admin_select(objects: DataFrame, where: str = "active = true", view: str | None = None, query: str | None = None) -> DataFrame:
    """Objects by a predicate, or by a full query over the view; the result must name what to act on."""
    if query is not None:
        objects.createOrReplaceTempView(view or "objects")
        rows = objects.sparkSession.sql(query)
    else:
        rows = objects.filter(F.expr(where)).select("object_id", "facility_id", "name")
    missing = {"object_id", "facility_id", "name"} - set(rows.columns)
    if missing:
        raise ValueError(f"the query lacks the columns {sorted(missing)}")
    return rows


def admin_select_by_date(targets: DataFrame, date: str, inclusive: bool = False) -> DataFrame:
    """Facility targets submitted after (or from) a date."""
    submitted, limit = F.col("date_submitted"), F.lit(date).cast("timestamp")
    return targets.filter(submitted >= limit if inclusive else submitted > limit)


def admin_apply(objects: DataFrame, results: DataFrame, action: str, match_by: str, now: Column) -> DataFrame:
    """
    results (key, status_code) of a 'deactivate' or 'delete', key = facility id ('pk') or name ('name').
    Success (or a 404: the target is gone) switches the object off; delete and 404 also drop its facility id.
    """
    if action not in ("deactivate", "delete") or match_by not in ("pk", "name"):
        raise ValueError(f"unknown action {action!r} or key {match_by!r}")
    accepted = [200, 204] if action == "delete" else [200, 201, 204]
    done = results.filter(F.col("status_code").isin(accepted + [404])).groupBy("key").agg(
        F.bool_or(F.lit(action == "delete") | (F.col("status_code") == 404)).alias("_forget")
    )
    column = "facility_id" if match_by == "pk" else "name"
    rows = objects.join(done, F.col(column) == F.col("key"), "left")
    hit = F.col("_forget").isNotNull()
    return rows.withColumns({
        "active": F.col("active") & ~hit,
        "sync_pending": F.col("sync_pending") & ~hit,
        "updated": F.when(hit, now).otherwise(F.col("updated")),
        "facility_id": F.when(~F.coalesce("_forget", F.lit(False)), F.col("facility_id")),
    }).drop("_forget", "key").select(*objects.columns)


def semi_join_changed(objects: DataFrame, staged: DataFrame, deactivated: DataFrame) -> DataFrame:
    """Objects that were staged or switched off."""
    ids = staged.select("object_id").unionByName(deactivated.select("object_id")).distinct()
    return objects.join(ids, "object_id", "left_semi")
