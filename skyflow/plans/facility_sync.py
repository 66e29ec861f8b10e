"""What the facility has taken in, merged into the stored objects up to a stored high-water mark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import iso_timestamp
from ..operators.facility import RESCAN_DAYS, ingestion_merge, target_scope
from ..operators.lineage import materialize
from ..sources.buckets import BucketStore

MARK = "facility_mark"        # of the pointer: the latest ingestion date that has been merged, in microseconds


@dataclass
class FacilitySync:
    """From when the facility was asked, how many objects changed, and the mark after the run (microseconds; None: nothing merged yet)."""

    since: str
    changed: int
    mark: int | None


def _text(micros: int) -> str:
    return dt.datetime.fromtimestamp(micros / 1e6, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def facility_sync_run(store: BucketStore, read: Callable[[str], DataFrame], subsurvey: str, start: str, force_full: bool = False) -> FacilitySync:
    """
    Ask for the targets that the facility took in since the mark less RESCAN_DAYS (or since `start`, if there is no mark or on
    force), keep our subsurvey's, and merge their ids and dates into the objects by facility id. `read` gets the moment as UTC text and returns target
    rows. Objects whose values change are found on narrow columns, and only their zones are read whole and written. The mark moves with
    the merge, in one pointer: a run that breaks off asks from the old mark again, and a repeated one changes nothing.
    """
    mark = store.pointer().get(MARK)
    since = start if mark is None or force_full else _text(mark - RESCAN_DAYS * 86_400_000_000)
    targets = materialize(target_scope(read(since), subsurvey).select("id", "ostd_targ_id", "ostd_u_obj_id", "date_ingested"), "targets")
    # several rows of one id: the last date counts, then the higher target id
    order = [F.coalesce(iso_timestamp(F.col("date_ingested")), F.lit("1970-01-01").cast("timestamp")), F.col("ostd_targ_id")]
    columns = ["ostd_targ_id", "ostd_u_obj_id", "date_ingested"]
    narrow = store.load().objects.filter("facility_id IS NOT NULL").select("object_id", "ra", "dec", "facility_id", *columns)
    merged = ingestion_merge(narrow, targets, *order).alias("n").join(narrow.select("object_id", *columns).alias("o"), "object_id")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    changed = materialize(merged.filter(~same).select("object_id", "ra", "dec"), "changed")
    known = narrow.select(F.col("facility_id").alias("id")).distinct()
    latest = targets.filter("ostd_targ_id IS NOT NULL").join(known, "id", "left_semi").agg(F.max(F.unix_micros(iso_timestamp(F.col("date_ingested"))))).first()[0]
    mark = max((m for m in (mark, latest) if m is not None), default=None)
    n = changed.count()
    if n:
        zones = [r["zone"] for r in store.zoned(changed.select("ra", "dec")).select("zone").distinct().collect()]
        around = store.load(zones)
        store.merge(around.with_tables(objects=ingestion_merge(around.objects, targets, *order)), changed, **{MARK: mark})
    elif mark != store.pointer().get(MARK):
        store.record(**{MARK: mark})
    return FacilitySync(since, n, mark)
