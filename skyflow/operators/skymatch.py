"""
Resolving positions: nearest object within a radius, new leaders, and the repeat-until-done batch.

Cone matches become equi-joins on declination-zone cells with the exact separation as join
condition. New leaders are found without pairing rows with rows: in a cell smaller than the
radius only the first row can lead, so each cell is first reduced to that one candidate (a
partial aggregate) and rows are only compared with candidates. The work per row is bounded by the
number of candidates around it, however many rows share a position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.sky import (
    CELLS_PER_RADIUS, MATCH_RADIUS_DEG, haversine_limit, haversine_sql, haversine_to_arcsec, tight_cell,
    with_ball_cells, with_cell,
)
from .lineage import materialize
from .numbering import with_row_index
from .skew import ROWS_PER_TASK, salted_join


def sky_pairs(
    rows: DataFrame,
    objects: DataFrame,
    row_key: str,
    object_key: str,
    radius_deg: float = MATCH_RADIUS_DEG,
    spread: str = "rows",
    known_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    cells_per_radius: int = CELLS_PER_RADIUS,
    send_rows: bool = False,
) -> DataFrame:
    """
    Every (row_key, object_key, _h) with a separation below `radius_deg`; _h orders like the separation.

    `spread` names the side that is copied into the neighbouring cells: the smaller one. Objects are
    pairwise farther apart than the radius, so a cell holds a bounded number of them, and hot cells
    of the row side are salted. `send_rows` sends the rows to the objects instead (only for a counted few; then the
    objects are neither shuffled nor sorted).
    """
    height = radius_deg * cells_per_radius
    left = rows.select(F.col(row_key).alias("_row"), F.col("ra").alias("_ra"), F.col("dec").alias("_dec"))
    right = objects.select(F.col(object_key).alias("_obj"), F.col("ra").alias("_ora"), F.col("dec").alias("_odec"))

    if spread == "rows":
        left = with_ball_cells(left, "_ra", "_dec", radius_deg, height, "_cell")
        right = with_cell(right, "_ora", "_odec", height, "_cell")
    else:
        left = with_cell(left, "_ra", "_dec", height, "_cell")
        right = with_ball_cells(right, "_ora", "_odec", radius_deg, height, "_cell")
    h = F.expr(haversine_sql("_ra", "_dec", "_ora", "_odec"))
    near = h < haversine_limit(radius_deg)
    if send_rows:
        pairs = right.withColumnRenamed("_cell", "_ocell").join(F.broadcast(left), (F.col("_cell") == F.col("_ocell")) & near)
    else:
        pairs = salted_join(left, right, "_cell", near, "_row", known_rows, rows_per_task)
    return pairs.select(F.col("_row").alias(row_key), F.col("_obj").alias(object_key), h.alias("_h"))


def sky_match_nearest(
    rows: DataFrame,
    objects: DataFrame,
    row_key: str = "stage_row",
    object_key: str = "object_id",
    radius_deg: float = MATCH_RADIUS_DEG,
    spread: str = "rows",
    known_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(row_key, object_key, separation_arcsec) of the nearest object in range; equal distance: the lower id."""
    pairs = sky_pairs(rows, objects, row_key, object_key, radius_deg, spread, known_rows, rows_per_task)
    best = pairs.groupBy(row_key).agg(F.min(F.struct("_h", object_key)).alias("_best"))
    return best.select(
        row_key, F.col("_best")[object_key].alias(object_key),
        haversine_to_arcsec(F.col("_best")["_h"]).alias("separation_arcsec"),
    )


def sky_new_leaders(
    rows: DataFrame,
    row_key: str = "stage_row",
    radius_deg: float = MATCH_RADIUS_DEG,
    known_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(row_key, ra, dec) of the rows with no row of a smaller `row_key` within the radius."""
    order = F.col(row_key)
    candidates = (
        rows.groupBy(tight_cell("ra", "dec", radius_deg).alias("_tight"))
        .agg(
            F.min(order).alias("_cand"), F.min_by("ra", order).alias("_cra"), F.min_by("dec", order).alias("_cdec"),
        )
        .drop("_tight")
    )
    height = radius_deg * 4
    left = with_cell(
        rows.select(order.alias("_row"), F.col("ra").alias("_ra"), F.col("dec").alias("_dec")), "_ra", "_dec", height, "_cell"
    )
    right = with_ball_cells(candidates, "_cra", "_cdec", radius_deg, height, "_cell")
    h = F.expr(haversine_sql("_ra", "_dec", "_cra", "_cdec"))
    blocked = salted_join(
        left, right, "_cell",
        (F.col("_row") < F.col("_cand")) & (h < haversine_limit(radius_deg)), "_row", known_rows, rows_per_task,
    ).select("_cand").distinct()
    leaders = candidates.join(blocked, "_cand", "left_anti")
    return leaders.select(F.col("_cand").alias(row_key), F.col("_cra").alias("ra"), F.col("_cdec").alias("dec"))


@dataclass
class Resolution:
    """`assignments`: (stage_row, object_id, match_pass), pass 0 = existed before. `leaders`: (stage_row, object_id, match_pass)."""

    assignments: DataFrame
    leaders: DataFrame
    n_rows: int
    n_new: int
    n_passes: int


def sky_resolve_batch(
    stage: DataFrame,
    objects: DataFrame,
    next_object_id: int = 1,
    radius_deg: float = MATCH_RADIUS_DEG,
    n_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> Resolution:
    """
    Attach every staged row to an object. Rows near an existing object take the nearest; the others
    elect leaders (new objects), attach to the nearest leader, and repeat until none is left. Every
    pass attaches at least one row. New ids follow (pass, stage_row). `stage` must be written out
    already (`materialize`): it is read once per step.
    """
    points = stage.select("stage_row", "ra", "dec")
    if n_rows is None:
        n_rows = points.count()
    if objects.isEmpty():
        hit, n_todo = points.select("stage_row", F.lit(0).cast("long").alias("object_id")).filter(F.lit(False)), n_rows
    else:
        hit = materialize(
            sky_match_nearest(
                points, objects, radius_deg=radius_deg, known_rows=n_rows, rows_per_task=rows_per_task
            ).select("stage_row", "object_id"),
            "matched",
        )
        n_todo = n_rows - hit.count()
    todo = points
    if 0 < n_todo < n_rows:
        todo = materialize(points.join(hit, "stage_row", "left_anti"), "unmatched")

    attached, leading = [], []
    n_passes = n_new = 0
    while n_todo:
        n_passes += 1
        found = materialize(
            sky_new_leaders(todo, radius_deg=radius_deg, known_rows=n_todo, rows_per_task=rows_per_task), "leaders"
        )
        n_leaders = found.count()
        if n_leaders == 0:
            raise RuntimeError("staged rows left unmatched: check ra/dec")
        leaders = with_row_index(
            found, [F.col("stage_row")], "object_id", known_rows=n_leaders, start=next_object_id + n_new
        )
        n_new += n_leaders
        match_pass = F.lit(n_passes).alias("match_pass")
        leading.append(leaders.select("stage_row", "object_id", match_pass))
        if n_leaders == n_todo:
            attached.append(leading[-1])
            break
        near = materialize(
            sky_match_nearest(
                todo, leaders, radius_deg=radius_deg, spread="objects", known_rows=n_todo, rows_per_task=rows_per_task
            ).select("stage_row", "object_id"),
            "attached",
        )
        attached.append(near.select("stage_row", "object_id", match_pass))
        n_left = n_todo - near.count()
        if n_left:
            todo = materialize(todo.join(near, "stage_row", "left_anti"), "unmatched")
        n_todo = n_left

    matched = hit.withColumn("match_pass", F.lit(0))
    if not leading:
        return Resolution(matched, matched.filter(F.lit(False)), n_rows, 0, 0)
    return Resolution(
        reduce(DataFrame.unionByName, attached, matched), reduce(DataFrame.unionByName, leading), n_rows, n_new, n_passes
    )
