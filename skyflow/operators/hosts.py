"""Host galaxies: which objects still need one, the cone match, ranking, the catalogue and the follow-up queue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.sky import haversine_to_arcsec, with_ball_cells, with_cell
from .lineage import materialize
from .numbering import with_row_index
from .skymatch import sky_pairs
from .upsert import insert_if_absent

# Fixed values.
MAX_HOSTS = 3
QUEUE_AFTER_DAYS = 50
FAINT_HOST_MAG = 24.0

SENT_OBJECTS = 100_000      # up to this many (counted) new objects are sent to the catalogue, some 10 MB in their cells
GALAXY_ZONE_DEG = 5.0
ASSOCIATION = (
    "association_id bigint, object_id bigint, host_id bigint, rank int, pipeline_id int, metadata string, facility_id bigint, "
    "sync_pending boolean, active boolean"
)
_GALAXY = "host_name string, ra double, dec double, mag double, zone bigint"


def unmatched_hosts(objects: DataFrame, associations: DataFrame, pipeline_id: int) -> DataFrame:
    """Active objects without an association of this pipeline; one that failed is found again next run."""
    done = associations.filter(F.col("pipeline_id") == pipeline_id)
    return objects.filter("active").join(done, "object_id", "left_anti")


def host_rank(candidates: DataFrame, *order: Column, limit: int = MAX_HOSTS) -> DataFrame:
    """The best `limit` candidates of each object with rank 1, 2, ...; reduced before the shuffle."""
    by_object = Window.partitionBy("object_id").orderBy(*(order or [F.col("separation_arcsec"), F.col("host_name")]))
    return candidates.withColumn("rank", F.row_number().over(by_object)).filter(F.col("rank") <= limit)


def host_crossmatch(objects: DataFrame, galaxies: DataFrame, radius_arcsec: float) -> DataFrame:
    """
    Up to three catalogue galaxies within the radius of each object, nearest first:
    (object_id, host_name, separation_arcsec, rank). Only rows of type galaxy are candidates.
    """
    pairs = sky_pairs(objects, usable_galaxies(galaxies), "object_id", "host_name", radius_arcsec / 3600.0, cells_per_radius=4)
    return _nearest_hosts(pairs)


def usable_galaxies(galaxies: DataFrame) -> DataFrame:
    """Galaxies once each. Entries at one position rank by name, so only the first three of them can ever be used."""
    same_place = Window.partitionBy("ra", "dec").orderBy("host_name")
    kept = [c for c in ("mag",) if c in galaxies.columns]
    once = galaxies.filter(F.col("object_type") == "galaxy").groupBy("host_name", "ra", "dec").agg(*[F.min(c).alias(c) for c in kept] or [F.lit(0).alias("_none")])
    return once.withColumn("_copy", F.row_number().over(same_place)).filter(F.col("_copy") <= MAX_HOSTS).select("host_name", "ra", "dec", *kept)


def _nearest_hosts(pairs: DataFrame) -> DataFrame:
    once = pairs.groupBy("object_id", "host_name").agg(F.min("_h").alias("_h"))     # a host counts once, at its nearest entry
    ranked = host_rank(once, F.col("_h"), F.col("host_name"))
    return ranked.select(
        "object_id", "host_name", haversine_to_arcsec(F.col("_h")).alias("separation_arcsec"), "rank"
    )


def host_catalog(catalog: DataFrame, galaxies: DataFrame, next_host_id: int, known_rows: int | None = None) -> DataFrame:
    """The catalogue plus the galaxies it lacks, each name once, new ids in name order."""
    once = Window.partitionBy("host_name").orderBy("ra", "dec")
    fresh = (
        galaxies.withColumn("_rank", F.row_number().over(once)).filter(F.col("_rank") == 1).drop("_rank")
        .join(catalog.select("host_name"), "host_name", "left_anti")
    )
    numbered = with_row_index(fresh, [F.col("host_name")], "host_id", known_rows, next_host_id)
    return catalog.unionByName(numbered.select(*catalog.columns))


def store_galaxies(galaxies: DataFrame, path: str, zone_deg: float = GALAXY_ZONE_DEG) -> None:
    """The usable galaxies of a catalogue, stored by zone of the sky. Done once for a catalogue."""
    zoned = with_cell(usable_galaxies(galaxies), "ra", "dec", zone_deg, "zone")
    zoned.select("host_name", "ra", "dec", F.col("mag").cast("double").alias("mag"), "zone").hint("rebalance", "zone").write.mode("overwrite").partitionBy("zone").parquet(path)


def galaxies_near(spark: SparkSession, path: str, points: DataFrame, radius_deg: float, zone_deg: float = GALAXY_ZONE_DEG) -> DataFrame:
    """The stored galaxies of the zones around the points; other zones are not read. The zones' size bounds their number."""
    cells = with_ball_cells(points.select("ra", "dec"), "ra", "dec", radius_deg, zone_deg, "zone").select("zone").distinct()
    zones = [r["zone"] for r in cells.collect()]
    return spark.read.schema(_GALAXY).parquet(path).filter(F.col("zone").isin(zones))


@dataclass
class HostRun:
    """All associations and the catalogue after a run, and the associations that it added."""

    associations: DataFrame
    catalog: DataFrame
    added: DataFrame


def host_associate(
    objects: DataFrame, associations: DataFrame, catalog: DataFrame, galaxy_path: str, pipeline_id: int, radius_arcsec: float,
    zone_deg: float = GALAXY_ZONE_DEG, sent_objects: int = SENT_OBJECTS,
) -> HostRun:
    """
    Associate the active objects that have no association of this pipeline with up to three galaxies of the stored catalogue. Only the zones
    around those objects are read, and a counted few objects are sent to them, so that the catalogue isn't shuffled. A row is unique by
    object, rank and pipeline; each galaxy enters `catalog` (host_id, host_name, ra, dec, mag) once, by name. An object without a
    galaxy in range stays unmatched and is looked at again in the next run; a run with nothing new adds nothing.
    """
    spark = objects.sparkSession
    new = materialize(unmatched_hosts(objects, associations, pipeline_id).select("object_id", "ra", "dec"), "unmatched")
    n_new = new.count()
    radius = radius_arcsec / 3600.0
    galaxies = galaxies_near(spark, galaxy_path, new, radius, zone_deg)
    pairs = sky_pairs(new, galaxies, "object_id", "host_name", radius, known_rows=n_new, cells_per_radius=4, send_rows=n_new <= sent_objects)
    ranked = materialize(_nearest_hosts(pairs), "hosts")
    n_found = ranked.count()
    entries = galaxies.join(ranked.select("host_name").distinct(), "host_name", "left_semi").withColumn("object_type", F.lit("galaxy"))
    last = catalog.agg(F.max("host_id")).first()[0] or 0
    catalog = materialize(host_catalog(catalog, entries.select("host_name", "ra", "dec", "mag"), last + 1, n_found), "catalogue")
    named = ranked.join(catalog.select("host_id", "host_name"), "host_name")
    numbered = with_row_index(named, [F.col("object_id"), F.col("rank")], "association_id", n_found, (associations.agg(F.max("association_id")).first()[0] or 0) + 1)
    metadata = F.to_json(F.struct(F.round("separation_arcsec", 6).alias("separation_arcsec")))
    fresh = numbered.withColumns({
        "pipeline_id": F.lit(pipeline_id), "metadata": metadata, "facility_id": F.lit(None).cast("bigint"), "sync_pending": F.lit(False), "active": F.lit(False)})
    both, added = insert_if_absent(associations, fresh, ["object_id", "rank", "pipeline_id"])
    return HostRun(materialize(both, "associations"), catalog, added)


def host_queue_rule(associations: DataFrame, objects: DataFrame, now_mjd: float) -> DataFrame:
    """
    Associations with the queue state: active when the object is switched off and either long unseen or
    faint in all of its LSST bands (no LSST band is not faint). A change in either direction is pending.
    """
    lsst = F.map_filter(F.col("latest_mags"), lambda band, _: band.like("%\\_lsst"))
    faint = (F.size(lsst) > 0) & F.forall(F.map_values(lsst), lambda m: m > FAINT_HOST_MAG)
    wanted = ~F.col("o_active") & ((F.lit(now_mjd) - F.col("o_jdmax") > QUEUE_AFTER_DAYS) | faint)
    state = objects.select(
        "object_id", F.col("active").alias("o_active"), F.col("jdmax").alias("o_jdmax"), "latest_mags"
    )
    rows = associations.join(state, "object_id").withColumn("_wanted", F.coalesce(wanted, F.lit(False)))
    return rows.withColumns({
        "sync_pending": F.col("sync_pending") | (F.col("active") != F.col("_wanted")),
        "active": F.col("_wanted"),
    }).select(*associations.columns)


def host_report_join(associations: DataFrame, objects: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each association with the object's and the galaxy's name."""
    return associations.join(
        objects.select("object_id", F.col("name").alias("object_name")), "object_id"
    ).join(catalog.select("host_id", "host_name"), "host_id")
