"""Sky matching against brute force: the RA wrap, the poles, dense places, hot cells, and the pass rules."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from skyflow.functions.sky import MATCH_RADIUS_DEG, angular_sep_arcsec, tight_cell, with_ball_cells, with_cell
from skyflow.operators import hosts, numbering, skew, skymatch

ARCSEC = 1.0 / 3600.0


def h(a, b):
    d = math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return d + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2


LIMIT = math.sin(math.radians(MATCH_RADIUS_DEG) / 2) ** 2


def frame(spark, points, key):
    return spark.createDataFrame([(i, *p) for i, p in points.items()], f"{key} bigint, ra double, dec double")


def clouds(seed, n):
    """Tight groups around awkward centres: wrap, both poles, equator, a zone edge."""
    rnd = random.Random(seed)
    centres = [(0.0, 10.0), (359.99999, -35.0), (123.0, 89.9999), (10.0, -89.99995), (200.0, 0.0), (77.7, 60.0), (40.0, 90.0)]
    out = {}
    for i in range(n):
        ra, dec = rnd.choice(centres)
        dec2 = dec + rnd.uniform(-2, 2) * ARCSEC
        ra2 = ra + rnd.uniform(-2, 2) * ARCSEC / max(math.cos(math.radians(dec2)), 1e-6)
        if dec2 > 90:
            dec2, ra2 = 180 - dec2, ra2 + 180
        if dec2 < -90:
            dec2, ra2 = -180 - dec2, ra2 + 180
        out[i] = (ra2 % 360.0, dec2)
    return out


def nearest(rows, objects):
    out = {}
    for i, p in rows.items():
        best = min(((h(p, q), j) for j, q in objects.items() if h(p, q) < LIMIT), default=None)
        if best:
            out[i] = best[1]
    return out


def leaders_of(rows):
    return {i for i, p in rows.items() if not any(j < i and h(p, q) < LIMIT for j, q in rows.items())}


def resolve(rows, objects, next_id):
    """The rule as stated: match, lead, attach, until none is left."""
    assigned = {i: (j, 0) for i, j in nearest(rows, objects).items()}
    todo, k = {i: p for i, p in rows.items() if i not in assigned}, 0
    while todo:
        k += 1
        new = {}
        for i in sorted(leaders_of(todo)):
            new[next_id] = todo[i]
            next_id += 1
        for i, j in nearest(todo, new).items():
            assigned[i] = (j, k)
        todo = {i: p for i, p in todo.items() if i not in assigned}
    return assigned


@pytest.mark.parametrize("spread", ["rows", "objects"])
@pytest.mark.parametrize("rows_per_task", [10, 1_000_000])
def test_match_equals_brute_force(spark, spread, rows_per_task):
    rows, objects = clouds(1, 300), clouds(2, 60)
    got = skymatch.sky_match_nearest(
        frame(spark, rows, "stage_row"), frame(spark, objects, "object_id"), spread=spread, rows_per_task=rows_per_task)
    assert {r["stage_row"]: r["object_id"] for r in got.collect()} == nearest(rows, objects)


@pytest.mark.parametrize("rows_per_task", [10, 1_000_000])
def test_leaders_equal_brute_force(spark, rows_per_task):
    rows = clouds(3, 400)
    got = skymatch.sky_new_leaders(frame(spark, rows, "stage_row"), rows_per_task=rows_per_task)
    assert {r["stage_row"] for r in got.collect()} == leaders_of(rows)


@pytest.mark.parametrize("rows_per_task", [20, 1_000_000])
def test_resolve_equals_brute_force(spark, rows_per_task):
    rows, objects = clouds(4, 250), clouds(5, 6)
    got = skymatch.sky_resolve_batch(
        frame(spark, rows, "stage_row"), frame(spark, objects, "object_id"), next_object_id=100, rows_per_task=rows_per_task)
    want = resolve(rows, objects, 100)
    assert {r["stage_row"]: (r["object_id"], r["match_pass"]) for r in got.assignments.collect()} == want
    assert got.n_passes >= 2 and got.n_new == len({j for j, k in want.values() if k})


def test_a_third_of_the_rows_in_one_place(spark):
    """Copies of one position and a hot cloud: every row is attached, to the right object."""
    rnd = random.Random(6)
    rows = {i: (30.0, 5.0) for i in range(1000)}
    rows.update({i: (30.0 + rnd.uniform(-0.5, 0.5) * ARCSEC, 5.0 + rnd.uniform(-0.5, 0.5) * ARCSEC) for i in range(1000, 2000)})
    rows.update({i: (rnd.uniform(0, 360), rnd.uniform(-80, 80)) for i in range(2000, 3000)})
    none = frame(spark, {0: (0.0, 0.0)}, "object_id").filter("false")
    got = skymatch.sky_resolve_batch(frame(spark, rows, "stage_row"), none, rows_per_task=100)
    assert {r["stage_row"]: (r["object_id"], r["match_pass"]) for r in got.assignments.collect()} == resolve(rows, {}, 1)


def chain(spark, offsets, objects=None):
    rows = {i: (150.0, 2.0 + x * ARCSEC) for i, x in enumerate(offsets)}
    objs = frame(spark, objects or {0: (0.0, 0.0)}, "object_id")
    got = skymatch.sky_resolve_batch(frame(spark, rows, "stage_row"), objs if objects else objs.filter("false"))
    return {r["stage_row"]: (r["object_id"], r["match_pass"]) for r in got.assignments.collect()}


def test_chain_takes_two_passes(spark):
    assert chain(spark, [0.0, 0.7, 1.4]) == {0: (1, 1), 1: (1, 1), 2: (2, 2)}


def test_chain_replay_moves_the_middle_row(spark):
    assert chain(spark, [0.0, 0.7, 1.3]) == {0: (1, 1), 1: (1, 1), 2: (2, 2)}
    objects = {1: (150.0, 2.0), 2: (150.0, 2.0 + 1.3 * ARCSEC)}
    assert chain(spark, [0.0, 0.7, 1.3], objects) == {0: (1, 0), 1: (2, 0), 2: (2, 0)}


def test_equal_distance_takes_the_lower_id(spark):
    objects = {9: (150.0, 2.0), 4: (150.0, 2.0)}
    assert chain(spark, [0.3], objects) == {0: (4, 0)}


def test_ra_wrap_is_one_object(spark):
    rows = frame(spark, {0: (359.99999, 1.0), 1: (0.00001, 1.0)}, "stage_row")
    got = skymatch.sky_resolve_batch(rows, frame(spark, {0: (0.0, 0.0)}, "object_id").filter("false"))
    assert {r["object_id"] for r in got.assignments.collect()} == {1}


def test_every_position_in_the_ball_is_in_its_cells(spark):
    rnd = random.Random(7)
    pairs = []
    for _ in range(4000):
        ra, dec = rnd.uniform(0, 360), rnd.choice([rnd.uniform(-90, 90), rnd.uniform(89.99, 90), rnd.uniform(-90, -89.99)])
        r, t = MATCH_RADIUS_DEG * rnd.uniform(0, 1), rnd.uniform(0, 2 * math.pi)
        dec2 = max(-90.0, min(90.0, dec + r * math.sin(t)))
        ra2 = (ra + r * math.cos(t) / max(math.cos(math.radians(dec)), 1e-9)) % 360.0
        if h((ra, dec), (ra2, dec2)) < LIMIT:
            pairs.append((ra, dec, ra2, dec2))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, ra double, dec double, ra2 double, dec2 double")
    height = MATCH_RADIUS_DEG * 4
    cells = with_ball_cells(with_cell(df, "ra2", "dec2", height, "c2"), "ra", "dec", MATCH_RADIUS_DEG, height, "c")
    met = cells.filter("c = c2").groupBy("i").count().collect()
    assert len(pairs) > 2000 and len(met) == len(pairs) and all(r["count"] == 1 for r in met)


def test_tight_cells_are_smaller_than_the_radius(spark):
    rnd = random.Random(8)
    pts = [(rnd.uniform(0, 3 * ARCSEC), d + rnd.uniform(-1.5, 1.5) * ARCSEC) for d in (0.0, 45.0, -70.0) for _ in range(300)]
    df = spark.createDataFrame(pts, "ra double, dec double").withColumn("c", tight_cell("ra", "dec", MATCH_RADIUS_DEG))
    groups: dict = {}
    for r in df.collect():
        groups.setdefault(r["c"], []).append((r["ra"], r["dec"]))
    assert any(len(g) > 3 for g in groups.values())
    assert all(h(a, b) < LIMIT for g in groups.values() for a in g for b in g)


def test_mock_pair_separation(spark):
    sep = spark.range(1).select(angular_sep_arcsec(F.lit(150.0), F.lit(2.0), F.lit(150.0001), F.lit(2.0001))).first()[0]
    assert sep == pytest.approx(0.509, abs=1e-3)


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).withColumn("x", F.pmod(F.hash("id"), F.lit(50)))
    got, n = numbering.write_row_index(df, [F.col("x").desc(), F.col("id")], "i", start=3)
    rows = sorted((r["i"], -r["x"], r["id"]) for r in got.collect())
    assert n == 5000 and [r[0] for r in rows] == list(range(3, 5003))
    assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    small = numbering.with_row_index(df, [F.col("x").desc(), F.col("id")], "i", known_rows=5000, start=3)
    assert sorted((r["i"], r["id"]) for r in small.collect()) == [(r[0], r[2]) for r in rows]


def test_salted_join_meets_every_pair_once(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("r"))
    joined = skew.salted_join(left, right, "k", F.col("l") % 2 == 0, "l", rows_per_task=100)
    want = {(r["l"], r["r"]) for r in left.join(right, "k").filter("l % 2 = 0").collect()}
    got = [(r["l"], r["r"]) for r in joined.collect()]
    assert len(got) == len(want) and set(got) == want
    assert skew.hot_keys(left, "k", 100).collect()[0].asDict() == {"k": 7, "_salts": 10}


def test_shared_folder_is_the_sessions_or_a_temporary_one(spark, monkeypatch):
    from skyflow.operators import lineage

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert lineage.shared_dir(spark) == named.rstrip("/")

    class Unset:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    monkeypatch.setattr(lineage, "_unset", {})
    first = lineage.shared_dir(Unset())
    assert first and lineage.shared_dir(Unset()) == first


def test_host_crossmatch_with_copies(spark):
    objs = frame(spark, {i: (150.0, 2.0) for i in range(1, 5)}, "object_id")
    rows = [(f"C{i:03d}", "galaxy", 150.0, 2.0 + ARCSEC) for i in range(40)] + [
        ("NEAR", "galaxy", 150.0, 2.0 + 0.2 * ARCSEC), ("STAR", "star", 150.0, 2.0), ("FAR", "galaxy", 150.0, 2.01)]
    gal = spark.createDataFrame(rows, "host_name string, object_type string, ra double, dec double")
    got = {(r["object_id"], r["rank"]): r["host_name"] for r in hosts.host_crossmatch(objs, gal, 5.0).collect()}
    assert got == {(i, k + 1): n for i in range(1, 5) for k, n in enumerate(["NEAR", "C000", "C001"])}


def test_more_hot_keys_than_any_list(spark):
    left = spark.range(15_000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("l"))
    right = spark.range(1500).select(F.col("id").alias("k"), F.col("id").alias("r"))
    joined = skew.salted_join(left, right, "k", F.lit(True), "l", rows_per_task=5)
    assert skew.hot_keys(left, "k", 5).count() == 1500
    assert joined.count() == 15_000 and joined.select("l").distinct().count() == 15_000
