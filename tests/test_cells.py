"""Adaptive cells against brute force, at the poles and the date line as well."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeworks.operators import cells, fire


def apart(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(8)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(600)]
    points += [(rng.gauss(51, 0.5), rng.gauss(-114, 0.5)) for _ in range(600)]  # a crowd, so cells are split
    points += [(90.0, 10.0), (-90.0, 0.0), (89.9, 179.99), (0.0, 180.0), (0.0, -180.0), (10.0, 179.999), (10.0, -179.999), (51.0, -114.0)]
    rows = [(la, lo, dt.datetime(2024, 1, 1 + i % 3), dt.date(2024, 1, 1 + i % 3), None if i % 9 == 0 else float(i % 7)) for i, (la, lo) in enumerate(points)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, datetime timestamp, date date, frp double")
    sites = [(1, 51.0447, -114.0719), (2, 89.5, 0.0), (3, -90.0, 40.0), (4, 10.0, 180.0), (5, 0.0, -179.9), (6, 60.0, 179.0), (7, -33.0, 151.0)]
    return rows, df, sites, spark.createDataFrame(sites, "site_id long, site_lat double, site_lon double")


@pytest.mark.parametrize("radius", [30.0, 400.0, 3000.0, 12_000.0])
@pytest.mark.parametrize("limit", [5, 100_000])
def test_pairs(world, radius, limit):
    rows, df, sites, site_df = world
    want = sorted((s, round(la, 6), round(lo, 6)) for s, a, b in sites for la, lo, *_ in rows if apart(a, b, la, lo) <= radius)
    for options in ({}, {"broadcast_rows": 0, "salts": 3}):
        got = fire.fires_near_sites(df, site_df, radius_km=radius, leaf_points=limit, **options)
        pairs = got.select("site_id", "latitude", "longitude", "distance_km").collect()
        assert sorted((r[0], round(r[1], 6), round(r[2], 6)) for r in pairs) == want
        at = {s: (a, b) for s, a, b in sites}
        assert all(r[3] == pytest.approx(apart(*at[r[0]], r[1], r[2]), abs=1e-6) for r in pairs)
        if radius != 400.0:
            break


def test_counts_without_distances(world):
    rows, df, sites, site_df = world
    want = {}
    for s, a, b in sites:
        for la, lo, _, day, frp in rows:
            if apart(a, b, la, lo) <= 2000.0:
                n, total = want.get((s, day), (0, 0.0))
                want[s, day] = (n + 1, total + (frp or 0.0))
    got = {(r["site_id"], r["date"]): (r["fire_count"], r["fire_frp_sum"]) for r in fire.site_fire_counts(df, site_df, radius_km=2000.0, leaf_points=20).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_classes_hold_for_every_point(world):
    _, df, sites, site_df = world
    tree = cells.quadtree(df, 20)
    met = {(r["site_id"], r["leaf"]): r["inside"] for r in cells.site_leaves(site_df, tree, ["site_id"], 2000.0).collect()}
    assert any(met.values()) and not all(met.values())
    for r in cells.in_leaves(df, tree).select("latitude", "longitude", "leaf").collect():
        for s, a, b in sites:
            near = apart(a, b, r["latitude"], r["longitude"]) <= 2000.0
            if met.get((s, r["leaf"])):
                assert near
            elif (s, r["leaf"]) not in met:
                assert not near


def test_tree_splits_where_points_are_many():
    counts = np.zeros((cells.SIDE, cells.SIDE), dtype=np.int64)
    counts[0, 0], counts[200, 200], counts[201, 200] = 3, 50, 60
    level = cells.leaf_levels(counts, 100)
    assert level[0, 0] == 1 and level[200, 200] == level[201, 200] == cells.DEPTH  # 110 points in one parent cell
    assert cells.leaf_levels(counts, 1000).max() == 0
    for at in range(cells.DEPTH + 1):  # leaves are whole cells of their level
        on = level == at
        size = cells.SIDE >> at
        blocks = on.reshape(1 << at, size, 1 << at, size)
        assert (blocks.all(axis=(1, 3)) == blocks.any(axis=(1, 3))).all()


def test_plan(world):
    _, df, _, site_df = world
    near = fire.fires_near_sites(df, site_df)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    pairwise = [line for line in plan.splitlines() if "ASIN" in line and "latitude#" in line]
    assert len(pairwise) == 1 and "Generate explode(filter(array(" in pairwise[0]  # one distance for each pair, none in a join
    assert near.where(F.col("distance_km") > 400.0001).isEmpty()
