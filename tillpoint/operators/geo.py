"""Nearest store per customer: an adaptive grid (quadtree) searched with
equi-joins — no cross join, and no cell that grows with a hot spot.

Index.  Stores (identical coordinates collapsed, smallest id kept — the one
the tie rule would pick) are counted in root cells of ``root_degrees``; a
cell holding more than ``leaf_capacity`` stores is split into four at the
next level, until every store sits in a leaf (or ``max_depth`` is reached).
One pass counts six levels at once (a grouped count, a semi join with the
overfull parents), so the stores of most maps are indexed by one pass; only
stores still in overfull cells go into the next.  Each node keeps a
representative store.

Search.
1. *Upper bound*: the representatives of the root cells (at most 40, a
   constant of the plan) and of the cells on the customer's own path give a
   distance that the nearest store cannot exceed.
2. *Exact pass*: the tree is descended level by level from the root cells
   that meet the bounding box of the spherical cap with that radius
   (latitude ± δ, longitude ± asin(sin δ / cos φ), the whole circle when the
   cap holds a pole).  Each round replaces an inner cell by its children that
   meet the box and keeps a leaf; the leaves reached are scanned.  Every store
   within the bound is therefore examined, so the arg-min — distance, then
   store_id — equals brute force.  Work per customer is the leaves near it
   times ``leaf_capacity``, whatever the density elsewhere.

Each round reads the one before once, so rounds form one plan; every fourth is
checkpointed into the shared folder (short lineage).  Joins are on a cell with
the tree, which has one row per cell: customers of one crowded cell are spread
by AQE (a broadcast of a small tree, else a split of the crowded partition).
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.geo import EARTH_RADIUS_KM, haversine_km
from tillpoint.session import cut_lineage

#: Tree levels that one pass over the stores counts.
LEVELS = 6


def _cy(lat: Column, g) -> Column:
    return F.floor(lat / g).cast("long")


def build_store_index(stores: DataFrame, leaf_capacity: int = 32, max_depth: int = 24,
                      root_degrees: float = 45.0):
    """(nodes, leaf_stores, g0, n0, depth).

    nodes: (l, cy, cx, cnt, is_leaf, rep_id, rep_lat, rep_lon) for every
    cell of the tree; leaf_stores: stores with the (l, cy, cx) of their leaf.
    """
    n0 = int(math.ceil(360.0 / root_degrees))
    g0 = 360.0 / n0
    store, cell = ["store_id", "store_lat", "store_lon"], ["l", "cy", "cx"]
    side = F.pow(F.lit(2.0), F.col("l"))
    active = cut_lineage(stores.groupBy("store_lat", "store_lon").agg(F.min("store_id").alias("store_id")))
    node_parts, leaf_parts = [], []
    for top in range(0, max_depth + 1, LEVELS):
        low = min(max_depth, top + LEVELS - 1)
        cells = active.withColumn("l", F.explode(F.sequence(F.lit(top), F.lit(low)))).select(
            *store, "l", _cy(F.col("store_lat"), g0 / side).alias("cy"),
            F.pmod(F.floor(F.col("store_lon") * side / F.lit(g0)).cast("long"), (F.lit(n0) * side).cast("long")).alias("cx"))
        counts = cut_lineage(cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("cnt"), F.min(F.struct(*store)).alias("rep")))
        fits = (F.col("cnt") <= leaf_capacity) | (F.col("l") == max_depth)
        # a cell is in the tree if its parent is overfull (then so are all above it); a store's leaf is its first cell that fits
        overfull = counts.filter(~fits).select((F.col("l") + 1).alias("pl"), F.col("cy").alias("py"), F.col("cx").alias("px"))
        inside = counts.join(overfull, (F.col("l") == F.col("pl")) & (F.shiftright("cy", 1) == F.col("py"))
                             & (F.shiftright("cx", 1) == F.col("px")), "left_semi").union(counts.filter(F.col("l") == top))
        node_parts.append(inside.select(*cell, "cnt", fits.alias("is_leaf"), F.col("rep.store_id").alias("rep_id"),
                                        F.col("rep.store_lat").alias("rep_lat"), F.col("rep.store_lon").alias("rep_lon")))
        placed = cut_lineage(cells.join(counts.select(*cell, "cnt"), cell).groupBy(*store)
                             .agg(F.min(F.when(fits, F.struct(*cell))).alias("leaf")))
        leaf_parts.append(placed.filter("leaf is not null").select("leaf.*", *store))
        active = placed.filter("leaf is null").select(*store)
        if active.isEmpty():
            break
    nodes = cut_lineage(functools.reduce(DataFrame.unionByName, node_parts))
    leaves = functools.reduce(DataFrame.unionByName, leaf_parts)
    depth = nodes.agg(F.max("l")).first()[0] or 0
    return nodes, leaves, g0, n0, depth


def _cap_box(ub: Column, lat: Column, lon: Column):
    """Bounding box (degrees) of the spherical cap of radius ``ub`` km."""
    delta = ub / F.lit(EARTH_RADIUS_KM) * F.lit(1 + 1e-9) + F.lit(1e-12)      # radians, slightly inflated
    d_deg = F.degrees(delta)
    lat_lo, lat_hi = lat - d_deg, lat + d_deg
    ratio = F.sin(delta) / F.cos(F.radians(lat))
    full = (lat_hi >= 90.0) | (lat_lo <= -90.0) | (ratio >= 1.0)
    dlon = F.degrees(F.asin(F.least(F.lit(1.0), ratio)))
    return lat_lo, lat_hi, lon - dlon, lon + dlon, full


def _meets_box(cy: Column, cx: Column, g: float) -> Column:
    """Does cell (cy, cx) of size g meet the customer's box?"""
    lat_ok = (cy * F.lit(g) <= F.col("lat_hi")) & ((cy + 1) * F.lit(g) > F.col("lat_lo"))
    off = F.pmod(cx * F.lit(g) - F.col("lon_lo"), F.lit(360.0))        # cell start relative to the box start
    lon_ok = F.col("full_lon") | (off <= F.col("lon_hi") - F.col("lon_lo")) | (off + F.lit(g) > F.lit(360.0))
    return lat_ok & lon_ok


def nearest_store(customers: DataFrame, stores: DataFrame, leaf_capacity: int = 32,
                  max_depth: int = 24, root_degrees: float = 45.0) -> DataFrame:
    """(customer_id, nearest_store_id, nearest_store_distance); customers are
    kept (with NULLs) when there are no stores or they have no coordinates.

    The plan holds (180 / root_degrees + 1) * 360 / root_degrees root cells."""
    nodes, leaves, g0, n0, depth = build_store_index(stores, leaf_capacity, max_depth, root_degrees)
    cust = customers.select("customer_id", "customer_lat", "customer_lon")
    lat, lon = F.col("customer_lat"), F.col("customer_lon")
    on_globe = F.col("cy").between(math.floor(-90.0 / g0), math.floor(90.0 / g0))
    roots = nodes.filter(F.col("l").eqNullSafe(0) & on_globe).collect()
    if not roots:
        return cust.select("customer_id", F.lit(None).cast(stores.schema["store_id"].dataType).alias("nearest_store_id"),
                           F.lit(None).cast("double").alias("nearest_store_distance"))
    root_cells = F.array(*[F.struct(F.lit(0).alias("l"), F.lit(r.cy).alias("cy"), F.lit(r.cx).alias("cx"),
                                    F.lit(r.is_leaf).alias("is_leaf"), F.lit(r.rep_lat).alias("rep_lat"),
                                    F.lit(r.rep_lon).alias("rep_lon")) for r in roots])

    # ---- 1. upper bound from representatives (every root cell + own path)
    point = ["customer_id", "customer_lat", "customer_lon"]
    bound = F.array_min(F.transform(root_cells, lambda r: haversine_km(lat, lon, r["rep_lat"], r["rep_lon"])))
    bounded = cust.filter(lat.isNotNull() & lon.isNotNull()).withColumn("ub", bound)
    if depth:
        side = F.pow(F.lit(2.0), F.col("l"))
        path = bounded.withColumn("l", F.explode(F.sequence(F.lit(1), F.lit(depth)))).withColumns({
            "cy": _cy(lat, g0 / side), "cx": F.pmod(F.floor(lon * side / F.lit(g0)).cast("long"), (F.lit(n0) * side).cast("long"))})
        near = path.join(nodes.select("l", "cy", "cx", "rep_lat", "rep_lon"), ["l", "cy", "cx"], "left")
        bounded = near.groupBy(*point).agg(
            F.least(F.min("ub"), F.min(haversine_km("customer_lat", "customer_lon", "rep_lat", "rep_lon"))).alias("ub"))
    lat_lo, lat_hi, lon_lo, lon_hi, full = _cap_box(F.col("ub"), lat, lon)
    boxed = bounded.select(*point, lat_lo.alias("lat_lo"), lat_hi.alias("lat_hi"),
                           lon_lo.alias("lon_lo"), lon_hi.alias("lon_hi"), full.alias("full_lon"))

    # ---- 2. descend the tree inside each customer's box
    box = boxed.columns
    hit = F.filter(root_cells, lambda r: _meets_box(r["cy"], r["cx"], g0))
    reached = boxed.select(*box, F.explode(hit).alias("c")).select(*box, "c.l", "c.cy", "c.cx", "c.is_leaf")
    tree = nodes.select("l", "cy", "cx", "is_leaf")
    for level in range(depth):
        def cell(down, dy, dx):
            return F.struct((F.col("l") + down).alias("l"), (F.col("cy") * (1 + down) + dy).alias("cy"),
                            (F.col("cx") * (1 + down) + dx).alias("cx"))

        kids = F.filter(F.array(*[cell(1, a, b) for a in (0, 1) for b in (0, 1)]),
                        lambda k: _meets_box(k["cy"], k["cx"], g0 / 2 ** (level + 1)))  # noqa: B023
        step = F.explode(F.when(F.col("is_leaf"), F.array(cell(0, 0, 0))).otherwise(kids))
        reached = reached.select(*box, step.alias("c")).select(*box, "c.l", "c.cy", "c.cx").join(tree, ["l", "cy", "cx"])
        if level % 4 == 3:
            reached = cut_lineage(reached)
    cand = reached.select(*point, "l", "cy", "cx").join(leaves, ["l", "cy", "cx"]).select(
        "customer_id", F.struct(haversine_km("customer_lat", "customer_lon", "store_lat", "store_lon").alias("d"), "store_id").alias("s"))
    best = cand.groupBy("customer_id").agg(F.min("s").alias("b"))
    return cust.join(best, "customer_id", "left").select(
        "customer_id", F.col("b.store_id").alias("nearest_store_id"),
        F.col("b.d").alias("nearest_store_distance"))
