"""Nearest candidates by great-circle distance.

The planar search of ``weather.py`` bounds cells in degrees, which fails at the
date line and the poles. Here places are points of the unit sphere in space:
the straight (chord) distance grows with the great-circle distance, so an octree over
the cube around the sphere gives exact bounds everywhere without special cases. The
search is the same branch and bound by equi-joins: a store's own cells bound its
k-th distance, the 3 x 3 x 3 block of cells as wide as that bound covers it, and
cells with many places are refined while their boxes can beat the bound.

Defined results: latitudes beyond 90 degrees and coordinates that are NULL, NaN or infinite
are left out; longitudes are taken modulo 360, and at a pole all longitudes are one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.operators.weather import _empty_result, _finite
from bandwise.session import checkpointed

EARTH_KM = 6371.0088  # mean radius
LEVELS = 24  # octree levels; the finest cell is under a metre wide
STEP = 2  # levels refined in one round
COARSE = 4  # cells up to this level are few (4,681 at most) whatever the input: only they are sent to every task
LEAF_POINTS = 16  # a cell with at most this many distinct places is not refined further
MARGIN = 1e-9  # of a chord (6 mm): rounding, and distances that count as ties
_AXES = ("x", "y", "z")
_CELL = ["level", "cx", "cy", "cz"]


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in kilometres of places given in degrees."""
    a, b = F.sin(F.radians(lat1 - lat2) / 2), F.sin(F.radians(lng1 - lng2) / 2)
    h = a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _loose(bound: Column) -> Column:
    return bound * (1 + 1e-9) + MARGIN


def _big() -> Column:
    """Cells that are refined: many places, and cells STEP levels down exist."""
    return (F.col("places") > LEAF_POINTS) & (F.col("level") <= LEVELS - STEP)


def _longitude(lat: Column, lng: Column) -> Column:
    """The longitude in [-180, 180); 0 at a pole."""
    inside = F.when((lng >= -180) & (lng < 180), lng).otherwise(F.pmod(lng + 180, F.lit(360.0)) - 180)
    return F.when(F.abs(lat) == 90, F.lit(0.0)).otherwise(inside)


def _placed(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """The rows with usable coordinates, as _la, _lo and a point x, y, z."""
    ok = df.filter(_finite(lat, lng) & (F.abs(F.col(lat).cast("double")) <= 90))
    ok = ok.withColumn("_la", F.col(lat).cast("double"))
    return ok.withColumn("_lo", _longitude(F.col("_la"), F.col(lng).cast("double")))


def _point(df: DataFrame) -> DataFrame:
    la, lo = F.radians("_la"), F.radians("_lo")
    return df.withColumns({"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)})


def _on_levels(points: DataFrame) -> DataFrame:
    """Every point once for each level, with its cell there."""
    out = points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    wide = F.pow(F.lit(2.0), F.col("level"))
    last = wide.cast("long") - 1
    return out.withColumns({f"c{a}": F.least(F.floor((F.col(a) + 1) / 2 * wide), last) for a in _AXES})


def _inner() -> Column:
    """Chord from a store to the nearest point of a cell's box of places."""
    gaps = [F.greatest(F.col(f"{a}0") - F.col(f"_s{a}"), F.col(f"_s{a}") - F.col(f"{a}1"), F.lit(0.0)) for a in _AXES]
    return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))


def _outer() -> Column:
    """Chord from a store to the farthest corner of a cell's box of places."""
    gaps = [F.greatest(F.abs(F.col(f"_s{a}") - F.col(f"{a}0")), F.abs(F.col(f"_s{a}") - F.col(f"{a}1"))) for a in _AXES]
    return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))


def _prune(frontier: DataFrame, k: int) -> DataFrame:
    """Tighten each store's bound by the boxes that end first and drop cells beyond it."""
    by_end = Window.partitionBy("_sk").orderBy("_end", *_CELL).rowsBetween(Window.unboundedPreceding, 0)
    counted = frontier.withColumn("_upto", F.sum("n").over(by_end))
    enough = F.min(F.when(F.col("_upto") >= k, F.col("_end"))).over(Window.partitionBy("_sk"))
    tight = counted.withColumn("_ub", F.least("_ub", F.coalesce(enough, F.col("_ub")))).drop("_upto")
    return tight.filter(_inner() <= _loose(F.col("_ub")))


def _at_cells(stores: DataFrame, cells: DataFrame, on: list[str], level: str = "level") -> DataFrame:
    """Equi-join on cells: the few coarse ones, which all stores share, go to every task; finer ones are merged, as they grow with the input."""
    coarse = F.col(level) <= COARSE
    near = stores.filter(coarse).join(F.broadcast(cells.filter(coarse)), on)
    return near.unionByName(stores.filter(~coarse).join(cells.filter(~coarse).hint("merge"), on))


_STORE = ["_sk", "_la", "_lo", "_sx", "_sy", "_sz"]


def _frontier(sto: DataFrame, cells: DataFrame, k: int, total: int) -> DataFrame:
    """Every store with the cells that may hold one of its k nearest, before refinement."""
    points = sto.withColumns({a: F.col(f"_s{a}") for a in _AXES})
    rich = cells.filter(F.col("n") >= min(total, k))  # at least the root
    bounds = _at_cells(_on_levels(points).drop(*_AXES), rich, _CELL).groupBy(*_STORE).agg(F.min(_outer()).alias("_ub"))
    level = F.floor(F.log2(F.lit(2.0) / F.greatest(_loose(F.col("_ub")), F.lit(2.0**-LEVELS))))
    around = bounds.withColumn("level", F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS)).cast("int"))
    wide = F.pow(F.lit(2.0), F.col("level"))
    last = wide.cast("long") - 1
    near = around
    for a in _AXES:
        own = F.least(F.floor((F.col(f"_s{a}") + 1) / 2 * wide), last)
        near = near.withColumn(f"c{a}", F.explode(F.sequence(own - 1, own + 1)))
    return _prune(_at_cells(near, cells, _CELL).withColumn("_end", _outer()), k)


def _refined(frontier: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """Cells with many places replaced by their occupied descendants STEP levels down."""
    big = _big()
    wide = F.lit(1 << STEP)
    parent = [F.floor(F.col(c) / wide).alias(f"p{c}") for c in _CELL[1:]]
    below = cells.filter(F.col("level") >= STEP).select("*", (F.col("level") - STEP).alias("plevel"), *parent)
    above = frontier.filter(big).select(*_STORE, "_ub", *[F.col(c).alias(f"p{c}") for c in _CELL])
    children = _at_cells(above, below, [f"p{c}" for c in _CELL], "plevel").drop(*[f"p{c}" for c in _CELL]).withColumn("_end", _outer())
    return _prune(frontier.filter(~big).unionByName(children), k)


def nearest_on_sphere(
    stores: DataFrame,
    candidates: DataFrame,
    k: int = 1,
    store_key: str = "BranchCode",
    store_lat: str = "lat",
    store_lng: str = "lng",
    cand_lat: str = "lat",
    cand_lng: str = "lon",
    tie_break: tuple[str, ...] = ("name",),
) -> DataFrame:
    """The ``k`` nearest candidates of every store by great-circle distance, exactly.

    Returns the store key, all candidate columns, ``dis_km`` and ``rank`` (1..k; distances that agree
    to a millimetre are ties, broken by ``tie_break``; near the antipode the formula itself is good to
    decimetres only). Store keys are expected to be unique.
    """
    sto = _point(_placed(stores.select(F.col(store_key).alias("_sk"), F.col(store_lat).alias("_a"), F.col(store_lng).alias("_o")), "_a", "_o"))
    sto = sto.select("_sk", "_la", "_lo", *[F.col(a).alias(f"_s{a}") for a in _AXES])
    cols = list(candidates.columns)
    cands = checkpointed(_placed(candidates, cand_lat, cand_lng))
    at_place = Window.partitionBy("_la", "_lo").orderBy(*tie_break)
    best = cands.withColumn("_place", F.row_number().over(at_place)).filter(F.col("_place") <= k).drop("_place")
    points = checkpointed(_point(cands.groupBy("_la", "_lo").agg(F.count(F.lit(1)).alias("_n"))))
    total = points.agg(F.sum("_n")).first()[0]
    if total is None:
        none = _empty_result(sto, cands.select(*cols), store_key)
        return none.drop("avg_rank").withColumnRenamed("dis_store", "dis_km")
    placed = _on_levels(points)
    box = [f(a).alias(f"{a}{i}") for a in _AXES for i, f in enumerate((F.min, F.max))]
    cells = checkpointed(placed.groupBy(*_CELL).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("places"), *box))
    frontier = checkpointed(_frontier(sto, cells, k, total))
    for _ in range(LEVELS // STEP + 1):
        if frontier.filter(_big()).isEmpty():
            break
        frontier = checkpointed(_refined(frontier, cells, k))
    places = placed.select(*_CELL, F.col("_la").alias("_pa"), F.col("_lo").alias("_po"))
    leaves = F.broadcast(cells.filter(~_big() & (F.col("level") <= COARSE)).select(*_CELL))  # of at most LEAF_POINTS places each
    places = places.filter(F.col("level") > COARSE).unionByName(places.filter(F.col("level") <= COARSE).join(leaves, _CELL, "left_semi"))
    near = _at_cells(frontier.select("_sk", "_la", "_lo", *_CELL), places, _CELL).drop(*_CELL)
    near = near.withColumn("dis_km", haversine_km(F.col("_la"), F.col("_lo"), F.col("_pa"), F.col("_po"))).drop("_la", "_lo")
    shown = near.join(best.withColumnsRenamed({"_la": "_pa", "_lo": "_po"}).hint("merge"), ["_pa", "_po"])
    order = Window.partitionBy("_sk").orderBy(F.round("dis_km", 6), *tie_break)
    shown = shown.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return shown.select(F.col("_sk").alias(store_key), *cols, "dis_km", "rank")
