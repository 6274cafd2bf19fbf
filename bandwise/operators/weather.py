"""Store locations, latest station weather, and nearest station per store.

The original module crosses every store with every station (a dummy-key merge in
pandas), ranks by distance, and keeps all pairs. Here the nearest-station
search is an exact branch-and-bound over a grid pyramid of the stations, built
from equi-joins. Cells that hold stations are counted on every grid level. A
store's own cells give a first bound on its k-th distance; it then meets only the few
cells that can beat the bound, and cells with many stations are refined until
few remain. So cells follow the occupancy: an outlier station, a dense town
or a store far from everything costs a store no more than a few cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.functions.calendar import cast_to
from bandwise.functions.scoring import planar_distance
from bandwise.session import checkpointed

LEVELS = 24  # grid levels; a cell of the finest is the extent / 2**24 wide
STEP = 2  # levels refined in one round (up to 16 children for each cell)
LEAF_POINTS = 16  # a cell with at most this many distinct places is not refined further


def store_location(raw: DataFrame) -> DataFrame:
    """Store master (code, lat, lng) -> (BranchCode, lat, lng); every store is kept."""
    return raw.select(cast_to(raw, "code", "int").alias("BranchCode"), "lat", "lng")


def weather_latest(
    weather: DataFrame, stations: DataFrame, country: str = "TH", year: int | str | None = None
) -> DataFrame:
    """Daily weather of the country's stations, only each station name's latest date.

    = weather LEFT JOIN stations ON stn = usaf, WHERE stn IN (stations of
    ``country``), keeping rows whose date equals MAX(date) of their station
    name (ties kept, NULL names dropped). ``year`` filters the date first, as a
    range that reaches the scan (and as a partition filter when weather is
    partitioned by year); ``"today"`` means the current year, as the original query did.
    """
    w = weather
    if year is not None:
        if "year" in w.columns:
            w = w.filter(F.col("year") == (F.year(F.current_date()) if year == "today" else F.lit(year)))
        elif year == "today":
            first = F.trunc(F.current_date(), "year")
            w = w.filter((F.col("date") >= first) & (F.col("date") < F.add_months(first, 12)))
        else:
            w = w.filter((F.col("date") >= F.lit(f"{int(year):04d}-01-01")) & (F.col("date") < F.lit(f"{int(year) + 1:04d}-01-01")))
    local = stations.filter(F.col("country") == country).select(F.col("usaf").alias("_usaf")).distinct()
    w = w.join(local, w["stn"] == F.col("_usaf"), "left_semi")
    meta = stations.filter(F.col("name").isNotNull()).select(F.col("usaf").alias("_st_usaf"), "name", "lat", "lon")
    w = w.join(meta, w["stn"] == F.col("_st_usaf")).drop("_st_usaf")
    # one scan of the weather: the rank limit is applied before the shuffle as well
    place = F.rank().over(Window.partitionBy("name").orderBy(F.desc("date")))
    return w.filter(F.col("date").isNotNull()).withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _finite(*columns: str) -> Column:
    ok = F.lit(True)
    for c in columns:
        v = F.col(c).cast("double")
        ok = ok & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return ok


class _Grid:
    """Cell numbers over the candidates' extent; level 0 is one cell."""

    def __init__(self, lat0: float, lat1: float, lng0: float, lng1: float):
        self.lat0, self.lat1, self.lng0, self.lng1 = lat0, lat1, lng0, lng1
        self.width = max(lat1 - lat0, lng1 - lng0, 1e-9) * (1 + 1e-9)

    def finest(self, lat: Column, lng: Column) -> tuple[Column, Column]:
        """The finest cell of a place (places outside the extent take the nearest cell)."""

        def cell(v, low, high):
            inside = F.least(F.greatest(v, F.lit(low)), F.lit(high)) - F.lit(low)
            return F.least(F.floor(inside / self.width * (1 << LEVELS)), F.lit((1 << LEVELS) - 1)).cast("long")

        return cell(lat, self.lat0, self.lat1), cell(lng, self.lng0, self.lng1)


def _outer(lat: str, lng: str) -> Column:
    """Distance from a store to the farthest corner of a cell's box of places."""
    dy = F.greatest(F.abs(F.col(lat) - F.col("a0")), F.abs(F.col(lat) - F.col("a1")))
    dx = F.greatest(F.abs(F.col(lng) - F.col("o0")), F.abs(F.col(lng) - F.col("o1")))
    return F.sqrt(dx * dx + dy * dy)


def _inner(lat: str, lng: str) -> Column:
    """Distance from a store to the nearest edge of a cell's box of places."""
    dy = F.greatest(F.col("a0") - F.col(lat), F.col(lat) - F.col("a1"), F.lit(0.0))
    dx = F.greatest(F.col("o0") - F.col(lng), F.col(lng) - F.col("o1"), F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def _loose(bound: Column) -> Column:
    """A bound with a margin for rounding."""
    return bound * (1 + 1e-9) + 1e-12


def _prune(frontier: DataFrame, k: int) -> DataFrame:
    """Tighten each store's bound (the cells whose boxes end first hold k candidates) and drop cells beyond it."""
    by_end = Window.partitionBy("_sk").orderBy("_end", "level", "cx", "cy").rowsBetween(Window.unboundedPreceding, 0)
    counted = frontier.withColumn("_upto", F.sum("n").over(by_end))
    enough = F.min(F.when(F.col("_upto") >= k, F.col("_end"))).over(Window.partitionBy("_sk"))
    tight = counted.withColumn("_ub", F.least("_ub", F.coalesce(enough, F.col("_ub")))).drop("_upto")
    return tight.filter(_inner("_slat", "_slng") <= _loose(F.col("_ub")))


_CELL = ["level", "cx", "cy"]


def _cells(points: DataFrame, grid: _Grid, cand_lat: str, cand_lng: str) -> tuple[DataFrame, DataFrame]:
    """(every place on every level, cells with number of candidates, number of places and box)."""
    cx, cy = grid.finest(F.col(cand_lat), F.col(cand_lng))
    placed = points.withColumns({"_fx": cx, "_fy": cy}).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    shift = F.pow(F.lit(2.0), F.lit(LEVELS) - F.col("level"))
    placed = placed.withColumns({"cx": F.floor(F.col("_fx") / shift), "cy": F.floor(F.col("_fy") / shift)}).drop("_fx", "_fy")
    cells = placed.groupBy(*_CELL).agg(
        F.sum("_n").alias("n"),
        F.count(F.lit(1)).alias("places"),
        F.min(cand_lat).alias("a0"),
        F.max(cand_lat).alias("a1"),
        F.min(cand_lng).alias("o0"),
        F.max(cand_lng).alias("o1"),
    )
    return placed, cells


def _frontier(sto: DataFrame, cells: DataFrame, grid: _Grid, k: int, total: int) -> DataFrame:
    """Every store with the cells that may hold one of its k nearest of ``total`` candidates, before refinement."""
    fx, fy = grid.finest(F.col("_slat"), F.col("_slng"))
    path = sto.withColumns({"_fx": fx, "_fy": fy}).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    shift = F.pow(F.lit(2.0), F.lit(LEVELS) - F.col("level"))
    path = path.withColumns({"cx": F.floor(F.col("_fx") / shift), "cy": F.floor(F.col("_fy") / shift)})
    rich = cells.filter(F.col("n") >= min(total, k))  # at least the root
    bounds = path.join(rich, _CELL).groupBy("_sk", "_slat", "_slng", "_fx", "_fy").agg(F.min(_outer("_slat", "_slng")).alias("_ub"))
    # the finest level whose cells are at least as wide as the bound: the 3 x 3 block covers it
    level = F.floor(F.log2(F.lit(grid.width) / F.greatest(_loose(F.col("_ub")), F.lit(grid.width / (1 << LEVELS)))))
    around = bounds.withColumn("level", F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS)).cast("int"))
    shift = F.pow(F.lit(2.0), F.lit(LEVELS) - F.col("level"))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    probes = around.withColumn("_nb", F.explode(offsets)).select(
        "_sk", "_slat", "_slng", "_ub", "level", (F.floor(F.col("_fx") / shift) + F.col("_nb.dx")).alias("cx"), (F.floor(F.col("_fy") / shift) + F.col("_nb.dy")).alias("cy")
    )
    return _prune(probes.join(cells, _CELL).withColumn("_end", _outer("_slat", "_slng")), k)


def _refined(frontier: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """Cells with many places replaced by their descendants STEP levels down."""
    down = F.least(F.lit(STEP), F.lit(LEVELS) - F.col("level"))
    big = (F.col("places") > LEAF_POINTS) & (F.col("level") < LEVELS)
    grid_steps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(1 << STEP) for y in range(1 << STEP)])
    wide = F.pow(F.lit(2.0), down).cast("long")
    children = (
        frontier.filter(big)
        .withColumn("_c", F.explode(grid_steps))
        .filter((F.col("_c.x") < wide) & (F.col("_c.y") < wide))
        .select("_sk", "_slat", "_slng", "_ub", (F.col("level") + down).alias("level"), (F.col("cx") * wide + F.col("_c.x")).alias("cx"), (F.col("cy") * wide + F.col("_c.y")).alias("cy"))
        .join(cells, _CELL)
        .withColumn("_end", _outer("_slat", "_slng"))
    )
    return _prune(frontier.filter(~big).unionByName(children), k)


def _pairs(frontier: DataFrame, placed: DataFrame, cand_lat: str, cand_lng: str) -> DataFrame:
    """The candidates that can be among a store's k nearest, with their distance."""
    near = frontier.select("_sk", "_slat", "_slng", "_ub", *_CELL).join(placed, _CELL).drop(*_CELL)
    near = near.withColumn("dis_store", planar_distance(F.col("_slat"), F.col("_slng"), F.col(cand_lat), F.col(cand_lng)))
    return near.filter(F.col("dis_store") <= _loose(F.col("_ub")))


def nearest_station(
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
    """The ``k`` nearest candidates of every store (planar distance in degrees).

    Returns the store key, all candidate columns, ``dis_store``, ``rank``
    (1..k, ties broken by ``tie_break``) and ``avg_rank`` (the average rank of
    ties, i.e. pandas ``rank()``). Exact. Stores and candidates whose coordinates are
    NULL, NaN or infinite are left out; store keys are expected to be unique.
    """
    sto = stores.select(
        F.col(store_key).alias("_sk"), F.col(store_lat).cast("double").alias("_slat"), F.col(store_lng).cast("double").alias("_slng")
    ).filter(_finite("_slat", "_slng"))
    cols = list(candidates.columns)
    # read twice below: the candidates are a dimension, often an aggregate of something larger
    cands = checkpointed(
        candidates.filter(_finite(cand_lat, cand_lng)).withColumns({"_la": F.col(cand_lat).cast("double"), "_lo": F.col(cand_lng).cast("double")})
    )
    # of the candidates at one place only the best k can be reported; the place remembers how many there are
    at_place = Window.partitionBy("_la", "_lo").orderBy(*tie_break)
    best = cands.withColumn("_place", F.row_number().over(at_place)).filter(F.col("_place") <= k)
    points = checkpointed(cands.groupBy("_la", "_lo").agg(F.count(F.lit(1)).alias("_n")))
    ext = points.agg(F.min("_la"), F.max("_la"), F.min("_lo"), F.max("_lo"), F.sum("_n")).first()
    if ext[0] is None:
        return _empty_result(sto, cands.select(*cols), store_key)
    grid = _Grid(*(float(x) for x in ext[:4]))
    placed, cells = _cells(points, grid, "_la", "_lo")
    cells = checkpointed(cells)
    frontier = checkpointed(_frontier(sto, cells, grid, k, ext[4]))
    for _ in range(LEVELS // STEP + 1):
        if frontier.filter((F.col("places") > LEAF_POINTS) & (F.col("level") < LEVELS)).isEmpty():
            break
        frontier = checkpointed(_refined(frontier, cells, k))
    else:
        raise RuntimeError("the grid refinement did not end")  # every round goes STEP levels down
    near = _pairs(frontier, placed, "_la", "_lo")
    # places strictly closer, and candidates at the same distance, give the average rank of ties
    by_dist = Window.partitionBy("_sk").orderBy("dis_store")
    ranked = near.withColumns(
        {
            "_upto": F.sum("_n").over(by_dist),  # up to and with this distance
            "_ties": F.sum("_n").over(Window.partitionBy("_sk", "dis_store")),
        }
    ).filter(F.col("_upto") - F.col("_ties") < k)
    shown = ranked.join(best, ["_la", "_lo"])
    order = Window.partitionBy("_sk").orderBy("dis_store", *tie_break)
    shown = shown.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    closer = F.col("_upto") - F.col("_ties")
    return shown.select(
        F.col("_sk").alias(store_key), *cols, "dis_store", "rank", (closer + (F.col("_ties") + 1) / 2.0).alias("avg_rank")
    )


def _empty_result(sto: DataFrame, cands: DataFrame, store_key: str) -> DataFrame:
    """No rows, with the columns and types of a result."""
    none = sto.filter(F.lit(False)).select(F.col("_sk").alias(store_key), *[F.lit(None).cast(f.dataType).alias(f.name) for f in cands.schema])
    return none.withColumns(
        {"dis_store": F.lit(None).cast("double"), "rank": F.lit(None).cast("int"), "avg_rank": F.lit(None).cast("double")}
    )


def map_weather_to_store(stores: DataFrame, latest_weather: DataFrame, k: int = 1) -> DataFrame:
    """(BranchCode, name, temp) from each store's nearest latest-weather station."""
    near = nearest_station(stores, latest_weather, k=k)
    return near.select("BranchCode", "name", "temp")
