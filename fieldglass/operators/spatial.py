"""Kernel densities on a grid of degrees, hot spots, nearest points and nested places."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.geo import EARTH_RADIUS_KM, KM_PER_DEGREE, gaussian_density, haversine_km, inside, log2_risk
from fieldglass.staging import stage

#: Points up to this many are broadcast to look for the nearest; the result is the same beyond.
MAX_BROADCAST_POINTS = 4_000


def cell_lat(i: Column, step: float) -> Column:
    return i * step - (90 - step / 2)


def cell_lon(j: Column, step: float) -> Column:
    return j * step - (180 - step / 2)


def kde(points: DataFrame, lat: str, lon: str, weight: str, step: float, bandwidth_km: float, cutoff: float = 4.0) -> DataFrame:
    """(i, j, density): weight per square km at the centres of a grid's cells, by a Gaussian kernel cut off at `cutoff`
    bandwidths. Rows count from the south, columns from the west, around the globe.

    Each place makes rows for the cells in its window only, never for all; places are summed first.
    """
    ny, nx, reach = round(180 / step), round(360 / step), cutoff * bandwidth_km
    places = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).agg(F.sum(weight).alias("w"))
    up = reach / KM_PER_DEGREE
    row = lambda at: F.ceil((at - (step / 2 - 90)) / step)
    low, high = F.greatest(row(F.col("lat") - up), F.lit(0)), F.least(row(F.col("lat") + up), F.lit(ny))
    wide = F.least(F.lit(reach) / (KM_PER_DEGREE * F.greatest(F.cos(F.radians("lat")), F.lit(1e-6))), F.lit(180.0))
    span = F.least(F.ceil(wide / step) + 1, F.lit((nx - 1) // 2)).cast("int")
    middle = F.rint((F.col("lon") - (step / 2 - 180)) / step).cast("int")
    cells = places.where(low < high).select("*", F.explode(F.sequence(low, high - 1)).alias("i")).select("*", F.explode(F.sequence(middle - span, middle + span)).alias("column"))
    cells = cells.withColumn("j", F.pmod("column", F.lit(nx))).withColumn("i", F.col("i").cast("int"))
    km = haversine_km(F.col("lat"), F.col("lon"), cell_lat(F.col("i"), step), cell_lon(F.col("j"), step))
    near = cells.select("i", "j", "w", km.alias("km")).where(F.col("km") <= reach)
    return near.groupBy("i", "j").agg(F.sum(gaussian_density(F.col("w"), F.col("km"), bandwidth_km)).alias("density"))


def relative_risk(part: DataFrame, base: DataFrame, columns: tuple[str, str, str], *, step: float = 0.25, bandwidth_km: float = 75.0, least_base: float = 1.0, smoothing: float = 50.0, cutoff: float = 4.0) -> DataFrame:
    """(i, j, part, base, log2_risk): the density of `part` over that of `base` at the overall rate, smoothed, where the
    base's density is at least `least_base`. `columns` are latitude, longitude and weight of both."""
    weight = columns[2]
    some, all_ = part.agg(F.sum(weight)).first()[0] or 0, base.agg(F.sum(weight)).first()[0] or 0
    if not some or not all_:
        return kde(base, *columns, step, bandwidth_km, cutoff).where("false").selectExpr("i", "j", "density part", "density base", "density log2_risk")
    p = kde(part, *columns, step, bandwidth_km, cutoff).withColumnRenamed("density", "part")
    q = kde(base, *columns, step, bandwidth_km, cutoff).withColumnRenamed("density", "base").where(F.col("base") >= least_base)
    both = q.join(p, ["i", "j"], "left").na.fill(0.0, ["part"])
    return both.select("i", "j", "part", "base", log2_risk(F.col("part"), F.col("base"), F.lit(float(some) / float(all_)), smoothing).alias("log2_risk"))


def local_maxima(cells: DataFrame, value: str, reach: int) -> DataFrame:
    """Cells (i, j) whose value is the largest in the square of `reach` cells around; the square doesn't go around the
    globe. Largest over rows first, then over columns."""
    rows = cells.select(F.explode(F.sequence(F.col("i") - reach, F.col("i") + reach)).alias("i"), "j", value).groupBy("i", "j").agg(F.max(value).alias("most"))
    w = Window.partitionBy("i").orderBy("j").rangeBetween(-reach, reach)
    rows = rows.withColumn("most", F.max("most").over(w))
    return cells.join(rows, ["i", "j"]).where(F.col(value) == F.col("most")).drop("most")


def nearest(rows: DataFrame, points: DataFrame, lat: str, lon: str, point_lat: str, point_lon: str, order: Sequence[str]) -> DataFrame:
    """Each row with its nearest point as a struct `nearest`, with `km`; ties by `order`. Rows or points without a place have
    none and are none. Where points are many they are looked for cell by cell."""
    ids = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("row id", F.monotonically_increasing_id())
    points = points.where(F.col(point_lat).isNotNull() & F.col(point_lon).isNotNull())
    few = points.limit(MAX_BROADCAST_POINTS + 1).count() <= MAX_BROADCAST_POINTS
    points = points.select(F.struct(*points.columns).alias("point"))
    km = haversine_km(F.col(lat), F.col(lon), F.col(f"point.{point_lat}"), F.col(f"point.{point_lon}"))
    best = F.min_by(F.struct(F.col("point"), km.alias("km")), F.struct(km, *(F.col(f"point.{c}") for c in order)))
    if few:
        found = ids.crossJoin(F.broadcast(points)).groupBy(*ids.columns).agg(best.alias("found"))
    else:
        found = _by_cells(stage(ids), stage(points), (lat, lon), (f"point.{point_lat}", f"point.{point_lon}"), best)
    return found.select(*rows.columns, F.col("found.point").alias("nearest"), "found.km")


def _by_cells(ids: DataFrame, points: DataFrame, at: tuple[str, str], point_at: tuple[str, str], best: Column, first: float = 1 / 64) -> DataFrame:
    """`ids` with found: the best of the points in the cells around. Cells are cubes in the space around a globe of radius 1, so
    no pole or date line is in the way. A point beyond the cells next to a row's own is at least a cell's side away: a row whose
    best is nearer is done, the others go on with cells twice as wide."""

    def axes(lat: str, lon: str) -> list[Column]:
        up, round_ = F.radians(F.col(lat)), F.radians(F.col(lon))
        return [F.cos(up) * F.cos(round_), F.cos(up) * F.sin(round_), F.sin(up)]

    left, done, side = ids, [], first
    while True:
        cell = lambda c, side=side: F.floor(c / F.lit(side))
        own = [cell(c) for c in axes(*at)]
        around = F.array(*(F.struct(*((own[k] + d[k]).alias(f"cell {k}") for k in range(3))) for d in product((-1, 0, 1), repeat=3)))
        keys = [f"cell {k}" for k in range(3)]
        spread = left.select("*", F.inline(around))
        filed = points.select("point", *(cell(c).alias(k) for c, k in zip(axes(*point_at), keys, strict=True)))
        found = stage(spread.join(filed, keys).groupBy(*ids.columns).agg(best.alias("found")))
        sure = 2 * EARTH_RADIUS_KM * math.asin(min(side / 2, 1.0)) * (1 - 1e-9)
        ok = found if side >= 2 else found.where(F.col("found.km") <= sure)
        done.append(ok)
        if side >= 2:
            break
        left = stage(left.join(ok.select("row id"), "row id", "left_anti"))
        if left.isEmpty():
            break
        side *= 2
    return reduce(DataFrame.unionByName, done)


def hotspots(cells: DataFrame, places: DataFrame, *, step: float, bandwidth_km: float, top: int, lat: str = "lat", lon: str = "lon", order: Sequence[str] = ("name",), value: str = "log2_risk") -> DataFrame:
    """The `top` places nearest to the peaks of `value`, highest first; each place counts once, for its highest peak."""
    reach = max(round(2 * bandwidth_km / KM_PER_DEGREE / step), 1)
    peaks = local_maxima(cells, value, reach).select("i", "j", value, cell_lat(F.col("i"), step).alias("peak_lat"), cell_lon(F.col("j"), step).alias("peak_lon"))
    found = nearest(peaks, places, "peak_lat", "peak_lon", lat, lon, order)
    once = Window.partitionBy("nearest").orderBy(F.desc(value), "i", "j")
    found = found.withColumn("place in point", F.row_number().over(once)).where(F.col("place in point") == 1)
    return found.orderBy(F.desc(value), "i", "j").limit(top).select("nearest.*", F.round(value, 4).alias(value), "i", "j")


def prefer_nested(candidates: DataFrame, query: str, rank: str, is_region: str, box: Sequence[str], lat: str, lon: str) -> DataFrame:
    """Each query's candidate: the first, but if that is a region, the first other that is no region and lies in its box
    (south, north, west, east), if there is one."""
    packed = F.struct(*candidates.columns)
    top = candidates.groupBy(query).agg(F.min_by(packed, rank).alias("top"))
    joined = candidates.join(top, query)
    nested = F.col(f"top.{is_region}") & ~F.col(is_region) & inside(F.col(lat), F.col(lon), *(F.col(f"top.{b}") for b in box))
    best = joined.groupBy(query).agg(F.coalesce(F.min_by(F.when(nested, packed), F.when(nested, F.col(rank))), F.min_by(packed, rank)).alias("best"))
    return best.select("best.*")
