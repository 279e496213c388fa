"""Water depth from a bathymetry grid."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class Axis(NamedTuple):
    """A grid axis: first line, distance of the lines, index of the last line; `lines` has all lines where they are not regularly spaced."""

    first: float
    step: float
    last: int
    lines: tuple[float, ...] | None = None


#: Steps of the search in the lines of an irregular axis, of which the driver holds at most 2^17 (a global grid has 86,400).
SEARCH_STEPS = 17


def grid_axes(bathymetry: DataFrame) -> tuple[Axis, Axis]:
    """The two axes of a grid, from one aggregate with one row: the sorted lines of each axis.

    Of a regular axis three numbers come to the driver, of an irregular one its lines, at most 2^`SEARCH_STEPS`.
    """
    lines = bathymetry.agg(*[F.array_sort(F.collect_set(F.nullif(axis, F.lit(float("nan"))))).alias(axis) for axis in ("x", "y")])

    def about(axis: str) -> Column:
        at, n = F.col(axis), F.size(axis)
        first, high = F.get(at, F.lit(0)), F.get(at, n - 1)
        step = F.when(n > 1, (high - first) / (n - 1)).otherwise(1.0)
        regular = F.forall(F.transform(at, lambda v, i: F.abs((v - first) / step - i) < 1e-4), lambda near: near)
        kept = F.when(~regular & (n <= 2**SEARCH_STEPS), at)
        return F.struct(first.alias("first"), step.alias("step"), (n - 1).alias("last"), regular.alias("regular"), kept.alias("lines")).alias(axis)

    axes = []
    for found in lines.select(about("x"), about("y")).first():
        if found["last"] < 0:
            raise ValueError("The bathymetry grid is empty.")
        if not found["regular"] and found["lines"] is None:
            raise ValueError(f"An axis of the bathymetry grid has more than {2**SEARCH_STEPS} irregular lines.")
        axes.append(Axis(found["first"], found["step"], found["last"], found["lines"] and tuple(found["lines"])))
    return axes[0], axes[1]


def _lines(axis: Axis) -> Column:
    """The lines as one array, which the optimizer folds to a constant."""
    return F.from_json(F.lit(json.dumps(axis.lines)), "array<double>")


def _search(value: Column, axis: Axis) -> Column:
    """Index of the first of the lines that is not below the value, or of the last line: a binary search."""

    lines = _lines(axis)

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        upper = F.struct((middle + 1).alias("low"), high.alias("high"))
        lower = F.struct(low.alias("low"), middle.alias("high"))
        return F.when(low >= high, span).otherwise(F.when(F.get(lines, middle) < value, upper).otherwise(lower))

    whole = F.struct(F.lit(0).alias("low"), F.lit(axis.last).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SEARCH_STEPS)), whole, halve)["low"]


def _nearest_line(value: Column, axis: Axis) -> Column:
    """Index of the nearest grid line, the lower one of a tie, clamped at the edge."""
    if axis.lines is not None:
        found, lines = _search(value, axis), _lines(axis)
        lower = value - F.get(lines, found - 1) <= F.get(lines, found) - value
        return F.when(value.isNotNull(), F.when((found > 0) & lower, found - 1).otherwise(found)).cast("bigint")
    line = F.ceil((value - axis.first) / axis.step - 0.5)
    return F.greatest(F.lit(0), F.least(line, F.lit(axis.last)))


def _own_line(value: Column, axis: Axis) -> Column:
    """Index of a grid line."""
    if axis.lines is not None:
        return F.when(value.isNotNull(), _search(value, axis)).cast("bigint")
    return F.rint((value - axis.first) / axis.step).cast("bigint")


def index_grid(bathymetry: DataFrame, axes: tuple[Axis, Axis]) -> DataFrame:
    """Depth by integer grid position: (_ix, _iy, _depth), one row per cell."""
    return (
        bathymetry.select(
            _own_line(F.col("x"), axes[0]).alias("_ix"),
            _own_line(F.col("y"), axes[1]).alias("_iy"),
            (-F.col("z")).alias("_depth"),
        )
        .groupBy("_ix", "_iy")
        .agg(F.min("_depth").alias("_depth"))
    )


def add_water_depth(
    stations: DataFrame,
    bathymetry: DataFrame,
    col_lon: str,
    col_lat: str,
    col_name: str,
    axes: tuple[Axis, Axis] | None = None,
) -> DataFrame:
    """Add the depth of the nearest grid cell.

    Nearest longitude and nearest latitude are taken independently, so the lookup
    is an equi-join on two integers. A station without coordinates gets NULL; such
    stations get distinct negative positions, so that they do not meet in one task
    when the grid is too large to broadcast. `axes` saves a look at the grid.
    """
    axes = axes or grid_axes(bathymetry)
    lon, lat = F.col(col_lon), F.col(col_lat)
    placeless = lon.isNull() | lat.isNull()
    spread = -1 - F.pmod(F.xxhash64("StationID"), F.lit(4096))
    placed = stations.withColumns({
        "_ix": F.when(placeless, spread).otherwise(_nearest_line(lon, axes[0])),
        "_iy": F.when(placeless, spread).otherwise(_nearest_line(lat, axes[1])),
    })
    found = placed.join(index_grid(bathymetry, axes), ["_ix", "_iy"], "left")
    return found.withColumnRenamed("_depth", col_name).drop("_ix", "_iy")


def survey_bbox(
    stations: DataFrame,
    buffer: float = 2,
    lats: Sequence[float] | None = None,
    lons: Sequence[float] | None = None,
) -> DataFrame:
    """One row lon1, lon2, lat1, lat2 around all stations, or the given coordinates."""
    if (lats is None) != (lons is None):
        raise ValueError("Give both latitudes and longitudes, or neither.")
    if lats is not None:
        ends = stations.sparkSession.range(1).select(
            F.lit(float(min(lons))).alias("lon1"), F.lit(float(max(lons))).alias("lon2"),
            F.lit(float(min(lats))).alias("lat1"), F.lit(float(max(lats))).alias("lat2"),
        )
    else:
        lon_columns = ("Lon_DD_midpt", "Lon_start_DD", "Lon_stop_DD")
        lat_columns = ("Lat_DD_midpt", "Lat_start_DD", "Lat_stop_DD")
        ends = stations.agg(
            F.least(*[F.min(c) for c in lon_columns]).alias("lon1"),
            F.greatest(*[F.max(c) for c in lon_columns]).alias("lon2"),
            F.least(*[F.min(c) for c in lat_columns]).alias("lat1"),
            F.greatest(*[F.max(c) for c in lat_columns]).alias("lat2"),
        )
    return ends.select(*[
        F.bround(F.col(c) + (-buffer if c.endswith("1") else buffer), 1).alias(c)
        for c in ("lon1", "lon2", "lat1", "lat2")
    ])


def prune_bathymetry(bathymetry: DataFrame, bbox: DataFrame) -> DataFrame:
    """Only the grid cells inside a bounding box."""
    box = bbox.select(F.struct("lon1", "lon2", "lat1", "lat2")).scalar()
    return bathymetry.filter(
        F.col("x").between(box["lon1"], box["lon2"]) & F.col("y").between(box["lat1"], box["lat2"])
    )


def add_depths(stations: DataFrame, bathymetry: DataFrame) -> DataFrame:
    """Depth at the reported and at the calculated midpoint."""
    axes = grid_axes(bathymetry)
    reported = add_water_depth(
        stations, bathymetry, "Lon_DD_midpt", "Lat_DD_midpt", "Water_depth_m_Bathy", axes
    )
    return add_water_depth(
        reported, bathymetry, "Lon_DD_calc", "Lat_DD_calc", "Water_depth_m_Bathy2", axes
    )
