"""Track geometry of the stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.functions.geodesy import geodesic_track


def _track() -> Column:
    return geodesic_track(
        F.col("Lat_start_DD"), F.col("Lon_start_DD"), F.col("Lat_stop_DD"), F.col("Lon_stop_DD")
    )


def add_track_geometry(stations: DataFrame) -> DataFrame:
    """Midpoint, GPS track length and initial bearing from one geodesic solution."""
    solved = stations.withColumn("_track", _track())
    return solved.withColumns({
        "Lon_DD_calc": F.col("_track.mid_lon"),
        "Lat_DD_calc": F.col("_track.mid_lat"),
        "Track_dist_m_GPS": F.col("_track.distance_m"),
        "Bearing_calc": F.col("_track.azimuth_deg"),
    }).drop("_track")


def add_track_midpoints(stations: DataFrame) -> DataFrame:
    """Add the geographic midpoint of each track: Lon_DD_calc, Lat_DD_calc."""
    solved = stations.withColumn("_track", _track())
    return solved.withColumns({
        "Lon_DD_calc": F.col("_track.mid_lon"), "Lat_DD_calc": F.col("_track.mid_lat")
    }).drop("_track")


def find_track_midpoints(stations: DataFrame) -> DataFrame:
    """Only the midpoints, with the station they belong to (G1)."""
    return add_track_midpoints(stations).select("StationID", "Lon_DD_calc", "Lat_DD_calc")


def add_track_length_GPS(stations: DataFrame) -> DataFrame:
    """Add the geodesic length of each track in metres: Track_dist_m_GPS."""
    return stations.withColumn("Track_dist_m_GPS", _track()["distance_m"])


def add_track_length_Odometer(stations: DataFrame, tick_length_m: float = 2) -> DataFrame:
    """Add the track length by odometer ticks: Track_dist_m_Odometer."""
    return stations.withColumn("Track_dist_m_Odometer", F.col("Odometer_count") * tick_length_m)


def add_bearings(stations: DataFrame) -> DataFrame:
    """Add the initial bearing, -180..180 degrees from north: Bearing_calc."""
    return stations.withColumn("Bearing_calc", _track()["azimuth_deg"])
