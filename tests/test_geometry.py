import numpy as np
import pytest
from conftest import rows

from benthoframe.functions import geodesy
from benthoframe.operators import depth, geometry

TRACK = "StationID string, Lat_start_DD double, Lon_start_DD double, Lat_stop_DD double, Lon_stop_DD double, Odometer_count long"


def dms(d, m, s):
    return (abs(d) + m / 60 + s / 3600) * (-1 if d < 0 else 1)


def test_published_line():
    # Flinders Peak to Buninyong, the published example for this ellipsoid size.
    d, az = geodesy.inverse(*[
        np.array([x]) for x in (dms(-37, 57, 3.72030), dms(144, 25, 29.52440),
                                dms(-37, 39, 10.15610), dms(143, 55, 35.38390))
    ])
    assert d[0] == pytest.approx(54972.271, abs=2e-3)
    assert az[0] % 360 == pytest.approx(dms(306, 52, 5.37), abs=1e-5)


def test_direct_inverts_inverse():
    rng = np.random.default_rng(1)
    lat1, lat2 = rng.uniform(-80, 80, (2, 500))
    lon1 = rng.uniform(-180, 180, 500)
    lon2 = lon1 + rng.uniform(-150, 150, 500)
    d, az = geodesy.inverse(lat1, lon1, lat2, lon2)
    lat, lon = geodesy.direct(lat1, lon1, az, d)
    assert np.allclose(lat, lat2, atol=1e-9)
    assert np.allclose((lon - lon2 + 540) % 360 - 180, 0, atol=1e-9)


def solve(*line):
    return tuple(float(v[0]) for v in geodesy.inverse(*[np.array([float(x)]) for x in line]))


def test_published_antipodal_lines():
    """Published for WGS84: two lines where the plain iteration fails or nearly does, and half a meridian."""
    assert solve(0, 0, 0.5, 179.5) == (pytest.approx(19936288.579, abs=1e-3), pytest.approx(25.671876, abs=1e-5))
    assert solve(0, 0, 0.5, 179.7) == (pytest.approx(19944127.421, abs=1e-3), pytest.approx(15.556883, abs=1e-5))
    half = 20003931.4586
    for line in ((0, 0, 0, 180), (0, 20, 0, -160), (90, 0, -90, 50), (30, 10, -30, -170), (-89.9, 0, 89.9, 180)):
        assert solve(*line)[0] == pytest.approx(half, abs=1e-3)


def test_nearly_antipodal_points():
    """The direct solution leads back, both ways are as long, and no way is longer than half a meridian."""
    rng = np.random.default_rng(4)
    lat1, lon1 = rng.uniform(-85, 85, 2000), rng.uniform(-180, 180, 2000)
    lat2, lon2 = -lat1 + rng.uniform(-1, 1, 2000), lon1 + 180 + rng.uniform(-1, 1, 2000)
    lat1[:200] = 0.0
    lat2[:200] = rng.choice([0.0, 0.01, -0.3], 200)
    d, az = geodesy.inverse(lat1, lon1, lat2, lon2)
    assert np.isfinite(d).all() and (d <= 20003931.459).all() and (d > 19.8e6).all()
    lat, lon = geodesy.direct(lat1, lon1, az, d)
    metres = np.hypot(lat - lat2, ((lon - lon2 + 540) % 360 - 180) * np.cos(np.radians(lat2))) * 111_320
    assert metres.max() < 1e-3
    assert np.allclose(geodesy.inverse(lat2, lon2, lat1, lon1)[0], d, rtol=0, atol=1e-3)


def test_antipodal_solution_on_common_lines():
    """Where both solutions work they agree."""
    rng = np.random.default_rng(6)
    lat1, lat2 = rng.uniform(-80, 80, (2, 500))
    lon1, turn = rng.uniform(-180, 180, 500), rng.uniform(-170, 170, 500)
    d, az = geodesy.inverse(lat1, lon1, lat2, lon1 + turn)
    other, az2 = geodesy.antipodal(lat1, lon1, lat2, lon1 + turn)
    assert np.allclose(d, other, rtol=0, atol=2e-3) and np.abs((az - az2 + 540) % 360 - 180).max() < 1e-6


def test_short_track_is_accurate():
    point = [np.array([x]) for x in (52.703, 5.663, 52.7035, 5.6638)]
    exact, _ = geodesy.inverse(*[p.astype(np.longdouble) for p in point])
    assert abs(geodesy.inverse(*point)[0] - exact)[0] / exact[0] < 1e-14


def test_track_operators(spark):
    df = spark.createDataFrame([
        ("a", 52.0, 4.0, 52.0009, 4.0, 50), ("b", None, 4.0, 52.0, 4.0, None),
        ("c", 10.0, 179.9, 10.0, -179.9, 1), ("d", 51.0, 2.0, 51.0, 2.0, 0),
    ], TRACK)
    got = {r["StationID"]: r for r in geometry.add_track_length_Odometer(
        geometry.add_track_geometry(df)).collect()}
    assert got["a"]["Track_dist_m_GPS"] == pytest.approx(100.1406, abs=1e-3)
    assert got["a"]["Bearing_calc"] == pytest.approx(0)
    assert got["a"]["Lat_DD_calc"] == pytest.approx(52.00045, abs=1e-7)
    assert got["a"]["Track_dist_m_Odometer"] == 100 and got["b"]["Track_dist_m_Odometer"] is None
    assert got["b"]["Track_dist_m_GPS"] is None and got["b"]["Lat_DD_calc"] is None
    assert abs(got["c"]["Lon_DD_calc"]) == pytest.approx(180)
    assert got["c"]["Track_dist_m_GPS"] == pytest.approx(21927.87, abs=0.01)
    assert got["d"]["Track_dist_m_GPS"] == 0
    one = {r["StationID"]: r for r in geometry.add_bearings(
        geometry.add_track_length_GPS(geometry.add_track_midpoints(df))).collect()}
    for s, r in one.items():
        for c in ("Track_dist_m_GPS", "Bearing_calc", "Lat_DD_calc", "Lon_DD_calc"):
            assert r[c] == got[s][c]
    assert rows(geometry.find_track_midpoints(df))[0][0] == "a"


def grid(spark):
    cells = [(x / 10, y / 10, -float(x * 100 + y)) for x in range(20, 24) for y in range(510, 513)]
    return spark.createDataFrame(cells, "x double, y double, z double")


def test_depth_against_brute_force(spark):
    points = [("a", 2.04, 51.16), ("b", 2.05, 51.0), ("c", -9.0, 99.0), ("d", None, 51.0),
              ("e", 2.0, None), ("f", 2.3, 51.2)]
    df = spark.createDataFrame(points, "StationID string, lon double, lat double")
    got = {r["StationID"]: r["depth"] for r in depth.add_water_depth(
        df, grid(spark), "lon", "lat", "depth").collect()}
    cells = grid(spark).collect()
    for name, lon, lat in points:
        if lon is None or lat is None:
            assert got[name] is None
            continue
        x = min((c["x"] for c in cells), key=lambda v: (round(abs(v - lon), 9), v))
        y = min((c["y"] for c in cells), key=lambda v: (round(abs(v - lat), 9), v))
        assert got[name] == next(-c["z"] for c in cells if (c["x"], c["y"]) == (x, y))


def test_depth_missing_cell_and_irregular_grid(spark):
    df = spark.createDataFrame([("a", 2.0, 51.0)], "StationID string, lon double, lat double")
    holed = grid(spark).filter("NOT (x = 2.0 AND y = 51.0)")
    assert depth.add_water_depth(df, holed, "lon", "lat", "d").first()["d"] is None
    empty = grid(spark).limit(0)
    with pytest.raises(ValueError, match="empty"):
        depth.add_water_depth(df, empty, "lon", "lat", "d")


@pytest.mark.parametrize("regular_y", [True, False])
def test_depth_on_irregular_axes(spark, regular_y):
    """Nearest lines by brute force, beyond both edges, on lines and between them, with a line missing."""
    xs = [0.0, 0.1, 0.15, 1.0, 1.1, 2.5, 7.0, 7.01]
    ys = [50.0, 50.5, 51.0] if regular_y else [50.0, 50.5, 51.5, 52.0]
    cells = [(x, y, -(100 * i + j + 1.0)) for i, x in enumerate(xs) for j, y in enumerate(ys)]
    points = [(f"s{i}", -1 + i * 0.0917, 49.7 + i * 0.031) for i in range(100)] + [("on", 2.5, 50.5), ("tie", 1.75, 50.25), ("none", None, 50.0)]
    df = spark.createDataFrame(points, "StationID string, lon double, lat double")
    odd = spark.createDataFrame(cells, "x double, y double, z double")
    got = {r["StationID"]: r["d"] for r in depth.add_water_depth(df, odd, "lon", "lat", "d").collect()}
    for name, lon, lat in points:
        if lon is None:
            assert got[name] is None
            continue
        x, y = (min(lines, key=lambda v: (abs(v - at), v)) for lines, at in ((xs, lon), (ys, lat)))
        assert got[name] == next(-z for cx, cy, z in cells if (cx, cy) == (x, y)), name


def test_bbox(spark):
    df = spark.createDataFrame(
        [(None, None, 51.26, 2.0, 51.3, 2.04), (55.0, 3.0, None, None, None, None)],
        "Lat_DD_midpt double, Lon_DD_midpt double, Lat_start_DD double, Lon_start_DD double,"
        " Lat_stop_DD double, Lon_stop_DD double")
    box = depth.survey_bbox(df)
    assert rows(box) == [(0.0, 5.0, 49.3, 57.0)]
    assert rows(depth.survey_bbox(df, 1, [50, 52], [3, 4])) == [(2.0, 5.0, 49.0, 53.0)]
    with pytest.raises(ValueError):
        depth.survey_bbox(df, lats=[1])
    assert depth.prune_bathymetry(grid(spark), depth.survey_bbox(
        df, 0, [51.0, 51.1], [2.1, 2.2])).count() == 4
