"""The registered queries as plain SQL over the test tables.

Written apart from the library: windows and self-joins where the library uses
aggregates, a plain cross join for fuzzy names, the textbook loop for geodesics.
Common tables are put in front of a query when its text mentions them.
"""

from __future__ import annotations

import re

from benthoframe.plans.survey_views import VIEWS

# Survey views read the test tables under their own names.
COMMON: dict[str, str] = {
    name: re.sub(r"\{(\w+)\}", r"\1", text).strip() for name, text in VIEWS.items()
}
ORACLE: dict[str, str] = {}

RECORD = 'valid_name, rank, phylum, class, "order", family, genus, status, isExtinct'
RANKS = 'rank, phylum, class, "order", family, genus'


def single(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE) AS {name}"


def singles(*names: str) -> str:
    return ", ".join(single(n, n) for n in names)


def with_common(text: str) -> str:
    """Put every common table the text needs, and what those need, before it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in COMMON:
            if re.search(rf"\b{name}\b", sql) and name not in needed:
                visit_first = COMMON[name]
                visit(visit_first)
                if name not in needed:
                    needed.append(name)

    visit(text)
    if not needed:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({COMMON[n]})" for n in needed) + "\n" + text


def oracle(name: str, text: str) -> None:
    ORACLE[name] = with_common(text.strip())


# --- geodesics -----------------------------------------------------------------------

A = "6378137.0e0"
FL = "(1e0 / 298.257223563e0)"
B = f"({A} * (1 - {FL}))"
E2 = f"(({A} * {A} - {B} * {B}) / ({B} * {B}))"

_ARC = """
 sqrt(pow(cu2 * sin(lam), 2) + pow(du + 2 * su1 * cu2 * pow(sin(lam / 2), 2), 2)) AS ss,
 su1 * su2 + cu1 * cu2 * cos(lam) AS cs"""


def _arc(source: str) -> str:
    return f"""
SELECT *, CASE WHEN ca = 0 THEN 0 ELSE cs - 2 * su1 * su2 / ca END AS cm FROM (
 SELECT *, 1 - sa * sa AS ca, atan2(ss, cs) AS sg FROM (
  SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
   SELECT *, {_ARC} FROM ({source}))))"""


def _gap() -> str:
    c = f"({FL} / 16 * ca * (4 + {FL} * (4 - 3 * ca)))"
    return f"(1 - {c}) * {FL} * sa * (sg + {c} * ss * (cm + {c} * cs * (2 * cm * cm - 1)))"


def _dsigma(b: str) -> str:
    return (
        f"{b} * ss * (cm + {b} / 4 * (cs * (2 * cm * cm - 1)"
        f" - {b} / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))"
    )


SERIES_A = f"(1 + ca * {E2} / 16384 * (4096 + ca * {E2} * (-768 + ca * {E2} * (320 - 175 * ca * {E2}))))"
SERIES_B = f"(ca * {E2} / 1024 * (256 + ca * {E2} * (-128 + ca * {E2} * (74 - 47 * ca * {E2}))))"
_KEEP = "StationID, lat1, lon1, L, su1, cu1, su2, cu2, du"

COMMON["geo_0"] = f"""
SELECT StationID, lat1, lon1, L, cu1 * t1 AS su1, cu1, cu2 * t2 AS su2, cu2,
 cu1 * cu2 * (1 - {FL}) * sin(radians(lat2 - lat1)) / (cos(radians(lat1)) * cos(radians(lat2))) AS du,
 L AS lam
FROM (SELECT *, 1 / sqrt(1 + t1 * t1) AS cu1, 1 / sqrt(1 + t2 * t2) AS cu2 FROM (
 SELECT StationID, Lat_start_DD AS lat1, Lon_start_DD AS lon1, Lat_stop_DD AS lat2,
  radians(Lon_stop_DD - Lon_start_DD) AS L,
  (1 - {FL}) * tan(radians(Lat_start_DD)) AS t1, (1 - {FL}) * tan(radians(Lat_stop_DD)) AS t2
 FROM stations))"""
for i in range(1, 8):
    COMMON[f"geo_{i}"] = f"SELECT {_KEEP}, L + {_gap()} AS lam FROM ({_arc(f'SELECT * FROM geo_{i - 1}')})"
COMMON["track_end"] = f"""
SELECT StationID, lat1, lon1, su1, cu1,
 {B} * {SERIES_A} * (sg - {_dsigma(SERIES_B)}) AS distance_m,
 atan2(cu2 * sin(lam), du + 2 * su1 * cu2 * pow(sin(lam / 2), 2)) AS az
FROM ({_arc('SELECT * FROM geo_7')})"""
COMMON["mid_0"] = f"""
SELECT *, distance_m / 2 / ({B} * {SERIES_A}) AS first, distance_m / 2 / ({B} * {SERIES_A}) AS sg FROM (
 SELECT *, cu1 * sin(az) AS sa, 1 - pow(cu1 * sin(az), 2) AS ca, atan2(su1, cu1 * cos(az)) AS s1
 FROM track_end)"""
_MID_KEEP = "StationID, lat1, lon1, su1, cu1, distance_m, az, sa, ca, s1, first"
for i in range(1, 6):
    COMMON[f"mid_{i}"] = f"""
SELECT {_MID_KEEP}, first + {_dsigma(SERIES_B)} AS sg FROM (
 SELECT *, sin(sg) AS ss, cos(sg) AS cs, cos(2 * s1 + sg) AS cm FROM mid_{i - 1})"""
COMMON["tracks"] = f"""
SELECT StationID, distance_m, degrees(az) AS azimuth_deg,
 degrees(atan2(su1 * cs + cu1 * ss * cos(az),
  (1 - {FL}) * sqrt(sa * sa + pow(su1 * ss - cu1 * cs * cos(az), 2)))) AS mid_lat,
 lon1 + degrees(atan2(ss * sin(az), cu1 * cs - su1 * ss * cos(az)) - {_gap()}) AS mid_lon
FROM (SELECT *, sin(sg) AS ss, cos(sg) AS cs, cos(2 * s1 + sg) AS cm FROM mid_5)"""

oracle("track_midpoint", """
SELECT StationID, round(mid_lon, 8) AS Lon_DD_calc, round(mid_lat, 8) AS Lat_DD_calc FROM tracks""")
oracle("track_length_gps", f"SELECT StationID, {single('distance_m', 'Track_dist_m_GPS')} FROM tracks")
oracle("track_bearing", f"SELECT StationID, {single('azimuth_deg', 'Bearing_calc')} FROM tracks")
oracle("track_length_odometer", """
SELECT StationID, CAST(Odometer_count * 2 AS DOUBLE) AS Track_dist_m_Odometer FROM stations""")

# --- depth and stations ----------------------------------------------------------------

# Nearest grid line by brute force over the distinct lines, ties to the lower one.
COMMON["x_lines"] = "SELECT DISTINCT x FROM bathymetry"
COMMON["y_lines"] = "SELECT DISTINCT y FROM bathymetry"


def _nearest(points: str, lon: str, lat: str) -> str:
    def line(value: str, axis: str) -> str:
        return (
            f"SELECT v, min_by({axis}, struct_pack(d := abs(v - {axis}), l := {axis})) AS {axis}"
            f" FROM (SELECT DISTINCT {value} AS v FROM {points} WHERE {value} IS NOT NULL)"
            f" CROSS JOIN {axis}_lines GROUP BY v"
        )

    return f"""
SELECT s.StationID, -b.z AS depth FROM {points} s
LEFT JOIN ({line(lon, 'x')}) nx ON nx.v = s.{lon}
LEFT JOIN ({line(lat, 'y')}) ny ON ny.v = s.{lat}
LEFT JOIN bathymetry b ON b.x = nx.x AND b.y = ny.y"""


COMMON["depth_reported"] = _nearest("stations", "Lon_DD_midpt", "Lat_DD_midpt")
COMMON["depth_calculated"] = _nearest("tracks", "mid_lon", "mid_lat")
COMMON["stations_done"] = """
SELECT s.*, t.mid_lat AS Lat_DD_calc, t.mid_lon AS Lon_DD_calc, t.distance_m AS Track_dist_m_GPS,
 t.azimuth_deg AS Bearing_calc, Odometer_count * 2 AS Track_dist_m_Odometer,
 d1.depth AS Water_depth_m_Bathy, d2.depth AS Water_depth_m_Bathy2
FROM stations s JOIN tracks t USING (StationID) JOIN depth_reported d1 USING (StationID)
JOIN depth_calculated d2 USING (StationID)"""
COMMON["stations_clean"] = """
SELECT *, Track_length_m * (Blade_width_cm / 100) AS Sample_area_m2,
 Track_length_m * (Blade_width_cm / 100) * (Blade_depth_cm / 100) AS Sample_volume_m3 FROM (
SELECT File, CruiseID, StationID, Date, Blade_width_cm, Blade_depth_cm, is_Quantitative,
 Station_objective, Excluded, Focus, Comment,
 coalesce(Lat_DD_midpt, Lat_DD_calc) AS Lat_DD,
 CASE WHEN Lat_DD_midpt IS NOT NULL THEN 'Lat_DD_midpt' ELSE 'Lat_DD_calc' END AS source_Lat_DD,
 coalesce(Lon_DD_midpt, Lon_DD_calc) AS Lon_DD,
 CASE WHEN Lon_DD_midpt IS NOT NULL THEN 'Lon_DD_midpt' ELSE 'Lon_DD_calc' END AS source_Lon_DD,
 coalesce(Water_depth_m_cruise, Water_depth_m_Bathy, Water_depth_m_Bathy2) AS Water_depth_m,
 CASE WHEN Water_depth_m_cruise IS NOT NULL THEN 'Water_depth_m_cruise'
  WHEN Water_depth_m_Bathy IS NOT NULL THEN 'Water_depth_m_Bathy'
  ELSE 'Water_depth_m_Bathy2' END AS source_Water_depth_m,
 coalesce(Track_length_m_preset, Track_dist_m_Odometer, Track_dist_m_GPS) AS Track_length_m,
 CASE WHEN Track_length_m_preset IS NOT NULL THEN 'Track_length_m_preset'
  WHEN Track_dist_m_Odometer IS NOT NULL THEN 'Track_dist_m_Odometer'
  ELSE 'Track_dist_m_GPS' END AS source_Track_length_m,
 coalesce(Bearing, Bearing_calc) AS Bearings,
 CASE WHEN Bearing IS NOT NULL THEN 'Bearing' ELSE 'Bearing_calc' END AS source_Bearings
FROM stations_done)"""

STATION_VALUES = (
    "Lat_DD", "Lon_DD", "Water_depth_m", "Track_length_m", "Bearings", "Sample_area_m2",
    "Sample_volume_m3",
)
DENSITIES = ("Density_nr_per_m2", "Density_nr_per_m3", "Biomass_g_per_m2", "Biomass_g_per_m3")
STATION_TEXT = (
    "CruiseID, Date, Blade_width_cm, Blade_depth_cm, is_Quantitative, Station_objective, Excluded,"
    " Focus, source_Lat_DD, source_Lon_DD, source_Water_depth_m, source_Track_length_m,"
    " source_Bearings"
)

oracle("combine_sources", """
SELECT StationID, coalesce(Track_length_m_preset, Odometer_count * 2) AS Track_length_m,
 CASE WHEN Track_length_m_preset IS NOT NULL THEN 'Track_length_m_preset'
  ELSE 'Track_dist_m_Odometer' END AS source_Track_length_m,
 Water_depth_m_cruise AS Depth_m, 'Water_depth_m_cruise' AS source_Depth_m
FROM stations""")
oracle("station_area_volume", f"""
SELECT File, StationID, Comment, {STATION_TEXT}, {singles(*STATION_VALUES)} FROM stations_clean""")
oracle("water_depth", """
SELECT StationID, Water_depth_m_Bathy, Water_depth_m_Bathy2 FROM stations_done""")


def _bbox(buffer: str) -> str:
    return f"""
SELECT round_even(min(lon) - ({buffer}), 1) AS lon1, round_even(max(lon) + ({buffer}), 1) AS lon2,
 round_even(min(lat) - ({buffer}), 1) AS lat1, round_even(max(lat) + ({buffer}), 1) AS lat2 FROM (
SELECT Lon_DD_midpt AS lon, Lat_DD_midpt AS lat FROM stations UNION ALL
SELECT Lon_start_DD, Lat_start_DD FROM stations UNION ALL
SELECT Lon_stop_DD, Lat_stop_DD FROM stations)"""


oracle("survey_bbox", _bbox("2"))
oracle("bathymetry_in_bbox", f"""
SELECT x, y, z FROM bathymetry, ({_bbox('-0.5')})
WHERE x BETWEEN lon1 AND lon2 AND y BETWEEN lat1 AND lat2""")

# --- taxonomy ----------------------------------------------------------------------------

COMMON["all_names"] = """
SELECT Species_reported AS Query FROM species UNION SELECT Taxon FROM bioconversion"""


def _exact(names: str) -> str:
    return f"""
SELECT n.Query, 0 AS isFuzzy, t.cand_id, {RECORD} FROM {names} n
JOIN taxonomy_candidates t ON t.name = n.Query"""


# Like sounds of a word, as the library has them, letter by letter.
_FIRST = (
    "ae:e cn:n ct:t cz:c dj:j ea:e eu:u gn:n kn:n mn:n oe:e qu:q ps:s pt:t ts:s wr:r x:z"
)
_INSIDE = "ae:i ia:a oe:i oi:a sc:s ph:f h:"


def _sound(name: str) -> str:
    first = " ".join(
        f"WHEN starts_with(w, '{a}') THEN '{b}' || substr(w, {len(a) + 1})"
        for a, b in (pair.split(":") for pair in _FIRST.split())
    )
    word = f"CASE {first} ELSE w END"
    for a, b in (pair.split(":") for pair in _INSIDE.split()):
        word = f"replace({word}, '{a}', '{b}')"
    letters = f"list_prepend('', string_split(translate({word}, 'eouykz', 'iaiicc'), ''))"
    single = f"list_reduce({letters}, lambda s, c: CASE WHEN right(s, 1) = c THEN s ELSE s || c END)"
    words = f"string_split_regex(regexp_replace(lower(trim({name})), '[^a-z ]', '', 'g'), ' +')"
    return f"array_to_string(list_transform({words}, lambda w: regexp_replace({single}, '[ai][sm]?$', 'a')), ' ')"


def _fuzzy(names: str, distance: int, phonetic: bool = False) -> str:
    alike = f"""
 OR ({_sound('Query')} = {_sound('name')} AND d <= greatest(2, least(length(Query), length(name)) // 4))"""
    return f"""
SELECT Query, 1 AS isFuzzy, cand_id, {RECORD} FROM (
 SELECT *, min(d) OVER (PARTITION BY Query) AS nearest FROM (
  SELECT n.Query, t.*, levenshtein(n.Query, t.name) AS d
  FROM {names} n CROSS JOIN taxonomy_candidates t
  WHERE n.Query NOT IN (SELECT name FROM taxonomy_candidates))
 WHERE d <= {distance}{alike if phonetic else ''}) WHERE d = nearest"""


def _resolve(names: str, candidates: str) -> str:
    return f"""
SELECT n.Query, {', '.join('r.' + c.strip() for c in RECORD.split(','))},
 CASE WHEN n.Query IN (SELECT name FROM taxonomy_candidates) THEN 0 ELSE 1 END AS isFuzzy,
 CASE WHEN r.Query IS NULL THEN 1 ELSE 0 END AS hasNoMatch
FROM (SELECT DISTINCT Query FROM {names}) n LEFT JOIN (
 SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY Query ORDER BY cand_id, valid_name) AS place FROM (
   SELECT *, sum(CASE WHEN status = 'accepted' THEN 1 ELSE 0 END) OVER (PARTITION BY Query) AS accepted,
    min(valid_name) OVER (PARTITION BY Query) AS low, max(valid_name) OVER (PARTITION BY Query) AS high
   FROM (SELECT *, count(*) OVER (PARTITION BY Query) AS many FROM ({candidates}))
   WHERE many = 1 OR coalesce(isExtinct, 0) <> 1)
  WHERE many = 1 OR (accepted = 1 AND status = 'accepted') OR (accepted <> 1 AND low = high))
 WHERE place = 1) r ON r.Query = n.Query"""


COMMON["names"] = _resolve("all_names", _exact("all_names"))
COMMON["merged_names"] = _resolve(
    "all_names", _exact("all_names") + " UNION ALL " + _fuzzy("all_names", 1)
)

oracle("distinct_names", "SELECT Query FROM all_names")
oracle("name_exact", """
SELECT s.Species_reported AS Query, t.* EXCLUDE (name), 0 AS isFuzzy
FROM (SELECT DISTINCT Species_reported FROM species) s
JOIN taxonomy_candidates t ON t.name = s.Species_reported""")
oracle("name_fuzzy", _fuzzy("written_names", 1))
oracle("name_fuzzy_two", _fuzzy("written_names", 2))
oracle("name_resolution", _resolve(
    "written_names", _exact("written_names") + " UNION ALL " + _fuzzy("written_names", 1)
))
oracle("name_phonetic", _fuzzy("spoken_names", 1, True))
oracle("name_resolution_phonetic", _resolve(
    "spoken_names", _exact("spoken_names") + " UNION ALL " + _fuzzy("spoken_names", 1, True)
))
oracle("name_resolution_all", "SELECT * FROM merged_names")

# --- conversions -------------------------------------------------------------------------


def _named(names: str) -> str:
    return f"""
SELECT DISTINCT b.*, n.valid_name, n.isFuzzy, n.phylum, n.class, n."order", n.family, n.genus
FROM bioconversion b LEFT JOIN {names} n ON n.Query = b.Taxon"""


COMMON["named"] = _named("names")
COMMON["named_merged"] = _named("merged_names")
COMMON["leveled"] = " UNION ALL ".join(
    f"""SELECT '{level}' AS level, "{level}" AS higher_taxon, * FROM named WHERE "{level}" IS NOT NULL"""
    for level in ("phylum", "class", "order", "family", "genus")
)
COMMON["regression_means"] = """
SELECT * EXCLUDE (several) FROM (
 SELECT *, count(*) OVER (PARTITION BY level, higher_taxon, Size_dimension) AS several FROM (
  SELECT level, higher_taxon, Size_dimension, Size_unit, Output_unit, avg(A_factor) AS A_factor,
   avg(B_exponent) AS B_exponent FROM leveled WHERE Size_dimension IS NOT NULL
  GROUP BY level, higher_taxon, Size_dimension, Size_unit, Output_unit))
WHERE several = 1 OR Output_unit <> 'WW_g'"""
COMMON["factor_means"] = """
SELECT level, higher_taxon, is_Shell_removed, avg(WW_to_AFDW) AS WW_to_AFDW FROM leveled
GROUP BY level, higher_taxon, is_Shell_removed HAVING avg(WW_to_AFDW) IS NOT NULL"""
COMMON["combined_means"] = """
SELECT 'Ignore' AS Taxon, coalesce(f.higher_taxon, r.higher_taxon) AS valid_name, is_Shell_removed,
 WW_to_AFDW, Size_dimension, Size_unit, Output_unit, A_factor, B_exponent,
 'Automatic calculated mean.' AS Comment_WW_to_AFDW, 'Automatic calculated mean.' AS Comment_regression
FROM factor_means f FULL JOIN regression_means r ON f.level = r.level AND f.higher_taxon = r.higher_taxon
WHERE is_Shell_removed IS NOT NULL"""
COMMON["conversion"] = """
SELECT valid_name, WW_to_AFDW, Reference_WW_to_AFDW, Comment_WW_to_AFDW, Size_dimension, A_factor,
 B_exponent, Output_unit, Reference_regression, Comment_regression, is_Shell_removed = 1 AS is_Shell_removed
FROM (SELECT * FROM named UNION ALL BY NAME SELECT * FROM combined_means) WHERE valid_name IS NOT NULL"""
COMMON["factors"] = """
SELECT * EXCLUDE (n) FROM (
 SELECT *, count(*) OVER (PARTITION BY valid_name, is_Shell_removed) AS n FROM (
  SELECT DISTINCT valid_name, WW_to_AFDW, Reference_WW_to_AFDW, is_Shell_removed, Comment_WW_to_AFDW
  FROM conversion WHERE WW_to_AFDW > 0))
WHERE n <> 2 OR Comment_WW_to_AFDW IS DISTINCT FROM 'Automatic calculated mean.'"""
COMMON["regressions"] = """
SELECT * EXCLUDE (n) FROM (
 SELECT *, count(*) OVER (PARTITION BY valid_name, Size_dimension, is_Shell_removed) AS n FROM (
  SELECT DISTINCT valid_name, Size_dimension, A_factor, B_exponent, Output_unit, Reference_regression,
   Comment_regression, is_Shell_removed FROM conversion WHERE Output_unit IS NOT NULL))
WHERE n <> 2 OR Comment_regression IS DISTINCT FROM 'Automatic calculated mean.'"""

FACTOR_COLUMNS = "valid_name, WW_to_AFDW, Reference_WW_to_AFDW, is_Shell_removed, Comment_WW_to_AFDW"
REGRESSION_COLUMNS = (
    "valid_name, Size_dimension, A_factor, B_exponent, Output_unit, Reference_regression,"
    " Comment_regression, is_Shell_removed"
)
oracle("conv_split_factors", f"""
SELECT DISTINCT {FACTOR_COLUMNS} FROM named WHERE valid_name IS NOT NULL AND WW_to_AFDW > 0""")
oracle("conv_split_regressions", f"""
SELECT DISTINCT {REGRESSION_COLUMNS} FROM named WHERE valid_name IS NOT NULL AND Output_unit IS NOT NULL""")
oracle("conv_double_factors", f"""
SELECT valid_name, is_Shell_removed, count(*) AS Count FROM (
 SELECT DISTINCT {FACTOR_COLUMNS} FROM named_merged WHERE valid_name IS NOT NULL AND WW_to_AFDW > 0)
GROUP BY valid_name, is_Shell_removed HAVING count(*) > 1""")
oracle("conv_double_regressions", f"""
SELECT valid_name, Size_dimension, is_Shell_removed, count(*) AS Count FROM (
 SELECT DISTINCT {REGRESSION_COLUMNS} FROM named_merged WHERE valid_name IS NOT NULL AND Output_unit IS NOT NULL)
GROUP BY valid_name, Size_dimension, is_Shell_removed HAVING count(*) > 1""")
oracle("conv_names", "SELECT * FROM named")
oracle("conv_unmatched", "SELECT DISTINCT Taxon FROM named WHERE valid_name IS NULL")
oracle("conv_means_regression", f"""
SELECT level, higher_taxon, Size_dimension, Size_unit, Output_unit, {singles('A_factor', 'B_exponent')}
FROM regression_means""")
oracle("conv_means_factor", f"""
SELECT level, higher_taxon, is_Shell_removed, {singles('WW_to_AFDW')} FROM factor_means""")
oracle("conv_means_combined", f"""
SELECT * EXCLUDE (WW_to_AFDW, A_factor, B_exponent), {singles('WW_to_AFDW', 'A_factor', 'B_exponent')}
FROM combined_means""")
oracle("conv_prepared_factors", f"""
SELECT * EXCLUDE (WW_to_AFDW), {singles('WW_to_AFDW')} FROM factors""")
oracle("conv_prepared_regressions", f"""
SELECT * EXCLUDE (A_factor, B_exponent), {singles('A_factor', 'B_exponent')} FROM regressions""")

# --- entries -----------------------------------------------------------------------------

COMMON["completed"] = """
SELECT *, CASE WHEN Output_unit = 'AFDW_g' THEN A_factor * pow(Size_mm, B_exponent) * Count
 WHEN Output_unit IS NOT NULL THEN WW_g_calc * WW_to_AFDW END AS AFDW_g_calc,
 WW_g_threshold * WW_to_AFDW AS AFDW_g_from_WW FROM (
SELECT *, CASE WHEN Output_unit = 'WW_g' THEN A_factor * pow(Size_mm, B_exponent) * Count END AS WW_g_calc,
 CASE WHEN WW_g = 0 THEN Threshold_scale / 2 ELSE WW_g END AS WW_g_threshold FROM (
SELECT s.*, n.valid_name, n.rank, n.phylum, n.class, n."order", n.family, n.genus, n.hasNoMatch, n.isFuzzy,
 f.WW_to_AFDW, r.A_factor, r.B_exponent, r.Output_unit,
 CASE s.Size_unit WHEN '1/2cm' THEN s.Size_value * 5 + 5 WHEN 'cm' THEN s.Size_value * 10
  WHEN 'cm2' THEN s.Size_value * 100 WHEN 'cm3' THEN s.Size_value * 1000
  WHEN NULL THEN NULL ELSE s.Size_value END AS Size_mm
FROM species s LEFT JOIN names n ON n.Query = s.Species_reported
LEFT JOIN factors f ON f.valid_name = n.valid_name AND f.is_Shell_removed = s.is_Shell_removed
LEFT JOIN regressions r ON r.valid_name = n.valid_name AND r.is_Shell_removed = s.is_Shell_removed
 AND r.Size_dimension IS NOT DISTINCT FROM s.Size_dimension))"""
COMMON["upscaled"] = """
SELECT * REPLACE (round_even(Count / Fraction, 0) AS Count, AFDW_g / Fraction AS AFDW_g,
 AFDW_g_from_WW / Fraction AS AFDW_g_from_WW, AFDW_g_calc / Fraction AS AFDW_g_calc) FROM (
SELECT * REPLACE (
 CASE WHEN Weight_type_AFDW = 'Sample' AND AFDW_g IS NULL THEN 0 ELSE AFDW_g END AS AFDW_g,
 CASE WHEN Weight_type = 'Sample' AND AFDW_g_from_WW IS NULL THEN 0 ELSE AFDW_g_from_WW END AS AFDW_g_from_WW)
FROM completed)
WHERE (hasNoMatch <> 1 OR hasNoMatch IS NULL) AND (Count <> -1 OR Count IS NULL)"""
COMMON["unconflicted"] = """
SELECT * REPLACE (
 CASE WHEN skip AND Weight_type = 'Sample' THEN NULL ELSE AFDW_g_from_WW END AS AFDW_g_from_WW,
 CASE WHEN skip AND Weight_type = 'Sample' THEN NULL ELSE Weight_type END AS Weight_type) FROM (
SELECT *, bool_or(Weight_type = 'Sample' AND Weight_type_AFDW IS NOT NULL)
 OVER (PARTITION BY valid_name, Weight_type) AS skip FROM upscaled)"""
COMMON["cleaned"] = """
SELECT *, coalesce(AFDW_g, AFDW_g_from_WW, AFDW_g_calc) AS AFDW_g_combined,
 CASE WHEN AFDW_g IS NOT NULL THEN 'AFDW_g' WHEN AFDW_g_from_WW IS NOT NULL THEN 'AFDW_g_from_WW'
  ELSE 'AFDW_g_calc' END AS source_AFDW_g_combined,
 CASE WHEN Count IS NULL THEN 1 ELSE 0 END AS incomplete_count,
 CASE WHEN coalesce(AFDW_g, AFDW_g_from_WW, AFDW_g_calc) IS NULL THEN 1 ELSE 0 END AS incomplete_biomass
FROM (SELECT * REPLACE (
 CASE WHEN is_Partial_WW AND AFDW_g_calc IS NOT NULL THEN NULL ELSE AFDW_g_from_WW END AS AFDW_g_from_WW,
 CASE WHEN is_Partial_AFDW AND AFDW_g_calc IS NOT NULL THEN NULL ELSE AFDW_g END AS AFDW_g)
FROM unconflicted)"""
COMMON["totals"] = f"""
SELECT StationID, valid_name, File, {RANKS}, sum(coalesce(Count, 1)) AS Count_total,
 coalesce(sum(AFDW_g_combined), 0) AS Biomass_g, sum(isFuzzy) > 0 AS isFuzzy,
 sum(incomplete_count) > 0 AS incomplete_count, sum(incomplete_biomass) > 0 AS incomplete_biomass
FROM cleaned GROUP BY StationID, valid_name, File, {RANKS}"""
COMMON["densities"] = f"""
SELECT t.* EXCLUDE (Count_total, Biomass_g), s.Comment, {', '.join('s.' + c.strip() for c in STATION_TEXT.split(','))},
 {', '.join('s.' + c for c in STATION_VALUES)},
 Count_total / Sample_area_m2 AS Density_nr_per_m2, Count_total / Sample_volume_m3 AS Density_nr_per_m3,
 Biomass_g / Sample_area_m2 AS Biomass_g_per_m2, Biomass_g / Sample_volume_m3 AS Biomass_g_per_m3
FROM totals t JOIN stations_clean s USING (StationID)"""

oracle("density_by_station_taxon", f"""
SELECT * EXCLUDE ({', '.join(STATION_VALUES + DENSITIES)}), {singles(*STATION_VALUES, *DENSITIES)}
FROM densities""")
oracle("totals_by_station_taxon", f"SELECT * EXCLUDE (Biomass_g), {singles('Biomass_g')} FROM totals")
oracle("individuals", f"""
SELECT File, EntryID, StationID, valid_name, is_ID_confident, rank, genus, family, "order", class,
 phylum, isFuzzy, Count, Size_dimension, Size_mm, is_Partial_AFDW, is_Shell_removed, is_Partial_WW,
 is_Fraction_assumed, is_Preserved, Comment_sp, s.Comment AS Comment_st, {STATION_TEXT},
 {singles(*STATION_VALUES, 'Individual_WW_g', 'Individual_AFDW_g')}
FROM (SELECT File, EntryID, StationID AS sid, valid_name, coalesce(is_ID_confident, true) AS is_ID_confident,
 {RANKS}, isFuzzy <> 0 AS isFuzzy, Count, Size_dimension, Size_mm,
 coalesce(is_Partial_AFDW, false) AS is_Partial_AFDW, is_Shell_removed,
 coalesce(is_Partial_WW, false) AS is_Partial_WW, is_Fraction_assumed,
 coalesce(is_Preserved, false) AS is_Preserved, Comment AS Comment_sp,
 CASE WHEN Weight_type <> 'Sample' THEN WW_g_threshold / Count END AS Individual_WW_g,
 CASE WHEN Weight_type_AFDW <> 'Sample' THEN AFDW_g / Count END AS Individual_AFDW_g
 FROM cleaned WHERE Count IS NOT NULL) c
JOIN (SELECT * EXCLUDE (File) FROM stations_clean) s ON s.StationID = c.sid
WHERE NOT (Size_mm IS NULL AND Individual_WW_g IS NULL AND Individual_AFDW_g IS NULL)""")
oracle("species_biomass", f"""
SELECT EntryID, valid_name, hasNoMatch, isFuzzy, Output_unit,
 {singles('WW_to_AFDW', 'A_factor', 'B_exponent', 'Size_mm', 'WW_g_calc', 'AFDW_g_calc', 'WW_g_threshold', 'AFDW_g_from_WW')} FROM completed""")
oracle("upscale_round", f"""
SELECT EntryID, Count, {singles('AFDW_g', 'AFDW_g_from_WW', 'AFDW_g_calc')} FROM upscaled""")
COMMON["kept"] = """
SELECT *, Weight_type = 'Sample' AND Weight_type_AFDW IS NOT NULL AS is_conflict FROM completed
WHERE (hasNoMatch <> 1 OR hasNoMatch IS NULL) AND (Count <> -1 OR Count IS NULL)"""


def _conflict(keys: str, extra: str) -> str:
    return f"""
SELECT EntryID, {extra} CASE WHEN skip AND Weight_type = 'Sample' THEN NULL ELSE Weight_type END AS Weight_type,
 {single("CASE WHEN skip AND Weight_type = 'Sample' THEN NULL ELSE AFDW_g_from_WW END", 'AFDW_g_from_WW')}
FROM (SELECT *, bool_or(is_conflict) OVER (PARTITION BY {keys}) AS skip FROM kept)"""


oracle("sample_conflict", _conflict("valid_name, Weight_type", "valid_name, is_conflict,"))
oracle("sample_conflict_per_station", _conflict("valid_name, StationID, Weight_type", ""))
oracle("partial_weight", f"""
SELECT EntryID, source_AFDW_g_combined, incomplete_count, incomplete_biomass,
 {singles('AFDW_g', 'AFDW_g_from_WW', 'AFDW_g_combined')} FROM (
SELECT *, coalesce(AFDW_g, AFDW_g_from_WW, AFDW_g_calc) AS AFDW_g_combined,
 CASE WHEN AFDW_g IS NOT NULL THEN 'AFDW_g' WHEN AFDW_g_from_WW IS NOT NULL THEN 'AFDW_g_from_WW'
  ELSE 'AFDW_g_calc' END AS source_AFDW_g_combined,
 CASE WHEN Count IS NULL THEN 1 ELSE 0 END AS incomplete_count,
 CASE WHEN coalesce(AFDW_g, AFDW_g_from_WW, AFDW_g_calc) IS NULL THEN 1 ELSE 0 END AS incomplete_biomass
FROM (SELECT * REPLACE (
 CASE WHEN is_Partial_WW AND AFDW_g_calc IS NOT NULL THEN NULL ELSE AFDW_g_from_WW END AS AFDW_g_from_WW,
 CASE WHEN is_Partial_AFDW AND AFDW_g_calc IS NOT NULL THEN NULL ELSE AFDW_g END AS AFDW_g)
FROM completed))""")
oracle("cleaned_entries", f"""
SELECT EntryID, Count, Weight_type, source_AFDW_g_combined, incomplete_count, incomplete_biomass,
 {singles('AFDW_g', 'AFDW_g_from_WW', 'AFDW_g_calc', 'AFDW_g_combined')} FROM cleaned""")

# --- reports -----------------------------------------------------------------------------

oracle("qc_no_match", """
SELECT File, Species_reported, count(*) AS Number_of_entries FROM completed WHERE hasNoMatch = 1
GROUP BY File, Species_reported""")
oracle("qc_no_factor", """
SELECT valid_name, is_Shell_removed, count(*) AS Number_of_entries FROM completed
WHERE (WW_g > 0 OR WW_g_calc > 0) AND WW_to_AFDW IS NULL GROUP BY valid_name, is_Shell_removed""")
oracle("qc_no_regression", """
SELECT valid_name, Size_dimension, is_Shell_removed, count(*) AS Number_of_species FROM completed
WHERE Size_value > 0 AND Size_dimension IS NOT NULL AND A_factor IS NULL
GROUP BY valid_name, Size_dimension, is_Shell_removed""")
oracle("qc_reports", """
SELECT 'unmatched_names' AS report, File, Species_reported, NULL AS valid_name, NULL AS Size_dimension, NULL AS is_Shell_removed, count(*) AS n
FROM completed WHERE hasNoMatch = 1 GROUP BY ALL
UNION ALL SELECT 'missing_factors', NULL, NULL, valid_name, NULL, is_Shell_removed, count(*)
FROM completed WHERE (WW_g > 0 OR WW_g_calc > 0) AND WW_to_AFDW IS NULL GROUP BY ALL
UNION ALL SELECT 'missing_regressions', NULL, NULL, valid_name, Size_dimension, is_Shell_removed, count(*)
FROM completed WHERE Size_value > 0 AND Size_dimension IS NOT NULL AND A_factor IS NULL GROUP BY ALL""")
oracle("qc_depth_difference", f"""
SELECT {single('avg(Water_depth_m_cruise) - (SELECT avg(depth) FROM depth_reported)', 'mean_diff_depth')}
FROM stations""")

# --- community matrices ------------------------------------------------------------------


def _matrix(level: str, measure: str, taxa: tuple[str, ...], where: str = "TRUE") -> str:
    def cell(taxon: str) -> str:
        mine = f"""FILTER (WHERE "{level}" = '{taxon}')"""
        if measure == "presence_absence":
            value = f"CASE WHEN count(*) {mine} > 0 THEN 1 ELSE 0 END"
        else:
            value = (
                f"CASE WHEN count(*) {mine} = 0 THEN 0"
                f" WHEN count({measure}) {mine} = count(*) {mine} THEN sum({measure}) {mine} END"
            )
        return single(value, taxon)

    return f"""
SELECT StationID, {', '.join(cell(t) for t in taxa)} FROM densities WHERE {where} GROUP BY StationID"""


# The second words of the part names give the genera, families and orders.
GENERA = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
FAMILIES = ("fam_an", "fam_bo", "fam_ge", "fam_gi", "fam_pl", "fam_ri", "fam_ro", "fam_wi")
ORDERS = ("ord_a", "ord_b", "ord_g", "ord_p", "ord_r", "ord_w")

oracle("community_density_family", _matrix("family", "Density_nr_per_m3", FAMILIES))
oracle("community_presence_absence", _matrix("genus", "presence_absence", GENERA))
oracle("community_complete_only", _matrix(
    "order", "Biomass_g_per_m2", ORDERS, "NOT incomplete_biomass"
))
oracle("community_values", f"""
SELECT StationID, valid_name AS taxon, {single('CASE WHEN count(Biomass_g_per_m3) = count(*) THEN sum(Biomass_g_per_m3) END', 'value')}
FROM densities WHERE rank = 'Species' GROUP BY StationID, valid_name""")

# --- validation --------------------------------------------------------------------------


def _rules(table: str, key: str, rules: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {"File" if table != "faulty_bioconversion" else "'bioconversion.csv'"} AS File,
 '{rule}' AS rule, {key} AS row_key, '{column}' AS "column", '{message}' AS message, CAST(1 AS BIGINT) AS n
FROM {table} WHERE {bad}"""
        for rule, column, message, bad in rules
    )


def _required(*columns: str) -> list[tuple[str, str, str, str]]:
    return [("required_missing", c, "a required value is NA", f"{c} IS NULL") for c in columns]


def _below(rule: str, message: str, bad: str, *columns: str) -> list[tuple[str, str, str, str]]:
    return [(rule, c, message, f"{c} {bad}") for c in columns]


def _listed(column: str, *values: str) -> tuple[str, str, str, str]:
    allowed = ", ".join(values)
    quoted = ", ".join(f"'{v}'" for v in values)
    return ("not_predefined", column, "must be one of: " + allowed, f"{column} NOT IN ({quoted})")


DIMENSIONS = (
    "Body_length", "Body_width", "Diameter", "Shell_length", "Shell_width", "Shell_height",
    "Siphon_width", "Tube_length", "Claw_length", "Claw_width", "Carapace_length",
    "Carapace_width", "Max_length", "Arm_disc_length", "Disc_diameter", "Mantle_length", "Area",
    "Volume",
)
WW_PARTS = ("Weight_type", "Threshold_scale", "is_Shell_removed", "is_Partial_WW")
AFDW_PARTS = ("Weight_type_AFDW", "Threshold_scale_AFDW", "is_Partial_AFDW")


def _weight(weight: str, parts: tuple[str, ...]) -> list[tuple[str, str, str, str]]:
    lacking = " OR ".join(f"{p} IS NULL" for p in parts)
    return [
        ("weight_incomplete", weight, "needs " + ", ".join(parts),
         f"{weight} IS NOT NULL AND ({lacking})"),
        ("weight_missing", weight, f"{parts[0]} cannot be Entry without a weight",
         f"{weight} IS NULL AND {parts[0]} = 'Entry'"),
    ]


oracle("violations_row_rules", _rules("faulty_species", "EntryID", [
    *_required("EntryID", "StationID", "Fraction", "is_Fraction_assumed", "Species_reported"),
    ("fraction_range", "Fraction", "must lie between 0 and 1", "Fraction < 0 OR Fraction > 1"),
    _listed("Size_dimension", *DIMENSIONS),
    _listed("Size_unit", "mm", "cm", "1/2cm", "mm2", "cm2", "mm3", "cm3"),
    _listed("Weight_type", "Entry", "Sample"),
    _listed("Weight_type_AFDW", "Entry", "Sample"),
    *_below("negative", "may not be negative", "< 0", "Size_value", "WW_g", "AFDW_g"),
    *_below("not_positive", "must be positive", "<= 0", "Threshold_scale", "Threshold_scale_AFDW"),
    ("negative", "Count", "may not be negative, except -1", "Count < -1"),
    ("count_zero", "Count", "may not be 0, use NA", "Count = 0"),
    *_weight("WW_g", WW_PARTS),
    *_weight("AFDW_g", AFDW_PARTS),
    *[("size_incomplete", c, "is missing for a measured size",
       f"Size_value IS NOT NULL AND {c} IS NULL") for c in ("Size_unit", "Size_dimension")],
    *[("size_missing", c, "is given without a size",
       f"Size_value IS NULL AND {c} IS NOT NULL") for c in ("Size_unit", "Size_dimension")],
]))
oracle("violations_station_rules", _rules("faulty_stations", "StationID", [
    *_required("CruiseID", "StationID", "Date", "Blade_depth_cm", "Blade_width_cm",
               "is_Quantitative", "Station_objective"),
    ("alternatives_missing", "Lat_start_DD, Lon_start_DD, Lat_stop_DD, Lon_stop_DD",
     "no complete set of alternative values",
     "(Lat_start_DD IS NULL OR Lon_start_DD IS NULL OR Lat_stop_DD IS NULL OR Lon_stop_DD IS NULL)"
     " AND (Lat_DD_midpt IS NULL OR Lon_DD_midpt IS NULL OR Track_length_m_preset IS NULL)"),
    _listed("Station_objective", "Complete", "Incomplete"),
    _listed("Region", "BB", "BC", "CB", "CZ", "DB", "DH", "FF", "FG", "OF", "OG", "WM"),
    *[("time_format", c, "must be a time HH:MM:SS",
       f"NOT regexp_full_match({c}, '[0-2][0-9]:[0-5][0-9]:[0-5][0-9]')")
      for c in ("Time_start", "Time_stop")],
    *_below("negative", "may not be negative", "< 0", "Track_length_m_preset", "Blade_depth_cm",
            "Blade_width_cm", "Tow_speed_knots", "Water_depth_m_cruise", "Odometer_count"),
    ("bearing_range", "Bearing", "must lie in -180 to 180", "abs(Bearing) > 180"),
    ("objective", "Station_objective", "Incomplete needs taxa in Excluded or Focus",
     "Station_objective = 'Incomplete' AND Excluded IS NULL AND Focus IS NULL"),
]))


def _set_rule(rule: str, column: str, message: str, key: str, groups: str, file: str = "File") -> str:
    return f"""SELECT {file} AS File, '{rule}' AS rule, {key} AS row_key, '{column}' AS "column",
 '{message}' AS message, CAST(n AS BIGINT) AS n FROM ({groups})"""


NO_FILE = "CAST(NULL AS VARCHAR)"
oracle("violations_bioconversion", _rules("faulty_bioconversion", "Taxon", [
    *_required("Taxon", "is_Shell_removed"),
    ("fraction_range", "WW_to_AFDW", "must lie between 0 and 1", "WW_to_AFDW < 0 OR WW_to_AFDW > 1"),
    _listed("Size_dimension", *DIMENSIONS),
    _listed("Size_unit", "mm", "mm2", "mm3"),
    _listed("Output_unit", "AFDW_g", "WW_g"),
    *_below("negative", "may not be negative", "< 0", "WW_to_AFDW"),
]) + " UNION ALL " + _set_rule(
    "factor_duplicated", "WW_to_AFDW", "more than one factor for a taxon and shell state", "Taxon",
    """SELECT Taxon, is_Shell_removed, count(*) AS n FROM (SELECT DISTINCT Taxon, WW_to_AFDW,
 Reference_WW_to_AFDW, is_Shell_removed, Comment_WW_to_AFDW FROM faulty_bioconversion WHERE WW_to_AFDW > 0)
GROUP BY Taxon, is_Shell_removed HAVING count(*) > 1""", NO_FILE,
) + " UNION ALL " + _set_rule(
    "regression_duplicated", "A_factor",
    "more than one regression for a taxon, dimension and shell state", "Taxon",
    """SELECT Taxon, Size_dimension, is_Shell_removed, count(*) AS n FROM (SELECT DISTINCT Taxon, Size_dimension,
 A_factor, B_exponent, Output_unit, Reference_regression, Comment_regression, is_Shell_removed
 FROM faulty_bioconversion WHERE Output_unit IS NOT NULL)
GROUP BY Taxon, Size_dimension, is_Shell_removed HAVING count(*) > 1""", NO_FILE,
))
oracle("violations_duplicate_ids", _set_rule(
    "id_duplicated", "EntryID", "IDs must be unique in a file", "EntryID",
    """SELECT l_returnflag || '.csv' AS File, l_orderkey || '_' || l_linenumber AS EntryID, count(*) - 1 AS n
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""))
oracle("violations_repeated_stations", _set_rule(
    "station_repeated", "StationID", "StationID occurs more than once over the files", "CruiseID",
    "SELECT CruiseID, count(*) - 1 AS n FROM stations GROUP BY CruiseID HAVING count(*) > 1", NO_FILE))
oracle("violations_fraction_consistency", _set_rule(
    "fraction_inconsistent", "Fraction",
    "Fraction and is_Fraction_assumed must be equal for a taxon in a sample",
    "concat_ws(' / ', StationID, Species_reported)",
    """SELECT File, StationID, Species_reported, count(*) AS n FROM faulty_species WHERE Count > -1
GROUP BY File, StationID, Species_reported
HAVING count(DISTINCT struct_pack(f := Fraction, a := is_Fraction_assumed)) > 1"""))
oracle("violations_sample_weights", " UNION ALL ".join(
    _set_rule(
        "bulk_weight_missing", weight, f"every {weight} of the Sample entries is NA",
        "concat_ws(' / ', StationID, Species_reported)",
        f"""SELECT File, StationID, Species_reported, count(*) AS n FROM faulty_species
WHERE {kind} = 'Sample' GROUP BY File, StationID, Species_reported
HAVING sum(CASE WHEN {weight} IS NULL THEN 1 ELSE 0 END) = count(*)""")
    for weight, kind in (("WW_g", "Weight_type"), ("AFDW_g", "Weight_type_AFDW"))
))
oracle("violations_orphan_stations", _set_rule(
    "station_unknown", "StationID", "StationID is missing in the stations table", "StationID",
    """SELECT StationID, count(*) AS n FROM faulty_species
WHERE StationID NOT IN (SELECT StationID FROM stations) GROUP BY StationID""", NO_FILE))


def _text(c: str, unreadable: str = "", message: str = "", rule: str = "") -> list[tuple[str, str, str, str]]:
    full = f"{c} IS NOT NULL AND {c} NOT IN ('', 'NaN', 'NA')"
    return [
        ("empty_cell", c, "cells may not be empty", f"{c} IS NULL OR {c} IN ('', 'NaN')"),
        ("required_missing", c, "a required value is NA", f"{c} = 'NA'"),
        *([(rule, c, message, f"{full} AND {unreadable}")] if rule else []),
    ]


NUMBER = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"
oracle("violations_text_rules", _rules("text_species", "EntryID", [
    *_text("EntryID"), *_text("StationID"), *_text("Species_reported"),
    *_text("Fraction", f"NOT regexp_full_match(Fraction, {NUMBER})", "not a number", "not_double"),
    *_text("is_Fraction_assumed", "lower(is_Fraction_assumed) NOT IN ('0', '1', 'true', 'false')",
           "must be 0, 1 or NA", "not_boolean"),
    ("empty_cell", "Count", "cells may not be empty", "Count IS NULL OR Count IN ('', 'NaN')"),
    ("not_integer", "Count", "not a whole number",
     "Count NOT IN ('', 'NaN', 'NA') AND NOT regexp_full_match(Count, '[+-]?[0-9]+')"),
    ("count_zero", "Count", "may not be 0, use NA", "Count = '0'"),
]) + " UNION ALL " + _rules("text_stations", "StationID", [
    *_text("StationID"),
    *_text("Date", "try_strptime(Date, '%d/%m/%Y') IS NULL", "must be a date DD/MM/YYYY", "date_format"),
]))


def _header(kind: int, rule: str, column: str, message: str) -> str:
    return f"""SELECT File, '{rule}' AS rule, CAST(NULL AS VARCHAR) AS row_key, '{column}' AS "column",
 '{message}' AS message, CAST(1 AS BIGINT) AS n FROM file_columns WHERE kind = {kind}"""


_BASE = ("CruiseID, StationID, Date, Blade_depth_cm, Blade_width_cm, is_Quantitative, Station_objective,"
         " Lat_start_DD, Lon_start_DD, Lat_stop_DD, Lon_stop_DD")
oracle("violations_headers", " UNION ALL ".join([
    _header(1, "required_absent", "CruiseID", "required columns are absent"),
    _header(2, "name_invalid", "Extra", "unknown column names"),
    _header(3, "name_repeated", _BASE + ", Comment, Comment", "column names occur more than once"),
    _header(4, "alternatives_absent", "Lat_start_DD, Lon_start_DD, Lat_stop_DD, Lon_stop_DD",
            "no complete set of alternative columns"),
    _header(5, "group_incomplete", "Lon_DD_midpt, Track_length_m_preset",
            "columns that belong together are absent"),
]))
oracle("violations_conversion_headers", " UNION ALL ".join([
    _header(1, "required_absent", "Taxon", "required columns are absent"),
    _header(2, "required_absent", "is_Shell_removed", "required columns are absent"),
    _header(3, "group_incomplete", "Reference_WW_to_AFDW", "columns that belong together are absent"),
    _header(5, "group_incomplete", "A_factor, Output_unit", "columns that belong together are absent"),
]))
oracle("violations_conversion_text", _rules("text_bioconversion", "Taxon", [
    ("empty_cell", "WW_to_AFDW", "cells may not be empty", "WW_to_AFDW = ''"),
    ("not_double", "WW_to_AFDW", "not a number", "WW_to_AFDW IN ('one', '0.2x')"),
    ("not_double", "A_factor", "not a number", "A_factor = '1,5'"),
    ("required_missing", "is_Shell_removed", "a required value is NA", "is_Shell_removed = 'NA'"),
    ("not_boolean", "is_Shell_removed", "must be 0, 1 or NA", "is_Shell_removed = 'maybe'"),
    ("fraction_range", "WW_to_AFDW", "must lie between 0 and 1", "WW_to_AFDW = '-1'"),
    ("negative", "WW_to_AFDW", "may not be negative", "WW_to_AFDW = '-1'"),
]))
oracle("bind_rows", """
SELECT File, EntryID, nullif(StationID, 'NA') AS StationID,
 CASE WHEN Fraction NOT IN ('half', 'NaN', 'NA') THEN TRY_CAST(Fraction AS DOUBLE) END AS Fraction,
 CAST(NULL AS BOOLEAN) AS is_Fraction_assumed, Species_reported,
 CASE WHEN regexp_full_match(Count, '[+-]?[0-9]+') THEN TRY_CAST(Count AS BIGINT) END AS Count, CAST(NULL AS DOUBLE) AS WW_g
FROM text_species WHERE File < 'sp_1995.csv'
UNION ALL
SELECT File, EntryID, NULL, NULL, CASE WHEN lower(is_Fraction_assumed) IN ('1', 'true') THEN true
 WHEN lower(is_Fraction_assumed) IN ('0', 'false') THEN false END, Species_reported, NULL, NULL
FROM text_species WHERE File >= 'sp_1995.csv'""")
oracle("boolean_defaults", """
SELECT EntryID, CASE WHEN Size_dimension IS NOT NULL THEN is_Shell_removed ELSE false END AS is_Shell_removed
FROM species""")
oracle("lookup_doubles", f"""
SELECT 'factors' AS lookup, valid_name || ', ' || is_Shell_removed AS key, count(*) AS Count FROM (
 SELECT DISTINCT {FACTOR_COLUMNS} FROM named_merged WHERE valid_name IS NOT NULL AND WW_to_AFDW > 0)
GROUP BY valid_name, is_Shell_removed HAVING count(*) > 1
UNION ALL
SELECT 'regressions', valid_name || ', ' || Size_dimension || ', ' || is_Shell_removed, count(*) FROM (
 SELECT DISTINCT {REGRESSION_COLUMNS} FROM named_merged WHERE valid_name IS NOT NULL AND Output_unit IS NOT NULL)
GROUP BY valid_name, Size_dimension, is_Shell_removed HAVING count(*) > 1
UNION ALL
SELECT 'taxonomy', name, count(*) FROM taxonomy_candidates GROUP BY name HAVING count(*) > 1""")

# --- what is rare ----------------------------------------------------------------------------

for _name in ("completed", "upscaled", "unconflicted", "cleaned", "totals"):
    _text = COMMON[_name].replace("JOIN names n", "JOIN merged_names n")
    for _before in ("completed", "upscaled", "unconflicted", "cleaned"):
        _text = re.sub(rf"\bFROM {_before}\b", f"FROM fuzzy_{_before}", _text)
    COMMON[f"fuzzy_{_name}"] = _text
oracle("totals_fuzzy_names", f"SELECT * EXCLUDE (Biomass_g), {singles('Biomass_g')} FROM fuzzy_totals")
oracle("rare_upscale", f"""
SELECT EntryID, CASE WHEN Fraction <> 0 THEN round_even(Count / Fraction, 0) END AS Count,
 {', '.join(single(f'CASE WHEN Fraction <> 0 THEN {c} / Fraction END', c) for c in ('AFDW_g', 'AFDW_g_from_WW', 'AFDW_g_calc'))}
FROM rare_entries""")
oracle("rare_regressions", """
SELECT EntryID, e.valid_name, e.Size_dimension, e.is_Shell_removed, A_factor, B_exponent, Output_unit
FROM rare_entries e LEFT JOIN rare_regressions r ON r.valid_name = e.valid_name
 AND r.Size_dimension IS NOT DISTINCT FROM e.Size_dimension AND r.is_Shell_removed IS NOT DISTINCT FROM e.is_Shell_removed""")
COMMON["rare_sums"] = f"""
SELECT StationID, valid_name, File, {RANKS}, sum(coalesce(Count, 1)) AS Count_total,
 coalesce(sum(AFDW_g_combined), 0) AS Biomass_g, max(isFuzzy) > 0 AS isFuzzy,
 max(incomplete_count) > 0 AS incomplete_count, max(incomplete_biomass) > 0 AS incomplete_biomass
FROM rare_entries GROUP BY StationID, valid_name, File, {RANKS}"""
COMMON["rare_database"] = """
SELECT r.* EXCLUDE (Count_total, Biomass_g), s.* EXCLUDE (File, StationID),
 CASE WHEN Sample_area_m2 <> 0 THEN Count_total / Sample_area_m2 END AS Density_nr_per_m2,
 CASE WHEN Sample_volume_m3 <> 0 THEN Count_total / Sample_volume_m3 END AS Density_nr_per_m3,
 CASE WHEN Sample_area_m2 <> 0 THEN Biomass_g / Sample_area_m2 END AS Biomass_g_per_m2,
 CASE WHEN Sample_volume_m3 <> 0 THEN Biomass_g / Sample_volume_m3 END AS Biomass_g_per_m3
FROM rare_sums r JOIN rare_stations s ON s.StationID = r.StationID"""
oracle("rare_totals", f"SELECT * EXCLUDE (Biomass_g), {singles('Biomass_g')} FROM rare_sums")
oracle("rare_densities", f"SELECT * EXCLUDE ({', '.join(DENSITIES)}), {singles(*DENSITIES)} FROM rare_database")
oracle("rare_community_values", f"""
SELECT StationID, family AS taxon, {single('CASE WHEN count(Density_nr_per_m2) = count(*) THEN sum(Density_nr_per_m2) END', 'value')}
FROM rare_database GROUP BY StationID, family""")


def _rare_cell(name: str, condition: str) -> str:
    mine = f"FILTER (WHERE {condition})"
    value = (
        f"CASE WHEN count(*) {mine} = 0 THEN 0"
        f" WHEN count(Density_nr_per_m3) {mine} = count(*) {mine} THEN sum(Density_nr_per_m3) {mine} END"
    )
    return single(value, name)


oracle("rare_community_matrix", f"""
SELECT StationID, {', '.join(_rare_cell(f, f"family = '{f}'") for f in FAMILIES)}, {_rare_cell('NA', 'family IS NULL')}
FROM rare_database GROUP BY StationID""")
