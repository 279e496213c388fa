"""Survey-shaped tables derived from the warehouse test tables.

The test tables hold no survey data, so stations come from `orders`, entries from
`lineitem`, taxa from `part`, with missing values put in by rule. The text is plain
SQL that Spark and the checking database both run, whole tables in, whole tables out.
Coordinates are added up as doubles, because the engines differ on decimal division.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "lineitem", "part")

VIEWS: dict[str, str] = {}
VIEWS["stations"] = """
SELECT 'st_' || year(o_orderdate) || '.csv' AS File,
 'C' || (o_custkey % 40) AS CruiseID,
 'C' || (o_custkey % 40) || '#' || o_orderkey AS StationID,
 CAST(o_orderdate AS DATE) AS Date,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(51.003 AS DOUBLE) + (o_orderkey % 400) / CAST(100 AS DOUBLE) END AS Lat_start_DD,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(2.003 AS DOUBLE) + (o_custkey % 450) / CAST(100 AS DOUBLE) END AS Lon_start_DD,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(51.0035 AS DOUBLE) + (o_orderkey % 400) / CAST(100 AS DOUBLE) END AS Lat_stop_DD,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(2.0038 AS DOUBLE) + (o_custkey % 450) / CAST(100 AS DOUBLE) END AS Lon_stop_DD,
 CASE WHEN o_orderkey % 4 IN (1, 2) THEN NULL ELSE CAST(51.0032 AS DOUBLE) + (o_orderkey % 400) / CAST(100 AS DOUBLE) END AS Lat_DD_midpt,
 CASE WHEN o_orderkey % 4 IN (1, 2) THEN NULL ELSE CAST(2.0034 AS DOUBLE) + (o_custkey % 450) / CAST(100 AS DOUBLE) END AS Lon_DD_midpt,
 CASE WHEN o_orderkey % 4 IN (1, 2) THEN NULL ELSE CAST(100 AS DOUBLE) END AS Track_length_m_preset,
 CAST(20 AS DOUBLE) AS Blade_width_cm, CAST(18 AS DOUBLE) AS Blade_depth_cm,
 o_orderkey % 7 <> 0 AS is_Quantitative,
 CASE WHEN o_orderstatus = 'F' THEN 'Incomplete' ELSE 'Complete' END AS Station_objective,
 CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'ring;rod' END AS Excluded,
 CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 1 THEN 'plate' END AS Focus,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(10 + o_orderkey % 40 AS DOUBLE) END AS Water_depth_m_cruise,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 40 + o_orderkey % 20 END AS Odometer_count,
 CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderkey % 360 - 180 AS DOUBLE) END AS Bearing,
 CASE WHEN o_orderkey % 9 = 0 THEN 'note' END AS Comment
FROM {orders}
"""

VIEWS["species"] = """
SELECT 'sp_' || year(o_orderdate) || '.csv' AS File,
 l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS EntryID,
 'C' || (o_custkey % 40) || '#' || l_orderkey AS StationID,
 CASE WHEN (l_orderkey + length(p_name)) % 3 = 0 THEN CAST(0.5 AS DOUBLE) WHEN (l_orderkey + length(p_name)) % 3 = 1 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS Fraction,
 l_orderkey % 2 = 0 AS is_Fraction_assumed,
 CASE WHEN l_suppkey % 10 = 3 THEN split_part(p_name, ' ', 2) ELSE p_name END AS Species_reported,
 CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity = 1 THEN -1 ELSE CAST(l_quantity AS BIGINT) END AS Count,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'Shell_length' WHEN l_returnflag = 'N' THEN 'Max_length' ELSE 'Area' END AS Size_dimension,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS Size_value,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'cm2' ELSE 'mm2' END WHEN l_linestatus = 'O' THEN CASE WHEN l_linenumber % 2 = 0 THEN '1/2cm' ELSE 'cm' END ELSE 'mm' END AS Size_unit,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 4 = 1 AND l_discount < 0.015 THEN CAST(0 AS DOUBLE) WHEN l_linenumber % 4 = 3 AND l_suppkey % 2 = 0 THEN NULL ELSE l_extendedprice / 1000 END AS WW_g,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 4 = 3 THEN 'Sample' ELSE 'Entry' END AS Weight_type,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS Threshold_scale,
 l_partkey % 2 = 0 AS is_Shell_removed,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_suppkey % 5 = 0 END AS is_Partial_WW,
 CASE WHEN l_suppkey % 10 = 1 AND (l_linenumber % 4 <> 3 OR p_name LIKE 'blue%') THEN l_extendedprice / 10000 END AS AFDW_g,
 CASE WHEN l_suppkey % 10 = 1 AND (l_linenumber % 4 <> 3 OR p_name LIKE 'blue%') THEN CASE WHEN l_linenumber = 3 AND l_partkey % 40 = 0 THEN 'Sample' ELSE 'Entry' END END AS Weight_type_AFDW,
 CASE WHEN l_suppkey % 10 = 1 AND (l_linenumber % 4 <> 3 OR p_name LIKE 'blue%') THEN CAST(0.005 AS DOUBLE) END AS Threshold_scale_AFDW,
 CASE WHEN l_suppkey % 10 = 1 AND (l_linenumber % 4 <> 3 OR p_name LIKE 'blue%') THEN l_partkey % 7 = 0 END AS is_Partial_AFDW,
 CASE WHEN l_linenumber = 2 THEN NULL ELSE l_linenumber <> 5 END AS is_ID_confident,
 CASE WHEN l_linenumber = 4 THEN NULL ELSE l_linenumber = 1 END AS is_Preserved,
 CASE WHEN l_linenumber = 6 THEN 'fragment' END AS Comment
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

VIEWS["taxonomy_candidates"] = """
SELECT DISTINCT p_name AS name, 1 AS cand_id, p_name AS valid_name, 'accepted' AS status,
 CASE WHEN length(p_name) % 5 = 0 THEN 1 ELSE 0 END AS isExtinct, 'Species' AS rank,
 'phy' || (length(split_part(p_name, ' ', 2)) % 3) AS phylum, 'cla' || (length(split_part(p_name, ' ', 2)) % 4) AS class,
 'ord_' || substr(split_part(p_name, ' ', 2), 1, 1) AS "order", 'fam_' || substr(split_part(p_name, ' ', 2), 1, 2) AS family,
 split_part(p_name, ' ', 2) AS genus
FROM {part} WHERE split_part(p_name, ' ', 1) <> 'old'
UNION ALL
SELECT DISTINCT p_name, 2, split_part(p_name, ' ', 2) || ' alt', 'unaccepted', 0, 'Species', 'phy' || (length(split_part(p_name, ' ', 2)) % 3), 'cla' || (length(split_part(p_name, ' ', 2)) % 4),
 'ord_' || substr(split_part(p_name, ' ', 2), 1, 1), 'fam_' || substr(split_part(p_name, ' ', 2), 1, 2), split_part(p_name, ' ', 2)
FROM {part} WHERE split_part(p_name, ' ', 1) IN ('red', 'hot')
UNION ALL
SELECT DISTINCT split_part(p_name, ' ', 2), 1, split_part(p_name, ' ', 2), 'accepted', 0, 'Genus', 'phy' || (length(split_part(p_name, ' ', 2)) % 3), 'cla' || (length(split_part(p_name, ' ', 2)) % 4),
 'ord_' || substr(split_part(p_name, ' ', 2), 1, 1), 'fam_' || substr(split_part(p_name, ' ', 2), 1, 2), split_part(p_name, ' ', 2)
FROM {part}
"""

VIEWS["bioconversion"] = """
SELECT DISTINCT p_name AS Taxon, CAST((length(p_name) % 10 + 5) / 100.0 AS DOUBLE) AS WW_to_AFDW, 'ref' AS Reference_WW_to_AFDW, CAST(NULL AS VARCHAR(9)) AS Comment_WW_to_AFDW,
 CASE WHEN length(p_name) % 4 < 2 THEN 'Shell_length' ELSE 'Max_length' END AS Size_dimension, 'mm' AS Size_unit,
 CAST(length(p_name) / 100000.0 AS DOUBLE) AS A_factor, CAST(2.5 AS DOUBLE) AS B_exponent,
 CASE WHEN length(p_name) % 3 = 0 THEN 'AFDW_g' ELSE 'WW_g' END AS Output_unit, 'ref' AS Reference_regression, CAST(NULL AS VARCHAR(9)) AS Comment_regression,
 p_partkey % 2 AS is_Shell_removed
FROM {part} WHERE split_part(p_name, ' ', 1) <> 'red'
UNION ALL
SELECT DISTINCT split_part(p_name, ' ', 2), CAST(0.15 AS DOUBLE), 'genus', CAST(NULL AS VARCHAR(9)), 'Shell_length', 'mm', CAST(0.0002 AS DOUBLE), CAST(2.5 AS DOUBLE), 'WW_g', 'genus', CAST(NULL AS VARCHAR(9)), 1
FROM {part}
"""

VIEWS["bathymetry"] = """
SELECT CAST(20 + i AS DOUBLE) / 10 AS x, CAST(510 + j AS DOUBLE) / 10 AS y, -CAST(10 + (i * 7 + j * 3) % 50 AS DOUBLE) AS z
FROM (SELECT DISTINCT o_orderkey % 40 AS i FROM {orders}) a CROSS JOIN (SELECT DISTINCT o_orderkey % 40 AS j FROM {orders}) b
"""

# The same tables with faults of every kind, for the validation rules.
VIEWS["faulty_species"] = """
SELECT File, EntryID,
 CASE WHEN Count = 14 THEN 'X' || StationID ELSE StationID END AS StationID,
 CASE WHEN Count = 2 THEN CAST(1.5 AS DOUBLE) WHEN Count = 15 THEN CAST(-0.5 AS DOUBLE) ELSE Fraction END AS Fraction,
 is_Fraction_assumed,
 CASE WHEN Count = 13 THEN NULL ELSE Species_reported END AS Species_reported,
 CASE WHEN Count = 3 THEN 0 WHEN Count = 4 THEN -2 ELSE Count END AS Count,
 CASE WHEN Size_value = 11 THEN 'Girth' WHEN Size_value = 12 THEN NULL ELSE Size_dimension END AS Size_dimension,
 CASE WHEN Size_value = 9 THEN NULL WHEN Size_value = 10 THEN -Size_value ELSE Size_value END AS Size_value,
 CASE WHEN Size_value = 7 THEN 'inch' WHEN Size_value = 8 THEN NULL ELSE Size_unit END AS Size_unit,
 CASE WHEN Count = 5 THEN NULL WHEN Count = 9 THEN -WW_g - 1 ELSE WW_g END AS WW_g,
 CASE WHEN Count = 7 THEN 'Bulk' ELSE Weight_type END AS Weight_type,
 CASE WHEN Count = 6 THEN NULL WHEN Count = 8 THEN -Threshold_scale ELSE Threshold_scale END AS Threshold_scale,
 is_Shell_removed, is_Partial_WW,
 CASE WHEN Count = 12 OR Count = 18 THEN NULL WHEN Count = 16 THEN -AFDW_g - 1 ELSE AFDW_g END AS AFDW_g,
 CASE WHEN Count = 17 THEN 'Bulk' WHEN Count = 18 THEN 'Sample' ELSE Weight_type_AFDW END AS Weight_type_AFDW,
 CASE WHEN Count = 10 THEN CAST(0 AS DOUBLE) ELSE Threshold_scale_AFDW END AS Threshold_scale_AFDW,
 CASE WHEN Count = 11 THEN NULL ELSE is_Partial_AFDW END AS is_Partial_AFDW,
 is_ID_confident, is_Preserved, Comment
FROM {species}
"""

VIEWS["faulty_stations"] = """
SELECT File, CruiseID, StationID,
 CASE WHEN Odometer_count = 41 THEN NULL ELSE Date END AS Date,
 Lat_start_DD, Lon_start_DD,
 CASE WHEN Odometer_count = 42 THEN NULL ELSE Lat_stop_DD END AS Lat_stop_DD,
 Lon_stop_DD, Lat_DD_midpt, Lon_DD_midpt,
 CASE WHEN Odometer_count = 43 THEN -Track_length_m_preset ELSE Track_length_m_preset END AS Track_length_m_preset,
 CASE WHEN Odometer_count = 44 THEN -Blade_width_cm ELSE Blade_width_cm END AS Blade_width_cm,
 CASE WHEN Odometer_count = 46 THEN -Blade_depth_cm ELSE Blade_depth_cm END AS Blade_depth_cm,
 is_Quantitative,
 CASE WHEN Odometer_count = 47 THEN 'Partial' ELSE Station_objective END AS Station_objective,
 CASE WHEN Odometer_count = 48 THEN NULL ELSE Excluded END AS Excluded,
 CASE WHEN Odometer_count = 49 THEN NULL ELSE Focus END AS Focus,
 CASE WHEN Odometer_count = 51 THEN 'North' ELSE 'OG' END AS Region,
 CASE WHEN Odometer_count = 52 THEN '9:30:00' WHEN Odometer_count = 53 THEN '10:00:0011:00:00' ELSE '09:30:00' END AS Time_start,
 CASE WHEN Odometer_count = 54 THEN '23:60:00' END AS Time_stop,
 CASE WHEN Odometer_count = 56 THEN -Water_depth_m_cruise ELSE Water_depth_m_cruise END AS Water_depth_m_cruise,
 CASE WHEN Odometer_count = 57 THEN -1 ELSE Odometer_count END AS Odometer_count,
 Bearing * 2 AS Bearing, CASE WHEN Odometer_count = 58 THEN CAST(-1 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END AS Tow_speed_knots, Comment
FROM {stations}
"""

VIEWS["faulty_bioconversion"] = """
SELECT DISTINCT p_name AS Taxon, CASE WHEN p_size = 7 THEN CAST(-0.1 AS DOUBLE) ELSE CAST(p_size / 40.0 AS DOUBLE) END AS WW_to_AFDW, 'ref' AS Reference_WW_to_AFDW,
 CAST(NULL AS VARCHAR(9)) AS Comment_WW_to_AFDW,
 CASE WHEN p_size % 10 = 0 THEN 'Width' ELSE 'Shell_length' END AS Size_dimension,
 CASE WHEN p_size % 10 = 1 THEN 'cm' ELSE 'mm' END AS Size_unit,
 CAST((length(p_name) + p_size) / 100000.0 AS DOUBLE) AS A_factor, CAST(2.5 AS DOUBLE) AS B_exponent,
 CASE WHEN p_size % 10 = 2 THEN 'g' ELSE 'AFDW_g' END AS Output_unit, 'ref' AS Reference_regression,
 CAST(NULL AS VARCHAR(9)) AS Comment_regression,
 CASE WHEN p_size % 10 = 3 THEN NULL ELSE p_partkey % 2 = 0 END AS is_Shell_removed
FROM {part}
"""

# Entries as they stand in a file, as text, with cells that cannot be read.
VIEWS["text_species"] = """
SELECT 'sp_' || year(o_orderdate) || '.csv' AS File,
 CASE WHEN l_quantity = 20 THEN '' ELSE l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey END AS EntryID,
 CASE WHEN l_quantity = 21 THEN 'NA' ELSE 'C' || o_custkey END AS StationID,
 CASE WHEN l_quantity = 22 THEN 'half' WHEN l_quantity = 23 THEN 'NaN' ELSE '0.5' END AS Fraction,
 CASE WHEN l_quantity = 24 THEN 'yes' WHEN l_quantity = 25 THEN '2' WHEN l_quantity = 26 THEN 'TRUE' ELSE '0' END AS is_Fraction_assumed,
 CASE WHEN l_quantity = 27 THEN CAST(NULL AS VARCHAR(9)) ELSE p_name END AS Species_reported,
 CASE WHEN l_quantity = 28 THEN '1.5' WHEN l_quantity = 29 THEN '0' WHEN l_quantity = 30 THEN 'NA' ELSE '4' END AS Count
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

VIEWS["text_bioconversion"] = """
SELECT 'conversion.csv' AS File, p_name || ' ' || p_partkey AS Taxon,
 CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN '0.2x' WHEN 3 THEN 'NA' WHEN 4 THEN '' WHEN 5 THEN '-1' ELSE '0.2' END AS WW_to_AFDW,
 CASE p_size WHEN 6 THEN '1,5' WHEN 9 THEN 'NA' ELSE '1.5e-3' END AS A_factor,
 CASE p_size WHEN 7 THEN 'NA' WHEN 8 THEN 'maybe' WHEN 10 THEN 'TRUE' ELSE '1' END AS is_Shell_removed
FROM {part}
"""

VIEWS["text_stations"] = """
SELECT 'st_' || year(o_orderdate) || '.csv' AS File, 'C' || o_orderkey AS StationID,
 CASE WHEN o_custkey % 10 = 0 THEN '2017-01-02' WHEN o_custkey % 10 = 1 THEN '31/2/2017' WHEN o_custkey % 10 = 2 THEN 'NA' ELSE '2/1/2017' END AS Date
FROM {orders}
"""

# The columns of one file per customer and year: some lack columns, repeat one or have an unknown one.
VIEWS["file_columns"] = """
SELECT DISTINCT 'st_' || o_custkey || '_' || year(o_orderdate) || '.csv' AS File, o_custkey % 6 AS kind FROM {orders}
"""

# Names with one letter lost in writing, beside the right ones.
VIEWS["written_names"] = """
SELECT DISTINCT p_name AS Query FROM {part}
UNION
SELECT DISTINCT substr(p_name, 1, 2) || substr(p_name, 4) FROM {part}
"""

# Names as heard: doubled letters, and one vowel for another.
VIEWS["spoken_names"] = """
SELECT DISTINCT replace(replace(p_name, 'l', 'll'), 'i', 'y') AS Query FROM {part}
UNION
SELECT DISTINCT replace(p_name, 'o', 'oo') || 'us' FROM {part}
"""

# Entries as cleaning leaves them, with what is rare: names found by likeness or unknown whether, a taxon of a station in several
# files, stations that are not listed, taxa without a family, fractions of 0 and unknown ones, sizes without a dimension.
VIEWS["rare_entries"] = """
SELECT 'sp_' || (l_linenumber % 3) || '.csv' AS File,
 l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS EntryID,
 'S' || (l_orderkey % 500) AS StationID, p_name AS valid_name, 'Species' AS rank,
 'phy' AS phylum, 'cla' AS class, CASE WHEN p_size % 6 = 0 THEN NULL ELSE 'ord' END AS "order",
 CASE WHEN length(p_name) % 5 = 0 THEN NULL ELSE 'fam_' || substr(split_part(p_name, ' ', 2), 1, 2) END AS family,
 split_part(p_name, ' ', 2) AS genus,
 CASE WHEN l_suppkey % 10 = 0 THEN CAST(0 AS DOUBLE) WHEN l_suppkey % 10 = 1 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS Fraction,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS Count,
 CAST(l_extendedprice AS DOUBLE) / 10000 AS AFDW_g,
 CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) / 100 END AS AFDW_g_from_WW,
 CAST(l_tax AS DOUBLE) AS AFDW_g_calc,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) / 1000 END AS AFDW_g_combined,
 CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS incomplete_count,
 CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE 0 END AS incomplete_biomass,
 CASE WHEN l_suppkey % 7 = 0 THEN 1 WHEN l_suppkey % 7 < 5 THEN NULL ELSE 0 END AS isFuzzy,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'Shell_length' END AS Size_dimension,
 CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_partkey % 2 = 0 END AS is_Shell_removed
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

VIEWS["rare_stations"] = """
SELECT 'st.csv' AS File, 'S' || n AS StationID, n % 3 <> 0 AS is_Quantitative,
 CASE WHEN n % 10 = 0 THEN NULL WHEN n % 10 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(20 + n AS DOUBLE) END AS Sample_area_m2,
 CASE WHEN n % 10 = 0 OR n % 7 = 0 THEN NULL WHEN n % 10 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(2 + n AS DOUBLE) END AS Sample_volume_m3
FROM (SELECT DISTINCT o_orderkey % 480 AS n FROM {orders}) stations
"""

VIEWS["rare_regressions"] = """
SELECT DISTINCT p_name AS valid_name, CASE WHEN p_partkey % 2 = 0 THEN 'Shell_length' END AS Size_dimension,
 CAST(length(p_name) AS DOUBLE) AS A_factor, CAST(2 AS DOUBLE) AS B_exponent, 'WW_g' AS Output_unit, p_partkey % 4 < 2 AS is_Shell_removed
FROM {part}
"""


@lru_cache(maxsize=64)
def _table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; keeps only its schema and file list, so each is looked up once."""
    return spark.read.parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or survey-shaped view as a lazy DataFrame."""
    if name not in VIEWS:
        return _table(spark, f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace('"order"', "`order`")
    inputs = [t for t in (*TABLES, *VIEWS) if "{" + t + "}" in text]
    frames = {t: view(spark, sf_dir, t) for t in inputs}
    return spark.sql(text, **frames)

