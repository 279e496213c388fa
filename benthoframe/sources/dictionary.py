"""The data dictionaries: the schema as data.

Each table is described by rows of attribute, unit, requirement, datatype and
group. From these rows come the Spark schema of the table and most validation
rules; `data_dictionary` shows them as a DataFrame.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Attribute(NamedTuple):
    name: str
    unit: str | None
    requirement: str | None
    datatype: str
    group: str | None
    description: str


SPARK_TYPES = {
    "String": T.StringType(),
    "Double": T.DoubleType(),
    "Integer": T.LongType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Time": T.StringType(),
}

# Attribute | unit | requirement | datatype | group | meaning.
_STATIONS = """
CruiseID | NA | Required | String | NA | cruise on which the track was sampled
StationID | <cruiseID/cruise name>#<station/event number> | Required | String | NA | sampling event, unique
Date | DD/MM/YYYY | Required | Date | NA | sampling date, UTC
Lat_start_DD | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 1 | latitude at the start of the track
Lon_start_DD | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 1 | longitude at the start of the track
Lat_stop_DD | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 1 | latitude at the end of the track
Lon_stop_DD | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 1 | longitude at the end of the track
Lat_DD_midpt | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 2 | reported latitude of the middle of the track
Lon_DD_midpt | Decimal degrees in WGS84 (aka EPSG:4326) | Required_alternative | Double | 2 | reported longitude of the middle of the track
Track_length_m_preset | Meters | Required_alternative | Double | 2 | planned track length
Blade_depth_cm | Centimeters | Required | Double | NA | depth of the blade
Blade_width_cm | Centimeters | Required | Double | NA | width of the blade
is_Quantitative | 1 or 0 | Required | Boolean | NA | whether the catch represents the whole track
Station_objective | Predefined: Complete, Incomplete | Required | String | NA | whether every taxon was processed
Excluded | String | Optional | String | NA | taxa left out, separated by ;
Focus | NA | Optional | String | NA | the only taxa processed, separated by ;
Vessel | NA | Optional | String | NA | research vessel
Cruise_name | NA | Optional | String | NA | common name of the cruise
Station_name | NA | Optional | String | NA | common name of the location
Region | Predefined: BB, BC, CB, CZ, DB, DH, FF, FG, OF, OG, WM | Optional | String | NA | survey region
Time_start | HH:MM:SS | Optional | Time | NA | start of sampling, UTC
Time_stop | HH:MM:SS | Optional | Time | NA | end of sampling, UTC
Bearing | Decimal degrees | Optional | Double | NA | reported direction of the track, east positive
Tow_speed_knots | Knots | Optional | Double | NA | towing speed
Water_depth_m_cruise | Meters | Optional | Double | NA | depth measured on board
Odometer_count | Count | Optional | Integer | NA | ticks of the distance wheel
Comment | NA | Optional | String | NA | remarks on the station
"""

# The predefined size dimensions.
_DIMENSIONS = (
    "Body_length, Body_width, Diameter, Shell_length, Shell_width, Shell_height, Siphon_width, "
    "Tube_length, Claw_length, Claw_width, Carapace_length, Carapace_width, Max_length, "
    "Arm_disc_length, Disc_diameter, Mantle_length, Area, Volume"
)

# Attribute | unit | requirement | datatype | group | meaning.
_SPECIES = f"""
EntryID | CruiseID_rownr | Required | String | NA | one row of the file, unique within it
StationID | <cruiseID/cruise name>#<station/event number> | Required | String | NA | sampling event of the entry
Fraction | Fraction | Required | Double | 1 | part of the catch of this taxon that was processed
is_Fraction_assumed | 0 or 1 | Required | Boolean | 1 | whether the fraction is a guess
Species_reported | Genus species | Required | String | NA | taxon name as written down
Count | Count | Optional | Integer | NA | specimens in the entry, -1 for remains that are no specimens
Size_dimension | Predefined: {_DIMENSIONS} | Optional | String | 2 | what was measured
Size_value | Specified in Size_unit. | Optional | Double | 2 | measured size
Size_unit | Predefined: mm, cm, 1/2cm, mm2, cm2, mm3, cm3 | Optional | String | 2 | unit of the size
WW_g | Grams | Optional | Double | 4 | wet weight, 0 when below the scale threshold
Weight_type | Predefined: Entry, Sample | Optional | String | 4 | wet weight of this row or of a bulk sample
Threshold_scale | Grams | Optional | Double | 4 | smallest wet weight the scale can show
is_Shell_removed | 0 or 1 | Optional | Boolean | 4 | whether the shell was taken off before weighing
is_Partial_WW | 0 or 1 | Optional | Boolean | 4 | whether only a part was weighed
AFDW_g | Grams | Optional | Double | 5 | ash-free dry weight, 0 when below the threshold
Weight_type_AFDW | Predefined: Entry, Sample | Optional | String | 5 | dry weight of this row or of a bulk sample
Threshold_scale_AFDW | Grams | Optional | Double | 5 | smallest dry weight the scale can show
is_Partial_AFDW | 0 or 1 | Optional | Boolean | 5 | whether only a part was weighed dry
ID_by | NA | Optional | String | NA | person who identified the specimens
is_ID_confident | 0 or 1 | Optional | Boolean | NA | whether the identification is certain
is_Preserved | 0 or 1 | Optional | Boolean | NA | whether the specimens were kept
Comment | NA | Optional | String | NA | remarks on the entry
"""

# Attribute | unit | requirement | datatype | group | meaning.
_BIOCONVERSION = f"""
Taxon | NA | Required | String | NA | taxon the conversion is for
WW_to_AFDW | Fraction | Optional | Double | 1 | ash-free dry weight per wet weight
Reference_WW_to_AFDW | NA | Optional | String | 1 | source of the factor
Comment_WW_to_AFDW | NA | Optional | String | 1 | remarks on the factor
Size_dimension | Predefined: {_DIMENSIONS} | Optional | String | 2 | size the regression takes
Size_unit | Predefined: mm, mm2, mm3 | Optional | String | 2 | unit of that size
A_factor | NA | Optional | Double | 2 | factor of the power law
B_exponent | NA | Optional | Double | 2 | exponent of the power law
Output_unit | Predefined: AFDW_g, WW_g | Optional | String | 2 | weight the regression gives
Reference_regression | NA | Optional | String | 2 | source of the regression
Comment_regression | NA | Optional | String | 2 | remarks on the regression
is_Shell_removed | Boolean | Required | Boolean | NA | whether the weights are without shell
"""

# The columns of the result tables, as published.
_RANKS = {
    "rank": "rank | Taxonomic rank | NA | String | NA | rank of valid_name",
    "phylum": "phylum | Taxonomic rank | NA | String | NA | phylum of valid_name",
    "class": "class | Taxonomic rank | NA | String | NA | class of valid_name",
    "order": "order | Taxonomic rank | NA | String | NA | order of valid_name",
    "family": "family | Taxonomic rank | NA | String | NA | family of valid_name",
    "genus": "genus | Taxonomic rank | NA | String | NA | genus of valid_name",
}

# What the two result tables keep of a station; the datatypes are the input's.
_STATION_RESULT = """
CruiseID | NA | NA | String | NA | cruise on which the track was sampled
Date | DD/MM/YYYY | NA | Date | NA | sampling date, UTC
Blade_depth_cm | Centimeters | NA | Double | NA | depth of the blade
Blade_width_cm | Centimeters | NA | Double | NA | width of the blade
is_Quantitative | TRUE or FALSE | NA | Boolean | NA | whether the catch represents the whole track
Station_objective | Predefined: Complete, Incomplete | NA | String | NA | whether every taxon was processed
Excluded | String | NA | String | NA | taxa left out, separated by ;
Focus | NA | NA | String | NA | the only taxa processed, separated by ;
Vessel | NA | NA | String | NA | research vessel
Cruise_name | NA | NA | String | NA | common name of the cruise
Station_name | NA | NA | String | NA | common name of the location
Region | Predefined: BB, BC, CB, CZ, DB, DH, FF, FG, OF, OG, WM | NA | String | NA | survey region
Time_start | HH:MM:SS | NA | Time | NA | start of sampling, UTC
Time_stop | HH:MM:SS | NA | Time | NA | end of sampling, UTC
Tow_speed_knots | Knots | NA | Double | NA | towing speed
Lat_DD | Decimal degrees in WGS84 | NA | Double | NA | latitude of the middle of the track
source_Lat_DD | NA | NA | String | NA | column the latitude came from
Lon_DD | Decimal degrees in WGS84 | NA | Double | NA | longitude of the middle of the track
source_Lon_DD | NA | NA | String | NA | column the longitude came from
Water_depth_m | Meters | NA | Double | NA | water depth
source_Water_depth_m | NA | NA | String | NA | column the depth came from
Track_length_m | Meters | NA | Double | NA | track length
source_Track_length_m | NA | NA | String | NA | column the track length came from
Bearings | Angle | NA | Double | NA | direction of the track, east positive
source_Bearings | NA | NA | String | NA | column the direction came from
Sample_area_m2 | Squared meters | NA | Double | NA | track length times blade width
Sample_volume_m3 | Cubic meters | NA | Double | NA | sampled area times blade depth
"""

_DATABASE = """
StationID | <cruiseID/cruise name>#<station/event number> | NA | String | NA | sampling event
valid_name | Taxon | NA | String | NA | accepted name of the taxon
File | File name | NA | String | NA | species file of the entries
""" + "\n".join(_RANKS[r] for r in ("rank", "phylum", "class", "order", "family", "genus")) + """
isFuzzy | TRUE or FALSE | NA | Boolean | NA | whether a name was found by fuzzy matching
incomplete_count | TRUE or FALSE | NA | Boolean | NA | whether a count was unknown
incomplete_biomass | TRUE or FALSE | NA | Boolean | NA | whether a biomass was unknown
""" + _STATION_RESULT + """
Comment | Text | NA | String | NA | remarks on the station
Density_nr_per_m2 | Count per squared meter | NA | Double | NA | specimens per sampled area
Density_nr_per_m3 | Count per cubic meter | NA | Double | NA | specimens per sampled volume
Biomass_g_per_m2 | Grams ash-free dry weight per squared meter | NA | Double | NA | biomass per sampled area
Biomass_g_per_m3 | Grams ash-free dry weight per cubic meter | NA | Double | NA | biomass per sampled volume
"""

_DATABASE_INDIVIDUALS = """
File | File name | NA | String | NA | species file of the entry
EntryID | ID | NA | String | NA | row of the species file
StationID | <cruiseID/cruise name>#<station/event number> | NA | String | NA | sampling event
valid_name | Taxon | NA | String | NA | accepted name of the taxon
is_ID_confident | TRUE or FALSE | NA | Boolean | NA | whether the identification is certain
""" + "\n".join(_RANKS[r] for r in ("rank", "genus", "family", "order", "class", "phylum")) + """
isFuzzy | TRUE or FALSE | NA | Boolean | NA | whether the name was found by fuzzy matching
Count | Number | NA | Double | NA | specimens in the entry, scaled up to the whole catch
Size_dimension | NA | NA | String | NA | what was measured
Size_mm | millimeter | NA | Double | NA | size in mm, mm2 or mm3
is_Partial_AFDW | TRUE or FALSE | NA | Boolean | NA | whether only a part was weighed dry
is_Shell_removed | TRUE or FALSE | NA | Boolean | NA | whether the shell was taken off before weighing
is_Partial_WW | TRUE or FALSE | NA | Boolean | NA | whether only a part was weighed
is_Fraction_assumed | TRUE or FALSE | NA | Boolean | NA | whether the fraction is a guess
is_Preserved | TRUE or FALSE | NA | Boolean | NA | whether the specimens were kept
Comment_sp | Text | NA | String | NA | remarks on the entry
Individual_WW_g | grams | NA | Double | NA | entry wet weight per specimen
Individual_AFDW_g | grams | NA | Double | NA | entry ash-free dry weight per specimen
""" + _STATION_RESULT + """
Comment_st | Text | NA | String | NA | remarks on the station
"""


def _parse(text: str) -> list[Attribute]:
    rows = []
    for line in text.strip().splitlines():
        if line.strip():
            cells = [None if c.strip() == "NA" else c.strip() for c in line.split(" | ")]
            rows.append(Attribute(*cells))
    return rows


DICTIONARIES: dict[str, list[Attribute]] = {
    "stations": _parse(_STATIONS),
    "species": _parse(_SPECIES),
    "bioconversion": _parse(_BIOCONVERSION),
    "database": _parse(_DATABASE),
    "database_individuals": _parse(_DATABASE_INDIVIDUALS),
}


def attributes(table: str) -> list[Attribute]:
    """The dictionary rows of a table."""
    return DICTIONARIES[table]


def required(table: str) -> list[str]:
    """Attributes that every file must have and fill."""
    return [a.name for a in attributes(table) if a.requirement == "Required"]


def alternatives(table: str) -> dict[str, list[str]]:
    """Groups of which at least one must be complete."""
    return _by_group(a for a in attributes(table) if a.requirement == "Required_alternative")


def groups(table: str) -> dict[str, list[str]]:
    """Attributes that may only occur together."""
    return _by_group(a for a in attributes(table) if a.group is not None)


def of_type(table: str, datatype: str) -> list[str]:
    """Attributes of a datatype: Double (D3), Integer (D4), Boolean (D6), ..."""
    return [a.name for a in attributes(table) if a.datatype == datatype]


def fractions(table: str) -> list[str]:
    """Attributes whose values lie in 0..1."""
    return [a.name for a in attributes(table) if a.unit == "Fraction"]


def predefined(table: str) -> dict[str, list[str]]:
    """Allowed values per attribute."""
    prefix = "Predefined: "
    return {
        a.name: a.unit.removeprefix(prefix).split(", ")
        for a in attributes(table)
        if a.unit and a.unit.startswith(prefix)
    }


def fields(table: str) -> list[T.StructField]:
    """The Spark schema of a table, in dictionary order."""
    return [T.StructField(a.name, SPARK_TYPES[a.datatype]) for a in attributes(table)]


def data_dictionary(spark: SparkSession, table: str) -> DataFrame:
    """The dictionary of a table as a DataFrame."""
    columns = [
        "Attribute", "Unit", "Required_or_Optional", "Datatype", "Group", "Description"
    ]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([tuple(a) for a in attributes(table)], schema)


def _by_group(rows) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for row in rows:
        grouped.setdefault(row.group, []).append(row.name)
    return grouped
