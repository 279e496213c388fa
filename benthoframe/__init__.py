"""Seabed survey analytics on Spark.

Every step is a DataFrame-to-DataFrame function usable with `df.transform`; the
functions below `construct_database` run the whole pipeline over folders.
"""

from benthoframe.operators.bioconversion import prepare_conversion
from benthoframe.operators.combine import combine_data_sources
from benthoframe.operators.depth import add_water_depth, prune_bathymetry, survey_bbox
from benthoframe.operators.geometry import (
    add_bearings,
    add_track_length_GPS,
    add_track_length_Odometer,
    add_track_midpoints,
    find_track_midpoints,
)
from benthoframe.operators.matrix import community_values, get_community_matrix, save_community_matrix
from benthoframe.operators.taxonomy import get_valid_names, match_exact, match_fuzzy
from benthoframe.operators.validate import InvalidInput, check_bioconversion_input
from benthoframe.plans.pipeline import (
    check_bioconversion,
    collect_bathymetry,
    collect_taxonomy,
    complete_database,
    construct_database,
    finalize_database,
    prepare_bioconversion,
)
from benthoframe.session import RECOMMENDED_CONF, clear_scratch, recommended_builder
from benthoframe.sources.dictionary import data_dictionary
from benthoframe.sources.tables import load_table, table_path

__all__ = [
    "InvalidInput", "RECOMMENDED_CONF", "add_bearings", "add_track_length_GPS",
    "add_track_length_Odometer", "add_track_midpoints", "add_water_depth", "check_bioconversion",
    "check_bioconversion_input", "clear_scratch", "collect_bathymetry", "collect_taxonomy", "combine_data_sources",
    "community_values", "complete_database", "construct_database", "data_dictionary",
    "finalize_database", "find_track_midpoints", "get_community_matrix", "get_valid_names", "load_table",
    "match_exact", "match_fuzzy", "prepare_bioconversion", "prepare_conversion",
    "prune_bathymetry", "recommended_builder", "save_community_matrix", "survey_bbox", "table_path",
]
