"""The registered queries: every operator on the survey-shaped tables.

Computed floating point columns pass through single precision (`single`), because
sums, powers and sines differ between engines in the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benthoframe.operators import bioconversion as bio
from benthoframe.operators import depth, finalize, geometry, matrix
from benthoframe.operators import species as sp
from benthoframe.operators import taxonomy as tx
from benthoframe.operators import validate as va
from benthoframe.operators.combine import combine_data_sources
from benthoframe.plans import pipeline
from benthoframe.plans.survey_views import view
from benthoframe.session import settle
from benthoframe.sources import csv_files as csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[fn.__name__] = fn
    return fn


def single(name: str) -> Column:
    return F.col(name).cast("float").cast("double").alias(name)


def with_single(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: single(n) for n in names})


# --- shared inputs -----------------------------------------------------------------

def resolved_names(spark: SparkSession, sf_dir: str, max_distance: int = 0, species: DataFrame | None = None) -> DataFrame:
    candidates = stored_taxonomy if max_distance else taxonomy_view
    return tx.resolve_taxonomy(
        species or view(spark, sf_dir, "species"),
        view(spark, sf_dir, "bioconversion"),
        candidates(spark, sf_dir),
        max_distance,
    )


def taxonomy_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "taxonomy_candidates")


def stored_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates as a stored table, as they are outside these tests; fuzzy matching reads them more than once."""
    return settle(taxonomy_view(spark, sf_dir), "taxonomy")


def completed_species(spark: SparkSession, sf_dir: str, worms: DataFrame | None = None) -> DataFrame:
    """Entries with names and conversions; the lookups are settled first, with one row per name and key."""
    worms = worms or settle(resolved_names(spark, sf_dir), "names")
    factors, regressions = bio.prepare_conversion(view(spark, sf_dir, "bioconversion"), worms, check=True)
    return sp.complete_species(view(spark, sf_dir, "species"), worms, factors, regressions)


def named_conversion(spark: SparkSession, sf_dir: str, max_distance: int = 0) -> DataFrame:
    """The conversion table with its names, which need no look at the entries."""
    conversion = view(spark, sf_dir, "bioconversion")
    names = conversion.select(F.col("Taxon").alias("Query"))
    worms = tx.get_valid_names(names, view(spark, sf_dir, "taxonomy_candidates"), max_distance)
    return bio.attach_names(conversion, worms)


def prepared_conversion(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    conversion = view(spark, sf_dir, "bioconversion")
    names = conversion.select(F.col("Taxon").alias("Query"))
    worms = tx.get_valid_names(names, view(spark, sf_dir, "taxonomy_candidates"), 0)
    return bio.prepare_conversion(conversion, worms)


def stored_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and conflicts need no more of the entries, which are read for both in one pass."""
    return settle(finalize.distinct_kinds(view(spark, sf_dir, "species")), "kinds")


def species_and_conflicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(completed entries, taxa with a conflict)."""
    kinds = stored_kinds(spark, sf_dir)
    worms = settle(resolved_names(spark, sf_dir, species=kinds), "names")
    return completed_species(spark, sf_dir, worms), pipeline.settle_conflicts(sp.add_taxonomy(kinds, worms))


def cleaned_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.clean_species(*species_and_conflicts(spark, sf_dir))


def completed_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.complete_stations(
        view(spark, sf_dir, "stations"), stored_bathymetry(spark, sf_dir)
    )


def stored_bathymetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid as a stored table, as it is outside these tests."""
    return settle(view(spark, sf_dir, "bathymetry"), "bathymetry")


def database(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = finalize.clean_stations(completed_stations(spark, sf_dir))
    return pipeline.density_table(cleaned_species(spark, sf_dir), stations)


STATION_VALUES = (
    "Lat_DD", "Lon_DD", "Water_depth_m", "Track_length_m", "Bearings", "Sample_area_m2",
    "Sample_volume_m3",
)
DENSITIES = ("Density_nr_per_m2", "Density_nr_per_m3", "Biomass_g_per_m2", "Biomass_g_per_m3")


# --- result tables -------------------------------------------------------------------

@query
def density_by_station_taxon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12-F13, F19-F23 on top of E1-E8 and F1-F11: the flagship."""
    return with_single(database(spark, sf_dir), *STATION_VALUES, *DENSITIES)


@query
def individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14-F18, F24."""
    stations = finalize.clean_stations(completed_stations(spark, sf_dir))
    joined = pipeline.individuals_table(cleaned_species(spark, sf_dir), stations)
    return with_single(joined, *STATION_VALUES, "Individual_WW_g", "Individual_AFDW_g")


@query
def species_biomass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E8."""
    columns = (
        "WW_to_AFDW", "A_factor", "B_exponent", "Size_mm", "WW_g_calc", "AFDW_g_calc",
        "WW_g_threshold", "AFDW_g_from_WW",
    )
    done = completed_species(spark, sf_dir).select(
        "EntryID", "valid_name", "hasNoMatch", "isFuzzy", "Output_unit", *columns,
    )
    return with_single(done, *columns)


@query
def upscale_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F5."""
    done = (
        completed_species(spark, sf_dir)
        .transform(finalize.fill_bulk_weights)
        .transform(finalize.drop_non_taxa)
        .transform(finalize.upscale)
        .select("EntryID", *finalize.UPSCALED)
    )
    return with_single(done, "AFDW_g", "AFDW_g_from_WW", "AFDW_g_calc")


@query
def sample_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F7."""
    completed, conflicts = species_and_conflicts(spark, sf_dir)
    done = (
        completed.transform(finalize.drop_non_taxa)
        .transform(finalize.flag_conflicts)
        .transform(finalize.drop_conflicting_weights, conflicts)
        .select("EntryID", "valid_name", "is_conflict", "Weight_type", "AFDW_g_from_WW")
    )
    return with_single(done, "AFDW_g_from_WW")


@query
def sample_conflict_per_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 with conflicts kept to their station."""
    worms = settle(resolved_names(spark, sf_dir), "names")
    completed = completed_species(spark, sf_dir, worms).transform(finalize.drop_non_taxa)
    # conflicts need the names only, so that their filter reaches the tables
    conflicts = pipeline.settle_conflicts(sp.add_taxonomy(view(spark, sf_dir, "species"), worms), per_station=True)
    done = completed.transform(finalize.drop_conflicting_weights, conflicts).select(
        "EntryID", "Weight_type", "AFDW_g_from_WW"
    )
    return with_single(done, "AFDW_g_from_WW")


@query
def partial_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, F10, F11."""
    columns = ("AFDW_g", "AFDW_g_from_WW", "AFDW_g_combined")
    done = (
        completed_species(spark, sf_dir)
        .transform(finalize.drop_partial_weights)
        .transform(finalize.combine_biomass)
        .select("EntryID", *columns, "source_AFDW_g_combined", "incomplete_count",
                "incomplete_biomass")
    )
    return with_single(done, *columns)


@query
def cleaned_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F11 together."""
    columns = ("AFDW_g", "AFDW_g_from_WW", "AFDW_g_calc", "AFDW_g_combined")
    done = cleaned_species(spark, sf_dir).select(
        "EntryID", "Count", "Weight_type", *columns, "source_AFDW_g_combined",
        "incomplete_count", "incomplete_biomass",
    )
    return with_single(done, *columns)


@query
def totals_by_station_taxon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, F13."""
    totals = finalize.aggregate_taxa(cleaned_species(spark, sf_dir))
    return with_single(totals, "Biomass_g")


@query
def totals_fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, F13 where names of entries are found by likeness, so that isFuzzy is true for some."""
    kinds = stored_kinds(spark, sf_dir)
    exact = settle(resolved_names(spark, sf_dir, species=kinds), "names")
    factors, regressions = bio.prepare_conversion(view(spark, sf_dir, "bioconversion"), exact, check=True)
    worms = settle(resolved_names(spark, sf_dir, 1, kinds), "names")
    species = view(spark, sf_dir, "species")
    completed = sp.complete_species(species, worms, factors, regressions)
    conflicts = pipeline.settle_conflicts(sp.add_taxonomy(kinds, worms))
    return with_single(finalize.aggregate_taxa(finalize.clean_species(completed, conflicts)), "Biomass_g")


# --- what is rare: unknown, zero, not listed, in several files ---------------------------

@query
def rare_upscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4, F5 with fractions of 0 and unknown ones."""
    scaled = finalize.upscale(view(spark, sf_dir, "rare_entries")).select("EntryID", *finalize.UPSCALED)
    return with_single(scaled, "AFDW_g", "AFDW_g_from_WW", "AFDW_g_calc")


@query
def rare_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 where a size has no dimension, in the entries and in the lookup."""
    entries = view(spark, sf_dir, "rare_entries").select("EntryID", "valid_name", "Size_dimension", "is_Shell_removed")
    return sp.add_regressions(entries, view(spark, sf_dir, "rare_regressions"))


def rare_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.density_table(view(spark, sf_dir, "rare_entries"), view(spark, sf_dir, "rare_stations"))


@query
def rare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13 with fuzzy names and taxa in several files."""
    return with_single(finalize.aggregate_taxa(view(spark, sf_dir, "rare_entries")), "Biomass_g")


@query
def rare_densities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F22, F23 with entries of unlisted stations, and areas that are 0 or unknown."""
    return with_single(rare_database(spark, sf_dir), *DENSITIES)


@query
def rare_community_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 with unknown densities."""
    values = matrix.community_values(rare_database(spark, sf_dir), "family", "Density_nr_per_m2")
    return with_single(values, "value")


@query
def rare_community_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 with unknown cells and taxa without a family."""
    wide = matrix.get_community_matrix(rare_database(spark, sf_dir), "family", "Density_nr_per_m3")
    return with_single(wide, *[c for c in wide.columns if c != "StationID"])


# --- stations ------------------------------------------------------------------------

@query
def combine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9."""
    stations = geometry.add_track_length_Odometer(view(spark, sf_dir, "stations"))
    combined = combine_data_sources(
        stations, ("Track_length_m_preset", "Track_dist_m_Odometer"), "Track_length_m"
    )
    return combine_data_sources(combined, ("Water_depth_m_cruise",), "Depth_m").select(
        "StationID", "Track_length_m", "source_Track_length_m", "Depth_m", "source_Depth_m"
    )


@query
def station_area_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19-F21."""
    cleaned = finalize.clean_stations(completed_stations(spark, sf_dir))
    return with_single(cleaned, *STATION_VALUES)


@query
def track_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, G2."""
    found = geometry.find_track_midpoints(view(spark, sf_dir, "stations"))
    return found.select(
        "StationID",
        F.round("Lon_DD_calc", 8).alias("Lon_DD_calc"),
        F.round("Lat_DD_calc", 8).alias("Lat_DD_calc"),
    )


@query
def track_length_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3."""
    done = geometry.add_track_length_GPS(view(spark, sf_dir, "stations"))
    return done.select("StationID", single("Track_dist_m_GPS"))


@query
def track_length_odometer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4."""
    done = geometry.add_track_length_Odometer(view(spark, sf_dir, "stations"))
    return done.select("StationID", F.col("Track_dist_m_Odometer").cast("double"))


@query
def track_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5."""
    done = geometry.add_bearings(view(spark, sf_dir, "stations"))
    return done.select("StationID", single("Bearing_calc"))


@query
def water_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, G7."""
    return completed_stations(spark, sf_dir).select(
        "StationID", "Water_depth_m_Bathy", "Water_depth_m_Bathy2"
    )


@query
def survey_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8."""
    return depth.survey_bbox(view(spark, sf_dir, "stations"))


@query
def bathymetry_in_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 as a filter on the grid."""
    box = depth.survey_bbox(view(spark, sf_dir, "stations"), buffer=-0.5)
    return depth.prune_bathymetry(view(spark, sf_dir, "bathymetry"), box)


# --- taxonomy ------------------------------------------------------------------------

@query
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1."""
    return tx.distinct_names(view(spark, sf_dir, "species"), view(spark, sf_dir, "bioconversion"))


@query
def name_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2."""
    names = tx.distinct_names(view(spark, sf_dir, "species"))
    return tx.match_exact(names, view(spark, sf_dir, "taxonomy_candidates"))


@query
def name_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3."""
    taxonomy = stored_taxonomy(spark, sf_dir)
    names = tx.names_without_match(view(spark, sf_dir, "written_names"), taxonomy)
    return tx.match_fuzzy(names, taxonomy)


@query
def name_fuzzy_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with distance 2."""
    taxonomy = stored_taxonomy(spark, sf_dir)
    names = tx.names_without_match(view(spark, sf_dir, "written_names"), taxonomy)
    return tx.match_fuzzy(names, taxonomy, 2)


@query
def name_phonetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 on names as heard, most of them beyond an edit distance of 1."""
    taxonomy = stored_taxonomy(spark, sf_dir)
    names = tx.names_without_match(view(spark, sf_dir, "spoken_names"), taxonomy)
    return tx.match_fuzzy(names, taxonomy, phonetic=True)


@query
def name_resolution_phonetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4-T9 on names as heard."""
    return tx.get_valid_names(view(spark, sf_dir, "spoken_names"), stored_taxonomy(spark, sf_dir), phonetic=True)


@query
def name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4-T9 on right and misspelled names."""
    return tx.get_valid_names(view(spark, sf_dir, "written_names"), stored_taxonomy(spark, sf_dir))


@query
def name_resolution_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 on the names of entries and conversions."""
    return resolved_names(spark, sf_dir, max_distance=1)


# --- conversions ---------------------------------------------------------------------

@query
def conv_split_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1."""
    return bio.split_factors(named_conversion(spark, sf_dir))


@query
def conv_split_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1."""
    return bio.split_regressions(named_conversion(spark, sf_dir))


@query
def conv_double_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 on names that fuzzy matching has merged."""
    return bio.double_factors(bio.split_factors(named_conversion(spark, sf_dir, 1)))


@query
def conv_double_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 on names that fuzzy matching has merged."""
    return bio.double_regressions(bio.split_regressions(named_conversion(spark, sf_dir, 1)))


@query
def conv_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4."""
    return named_conversion(spark, sf_dir)


@query
def conv_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5."""
    return bio.unmatched_taxa(named_conversion(spark, sf_dir))


@query
def conv_means_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6, B7."""
    return with_single(
        bio.mean_regressions(named_conversion(spark, sf_dir)), "A_factor", "B_exponent"
    )


@query
def conv_means_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8."""
    return with_single(bio.mean_factors(named_conversion(spark, sf_dir)), "WW_to_AFDW")


@query
def conv_means_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9, B10."""
    means = bio.mean_conversion(named_conversion(spark, sf_dir))
    return with_single(means, "WW_to_AFDW", "A_factor", "B_exponent")


@query
def conv_prepared_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11-B14."""
    return with_single(prepared_conversion(spark, sf_dir)[0], "WW_to_AFDW")


@query
def conv_prepared_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11-B14."""
    return with_single(prepared_conversion(spark, sf_dir)[1], "A_factor", "B_exponent")


# --- reports -------------------------------------------------------------------------

@query
def qc_no_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1."""
    return sp.report_unmatched_names(completed_species(spark, sf_dir))


@query
def qc_no_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2."""
    return sp.report_missing_factors(completed_species(spark, sf_dir))


@query
def qc_no_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3."""
    return sp.report_missing_regressions(completed_species(spark, sf_dir))


@query
def qc_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1-R3 in one grouped pass."""
    return sp.count_reports(completed_species(spark, sf_dir))


@query
def qc_depth_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4."""
    stations = depth.add_water_depth(
        view(spark, sf_dir, "stations"), stored_bathymetry(spark, sf_dir),
        "Lon_DD_midpt", "Lat_DD_midpt", "Water_depth_m_Bathy",
    )
    return with_single(sp.report_depth_difference(stations), "mean_diff_depth")


# --- community matrices --------------------------------------------------------------

def community(spark: SparkSession, sf_dir: str, *args, **kwargs) -> DataFrame:
    wide = matrix.get_community_matrix(database(spark, sf_dir), *args, **kwargs)
    return with_single(wide, *[c for c in wide.columns if c != "StationID"])


@query
def community_density_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M6."""
    return community(spark, sf_dir, "family", "Density_nr_per_m3")


@query
def community_presence_absence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3."""
    return community(spark, sf_dir, "genus", "presence_absence")


@query
def community_complete_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4."""
    return community(spark, sf_dir, "order", "Biomass_g_per_m2", include_incomplete=False)


@query
def community_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, M5: the long form, for any number of taxa."""
    values = matrix.community_values(database(spark, sf_dir), "species", "Biomass_g_per_m3")
    return with_single(values, "value")


# --- validation ----------------------------------------------------------------------

@query
def violations_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6, V11, V12, V17, V18, V20, V21, V23, V24, V27-V29 on faulty entries."""
    return va.validate_typed(view(spark, sf_dir, "faulty_species"), "species")


@query
def violations_station_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6, V7, V12, V14, V15, V25, V26 on faulty stations."""
    return va.validate_typed(view(spark, sf_dir, "faulty_stations"), "stations")


@query
def violations_bioconversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V33."""
    return va.check_bioconversion_input(view(spark, sf_dir, "faulty_bioconversion"))


@query
def violations_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on entries numbered by order and line, which is not unique."""
    entries = view(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", F.lit(".csv")).alias("File"),
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("EntryID"),
    )
    return va.duplicate_ids(entries, "EntryID")


@query
def violations_repeated_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V31 on stations named after their cruise."""
    stations = view(spark, sf_dir, "stations").withColumn("StationID", F.col("CruiseID"))
    return va.repeated_stations(stations)


@query
def violations_fraction_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V16."""
    return va.inconsistent_fractions(view(spark, sf_dir, "faulty_species"))


@query
def violations_sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V19, V22."""
    return va.empty_bulk_weights(view(spark, sf_dir, "faulty_species"))


@query
def violations_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V6, V9, V10, V13 on the text of files."""
    species = va.validate_part(view(spark, sf_dir, "text_species"), "species")
    stations = view(spark, sf_dir, "text_stations")
    found = va.validate_part(stations, "stations")
    # a file of three columns lacks every alternative; the header rules report that
    return species.unionByName(found.filter("rule <> 'alternatives_missing'"))


@query
def violations_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2, V3, V4, V8 on the columns of one file per customer and year."""
    base = ("CruiseID", "StationID", "Date", "Blade_depth_cm", "Blade_width_cm", "is_Quantitative",
            "Station_objective", "Lat_start_DD", "Lon_start_DD", "Lat_stop_DD", "Lon_stop_DD")
    kinds = (base, base[1:], (*base, "Extra"), (*base, "Comment", "Comment"), base[:7], (*base, "Lat_DD_midpt"))
    columns = F.array(*[F.array(*[F.lit(c) for c in k]) for k in kinds])
    headers = view(spark, sf_dir, "file_columns").select("File", F.get(columns, F.col("kind").cast("int")).alias("columns"))
    return va.header_violations(headers, "stations")


@query
def violations_conversion_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V33a, V33b on the columns of one conversion file per customer and year; a group may be absent as a whole."""
    base = ("Taxon", "is_Shell_removed", "WW_to_AFDW", "Reference_WW_to_AFDW", "Comment_WW_to_AFDW", "Size_dimension",
            "Size_unit", "A_factor", "B_exponent", "Output_unit", "Reference_regression", "Comment_regression")
    without = lambda *gone: tuple(c for c in base if c not in gone)
    kinds = (base, without("Taxon"), without("is_Shell_removed"), without("Reference_WW_to_AFDW"), base[:5], without("A_factor", "Output_unit"))
    columns = F.array(*[F.array(*[F.lit(c) for c in k]) for k in kinds])
    headers = view(spark, sf_dir, "file_columns").select("File", F.get(columns, F.col("kind").cast("int")).alias("columns"))
    return va.header_violations(headers, "bioconversion")


@query
def violations_conversion_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V33a, V33c, V33d, V33e, V33g on the text of a conversion file."""
    return va.validate_part(view(spark, sf_dir, "text_bioconversion"), "bioconversion")


@query
def bind_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, S3 and the types of S1 on the text of files with other columns in another order."""
    text = view(spark, sf_dir, "text_species")
    early = text.filter("File < 'sp_1995.csv'").select("File", "EntryID", "StationID", "Fraction", "Species_reported", "Count")
    late = text.filter("File >= 'sp_1995.csv'").select("Species_reported", "File", "is_Fraction_assumed", "EntryID", F.col("Count").alias("Number"))
    united = csv.unite([csv.type_columns(part, "species") for part in (early, late)])
    return united.select("File", "EntryID", "StationID", "Fraction", "is_Fraction_assumed", "Species_reported", "Count", "WW_g")


@query
def boolean_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V32 on entries without a note on the shell."""
    entries = view(spark, sf_dir, "species").select(
        "EntryID", F.when(F.col("Size_dimension").isNotNull(), F.col("is_Shell_removed")).alias("is_Shell_removed")
    )
    return va.apply_boolean_defaults(entries)


@query
def lookup_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13, V34 on lookups that are not unique: names merged by fuzzy matching, and taxa listed by their candidates."""
    conversion = named_conversion(spark, sf_dir, 1)
    worms = view(spark, sf_dir, "taxonomy_candidates").withColumnRenamed("name", "Query")
    return bio.lookup_doubles(bio.split_factors(conversion), bio.split_regressions(conversion), worms)


@query
def violations_orphan_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V30."""
    return va.orphan_stations(
        view(spark, sf_dir, "faulty_species"), view(spark, sf_dir, "stations")
    )
