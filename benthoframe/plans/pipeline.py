"""The pipeline: construct, collect, prepare, complete, finalize.

Each stage has a lazy form over DataFrames and a form over folders. The folder
form writes the stage as Parquet and the next stage reads it, so that a lost
executor costs a task, the lookups have a known size, and filters reach the scan.
The tables of a stage are published together, or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

from benthoframe.operators import bioconversion as bio
from benthoframe.operators import depth, finalize, geometry, species as sp, taxonomy as tx
from benthoframe.operators import validate as va
from benthoframe.session import scratch_root, settle
from benthoframe.sources import csv_files as csv
from benthoframe.sources import dictionary as dd
from benthoframe.sources.tables import load_table, save_table, save_tables


# --- construct ---------------------------------------------------------------

def construct_table(
    spark: SparkSession, folder: str, table: str, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(typed table, violations of its header and row rules) of a CSV folder.

    The files are read twice: for their headers, and for everything about their rows, which is stored.
    """
    headers = settle(csv.read_headers(spark, folder), "headers")
    checked, rules = va.checked_cells(csv.read_cells(spark, folder, headers, table, multiline), table)
    checked = settle(checked, f"checked-{table}")
    violations = csv.unite(
        [
            va.header_violations(headers, table),
            va.empty_file_violations(csv.empty_files(spark, folder)),
            va.cell_violations(checked, rules),
        ]
    )
    return checked.select("File", *[a.name for a in dd.attributes(table)]), violations


def construct_database(
    spark: SparkSession,
    in_folder: str = "inputfiles",
    out_folder: str = "data",
    as_csv: bool = True,
    multiline: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Read, check and store the CSV files of `Stations` and `Species`.

    Raises `InvalidInput` when a rule is violated; nothing is stored then.
    """
    stations, station_faults = construct_table(spark, f"{in_folder}/Stations", "stations", multiline)
    species, species_faults = construct_table(spark, f"{in_folder}/Species", "species", multiline)
    species = va.apply_boolean_defaults(species)
    va.assert_valid(station_faults.unionByName(species_faults))
    va.assert_valid(csv.unite([
        va.validate_stations_set(stations),
        va.validate_species_set(species),
        va.orphan_stations(species, stations),
    ]))
    save_tables({"stations_initial": stations, "species_initial": species}, out_folder, as_csv)
    return (
        load_table(spark, out_folder, "stations_initial"),
        load_table(spark, out_folder, "species_initial"),
    )


def check_bioconversion(
    spark: SparkSession, path: str = "inputfiles/bioconversion.csv"
) -> DataFrame:
    """Read and check the bio-conversion file; raises `InvalidInput`."""
    typed, violations = construct_table(spark, path, "bioconversion")
    va.assert_valid(violations)
    va.assert_valid(va.conversion_doubles(typed))
    return typed.drop("File")


def checked_conversion(spark: SparkSession, given: DataFrame | str) -> DataFrame:
    """A conversion table, or the checked one of a CSV path."""
    return check_bioconversion(spark, given) if isinstance(given, str) else given


# --- reference tables ----------------------------------------------------------

def collect_bathymetry(
    spark: SparkSession,
    grid: DataFrame,
    stations: DataFrame | None = None,
    buffer: float = 2,
    data_folder: str = "data",
    out_folder: str = "data",
    lats: list[float] | None = None,
    lons: list[float] | None = None,
    as_csv: bool = False,
) -> DataFrame:
    """Store the part of a bathymetry grid around the survey."""
    if stations is None:
        stations = load_table(spark, data_folder, "stations_initial")
    box = depth.survey_bbox(stations, buffer, lats, lons)
    save_table(depth.prune_bathymetry(grid, box), out_folder, "bathymetry", as_csv)
    return load_table(spark, out_folder, "bathymetry")


def collect_taxonomy(
    spark: SparkSession,
    taxonomy: DataFrame,
    conversion_data: DataFrame | str = "inputfiles/bioconversion.csv",
    species: DataFrame | None = None,
    data_folder: str = "data",
    out_folder: str = "data",
    max_distance: int = 1,
    as_csv: bool = False,
    phonetic: bool = True,
) -> DataFrame:
    """Resolve all names against a taxonomy table and store the result; typos and like sounds are allowed."""
    if species is None:
        species = load_table(spark, data_folder, "species_initial")
    conversion_data = checked_conversion(spark, conversion_data)
    resolved = tx.resolve_taxonomy(species, conversion_data, taxonomy, max_distance, phonetic)
    save_table(resolved, out_folder, "taxonomy", as_csv)
    return load_table(spark, out_folder, "taxonomy")


def prepare_bioconversion(
    spark: SparkSession,
    conversion_data: DataFrame | str = "inputfiles/bioconversion.csv",
    worms: DataFrame | None = None,
    data_folder: str = "data",
    out_folder: str = "data",
    as_csv: bool = False,
    levels: Sequence[str] = bio.LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Store the conversion factors and regressions by accepted name."""
    if worms is None:
        worms = load_table(spark, data_folder, "taxonomy")
    conversion_data = checked_conversion(spark, conversion_data)
    factors, regressions = bio.prepare_conversion(conversion_data, worms, levels, check=True)
    save_tables({"conversion_factors": factors, "regressions": regressions}, out_folder, as_csv)
    return (
        load_table(spark, out_folder, "conversion_factors"),
        load_table(spark, out_folder, "regressions"),
    )


# --- complete --------------------------------------------------------------------

def complete_stations(
    stations: DataFrame, bathymetry: DataFrame, tick_length_m: float = 2
) -> DataFrame:
    """All additions to the stations."""
    return (
        stations.transform(geometry.add_track_geometry)
        .transform(geometry.add_track_length_Odometer, tick_length_m)
        .transform(depth.add_depths, bathymetry)
    )


def complete_database(
    spark: SparkSession,
    data_folder: str = "data",
    out_folder: str = "data",
    bathymetry: DataFrame | None = None,
    as_csv: bool = True,
    tick_length_m: float = 2,
) -> dict[str, DataFrame]:
    """Complete stations and entries and store them (E9); returns the reports R1-R4.

    The depth difference is observed while the stations are written, and one grouped pass over
    the stored entries counts the other reports.
    """
    if bathymetry is None:
        bathymetry = load_table(spark, data_folder, "bathymetry")
    worms = load_table(spark, data_folder, "taxonomy")
    factors = load_table(spark, data_folder, "conversion_factors")
    regressions = load_table(spark, data_folder, "regressions")
    bio.assert_unique_conversion(factors, regressions, worms)

    stations = complete_stations(load_table(spark, data_folder, "stations_initial"), bathymetry, tick_length_m)
    species = sp.complete_species(
        load_table(spark, data_folder, "species_initial"), worms, factors, regressions
    )
    depths = Observation("depths")
    stations = stations.observe(depths, sp.depth_difference())
    save_tables({"stations_additions": stations, "species_additions": species}, out_folder, as_csv)
    counted = settle(sp.count_reports(load_table(spark, out_folder, "species_additions")), "reports")
    difference = depths.get["mean_diff_depth"]
    return {
        **{report: sp.counted_report(counted, report) for report in sp.REPORTS},
        "depth_difference": spark.createDataFrame([(difference,)], "mean_diff_depth double"),
    }


# --- finalize ----------------------------------------------------------------------

def settle_conflicts(species: DataFrame, per_station: bool = False) -> DataFrame:
    """The taxa (or stations and taxa) with conflicting weights as a stored lookup."""
    kept = finalize.drop_non_taxa(species)
    return settle(finalize.conflicting_taxa(kept, per_station), "conflicts")


def density_table(
    species_final: DataFrame,
    stations_final: DataFrame,
    quantitative_only: bool = False,
    default_count: float = 1,
) -> DataFrame:
    """Density and biomass per station and taxon."""
    return finalize.join_densities(
        finalize.aggregate_taxa(species_final, default_count), stations_final, quantitative_only
    )


def individuals_table(
    species_final: DataFrame, stations_final: DataFrame, suffixes: tuple[str, str] = ("_sp", "_st")
) -> DataFrame:
    """Size and weight per specimen with its station."""
    return finalize.join_individuals(
        finalize.select_individuals(species_final), stations_final, suffixes
    )


@contextmanager
def co_located(spark: SparkSession, folder: str, names: Sequence[str], buckets: int | None) -> Iterator[list[DataFrame]]:
    """Stored tables as they are, or as tables bucketed by StationID that are removed afterwards."""
    stored = [load_table(spark, folder, name) for name in names]
    if not buckets:
        yield stored
        return
    made = []
    try:
        for name, df in zip(names, stored):
            table = f"benthoframe_{name}_{uuid.uuid4().hex}"
            made.append(table)
            dealt = df.repartition(buckets, "StationID").write.bucketBy(buckets, "StationID").sortBy("StationID")
            dealt.option("path", f"{scratch_root(spark)}/{table}").format("parquet").saveAsTable(table)
        yield [spark.table(table) for table in made]
    finally:
        for table in made:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def finalize_database(
    spark: SparkSession,
    data_folder: str = "data",
    out_folder: str = "data",
    database_folder: str = ".",
    as_csv: bool = True,
    per_station: bool = False,
    upscale_wet_weight: bool = False,
    quantitative_only: bool = False,
    default_count: float = 1,
    suffixes: tuple[str, str] = ("_sp", "_st"),
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Clean, aggregate and join the completed tables and store the results.

    With `buckets` the cleaned tables are dealt by station into so many buckets once, and the aggregate and both
    joins need no further exchange; worth it where both tables are too large to broadcast. The other options are those of the steps in `operators.finalize`.
    """
    additions = load_table(spark, data_folder, "species_additions")
    conflicts = settle_conflicts(additions, per_station)
    cleaned = finalize.clean_species(additions, conflicts, upscale_wet_weight)
    stations = finalize.clean_stations(load_table(spark, data_folder, "stations_additions"))
    save_tables({"species_final": cleaned, "stations_final": stations}, out_folder, as_csv)

    with co_located(spark, out_folder, ("species_final", "stations_final"), buckets) as (species_final, stations_final):
        save_tables(
            {
                "database": density_table(species_final, stations_final, quantitative_only, default_count),
                "database_individuals": individuals_table(species_final, stations_final, suffixes),
            },
            database_folder, as_csv,
        )
    return (
        load_table(spark, database_folder, "database"),
        load_table(spark, database_folder, "database_individuals"),
    )
