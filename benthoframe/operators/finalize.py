"""Cleaning the entries and building the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benthoframe.functions.columns import if_known, left_join_lookup
from benthoframe.operators.combine import combine_data_sources

UPSCALED = ("Count", "AFDW_g", "AFDW_g_from_WW", "AFDW_g_calc")
# The key of the result table.
TAXON_KEY = (
    "StationID", "valid_name", "File", "rank", "phylum", "class", "order", "family", "genus"
)
# Result columns and their sources, best first.
STATION_SOURCES = {
    "Lat_DD": ("Lat_DD_midpt", "Lat_DD_calc"),
    "Lon_DD": ("Lon_DD_midpt", "Lon_DD_calc"),
    "Water_depth_m": ("Water_depth_m_cruise", "Water_depth_m_Bathy", "Water_depth_m_Bathy2"),
    "Track_length_m": ("Track_length_m_preset", "Track_dist_m_Odometer", "Track_dist_m_GPS"),
    "Bearings": ("Bearing", "Bearing_calc"),
}
# Every source, and the measured values that the sources derive from.
REPLACED_COLUMNS = (
    *(source for sources in STATION_SOURCES.values() for source in sources),
    "Lat_start_DD", "Lon_start_DD", "Lat_stop_DD", "Lon_stop_DD", "Odometer_count",
)


def fill_bulk_weights(species: DataFrame) -> DataFrame:
    """Rows weighed as part of a bulk sample weigh 0 themselves (F1)."""

    def filled(weight: str, kind: str):
        part_of_bulk = (F.col(kind) == "Sample") & F.col(weight).isNull()
        return F.when(part_of_bulk, 0.0).otherwise(F.col(weight))

    return species.withColumns({
        "AFDW_g": filled("AFDW_g", "Weight_type_AFDW"),
        "AFDW_g_from_WW": filled("AFDW_g_from_WW", "Weight_type"),
    })


def drop_non_taxa(species: DataFrame) -> DataFrame:
    """Drop entries without an accepted name, and remains with Count -1."""
    return species.filter(
        "coalesce(hasNoMatch <> 1, true) AND coalesce(Count <> -1, true)"
    )


def upscale(species: DataFrame, columns: Sequence[str] = UPSCALED) -> DataFrame:
    """Scale counts and weights up to the whole catch; counts half-even."""
    scaled = species.withColumns({c: F.try_divide(F.col(c), F.col("Fraction")) for c in columns})
    return scaled.withColumn("Count", F.bround("Count", 0)).drop("Fraction")


def flag_conflicts(species: DataFrame) -> DataFrame:
    """is_conflict: a bulk wet weight beside any dry weight."""
    bulk = F.col("Weight_type") == "Sample"
    return species.withColumn("is_conflict", bulk & F.col("Weight_type_AFDW").isNotNull())


def conflicting_taxa(species: DataFrame, per_station: bool = False) -> DataFrame:
    """The distinct taxa (or station and taxa) with a conflict.

    `species` are the entries after `drop_non_taxa`; only four columns are read.
    """
    keys = ["valid_name", "StationID"] if per_station else ["valid_name"]
    return (
        species.filter((F.col("Weight_type") == "Sample") & F.col("Weight_type_AFDW").isNotNull())
        .select(*keys, "Weight_type")
        .distinct()
    )


def distinct_kinds(species: DataFrame) -> DataFrame:
    """The distinct reported names, each with the weighings that a conflict depends on.

    All that resolving names, `drop_non_taxa` and the default of `conflicting_taxa` read of the entries; stored, it spares them a pass each.
    """
    return species.select(
        "Species_reported", "Weight_type", "Weight_type_AFDW", F.when(F.col("Count") == -1, F.col("Count")).alias("Count")
    ).distinct()


def drop_conflicting_weights(species: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Ignore the bulk wet weights of taxa with a conflict.

    The default of `conflicting_taxa` ignores the station: one conflict removes the
    bulk wet weights of that taxon everywhere.
    """
    keys = [c for c in ("valid_name", "StationID") if c in conflicts.columns]
    # only bulk weights can be meant: all other entries have no key
    marked = left_join_lookup(
        species.withColumn("_bulk", F.when(F.col("Weight_type") == "Sample", F.col("Weight_type"))),
        conflicts.select(*keys, F.col("Weight_type").alias("_bulk"), F.lit(True).alias("_skip")), [*keys, "_bulk"], "_bulk",
    )
    return marked.withColumns({
        "AFDW_g_from_WW": F.when(F.col("_skip").isNull(), F.col("AFDW_g_from_WW")),
        "Weight_type": F.when(F.col("_skip").isNull(), F.col("Weight_type")),
    }).drop("_skip", "_bulk")


def drop_partial_weights(species: DataFrame) -> DataFrame:
    """Prefer the regression to the weight of a broken specimen (F8)."""
    calculated = F.col("AFDW_g_calc").isNotNull()
    return species.withColumns({
        "AFDW_g_from_WW": F.when(F.col("is_Partial_WW") & calculated, None).otherwise(
            F.col("AFDW_g_from_WW")
        ),
        "AFDW_g": F.when(F.col("is_Partial_AFDW") & calculated, None).otherwise(F.col("AFDW_g")),
    })


def combine_biomass(species: DataFrame) -> DataFrame:
    """One biomass per entry, and whether count or biomass are unknown."""
    combined = combine_data_sources(
        species, ("AFDW_g", "AFDW_g_from_WW", "AFDW_g_calc"), "AFDW_g_combined"
    )
    return combined.withColumns({
        "incomplete_count": F.col("Count").isNull().cast("int"),
        "incomplete_biomass": F.col("AFDW_g_combined").isNull().cast("int"),
    })


def clean_species(
    species: DataFrame,
    conflicts: DataFrame | None = None,
    upscale_wet_weight: bool = False,
) -> DataFrame:
    """All cleaning steps on completed entries.

    Pass settled `conflicts` to keep the pass over the entries free of shuffles.
    Reported wet weights stay those of the processed part, so an individual wet
    weight divides them by the scaled-up count; `upscale_wet_weight=True` scales
    them too.
    """
    columns = (*UPSCALED, "WW_g_threshold") if upscale_wet_weight else UPSCALED
    kept = species.transform(fill_bulk_weights).transform(drop_non_taxa)
    if conflicts is None:
        conflicts = conflicting_taxa(kept)
    return (
        kept.transform(upscale, columns)
        .transform(flag_conflicts)
        .transform(drop_conflicting_weights, conflicts)
        .transform(drop_partial_weights)
        .transform(combine_biomass)
    )


def aggregate_taxa(species: DataFrame, default_count: float = 1) -> DataFrame:
    """Totals per station and taxon.

    An unknown count is `default_count` (at least one was seen). Sums skip unknown
    biomass and are 0 when all are unknown; the incomplete flags tell.
    """
    count = F.coalesce(F.col("Count"), F.lit(float(default_count)))
    return species.groupBy(*TAXON_KEY).agg(
        F.sum(count).alias("Count_total"),
        F.coalesce(F.sum("AFDW_g_combined"), F.lit(0.0)).alias("Biomass_g"),
        (F.max("isFuzzy") > 0).alias("isFuzzy"),
        (F.max("incomplete_count") > 0).alias("incomplete_count"),
        (F.max("incomplete_biomass") > 0).alias("incomplete_biomass"),
    )


def select_individuals(species: DataFrame) -> DataFrame:
    """Sizes and weights per specimen from entries with a known count.

    Only weights of the entry itself are divided, not those of a bulk sample.
    """

    def entry_only(kind: str, weight: str):
        return F.try_divide(if_known(F.col(kind) != "Sample", F.col(weight)), F.col("Count"))

    def flag(name: str, default: bool):
        return F.coalesce(F.col(name).cast("boolean"), F.lit(default)).alias(name)

    return (
        species.filter(F.col("Count").isNotNull())
        .select(
            "File", "EntryID", "StationID", "valid_name",
            flag("is_ID_confident", True),
            "rank", "genus", "family", "order", "class", "phylum",
            flag("isFuzzy", False),
            "Count", "Size_dimension", "Size_mm",
            flag("is_Partial_AFDW", False),
            "is_Shell_removed",
            flag("is_Partial_WW", False),
            "is_Fraction_assumed",
            flag("is_Preserved", False),
            "Comment",
            entry_only("Weight_type", "WW_g_threshold").alias("Individual_WW_g"),
            entry_only("Weight_type_AFDW", "AFDW_g").alias("Individual_AFDW_g"),
        )
        .dropna("all", subset=["Size_mm", "Individual_WW_g", "Individual_AFDW_g"])
    )


def clean_stations(stations: DataFrame) -> DataFrame:
    """Combine the sources of each station value; sampled area and volume."""
    combined = stations
    for name, sources in STATION_SOURCES.items():
        combined = combine_data_sources(combined, sources, name)
    area = F.col("Track_length_m") * (F.col("Blade_width_cm") / 100)
    return combined.withColumns({
        "Sample_area_m2": area,
        "Sample_volume_m3": area * (F.col("Blade_depth_cm") / 100),
    }).drop(*REPLACED_COLUMNS)


def join_densities(
    taxa: DataFrame, stations: DataFrame, quantitative_only: bool = False
) -> DataFrame:
    """Density and biomass per area and volume for each station and taxon.

    Both sides have one row per station (and taxon), so no key is hot. By default
    catches that are not quantitative are kept.
    """
    stations = stations.drop("File")
    if quantitative_only:
        stations = stations.filter("is_Quantitative")
    per = F.try_divide
    return taxa.join(stations, "StationID").withColumns({
        "Density_nr_per_m2": per(F.col("Count_total"), F.col("Sample_area_m2")),
        "Density_nr_per_m3": per(F.col("Count_total"), F.col("Sample_volume_m3")),
        "Biomass_g_per_m2": per(F.col("Biomass_g"), F.col("Sample_area_m2")),
        "Biomass_g_per_m3": per(F.col("Biomass_g"), F.col("Sample_volume_m3")),
    }).drop("Count_total", "Biomass_g")


def join_individuals(
    individuals: DataFrame, stations: DataFrame, suffixes: tuple[str, str] = ("_sp", "_st")
) -> DataFrame:
    """Individuals with their station; shared columns get a suffix."""
    stations = stations.drop("File")
    shared = [c for c in individuals.columns if c in stations.columns and c != "StationID"]
    left = individuals.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = stations.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, "StationID")
