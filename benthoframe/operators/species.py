"""Completing the species entries and the quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.functions.columns import end_method, if_known, left_join_lookup
from benthoframe.operators.taxonomy import RECORD

TAXON_COLUMNS = [c for c in RECORD if c not in ("status", "isExtinct")]


def add_taxonomy(species: DataFrame, worms: DataFrame) -> DataFrame:
    """Add the accepted name and classification of the reported name."""
    names = worms.select(
        F.col("Query").alias("Species_reported"), *TAXON_COLUMNS, "hasNoMatch", "isFuzzy"
    )
    return species.join(names, "Species_reported", "left")


def add_conversion_factors(species: DataFrame, factors: DataFrame) -> DataFrame:
    """Add the wet weight to dry weight factor."""
    return left_join_lookup(species, factors, ("valid_name", "is_Shell_removed"), "valid_name")


def add_regressions(species: DataFrame, regressions: DataFrame) -> DataFrame:
    """Add the size to weight regression."""
    return left_join_lookup(
        species, regressions, ("valid_name", "Size_dimension", "is_Shell_removed"), "valid_name"
    )


def add_size_mm(species: DataFrame) -> DataFrame:
    """Sizes in mm, mm2 or mm3: Size_mm.

    1/2cm are classes: class 0 is up to 5 mm, class 1 up to 10 mm.
    """
    unit, size = F.col("Size_unit"), F.col("Size_value")
    return species.withColumn(
        "Size_mm",
        F.when(unit == "1/2cm", size * 5 + 5)
        .when(unit == "cm", size * 10)
        .when(unit == "cm2", size * 100)
        .when(unit == "cm3", size * 1000)
        .when(unit.isNotNull(), size),
    )


def add_biomass(species: DataFrame) -> DataFrame:
    """Weights by regression, threshold and factor.

    Adds WW_g_calc, AFDW_g_calc, WW_g_threshold and AFDW_g_from_WW. A weight below
    the threshold of the scale counts as half the threshold.
    """
    output = F.col("Output_unit")
    regression = F.col("A_factor") * F.pow("Size_mm", "B_exponent") * F.col("Count")
    weighed = species.withColumns({
        "WW_g_calc": if_known(output == "WW_g", regression),
        "WW_g_threshold": if_known(
            F.col("WW_g") == 0, F.col("Threshold_scale") / 2, F.col("WW_g")
        ),
    })
    return weighed.withColumns({
        "AFDW_g_calc": if_known(
            output == "AFDW_g", regression, F.col("WW_g_calc") * F.col("WW_to_AFDW")
        ),
        "AFDW_g_from_WW": F.col("WW_g_threshold") * F.col("WW_to_AFDW"),
    })


def complete_species(
    species: DataFrame, worms: DataFrame, factors: DataFrame, regressions: DataFrame
) -> DataFrame:
    """All additions to the entries, without a shuffle when the lookups are small.

    The keys of the lookups must be unique (`assert_unique_conversion`), so the
    number of entries does not change (V34).
    """
    return (
        species.transform(add_taxonomy, worms)
        .transform(add_conversion_factors, factors)
        .transform(add_regressions, regressions)
        .transform(end_method, "joined_entries")
        .transform(add_size_mm)
        .transform(add_biomass)
    )


# Reports: what is reported, its keys, the name of its count.
REPORTS = {
    "unmatched_names": ("hasNoMatch = 1", ("File", "Species_reported"), "Number_of_entries"),
    "missing_factors": ("(WW_g > 0 OR WW_g_calc > 0) AND WW_to_AFDW IS NULL", ("valid_name", "is_Shell_removed"), "Number_of_entries"),
    "missing_regressions": (
        "Size_value > 0 AND Size_dimension IS NOT NULL AND A_factor IS NULL",
        ("valid_name", "Size_dimension", "is_Shell_removed"), "Number_of_species",
    ),
}
REPORT_KEYS = ("File", "Species_reported", "valid_name", "Size_dimension", "is_Shell_removed")


def count_reports(species: DataFrame) -> DataFrame:
    """The three reports about entries in one grouped pass (R1-R3): report, `REPORT_KEYS`, n."""

    def hit(report: str):
        condition, keys, _ = REPORTS[report]
        return F.when(F.expr(condition), F.struct(
            F.lit(report).alias("report"),
            *[(F.col(k) if k in keys else F.lit(None).cast(species.schema[k].dataType)).alias(k) for k in REPORT_KEYS],
        ))

    hits = species.select(F.explode(F.array_compact(F.array(*map(hit, REPORTS)))).alias("hit"))
    return hits.groupBy(*[F.col(f"hit.{c}").alias(c) for c in ("report", *REPORT_KEYS)]).agg(F.count(F.lit(1)).alias("n"))


def counted_report(counted: DataFrame, report: str) -> DataFrame:
    """One of the reports of `count_reports`, as its own function gives it."""
    _, keys, count = REPORTS[report]
    found = counted.filter(F.col("report") == report).select(*keys, F.col("n").alias(count))
    return found if report == "unmatched_names" else found.orderBy(*keys)


def _report(species: DataFrame, report: str) -> DataFrame:
    condition, keys, count = REPORTS[report]
    found = species.filter(condition).groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return found if report == "unmatched_names" else found.orderBy(*keys)


def report_unmatched_names(species: DataFrame) -> DataFrame:
    """Entries per file and reported name that the taxonomy does not know."""
    return _report(species, "unmatched_names")


def report_missing_factors(species: DataFrame) -> DataFrame:
    """Taxa with a wet weight but no factor (R2)."""
    return _report(species, "missing_factors")


def report_missing_regressions(species: DataFrame) -> DataFrame:
    """Measured taxa without a regression."""
    return _report(species, "missing_regressions")


def depth_difference() -> Column:
    """Mean depth on board minus mean depth of the bathymetry, each over its own known values."""
    return (F.avg("Water_depth_m_cruise") - F.avg("Water_depth_m_Bathy")).alias("mean_diff_depth")


def report_depth_difference(stations: DataFrame) -> DataFrame:
    """Mean depth on board minus mean depth of the bathymetry."""
    return stations.agg(depth_difference())
