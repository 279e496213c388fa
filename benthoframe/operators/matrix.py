"""Community matrices: stations in rows, taxa in columns (M1-M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benthoframe.session import settle

TAXONOMIC_LEVELS = ("all", "species", "genus", "family", "order", "class", "phylum")
INCOMPLETE_FLAG = {
    "Density_nr_per_m2": "incomplete_count",
    "Density_nr_per_m3": "incomplete_count",
    "Biomass_g_per_m2": "incomplete_biomass",
    "Biomass_g_per_m3": "incomplete_biomass",
}
ABUNDANCE_MEASURES = ("presence_absence", *INCOMPLETE_FLAG)


def community_values(
    database: DataFrame,
    taxonomic_level: str,
    abundance_measure: str,
    include_incomplete: bool = True,
    reference_mode: bool = False,
) -> DataFrame:
    """The matrix in long form: StationID, taxon, value (M1-M5).

    The value is NULL when one of the summed values is. `include_incomplete=False`
    leaves out values based on incomplete data; `reference_mode=True` keeps only
    those instead, as the original implementation does.
    """
    # The two error messages.
    if taxonomic_level not in TAXONOMIC_LEVELS:
        raise ValueError("Provide a valid taxonomic level.")
    if abundance_measure not in ABUNDANCE_MEASURES:
        raise ValueError("Provide a valid abundance measure.")

    chosen = database
    if taxonomic_level == "species":
        chosen = chosen.filter(F.col("rank") == "Species")
    taxon = "valid_name" if taxonomic_level in ("all", "species") else taxonomic_level

    flag = INCOMPLETE_FLAG.get(abundance_measure)
    if flag and not include_incomplete:
        chosen = chosen.filter(F.col(flag) == F.lit(reference_mode))

    if abundance_measure == "presence_absence":
        value = F.max(F.lit(1))
    else:
        measured = F.col(abundance_measure)
        value = F.when(F.count(measured) == F.count(F.lit(1)), F.sum(measured))
    return chosen.groupBy("StationID", F.col(taxon).alias("taxon")).agg(value.alias("value"))


def get_community_matrix(
    database: DataFrame,
    taxonomic_level: str,
    abundance_measure: str,
    include_incomplete: bool = True,
    reference_mode: bool = False,
    taxa: Sequence[str | None] | None = None,
) -> DataFrame:
    """One row per station and one column per taxon (M6).

    A taxon that was not found is 0, an unknown value NULL, and entries without a
    taxon at this level form the column ``NA``. The columns are the sorted distinct
    taxa, at most ``spark.sql.pivotMaxValues`` of them; give `taxa` to fix them, or use
    `community_values` for the long form or `save_community_matrix` for blocks of columns, of any size. Without `taxa` the values, one row per
    station and taxon, are stored first, so that the entries are read once. A taxon that is
    really called ``NA`` adds to the column of that name.
    """
    values = community_values(
        database, taxonomic_level, abundance_measure, include_incomplete, reference_mode
    ).withColumn("taxon", F.coalesce("taxon", F.lit("NA")))
    if taxa is None:
        values = settle(values, "community")
        limit = int(values.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = values.select("taxon").distinct().take(limit + 1)
        if len(found) > limit:
            raise ValueError(
                f"More than {limit} taxa: raise spark.sql.pivotMaxValues or use community_values."
            )
        taxa = sorted(row["taxon"] for row in found)
    return get_community_matrix_of(values, ["NA" if t is None else t for t in taxa], abundance_measure)


def get_community_matrix_of(values: DataFrame, names: Sequence[str], abundance_measure: str) -> DataFrame:
    """The columns of the taxa `names` for all stations of a matrix in long form, in which no taxon is NULL."""
    # NaN marks an unknown value, so that NULL after the pivot means "not found".
    marked = values.withColumn(
        "value", F.coalesce(F.col("value").cast("double"), F.lit(float("nan")))
    )
    together = F.max("value") if abundance_measure == "presence_absence" else F.sum("value")
    wide = marked.groupBy("StationID").pivot("taxon", names).agg(together)
    # By position: names may differ in case only. As text, since thousands of columns are many calls otherwise.
    placed = wide.toDF("StationID", *[f"_{i}" for i in range(len(names))])
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    return placed.selectExpr(
        "StationID",
        *[f"nullif(coalesce(_{i}, 0.0D), double('NaN')) AS {name}" for i, name in enumerate(quoted)],
    )


def save_community_matrix(
    database: DataFrame,
    taxonomic_level: str,
    abundance_measure: str,
    folder: str,
    block: int = 5000,
    include_incomplete: bool = True,
    reference_mode: bool = False,
) -> DataFrame:
    """Write a matrix of any number of taxa in blocks of columns; (block, first_taxon, last_taxon, taxa, path) of each.

    The taxa are sorted and cut into blocks of `block` columns. Every block is a table of all stations, as
    `get_community_matrix` has them, so blocks can be joined by StationID. The driver holds the names of one block
    at a time.
    """
    values = settle(
        community_values(database, taxonomic_level, abundance_measure, include_incomplete, reference_mode)
        .withColumn("taxon", F.coalesce("taxon", F.lit("NA"))),
        "community",
    )
    spark, written = database.sparkSession, []

    def write(names: list[str]) -> None:
        path = f"{folder}/block={len(written):05d}"
        get_community_matrix_of(values, names, abundance_measure).write.mode("overwrite").parquet(path)
        written.append((len(written), names[0], names[-1], len(names), path))

    names: list[str] = []
    for row in values.select("taxon").distinct().orderBy("taxon").toLocalIterator():
        names.append(row["taxon"])
        if len(names) == block:
            write(names)
            names = []
    if names:
        write(names)
    return spark.createDataFrame(written, "block int, first_taxon string, last_taxon string, taxa int, path string")
