"""Preparing the bio-conversion table.

The table holds wet weight to ash-free dry weight factors and size to weight
regressions. Means per higher taxon are added, then the table is split in two
lookups with unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthoframe.session import settle

LEVELS = ("phylum", "class", "order", "family", "genus")
FACTOR_KEY = ("is_Shell_removed",)
REGRESSION_KEY = ("Size_dimension", "is_Shell_removed")
# Fixed value: the label of a calculated mean.
MEAN_LABEL = "Automatic calculated mean."


def split_factors(conversion: DataFrame, name_column: str = "valid_name") -> DataFrame:
    """The distinct positive weight factors (B1)."""
    return (
        conversion.filter(F.col(name_column).isNotNull() & (F.col("WW_to_AFDW") > 0))
        .select(
            name_column, "WW_to_AFDW", "Reference_WW_to_AFDW", "is_Shell_removed",
            "Comment_WW_to_AFDW",
        )
        .distinct()
    )


def split_regressions(conversion: DataFrame, name_column: str = "valid_name") -> DataFrame:
    """The distinct regressions (B1)."""
    return (
        conversion.filter(F.col(name_column).isNotNull() & F.col("Output_unit").isNotNull())
        .select(
            name_column, "Size_dimension", "A_factor", "B_exponent", "Output_unit",
            "Reference_regression", "Comment_regression", "is_Shell_removed",
        )
        .distinct()
    )


def double_factors(factors: DataFrame, name_column: str = "valid_name") -> DataFrame:
    """Keys with more than one factor (B2)."""
    return _doubles(factors, (name_column, *FACTOR_KEY))


def double_regressions(regressions: DataFrame, name_column: str = "valid_name") -> DataFrame:
    """Keys with more than one regression."""
    return _doubles(regressions, (name_column, *REGRESSION_KEY))


def _doubles(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Count")).filter("Count > 1")


def attach_names(conversion_data: DataFrame, worms: DataFrame) -> DataFrame:
    """Add the accepted name and classification of each taxon."""
    names = worms.select(F.col("Query").alias("Taxon"), "valid_name", "isFuzzy", *LEVELS)
    return conversion_data.join(names, "Taxon", "left").distinct()


def unmatched_taxa(named: DataFrame) -> DataFrame:
    """Taxa of the conversion table that have no accepted name."""
    return named.filter(F.col("valid_name").isNull()).select("Taxon").distinct()


def _per_level(named: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Each row once per taxonomic level, with the taxon of that level."""
    pairs = F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(level).alias("higher_taxon")) for level in levels
    ])
    return named.select(F.explode(pairs).alias("_at"), "*").select("_at.*", *named.columns).filter(
        F.col("higher_taxon").isNotNull()
    )


def mean_regressions(named: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Mean regression per higher taxon, size and output; dry weight preferred."""
    means = (
        _per_level(named, levels)
        .filter(F.col("Size_dimension").isNotNull())
        .groupBy("level", "higher_taxon", "Size_dimension", "Size_unit", "Output_unit")
        .agg(F.avg("A_factor").alias("A_factor"), F.avg("B_exponent").alias("B_exponent"))
    )
    # A group holds one row per size and output unit, a handful by the dictionary.
    same_size = Window.partitionBy("level", "higher_taxon", "Size_dimension")
    several = F.count(F.lit(1)).over(same_size) > 1
    return means.withColumn("_several", several).filter(
        ~F.col("_several") | (F.col("Output_unit") != "WW_g")
    ).drop("_several")


def mean_factors(named: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Mean weight factor per higher taxon and shell state."""
    return (
        _per_level(named, levels)
        .groupBy("level", "higher_taxon", "is_Shell_removed")
        .agg(F.avg("WW_to_AFDW").alias("WW_to_AFDW"))
        .filter(F.col("WW_to_AFDW").isNotNull())
    )


def mean_conversion(named: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Rows of calculated means in the layout of the conversion table.

    Every mean factor meets every mean regression of its taxon. A taxon without a
    factor has no shell state and contributes nothing.
    """
    factors = mean_factors(named, levels).filter(F.col("is_Shell_removed").isNotNull())
    joined = factors.join(mean_regressions(named, levels), ["level", "higher_taxon"], "left")
    return joined.select(
        F.lit("Ignore").alias("Taxon"),
        F.col("higher_taxon").alias("valid_name"),
        "is_Shell_removed", "WW_to_AFDW", "Size_dimension", "Size_unit", "Output_unit",
        "A_factor", "B_exponent",
        F.lit(MEAN_LABEL).alias("Comment_WW_to_AFDW"),
        F.lit(MEAN_LABEL).alias("Comment_regression"),
    )


def calculate_mean_conversion(named: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The conversion table with the calculated means appended.

    The default covers all five ranks, as documented; ``levels=("genus",)`` gives
    the narrower result of the original implementation.
    """
    return named.unionByName(mean_conversion(named, levels), allowMissingColumns=True)


def prefer_manual(
    df: DataFrame, keys: Sequence[str], comment: str, reference_mode: bool = False
) -> DataFrame:
    """Drop a calculated row where its key has a manual one.

    Two calculated rows of one key stay, for the checks of unique keys to report.
    `reference_mode` drops every calculated row of a key with two rows, as the original does.
    """
    calculated = F.coalesce(F.col(comment) == MEAN_LABEL, F.lit(False))
    # A key has a handful of rows: the manual ones and a mean.
    same_key = Window.partitionBy(*keys)
    counted = df.withColumns({
        "_n": F.count(F.lit(1)).over(same_key), "_manual": F.count_if(~calculated).over(same_key)
    })
    beaten = (F.col("_n") == 2) if reference_mode else (F.col("_n") > 1) & (F.col("_manual") > 0)
    return counted.filter(~(calculated & beaten)).drop("_n", "_manual")


LOOKUP_KEY = ("lookup", "valid_name", "Size_dimension", "is_Shell_removed")


def prepare_lookups(
    conversion_data: DataFrame, worms: DataFrame, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """Factors and regressions by accepted name in one table, with means of higher taxa.

    `lookup` tells the two apart; `same_key` counts the rows of a key, which is 1 in a valid table (B13). The rows are dealt
    by their key once, for the distinct rows, the manual values and the count.
    """
    named = settle(attach_names(conversion_data, worms), "named")  # read by both means too
    complete = calculate_mean_conversion(named, levels).withColumn(
        "is_Shell_removed", F.col("is_Shell_removed").cast("boolean")
    )

    def row(lookup: str, known: Column, columns: Sequence[str], suffix: str) -> Column:
        kept = {c: F.col(c) if c in columns else F.lit(None).cast(complete.schema[c].dataType)
                for c in ("Size_dimension", "WW_to_AFDW", "A_factor", "B_exponent", "Output_unit")}
        return F.when(known, F.struct(
            F.lit(lookup).alias("lookup"), "valid_name", "is_Shell_removed", *[v.alias(c) for c, v in kept.items()],
            F.col(f"Reference_{suffix}").alias("reference"), F.col(f"Comment_{suffix}").alias("comment"),
        ))

    both = F.array(
        row("factors", F.col("WW_to_AFDW") > 0, ("WW_to_AFDW",), "WW_to_AFDW"),
        row("regressions", F.col("Output_unit").isNotNull(), ("Size_dimension", "A_factor", "B_exponent", "Output_unit"), "regression"),
    )
    rows = complete.filter(F.col("valid_name").isNotNull()).select(F.explode(F.array_compact(both)).alias("_row")).select("_row.*")
    kept = prefer_manual(rows.repartition(*LOOKUP_KEY).distinct(), LOOKUP_KEY, "comment")
    return kept.withColumn("same_key", F.count(F.lit(1)).over(Window.partitionBy(*LOOKUP_KEY)))


def prepare_conversion(
    conversion_data: DataFrame, worms: DataFrame, levels: Sequence[str] = LEVELS, check: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(factors, regressions) by accepted name, with means of higher taxa.

    Both are parts of one stored table. With `check` a key that occurs twice raises, as `assert_unique_conversion`
    does, in one look at that table (B13).
    """
    lookups = settle(prepare_lookups(conversion_data, worms, levels), "lookups")
    if check:
        doubles = lookups.filter("same_key > 1").select(
            "lookup", _key_text([c for c in LOOKUP_KEY if c != "lookup"]), F.col("same_key").alias("Count")
        )
        _refuse(doubles.distinct())
    factors = lookups.filter("lookup = 'factors'").select(
        "valid_name", "WW_to_AFDW", F.col("reference").alias("Reference_WW_to_AFDW"), "is_Shell_removed",
        F.col("comment").alias("Comment_WW_to_AFDW"),
    )
    regressions = lookups.filter("lookup = 'regressions'").select(
        "valid_name", "Size_dimension", "A_factor", "B_exponent", "Output_unit",
        F.col("reference").alias("Reference_regression"), F.col("comment").alias("Comment_regression"), "is_Shell_removed",
    )
    return factors, regressions


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]).alias("key")


def lookup_doubles(
    factors: DataFrame, regressions: DataFrame, worms: DataFrame | None = None
) -> DataFrame:
    """(lookup, key, Count) of every key that occurs more than once in a lookup."""
    checks = {
        "factors": (factors, ("valid_name", *FACTOR_KEY)),
        "regressions": (regressions, ("valid_name", *REGRESSION_KEY)),
    }
    if worms is not None:
        checks["taxonomy"] = (worms, ("Query",))
    found = [
        _doubles(df, keys).select(
            F.lit(lookup).alias("lookup"),
            _key_text(keys),
            "Count",
        )
        for lookup, (df, keys) in checks.items()
    ]
    return reduce(DataFrame.unionByName, found)


def assert_unique_conversion(
    factors: DataFrame, regressions: DataFrame, worms: DataFrame | None = None
) -> None:
    """Raise when a key of the prepared lookups occurs twice (B13, V34); one job for all of them."""
    _refuse(lookup_doubles(factors, regressions, worms))


def _refuse(doubles: DataFrame) -> None:
    shown = doubles.take(20)
    if shown:
        keys = "; ".join(f"{row.lookup}: {row.key} ({row.Count} rows)" for row in shown)
        raise ValueError(f"These lookup keys are not unique: {keys}")
