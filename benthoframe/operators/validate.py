"""Validation of the input tables.

Every rule yields violations: File, rule, row_key, column, message and n, the
number of rows concerned. Rules about one row are predicates that are evaluated
together in one scan; rules about a set of rows are aggregates or anti-joins, so
that a key with many rows is counted, never gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.functions.columns import any_missing
from benthoframe.operators.bioconversion import (
    double_factors,
    double_regressions,
    split_factors,
    split_regressions,
)
from benthoframe.sources import dictionary as dd
from benthoframe.sources.csv_files import BROKEN_ROW, MISSING, PLACES, parse_value

KEYS = {"stations": "StationID", "species": "EntryID", "bioconversion": "Taxon"}

NOT_NEGATIVE = {
    "stations": ("Track_length_m_preset", "Blade_depth_cm", "Blade_width_cm", "Tow_speed_knots",
                 "Water_depth_m_cruise", "Odometer_count"),
    "species": ("Size_value", "WW_g", "AFDW_g"),
    "bioconversion": ("WW_to_AFDW",),
}
POSITIVE = {"species": ("Threshold_scale", "Threshold_scale_AFDW")}
WEIGHTS = {
    # weight: (its type, what else must be known with it)
    "WW_g": ("Weight_type", ("Threshold_scale", "is_Shell_removed", "is_Partial_WW")),
    "AFDW_g": ("Weight_type_AFDW", ("Threshold_scale_AFDW", "is_Partial_AFDW")),
}
TIME_PATTERN = r"^[0-2]\d:[0-5]\d:[0-5]\d$"


class Rule(NamedTuple):
    rule: str
    column: str | None
    bad: Column
    message: str


TEXT = "_text_"


Presence = Callable[[str], Column]


def always(column: str) -> Column:
    return F.lit(True)


def text_rules(columns: Sequence[str], table: str, has: Presence = always) -> list[Rule]:
    """Rules about the text of a cell, in columns prefixed `TEXT`: V1, V6, V9, V10, V13.

    `columns` are the columns of the file, or those of all files, of which `has` tells
    whether the row's file has it; NA is a known missing value, an empty cell is not.
    """
    present = set(columns)
    required = set(dd.required(table))
    rules = []
    for a in dd.attributes(table):
        if a.name not in present:
            continue
        text = F.col(TEXT + a.name)
        given = has(a.name)
        empty = given & (text.isNull() | text.isin("", "NaN"))
        rules.append(Rule("empty_cell", a.name, empty, "cells may not be empty"))
        if a.name in required:
            rules.append(
                Rule("required_missing", a.name, text == MISSING, "a required value is NA")
            )
        unreadable = (
            given & ~empty & (text != MISSING) & parse_value(text, a.datatype).isNull()
        )
        if a.datatype == "Double":
            rules.append(Rule("not_double", a.name, unreadable, "not a number"))
        elif a.datatype == "Integer":
            rules.append(Rule("not_integer", a.name, unreadable, "not a whole number"))
        elif a.datatype == "Boolean":
            rules.append(Rule("not_boolean", a.name, unreadable, "must be 0, 1 or NA"))
        elif a.datatype == "Date":
            rules.append(Rule("date_format", a.name, unreadable, "must be a date DD/MM/YYYY"))
    return rules


def required_rules(columns: Sequence[str], table: str) -> list[Rule]:
    """Required values of a typed table (V6)."""
    present = set(columns)
    return [
        Rule("required_missing", c, F.col(c).isNull(), "a required value is NA")
        for c in dd.required(table) if c in present
    ]


def value_rules(columns: Sequence[str], table: str, has: Presence = always) -> list[Rule]:
    """Rules about typed values of one row: V7, V11, V12, V14, V15, V17-V18, V20-V21, V23-V29.

    A value that is not there breaks none of them, so only rules about what goes with a missing value ask `has`.
    """
    present = set(columns)
    rules = []

    def add(rule: str, column: str, bad: Column, message: str) -> None:
        rules.append(Rule(rule, column, bad, message))

    def known(column: str) -> Column:
        return F.col(column) if column in present else F.lit(None)

    alternatives = dd.alternatives(table)
    if alternatives:
        incomplete = reduce(
            lambda a, b: a & b, [any_missing([known(c) for c in g]) for g in alternatives.values()]
        )
        first = ", ".join(next(iter(alternatives.values())))
        add("alternatives_missing", first, incomplete, "no complete set of alternative values")
    for c in dd.fractions(table):
        if c in present:
            add("fraction_range", c, ~F.col(c).between(0, 1), "must lie between 0 and 1")
    for c, allowed in dd.predefined(table).items():
        if c in present:
            add("not_predefined", c, ~F.col(c).isin(allowed), "must be one of: " + ", ".join(allowed))
    for c in dd.of_type(table, "Time"):
        if c in present:
            add("time_format", c, ~F.col(c).rlike(TIME_PATTERN), "must be a time HH:MM:SS")
    for c in NOT_NEGATIVE.get(table, ()):
        if c in present:
            add("negative", c, F.col(c) < 0, "may not be negative")
    for c in POSITIVE.get(table, ()):
        if c in present:
            add("not_positive", c, F.col(c) <= 0, "must be positive")

    if table == "stations":
        if "Bearing" in present:
            add("bearing_range", "Bearing", F.abs("Bearing") > 180, "must lie in -180 to 180")
        if "Station_objective" in present:
            open_objective = (F.col("Station_objective") == "Incomplete") & F.coalesce(
                known("Excluded"), known("Focus")
            ).isNull()
            add("objective", "Station_objective", open_objective,
                "Incomplete needs taxa in Excluded or Focus")
    if table == "species":
        if "Count" in present:
            add("negative", "Count", F.col("Count") < -1, "may not be negative, except -1")
            add("count_zero", "Count", F.col("Count") == 0, "may not be 0, use NA")
        for weight, (kind, others) in WEIGHTS.items():
            if weight in present:
                missing = any_missing([known(c) for c in (kind, *others)])
                add("weight_incomplete", weight, F.col(weight).isNotNull() & missing,
                    "needs " + ", ".join((kind, *others)))
                add("weight_missing", weight,
                    has(weight) & F.col(weight).isNull() & (known(kind) == "Entry"),
                    f"{kind} cannot be Entry without a weight")
        if "Size_value" in present:
            for c in ("Size_unit", "Size_dimension"):
                add("size_incomplete", c, F.col("Size_value").isNotNull() & known(c).isNull(),
                    "is missing for a measured size")
                add("size_missing", c, has("Size_value") & F.col("Size_value").isNull() & known(c).isNotNull(),
                    "is given without a size")
    return rules


def row_violations(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Violations of row rules, all rules in one scan."""
    hits = df.select("File", F.col(key).cast("string").alias("row_key"), F.explode(broken_rules(rules)).alias("i"))
    return describe(hits, rules)


def broken_rules(rules: Sequence[Rule]) -> Column:
    """The numbers of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(r.bad, F.lit(i)) for i, r in enumerate(rules)]))


def describe(hits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations from (File, row_key, number of the rule `i`)."""
    described = F.array(*[
        F.struct(
            F.lit(r.rule).alias("rule"), F.lit(r.column).cast("string").alias("column"),
            F.lit(r.message).alias("message"),
        )
        for r in rules
    ])
    detail = F.get(described, F.col("i"))
    return hits.select(
        "File", detail["rule"].alias("rule"), "row_key", detail["column"].alias("column"),
        detail["message"].alias("message"), F.lit(1).cast("bigint").alias("n"),
    )


def _violation(
    df: DataFrame, rule: str, column: str, message: str, key: Column, file: Column | None = None
) -> DataFrame:
    """Violations from an aggregate that has a column `n`."""
    return df.select(
        (F.col("File") if file is None else file).alias("File"),
        F.lit(rule).alias("rule"),
        key.cast("string").alias("row_key"),
        F.lit(column).alias("column"),
        F.lit(message).alias("message"),
        F.col("n").cast("bigint").alias("n"),
    )


def empty_file_violations(files: DataFrame) -> DataFrame:
    """Files without a header."""
    return files.select(
        "File", F.lit("empty_file").alias("rule"), F.lit(None).cast("string").alias("row_key"),
        F.lit(None).cast("string").alias("column"), F.lit("the file is empty").alias("message"),
        F.lit(1).cast("bigint").alias("n"),
    )


def header_violations(headers: DataFrame, table: str) -> DataFrame:
    """Violations of the rules about columns: V2, V3, V4, V8."""
    names = F.col("columns")
    checks = []

    def add(rule: str, bad: Column, detail: Column, message: str) -> None:
        checks.append(
            F.when(bad, F.struct(
                F.lit(rule).alias("rule"), detail.alias("column"), F.lit(message).alias("message"),
            ))
        )

    def literal(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def listed(values: Column) -> Column:
        return F.concat_ws(", ", values)

    absent = F.array_except(literal(dd.required(table)), names)
    add("required_absent", F.size(absent) > 0, listed(absent), "required columns are absent")
    invalid = F.array_except(names, literal([a.name for a in dd.attributes(table)]))
    add("name_invalid", F.size(invalid) > 0, listed(invalid), "unknown column names")
    add("name_repeated", F.size(F.array_distinct(names)) < F.size(names), listed(names),
        "column names occur more than once")
    alternatives = dd.alternatives(table)
    if alternatives:
        all_incomplete = reduce(
            lambda a, b: a & b,
            [F.size(F.array_except(literal(g), names)) > 0 for g in alternatives.values()],
        )
        first = next(iter(alternatives.values()))
        add("alternatives_absent", all_incomplete, listed(literal(first)),
            "no complete set of alternative columns")
    for group in dd.groups(table).values():
        given = F.array_intersect(literal(group), names)
        partly = (F.size(given) > 0) & (F.size(given) < len(group))
        add("group_incomplete", partly, listed(F.array_except(literal(group), names)),
            "columns that belong together are absent")
    found = headers.select("File", F.explode(F.array_compact(F.array(*checks))).alias("v"))
    return found.select(
        "File", "v.rule", F.lit(None).cast("string").alias("row_key"), "v.column", "v.message",
        F.lit(1).cast("bigint").alias("n"),
    )


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    """IDs that occur more than once in a file (V5); n counts the surplus rows."""
    if id_column not in df.columns:
        raise ValueError(f"There is no column {id_column} to check for repeated IDs.")
    doubles = (
        df.groupBy("File", id_column).agg((F.count(F.lit(1)) - 1).alias("n")).filter("n > 0")
    )
    return _violation(doubles, "id_duplicated", id_column, "IDs must be unique in a file",
                      F.col(id_column))


def sample_violations(species: DataFrame, fractions: bool = True, weights: bool = True) -> DataFrame:
    """Rules about the entries of a taxon in a sample: V16, V19, V22, in one aggregate.

    `fractions`: more than one reported fraction. `weights`: bulk samples without any weight. Entries that count for
    none of them are left out before the shuffle.
    """
    counted, checks, concerned = [], [], F.lit(False)

    def add(rule: str, column: str, message: str, n: str, bad: Column) -> None:
        checks.append(F.when(bad, F.struct(
            F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.lit(message).alias("message"),
            F.col(n).cast("bigint").alias("n"),
        )))

    if fractions:
        present = F.col("Count") > -1
        concerned |= F.coalesce(present, F.lit(False))
        counted.append(F.count_if(present).alias("_present"))
        bad = F.lit(False)
        for c in ("Fraction", "is_Fraction_assumed"):
            value = F.when(present, F.col(c))
            counted += [F.count(value).alias(f"_known_{c}"), (F.min(value) != F.max(value)).alias(f"_differs_{c}")]
            known = F.col(f"_known_{c}")
            bad |= F.coalesce(f"_differs_{c}", F.lit(False)) | ((known > 0) & (known < F.col("_present")))
        add("fraction_inconsistent", "Fraction",
            "Fraction and is_Fraction_assumed must be equal for a taxon in a sample", "_present", bad)
    for weight, (kind, _) in WEIGHTS.items():
        if weights and weight in species.columns and kind in species.columns:
            bulk = F.col(kind) == "Sample"
            concerned |= F.coalesce(bulk, F.lit(False))
            counted += [F.count_if(bulk).alias(f"_bulk_{weight}"), F.count(F.when(bulk, F.col(weight))).alias(f"_weighed_{weight}")]
            add("bulk_weight_missing", weight, f"every {weight} of the Sample entries is NA", f"_bulk_{weight}",
                (F.col(f"_bulk_{weight}") > 0) & (F.col(f"_weighed_{weight}") == 0))
    samples = species.filter(concerned).groupBy("File", "StationID", "Species_reported").agg(*counted)
    found = samples.select("File", F.concat_ws(" / ", "StationID", "Species_reported").alias("row_key"),
                           F.explode(F.array_compact(F.array(*checks))).alias("v"))
    return found.select("File", "v.rule", "row_key", "v.column", "v.message", "v.n")


def inconsistent_fractions(species: DataFrame) -> DataFrame:
    """Taxa of a station with more than one reported fraction."""
    return sample_violations(species, weights=False)


def empty_bulk_weights(species: DataFrame) -> DataFrame:
    """Bulk samples without any weight."""
    return sample_violations(species, fractions=False)


def orphan_stations(species: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations of the entries that the stations table lacks.

    Entries are counted per station before the join, so a station with very many
    entries is one row there.
    """
    used = species.groupBy("StationID").agg(F.count(F.lit(1)).alias("n"))
    orphans = used.join(stations.select("StationID"), "StationID", "left_anti")
    return _violation(
        orphans, "station_unknown", "StationID", "StationID is missing in the stations table",
        F.col("StationID"), F.lit(None).cast("string"),
    )


def repeated_stations(stations: DataFrame) -> DataFrame:
    """Stations that occur in more than one row over all files."""
    doubles = (
        stations.groupBy("StationID").agg((F.count(F.lit(1)) - 1).alias("n")).filter("n > 0")
    )
    return _violation(
        doubles, "station_repeated", "StationID", "StationID occurs more than once over the files",
        F.col("StationID"), F.lit(None).cast("string"),
    )


def validate_typed(df: DataFrame, table: str) -> DataFrame:
    """All row rules on a typed table."""
    rules = required_rules(df.columns, table) + value_rules(df.columns, table)
    return row_violations(df, rules, KEYS[table])


def validate_part(raw: DataFrame, table: str) -> DataFrame:
    """All row rules on the text columns of files with one header, in one scan."""
    columns = raw.columns
    key = KEYS[table] if KEYS[table] in columns else "File"
    attributes = [a for a in dd.attributes(table) if a.name in columns]
    both = raw.select(
        "File",
        F.col(key).alias("_key"),
        *[F.col(a.name).alias(TEXT + a.name) for a in attributes],
        *[
            parse_value(F.nullif(F.col(a.name), F.lit(MISSING)), a.datatype).alias(a.name)
            for a in attributes
        ],
    )
    return row_violations(both, text_rules(columns, table) + value_rules(columns, table), "_key")


def checked_cells(cells: DataFrame, table: str) -> tuple[DataFrame, list[Rule]]:
    """The rows of `csv_files.read_cells` with typed values and the numbers of the rules they break, and these rules.

    Everything about a row comes from one scan: settle the result, and read both the table (`File` and the dictionary
    columns) and `cell_violations` from that.
    """
    attributes = dd.attributes(table)
    place = {a.name: F.get(PLACES, F.lit(i)) for i, a in enumerate(attributes)}
    names, key = list(place), KEYS[table]
    both = cells.select(
        "File", PLACES, BROKEN_ROW,
        *[F.col(n).alias(TEXT + n) for n in names],
        *[parse_value(F.nullif(F.col(a.name), F.lit(MISSING)), a.datatype).alias(a.name) for a in attributes],
    )

    def has(column: str) -> Column:
        return place[column] > 0

    width = Rule("row_width", None, F.col(BROKEN_ROW).isNotNull(), "the row has more or fewer cells than the header")
    rules = [width, *text_rules(names, table, has), *value_rules(names, table, has)]
    checked = both.select(
        "File", *names,
        F.when(has(key), F.col(TEXT + key)).otherwise(F.col("File")).alias("_key"), BROKEN_ROW, broken_rules(rules).alias("_faults"),
    )
    return checked, rules


def cell_violations(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of the rows of `checked_cells`; the key of a row of wrong width is its line."""
    hits = checked.select("File", "_key", BROKEN_ROW, F.explode("_faults").alias("i"))
    key = F.when(F.col("i") == 0, F.col(BROKEN_ROW)).otherwise(F.col("_key"))
    return describe(hits.select("File", key.alias("row_key"), "i"), rules)


def validate_species_set(species: DataFrame) -> DataFrame:
    """Set rules on all entries: V5, V16, V19, V22."""
    return duplicate_ids(species, "EntryID").unionByName(sample_violations(species))


def validate_stations_set(stations: DataFrame) -> DataFrame:
    """Set rules on all stations: V5, V31."""
    return duplicate_ids(stations, "StationID").unionByName(repeated_stations(stations))


def conversion_doubles(conversion_data: DataFrame) -> DataFrame:
    """Taxa with two factors or regressions for one key (V33h)."""
    factors = double_factors(split_factors(conversion_data, "Taxon"), "Taxon")
    regressions = double_regressions(split_regressions(conversion_data, "Taxon"), "Taxon")
    no_file = F.lit(None).cast("string")
    return _violation(
        factors.withColumnRenamed("Count", "n"), "factor_duplicated", "WW_to_AFDW",
        "more than one factor for a taxon and shell state", F.col("Taxon"), no_file,
    ).unionByName(_violation(
        regressions.withColumnRenamed("Count", "n"), "regression_duplicated", "A_factor",
        "more than one regression for a taxon, dimension and shell state", F.col("Taxon"), no_file,
    ))


def check_bioconversion_input(conversion_data: DataFrame) -> DataFrame:
    """Violations of a typed conversion table."""
    with_file = conversion_data
    if "File" not in conversion_data.columns:
        with_file = conversion_data.withColumn("File", F.lit("bioconversion.csv"))
    return validate_typed(with_file, "bioconversion").unionByName(
        conversion_doubles(conversion_data)
    )


def apply_boolean_defaults(species: DataFrame) -> DataFrame:
    """An unknown is_Shell_removed means that the shell was not removed."""
    return species.withColumn("is_Shell_removed", F.coalesce("is_Shell_removed", F.lit(False)))


class InvalidInput(ValueError):
    """Raised by `assert_valid`; `violations` holds the full table."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def assert_valid(violations: DataFrame) -> None:
    """Raise when there is any violation, showing the first twenty."""
    shown = violations.take(21)
    if shown:
        lines = [
            f"{r['File']}: {r['column']}: {r['message']} (row {r['row_key']})" for r in shown[:20]
        ]
        more = "\n..." if len(shown) > 20 else ""
        raise InvalidInput("Invalid input:\n" + "\n".join(lines) + more, violations)
