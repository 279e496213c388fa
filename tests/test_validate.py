import pytest
from pyspark.sql import functions as F

from benthoframe.functions.columns import ensure_columns, nan_to_null
from benthoframe.operators import validate as va
from benthoframe.sources import csv_files as csv
from benthoframe.sources import dictionary as dd

STATION = {
    "File": "s.csv", "CruiseID": "c", "StationID": "c#1", "Date": "2/1/2017", "Lat_start_DD": "52.0",
    "Lon_start_DD": "4", "Lat_stop_DD": "52.01", "Lon_stop_DD": "4.0", "Lat_DD_midpt": "NA",
    "Lon_DD_midpt": "NA", "Track_length_m_preset": "NA", "Blade_depth_cm": "18",
    "Blade_width_cm": "20.0", "is_Quantitative": "1", "Station_objective": "Complete",
    "Excluded": "NA", "Focus": "NA", "Region": "OG", "Time_start": "10:00:00", "Time_stop": "NA",
    "Bearing": "-180", "Tow_speed_knots": "1.5", "Water_depth_m_cruise": "40", "Odometer_count": "50",
}
ENTRY = {
    "File": "e.csv", "EntryID": "1", "StationID": "c#1", "Fraction": "0.5", "is_Fraction_assumed": "0",
    "Species_reported": "Abra alba", "Count": "2", "Size_dimension": "Shell_length",
    "Size_value": "3.5", "Size_unit": "mm", "WW_g": "1.5", "Weight_type": "Entry",
    "Threshold_scale": "0.5", "is_Shell_removed": "0", "is_Partial_WW": "0", "AFDW_g": "NA",
    "Weight_type_AFDW": "NA", "Threshold_scale_AFDW": "NA", "is_Partial_AFDW": "NA",
    "is_ID_confident": "NA", "is_Preserved": "1",
}
BAD_STATIONS = [
    ({"CruiseID": None}, "empty_cell"), ({"CruiseID": "NA"}, "required_missing"),
    ({"Blade_width_cm": "wide"}, "not_double"), ({"Odometer_count": "5.5"}, "not_integer"),
    ({"is_Quantitative": "2"}, "not_boolean"), ({"Date": "2017-01-02"}, "date_format"),
    ({"Time_start": "10:00:0011:00:00"}, "time_format"), ({"Time_stop": "9:00:00"}, "time_format"),
    ({"Station_objective": "Incomplete"}, "objective"), ({"Region": "XX"}, "not_predefined"),
    ({"Lat_start_DD": "NA"}, "alternatives_missing"), ({"Bearing": "181"}, "bearing_range"),
    *[({c: "-1"}, "negative") for c in va.NOT_NEGATIVE["stations"]],
]
BAD_ENTRIES = [
    ({"Fraction": "1.5"}, "fraction_range"), ({"Count": "0"}, "count_zero"), ({"Count": "-2"}, "negative"),
    ({"Count": "12.0"}, "not_integer"), ({"Count": "1e2"}, "not_integer"),
    ({"WW_g": "1.0d"}, "not_double"), ({"is_Shell_removed": "yes"}, "not_boolean"),
    ({"Size_unit": "inch"}, "not_predefined"), ({"Size_unit": "NA"}, "size_incomplete"),
    ({"Size_dimension": "NA"}, "size_incomplete"), ({"Size_value": "-1"}, "negative"),
    ({"Size_value": "NA", "Size_dimension": "NA"}, "size_missing"),
    ({"Size_value": "NA", "Size_unit": "NA"}, "size_missing"),
    ({"WW_g": "NA"}, "weight_missing"), ({"WW_g": "-1"}, "negative"),
    ({"Weight_type": "NA"}, "weight_incomplete"), ({"Threshold_scale": "NA"}, "weight_incomplete"),
    ({"is_Shell_removed": "NA"}, "weight_incomplete"), ({"is_Partial_WW": "NA"}, "weight_incomplete"),
    ({"Threshold_scale": "0"}, "not_positive"), ({"Weight_type_AFDW": "Entry"}, "weight_missing"),
    ({"AFDW_g": "1.0"}, "weight_incomplete"), ({"Threshold_scale_AFDW": "-1"}, "not_positive"),
    ({"AFDW_g": "-1", "Weight_type_AFDW": "Entry", "Threshold_scale_AFDW": "1", "is_Partial_AFDW": "0"},
     "negative"),
    ({"Species_reported": ""}, "empty_cell"), ({"WW_g": "NaN"}, "empty_cell"),
]

UNREADABLE = {"empty_cell", "not_double", "not_integer", "not_boolean", "date_format"}


def raw(spark, base, changes):
    rows = [{**base, **c, "_nr": str(i)} for i, c in enumerate(changes)]
    schema = ", ".join(f"{c} string" for c in [*base, "_nr"])
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


@pytest.mark.parametrize("table, base, bad", [
    ("stations", STATION, BAD_STATIONS), ("species", ENTRY, BAD_ENTRIES)])
def test_each_row_rule_alone(spark, table, base, bad):
    key = va.KEYS[table]
    df = raw(spark, base, [{}, *[c for c, _ in bad]])
    df = df.withColumn(key, F.when(F.col(key) == base[key], F.col("_nr")).otherwise(F.col(key))).drop("_nr")
    found = {}
    for r in va.validate_part(df, table).collect():
        found.setdefault(r["row_key"], []).append(r["rule"])
    assert "0" not in found                                    # the clean row
    for i, (change, rule) in enumerate(bad, 1):
        got = found[str(i)]
        # A cell that cannot be read comes first; what depends on its value may follow.
        assert (got[:1] if rule in UNREADABLE else got) == [rule], (change, got)


def test_typed_rules_agree_with_text_rules(spark):
    df = csv.type_columns(raw(spark, ENTRY, [{}, {"Count": "0"}, {"Fraction": "NA"}]).drop("_nr"), "species")
    got = sorted(r["rule"] for r in va.validate_typed(df, "species").collect())
    assert got == ["count_zero", "required_missing"]


def test_header_rules(spark):
    good = list(STATION)[1:]
    headers = spark.createDataFrame([
        ("good", good), ("absent", [c for c in good if c != "CruiseID"]), ("invalid", [*good, "Extra"]),
        ("alternatives", [c for c in good if c not in ("Lat_stop_DD", "Lon_stop_DD", "Lat_DD_midpt",
                                                       "Lon_DD_midpt", "Track_length_m_preset")]),
        ("repeated", [*good, "Comment", "Comment"]),
        ("only_two", [c for c in good if not c.endswith(("start_DD", "stop_DD"))]),
    ], "File string, columns array<string>")
    got = sorted((r["File"], r["rule"], r["column"]) for r in va.header_violations(headers, "stations").collect())
    assert got == [
        ("absent", "required_absent", "CruiseID"),
        ("alternatives", "alternatives_absent", "Lat_start_DD, Lon_start_DD, Lat_stop_DD, Lon_stop_DD"),
        ("alternatives", "group_incomplete", "Lat_stop_DD, Lon_stop_DD"),
        ("invalid", "name_invalid", "Extra"),
        ("repeated", "name_repeated", ", ".join([*good, "Comment", "Comment"])),
    ]


def test_set_rules(spark):
    df = spark.createDataFrame([
        ("f", "1", "s", "A", 0.5, False, 1, "Sample", None), ("f", "1", "s", "A", 0.5, None, 2, "Sample", None),
        ("g", "1", "s", "A", 0.2, False, 3, "Sample", 1.0), ("g", "2", "t", "B", 0.2, True, -1, "Sample", None),
        ("g", "3", "t", "B", 0.3, True, 1, None, None), ("g", "4", "t", "B", 0.3, True, None, "Sample", 1.0),
    ], "File string, EntryID string, StationID string, Species_reported string, Fraction double,"
       " is_Fraction_assumed boolean, Count long, Weight_type string, WW_g double")
    got = lambda v: sorted((r["File"], r["row_key"], r["n"]) for r in v.collect())
    assert got(va.duplicate_ids(df, "EntryID")) == [("f", "1", 1)]
    assert got(va.inconsistent_fractions(df)) == [("f", "s / A", 2)]
    assert got(va.empty_bulk_weights(df)) == [("f", "s / A", 2)]
    st = spark.createDataFrame([("x", "s"), ("y", "s"), ("y", "u")], "File string, StationID string")
    assert [(r["row_key"], r["n"]) for r in va.orphan_stations(df, st).collect()] == [("t", 3)]
    assert [(r["row_key"], r["n"]) for r in va.repeated_stations(st).collect()] == [("s", 1)]
    with pytest.raises(ValueError, match="no column nope"):
        va.duplicate_ids(df, "nope")
    with pytest.raises(va.InvalidInput, match="IDs must be unique") as caught:
        va.assert_valid(va.duplicate_ids(df, "EntryID"))
    assert caught.value.violations.count() == 1
    va.assert_valid(va.duplicate_ids(st, "StationID").filter("n > 5"))


def test_dictionary(spark):
    assert dd.required("species") == ["EntryID", "StationID", "Fraction", "is_Fraction_assumed", "Species_reported"]
    assert list(dd.alternatives("stations")) == ["1", "2"]
    assert dd.of_type("stations", "Integer") == ["Odometer_count"]
    assert dd.fractions("bioconversion") == ["WW_to_AFDW"]
    assert dd.predefined("species")["Size_unit"] == ["mm", "cm", "1/2cm", "mm2", "cm2", "mm3", "cm3"]
    assert len(dd.of_type("species", "Boolean")) == 6 and len(dd.of_type("species", "Double")) == 6
    table = dd.data_dictionary(spark, "stations")
    assert table.count() == 27 and table.filter("Datatype = 'Time'").count() == 2


def test_nulls(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1.0), (2.0, None)]
    full = ensure_columns(df, dd.fields("bioconversion"))
    assert dict(full.dtypes)["is_Shell_removed"] == "boolean" and full.columns[:2] == ["a", "b"]
