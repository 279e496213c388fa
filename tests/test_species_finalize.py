import pytest
from conftest import rows
from pyspark.sql import functions as F

from benthoframe.operators import combine, finalize as fz, species as sp


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_size_in_mm(spark):
    df = frame(spark, "Size_unit string, Size_value double",
               ("cm", 9.0), ("1/2cm", 0.0), ("1/2cm", 1.0), ("mm", 3.0), ("cm3", 13.0), ("cm2", 2.0),
               ("mm2", 4.0), (None, 5.0), ("cm", None))
    assert [r["Size_mm"] for r in sp.add_size_mm(df).collect()] == [
        90, 5, 10, 3, 13000, 200, 4, None, None]


def test_biomass(spark):
    df = frame(
        spark,
        "Output_unit string, A_factor double, Size_mm double, B_exponent double, Count long,"
        " WW_to_AFDW double, WW_g double, Threshold_scale double",
        ("WW_g", 2.0, 3.0, 2.0, 2, 0.1, 0.0, 0.5), ("AFDW_g", 2.0, 3.0, 2.0, 1, 0.1, 7.0, 0.5),
        (None, None, 3.0, None, 1, 0.2, None, None), ("WW_g", 2.0, 3.0, 2.0, None, 0.1, 1.0, None),
    )
    got = [[None if r[c] is None else round(r[c], 9) for c in
            ("WW_g_calc", "AFDW_g_calc", "WW_g_threshold", "AFDW_g_from_WW")]
           for r in sp.add_biomass(df).collect()]
    assert got == [[36, 3.6, 0.25, 0.025], [None, 18, 7, 0.7], [None, None, None, None],
                   [None, None, 1, 0.1]]


def test_regression_join_matches_missing_dimension(spark):
    species = frame(spark, "valid_name string, Size_dimension string, is_Shell_removed boolean",
                    ("A", None, False), ("A", "Area", False), (None, None, False))
    regs = frame(spark, "valid_name string, Size_dimension string, is_Shell_removed boolean, A_factor double",
                 ("A", None, False, 1.0), ("A", "Area", True, 2.0))
    assert rows(sp.add_regressions(species, regs).select("valid_name", "Size_dimension", "A_factor")) == [
        (None, None, None), ("A", None, 1.0), ("A", "Area", None)]


def test_reports(spark):
    df = frame(spark, "File string, Species_reported string, hasNoMatch int, valid_name string,"
               " is_Shell_removed boolean, WW_g double, WW_g_calc double, WW_to_AFDW double,"
               " Size_value double, Size_dimension string, A_factor double",
               ("f", "x", 1, None, False, 1.0, None, None, 1.0, "Area", None),
               ("f", "x", 1, None, False, None, 2.0, None, None, "Area", None),
               ("f", "y", 0, "Y", False, 0.0, None, None, 1.0, None, None),
               ("f", "z", 0, "Z", True, 1.0, None, 0.1, 1.0, "Area", 1.0))
    assert rows(sp.report_unmatched_names(df)) == [("f", "x", 2)]
    assert rows(sp.report_missing_factors(df)) == [(None, False, 2)]
    assert rows(sp.report_missing_regressions(df)) == [(None, "Area", False, 1)]
    st = frame(spark, "Water_depth_m_cruise double, Water_depth_m_Bathy double",
               (10.0, None), (20.0, 5.0), (None, 7.0))
    assert rows(sp.report_depth_difference(st)) == [(9.0,)]


def test_combine_sources(spark):
    df = frame(spark, "a double, b double, c double", (1.0, 2.0, 3.0), (None, None, 3.0), (None, None, None))
    assert rows(combine.combine_data_sources(df, ("a", "b", "c"), "v").select("v", "source_v")) == [
        (None, "c"), (1.0, "a"), (3.0, "c")]
    assert combine.combine_data_sources(df, ("a",)).columns[-2:] == ["new", "source_new"]
    with pytest.raises(ValueError):
        combine.combine_data_sources(df, ("a", "zz"))


def test_bulk_fill_and_drop(spark):
    df = frame(spark, "Weight_type_AFDW string, AFDW_g double, Weight_type string, AFDW_g_from_WW double,"
               " hasNoMatch int, Count long",
               ("Sample", None, "Sample", None, 0, 1), ("Entry", None, None, None, None, None),
               ("Sample", 2.0, "Sample", 3.0, 0, 2), (None, None, "Sample", None, 1, 1),
               (None, None, None, None, 0, -1))
    filled = fz.fill_bulk_weights(df)
    assert [(r[1], r[3]) for r in filled.collect()] == [
        (0.0, 0.0), (None, None), (2.0, 3.0), (None, 0.0), (None, None)]
    assert fz.drop_non_taxa(df).count() == 3


def test_upscale(spark):
    df = frame(spark, "Count long, AFDW_g double, AFDW_g_from_WW double, AFDW_g_calc double, Fraction double",
               (1, 1.0, None, 3.0, 0.5), (1, 1.0, 1.0, 1.0, 0.4), (3, 1.0, 1.0, 1.0, 2.0),
               (1, 1.0, 1.0, 1.0, 0.0), (None, None, None, None, 1.0))
    up = fz.upscale(df)
    assert "Fraction" not in up.columns
    assert [r["Count"] for r in up.collect()] == [2.0, 2.0, 2.0, None, None]    # half-even: 2.5, 1.5
    assert up.first()["AFDW_g"] == 2.0 and up.collect()[3]["AFDW_g"] is None
    same = df.withColumn("Fraction", F.lit(1.0))
    assert rows(fz.upscale(same).drop("Count")) == rows(same.drop("Count", "Fraction"))


def test_conflicts(spark):
    df = frame(spark, "StationID string, valid_name string, Weight_type string, Weight_type_AFDW string,"
               " AFDW_g_from_WW double",
               ("1", "A", "Sample", "Entry", 1.0), ("2", "A", "Sample", None, 2.0),
               ("2", "A", "Entry", "Entry", 3.0), ("1", "B", "Sample", None, 4.0),
               ("1", None, "Sample", "Entry", 5.0), ("3", None, "Sample", None, 6.0),
               ("1", "A", None, "Entry", 7.0))
    flags = [r["is_conflict"] for r in fz.flag_conflicts(df).collect()]
    assert flags == [True, False, False, False, True, False, None]
    everywhere = fz.drop_conflicting_weights(df, fz.conflicting_taxa(df))
    assert sorted(r["AFDW_g_from_WW"] for r in everywhere.collect() if r["AFDW_g_from_WW"]) == [3, 4, 7]
    local = fz.drop_conflicting_weights(df, fz.conflicting_taxa(df, per_station=True))
    assert sorted(r["AFDW_g_from_WW"] for r in local.collect() if r["AFDW_g_from_WW"]) == [2, 3, 4, 6, 7]


def test_partial(spark):
    df = frame(spark, "is_Partial_WW boolean, is_Partial_AFDW boolean, AFDW_g double,"
               " AFDW_g_from_WW double, AFDW_g_calc double, Count double",
               (True, False, None, 2.0, 3.0, 1.0), (True, None, None, 2.0, None, None),
               (None, True, 1.0, 2.0, 3.0, 1.0), (None, None, None, None, None, 1.0))
    done = fz.combine_biomass(fz.drop_partial_weights(df))
    assert [(r["AFDW_g_combined"], r["source_AFDW_g_combined"], r["incomplete_count"],
             r["incomplete_biomass"]) for r in done.collect()] == [
        (3.0, "AFDW_g_calc", 0, 0), (2.0, "AFDW_g_from_WW", 1, 0), (2.0, "AFDW_g_from_WW", 0, 0),
        (None, "AFDW_g_calc", 0, 1)]


ENTRY = ("StationID string, valid_name string, File string, rank string, phylum string, class string,"
         " order string, family string, genus string, Count double, AFDW_g_combined double, isFuzzy int,"
         " incomplete_count int, incomplete_biomass int")


def entry(station, name, count, biomass, fuzzy=0):
    return (station, name, "f", "Species", "P", "C", "O", "F", None, count, biomass, fuzzy,
            int(count is None), int(biomass is None))


def test_totals(spark):
    df = frame(spark, ENTRY, entry("1", "A", 2.0, None), entry("1", "A", None, 11.0, 1),
               entry("1", "A", 3.0, 5.0), entry("2", "B", 1.0, None))
    got = {r["StationID"]: r for r in fz.aggregate_taxa(df).collect()}
    assert got["1"]["Count_total"] == 6 and got["1"]["Biomass_g"] == 16
    assert got["1"]["isFuzzy"] and got["1"]["incomplete_count"] and got["1"]["incomplete_biomass"]
    assert got["2"]["Biomass_g"] == 0 and not got["2"]["isFuzzy"] and not got["2"]["incomplete_count"]
    assert {r["Count_total"] for r in fz.aggregate_taxa(df, default_count=0).collect()} == {5, 1}


def test_densities_times_area_are_totals(spark):
    totals = fz.aggregate_taxa(frame(spark, ENTRY, entry("1", "A", 2.0, 3.0), entry("2", "A", 1.0, 1.0),
                                     entry("9", "A", 1.0, 1.0)))
    st = frame(spark, "StationID string, File string, is_Quantitative boolean, Sample_area_m2 double,"
               " Sample_volume_m3 double", ("1", "s", True, 20.0, 4.0), ("2", "s", False, 0.0, None))
    got = {r["StationID"]: r for r in fz.join_densities(totals, st).collect()}
    assert set(got) == {"1", "2"} and got["1"]["File"] == "f"
    assert got["1"]["Density_nr_per_m2"] * 20 == pytest.approx(2)
    assert got["1"]["Biomass_g_per_m3"] * 4 == pytest.approx(3)
    assert got["2"]["Density_nr_per_m2"] is None and got["2"]["Density_nr_per_m3"] is None
    assert fz.join_densities(totals, st, quantitative_only=True).count() == 1


def test_individuals(spark):
    df = frame(spark, "File string, EntryID string, StationID string, valid_name string,"
               " is_ID_confident boolean, rank string, genus string, family string, order string,"
               " class string, phylum string, isFuzzy int, Count double, Size_dimension string,"
               " Size_mm double, AFDW_g double, Weight_type_AFDW string, is_Partial_AFDW boolean,"
               " WW_g_threshold double, Weight_type string, is_Shell_removed boolean,"
               " is_Partial_WW boolean, is_Fraction_assumed boolean, is_Preserved boolean, Comment string",
               ("f", "1", "s", "A", None, "S", "G", "F", "O", "C", "P", 1, 2.0, None, None, 4.0, "Entry",
                None, 6.0, "Sample", False, None, False, None, "c"),
               ("f", "2", "s", "A", False, "S", "G", "F", "O", "C", "P", None, 2.0, None, 5.0, 4.0, None,
                True, 6.0, "Entry", False, True, False, True, None),
               ("f", "3", "s", "A", None, "S", "G", "F", "O", "C", "P", 0, None, None, 5.0, 4.0, "Entry",
                None, 6.0, "Entry", False, None, False, None, None),
               ("f", "4", "s", "A", None, "S", "G", "F", "O", "C", "P", 0, 1.0, None, None, None, None,
                None, 6.0, "Sample", False, None, False, None, None))
    got = {r["EntryID"]: r for r in fz.select_individuals(df).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["Individual_WW_g"], got["1"]["Individual_AFDW_g"]) == (None, 2.0)
    assert (got["2"]["Individual_WW_g"], got["2"]["Individual_AFDW_g"]) == (3.0, None)
    assert got["1"]["is_ID_confident"] and got["1"]["isFuzzy"] and not got["1"]["is_Partial_WW"]
    assert not got["2"]["is_ID_confident"] and not got["2"]["isFuzzy"] and got["2"]["is_Preserved"]
    st = frame(spark, "StationID string, File string, Comment string", ("s", "x", "st"))
    joined = fz.join_individuals(fz.select_individuals(df), st)
    assert {"Comment_sp", "Comment_st"} <= set(joined.columns) and joined.count() == 2
    assert "Comment.sp" in fz.join_individuals(df, st, (".sp", ".st")).columns
