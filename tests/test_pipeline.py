"""The whole way from CSV files to result tables, with numbers worked out by hand."""

import pytest

from benthoframe.operators import validate as va
from benthoframe.operators.validate import InvalidInput
from benthoframe.plans import pipeline as pl
from benthoframe.sources import csv_files as csv
from benthoframe.sources import dictionary as dd
from benthoframe.sources.tables import load_table, save_tables, table_path

STATIONS_1 = """CruiseID,StationID,Date,Lat_start_DD,Lon_start_DD,Lat_stop_DD,Lon_stop_DD,Blade_depth_cm,Blade_width_cm,is_Quantitative,Station_objective,Odometer_count,Comment
C1,C1#1,1/2/2017,52.0,4.0,52.0009,4.0,20,20,1,Complete,50,"a, quoted"
C1,C1#2,02/02/2017,52.0,4.0,52.0009,4.0,20,20,0,Complete,NA,NA
"""
STATIONS_2 = """Station_objective, CruiseID,StationID,Date,Lat_DD_midpt,Lon_DD_midpt,Track_length_m_preset,Blade_depth_cm,Blade_width_cm,is_Quantitative,Focus
Incomplete, C2 ,C2#1,3/2/2018,52.04,4.06,100,10,50,1,Bivalvia
"""
SPECIES_1 = """EntryID,StationID,Fraction,is_Fraction_assumed,Species_reported,Count,WW_g,Weight_type,Threshold_scale,is_Shell_removed,is_Partial_WW
1,C1#1,0.5,0,Abra alba,3,8,Entry,0.5,0,0
2,C1#1,0.5,0,Abra alba,NA,0,Entry,0.5,0,0
3,C1#1,1,0,Abra albaa,1,NA,NA,NA,0,0
4,C1#2,1,0,Pagurus,1,3,Entry,0.5,1,0
5,C1#2,1,0,Stones,-1,NA,NA,NA,0,0
6,C1#2,1,0,Nobody knows,4,NA,NA,NA,0,0
"""
SPECIES_2 = """EntryID,StationID,Fraction,is_Fraction_assumed,Species_reported,Count,Size_dimension,Size_value,Size_unit
1,C2#1,1,1,Abra alba,2,Shell_length,1,cm
"""
CONVERSION = """Taxon,WW_to_AFDW,Reference_WW_to_AFDW,Comment_WW_to_AFDW,Size_dimension,Size_unit,A_factor,B_exponent,Output_unit,Reference_regression,Comment_regression,is_Shell_removed
Abra alba,0.2,ref,NA,Shell_length,mm,0.01,2,AFDW_g,ref,NA,0
Pagurus bernhardus,0.1,ref,NA,NA,NA,NA,NA,NA,NA,NA,1
"""


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    write(root / "Stations", "2017_C1.csv", STATIONS_1)
    write(root / "Stations", "2018_C2.csv", STATIONS_2)
    write(root / "Species", "2017_C1.csv", SPECIES_1)
    write(root / "Species", "2018_C2.csv", SPECIES_2)
    write(root, "bioconversion.csv", CONVERSION)
    return root


@pytest.fixture(scope="module")
def finished(spark, inputs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("data"))
    stations, species = pl.construct_database(spark, str(inputs), out)
    conversion = pl.check_bioconversion(spark, str(inputs / "bioconversion.csv"))
    taxonomy = spark.createDataFrame([
        ("Abra alba", 1, "Abra alba", "accepted", None, "Species", "Mollusca", "Bivalvia", "O", "F", "Abra"),
        ("Pagurus", 1, "Pagurus", "accepted", None, "Genus", "Arthropoda", "M", "D", "Paguridae", "Pagurus"),
        ("Pagurus bernhardus", 1, "Pagurus bernhardus", "accepted", None, "Species", "Arthropoda", "M",
         "D", "Paguridae", "Pagurus"),
        ("Stones", 1, "Stones", "accepted", None, "None", None, None, None, None, None),
    ], "name string, cand_id int, valid_name string, status string, isExtinct int, rank string,"
       " phylum string, class string, order string, family string, genus string")
    grid = spark.createDataFrame(
        [(x / 10, y / 10, -30.0 - x) for x in range(0, 100) for y in range(480, 560)],
        "x double, y double, z double")
    pl.collect_taxonomy(spark, taxonomy, conversion, data_folder=out, out_folder=out, as_csv=True)
    bathymetry = pl.collect_bathymetry(spark, grid, data_folder=out, out_folder=out)
    pl.prepare_bioconversion(spark, conversion, data_folder=out, out_folder=out)
    reports = pl.complete_database(spark, out, out)
    database, individuals = pl.finalize_database(spark, out, out, out)
    return dict(out=out, stations=stations, species=species, bathymetry=bathymetry, reports=reports,
                database=database, individuals=individuals)


def test_construct(finished):
    st = {r["StationID"]: r for r in finished["stations"].collect()}
    assert set(st) == {"C1#1", "C1#2", "C2#1"}
    assert st["C1#1"]["Comment"] == "a, quoted" and st["C1#2"]["Comment"] is None
    assert st["C2#1"]["CruiseID"] == "C2" and st["C2#1"]["File"] == "2018_C2.csv"
    assert str(st["C1#1"]["Date"]) == "2017-02-01" and st["C2#1"]["Lat_start_DD"] is None
    assert finished["stations"].columns == ["File", *[a.name for a in dd.attributes("stations")]]
    assert all(r["is_Shell_removed"] is False for r in finished["species"].filter("File LIKE '2018%'").collect())


def test_bathymetry_is_pruned(finished):
    lows = finished["bathymetry"].selectExpr("min(x)", "max(x)", "min(y)", "max(y)").first()
    assert tuple(lows) == (2.0, 6.1, 50.0, 54.0)


def test_reports(finished):
    reports = finished["reports"]
    assert [tuple(r) for r in reports["unmatched_names"].collect()] == [("2017_C1.csv", "Nobody knows", 1)]
    assert [r["valid_name"] for r in reports["missing_factors"].collect()] == []
    assert reports["missing_regressions"].count() == 0
    assert reports["depth_difference"].columns == ["mean_diff_depth"] and reports["depth_difference"].count() == 1


def test_density(finished):
    got = {(r["StationID"], r["valid_name"]): r for r in finished["database"].collect()}
    assert set(got) == {("C1#1", "Abra alba"), ("C1#2", "Pagurus"), ("C2#1", "Abra alba")}
    first = got[("C1#1", "Abra alba")]
    # Counts 3/0.5 + 1 (unknown) + 1 over 100 m by 0.2 m; weights (8 + 0.25) x 0.2 / 0.5.
    assert first["Density_nr_per_m2"] == pytest.approx(8 / 20)
    assert first["Biomass_g_per_m2"] == pytest.approx(8.25 * 0.2 / 0.5 / 20)
    assert first["Density_nr_per_m3"] == pytest.approx(8 / 4)
    assert first["isFuzzy"] and first["incomplete_count"] and first["incomplete_biomass"]
    assert first["source_Track_length_m"] == "Track_dist_m_Odometer"
    assert first["source_Lat_DD"] == "Lat_DD_calc" and first["Water_depth_m"] == 70
    # The genus has no factor of its own and takes the mean of its species.
    genus = got[("C1#2", "Pagurus")]
    assert genus["Biomass_g_per_m2"] == pytest.approx(0.3 / (100.1406 * 0.2), rel=1e-5)
    # Two of 10 mm: 2 x 0.01 x 10^2 over 100 m by 0.5 m.
    last = got[("C2#1", "Abra alba")]
    assert last["Biomass_g_per_m2"] == pytest.approx(2 / 50) and last["source_Lat_DD"] == "Lat_DD_midpt"
    assert last["source_Water_depth_m"] == "Water_depth_m_Bathy" and not last["incomplete_biomass"]


def test_individuals(finished):
    got = {(r["StationID"], r["EntryID"]): r for r in finished["individuals"].collect()}
    assert set(got) == {("C1#1", "1"), ("C1#2", "4"), ("C2#1", "1")}
    assert got[("C1#1", "1")]["Individual_WW_g"] == pytest.approx(8 / 6)
    assert got[("C2#1", "1")]["Size_mm"] == 10 and got[("C1#1", "1")]["Comment_st"] == "a, quoted"


def test_result_dictionaries_follow_the_tables(finished):
    for table in ("database", "database_individuals"):
        df = finished["database" if table == "database" else "individuals"]
        documented = {a.name: dd.SPARK_TYPES[a.datatype].simpleString() for a in dd.attributes(table)}
        assert dict(df.dtypes) == documented


def test_csv_copies(spark, finished):
    copy = csv.read_typed_folder(spark, table_path(spark, finished["out"], "stations_initial") + "_csv", "stations").drop("File")
    stored = load_table(spark, finished["out"], "stations_initial").select(*copy.columns)
    assert copy.exceptAll(stored).count() == 0 and copy.count() == stored.count()


def test_stage_options(spark, inputs, finished, tmp_path):
    out, new = finished["out"], str(tmp_path)
    factors, _ = pl.prepare_bioconversion(
        spark, str(inputs / "bioconversion.csv"), data_folder=out, out_folder=new, levels=("genus",))
    assert {r["valid_name"] for r in factors.collect()} == {"Abra alba", "Abra", "Pagurus bernhardus", "Pagurus"}
    database, individuals = pl.finalize_database(
        spark, out, new, new, as_csv=False, per_station=True, upscale_wet_weight=True, quantitative_only=True,
        default_count=3, suffixes=("_entry", "_station"))
    got = {(r["StationID"], r["valid_name"]): r for r in database.collect()}
    assert set(got) == {("C1#1", "Abra alba"), ("C2#1", "Abra alba")}
    assert got[("C1#1", "Abra alba")]["Density_nr_per_m2"] == pytest.approx((6 + 3 + 1) / 20)
    first = individuals.filter("StationID = 'C1#1' AND EntryID = '1'").first()
    assert first["Individual_WW_g"] == pytest.approx(16 / 6) and first["Comment_station"] == "a, quoted"


def test_a_failed_write_leaves_the_former_pair(spark, inputs, tmp_path):
    """Tables of a stage are published together."""
    out = str(tmp_path / "data")
    pl.construct_database(spark, str(inputs), out, as_csv=False)
    before = {n: load_table(spark, out, n).collect() for n in ("stations_initial", "species_initial")}
    stations = load_table(spark, out, "stations_initial")
    fails = load_table(spark, out, "species_initial").selectExpr("*", "raise_error('disk full') AS gone")
    with pytest.raises(Exception, match="disk full"):
        save_tables({"stations_initial": stations.limit(1), "species_initial": fails}, out)
    assert {n: load_table(spark, out, n).collect() for n in before} == before
    # a later call takes their place, others stay, and the folder does not fill up
    for n in (1, 2, 3):
        save_tables({"stations_initial": stations.limit(n)}, out)
    assert load_table(spark, out, "stations_initial").count() == 3
    assert load_table(spark, out, "species_initial").collect() == before["species_initial"]
    assert len(list((tmp_path / "data" / "versions").iterdir())) == 3


def test_two_scans_of_the_files(spark, inputs):
    """The headers take one text scan, all else about the rows one CSV scan; the results read stored tables."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    folder = str(inputs / "Species")
    headers = csv.read_headers(spark, folder)
    assert plan(headers).count("FileScan text") == 1
    checked, _ = va.checked_cells(csv.read_cells(spark, folder, pl.settle(headers, "headers"), "species"), "species")
    assert plan(checked).count("FileScan csv") == 1 and "FileScan text" not in plan(checked)
    for df in pl.construct_table(spark, folder, "species"):
        assert "FileScan csv" not in plan(df) and "FileScan text" not in plan(df)


def test_bucketed_tables_need_no_exchange(spark, finished, tmp_path):
    """With buckets the aggregate and both joins read their keys where they lie, and the results are the same."""
    out, new = finished["out"], str(tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pl.co_located(spark, out, ("species_final", "stations_final"), 4) as (species, stations):
            for df in (pl.density_table(species, stations), pl.individuals_table(species, stations)):
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and "Exchange" not in plan
        database, individuals = pl.finalize_database(spark, out, new, new, as_csv=False, buckets=4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("benthoframe_")]
    assert database.exceptAll(finished["database"]).count() == 0 == finished["database"].exceptAll(database).count()
    assert individuals.exceptAll(finished["individuals"]).count() == 0 and individuals.count() == finished["individuals"].count()


def test_invalid_input(spark, inputs, tmp_path):
    write(tmp_path / "Stations", "a.csv", STATIONS_1.replace("1/2/2017", "2017"))
    write(tmp_path / "Species", "a.csv", SPECIES_1)
    with pytest.raises(InvalidInput, match="DD/MM/YYYY"):
        pl.construct_database(spark, str(tmp_path), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    write(tmp_path / "Stations", "a.csv", STATIONS_1)
    write(tmp_path / "Species", "a.csv", SPECIES_1.replace("C1#2", "C9#9"))
    with pytest.raises(InvalidInput, match="missing in the stations table"):
        pl.construct_database(spark, str(tmp_path), str(tmp_path / "out"))
