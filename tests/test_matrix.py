import pytest

from benthoframe.operators.matrix import community_values, get_community_matrix

SCHEMA = ("StationID string, valid_name string, rank string, phylum string, class string, order string,"
          " family string, genus string, incomplete_count boolean, incomplete_biomass boolean,"
          " Density_nr_per_m2 double, Density_nr_per_m3 double, Biomass_g_per_m2 double,"
          " Biomass_g_per_m3 double")


def row(station, name, rank, family, incomplete, value):
    return (station, name, rank, "P", "C", "O", family, "G", incomplete, not incomplete,
            value, value, value, value)


@pytest.fixture(scope="module")
def database(spark):
    return spark.createDataFrame([
        row("1", "a one", "Species", "Fa", False, 1.0), row("1", "a two", "Species", "Fa", True, 2.0),
        row("1", "b", "Genus", "Fb", False, 4.0), row("2", "a one", "Species", "Fa", True, None),
        row("2", "a two", "Species", "Fa", False, 8.0), row("3", "top", "Class", None, False, 16.0),
        row("3", "b", "Genus", "F'`b.", False, 32.0),
    ], SCHEMA)


def matrix(*args, **kwargs):
    return {r["StationID"]: {k: v for k, v in r.asDict().items() if k != "StationID"}
            for r in get_community_matrix(*args, **kwargs).collect()}


def test_errors(database):
    with pytest.raises(ValueError, match="^Provide a valid abundance measure.$"):
        get_community_matrix(database, "species", "wrong")
    with pytest.raises(ValueError, match="^Provide a valid taxonomic level.$"):
        get_community_matrix(database, "wrong", "Biomass_g_per_m2")


def test_family(database):
    got = matrix(database, "family", "Density_nr_per_m3")
    assert got["1"] == {"F'`b.": 0, "Fa": 3, "Fb": 4, "NA": 0}
    assert got["2"] == {"F'`b.": 0, "Fa": None, "Fb": 0, "NA": 0}      # unknown, not absent
    assert got["3"] == {"F'`b.": 32, "Fa": 0, "Fb": 0, "NA": 16}


def test_levels(database):
    assert set(matrix(database, "species", "Biomass_g_per_m2")) == {"1", "2"}
    assert list(matrix(database, "all", "Biomass_g_per_m2")["1"]) == ["a one", "a two", "b", "top"]
    assert matrix(database, "phylum", "Biomass_g_per_m2")["3"] == {"P": 48}
    fixed = matrix(database, "family", "Density_nr_per_m2", taxa=["Fb", "Zz", None])
    assert fixed["1"] == {"Fb": 4, "Zz": 0, "NA": 0}


def test_presence(database):
    for incomplete in (True, False):
        got = matrix(database, "family", "presence_absence", incomplete)
        assert got["2"] == {"F'`b.": 0, "Fa": 1, "Fb": 0, "NA": 0} and got["1"]["Fa"] == 1


def test_incomplete(database):
    assert matrix(database, "family", "Density_nr_per_m2", False)["1"]["Fa"] == 1
    assert matrix(database, "family", "Density_nr_per_m2", False, reference_mode=True) == {
        "1": {"Fa": 2}, "2": {"Fa": None}}
    assert matrix(database, "family", "Biomass_g_per_m2", False) == {"1": {"Fa": 2}, "2": {"Fa": None}}


def test_row_sums_equal_long_form(database):
    known = database.filter("Density_nr_per_m2 IS NOT NULL")
    long = community_values(known, "all", "Density_nr_per_m2").groupBy("StationID").sum("value")
    wide = matrix(known, "all", "Density_nr_per_m2")
    assert {r[0]: r[1] for r in long.collect()} == {s: sum(v.values()) for s, v in wide.items()}


def test_too_many_taxa(spark, database):
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        with pytest.raises(ValueError, match="community_values"):
            get_community_matrix(database, "all", "Density_nr_per_m2")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
