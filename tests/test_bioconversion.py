import pytest
from conftest import rows

from benthoframe.operators import bioconversion as bio

CONV = ("Taxon string, WW_to_AFDW double, Reference_WW_to_AFDW string, Comment_WW_to_AFDW string,"
        " Size_dimension string, Size_unit string, A_factor double, B_exponent double,"
        " Output_unit string, Reference_regression string, Comment_regression string,"
        " is_Shell_removed int")
WORMS = ("Query string, valid_name string, isFuzzy int, phylum string, class string, order string,"
         " family string, genus string")


def conv(spark):
    return spark.createDataFrame([
        ("Aa one", 0.1, "r", None, "Shell_length", "mm", 1.0, 2.0, "WW_g", "r", None, 0),
        ("Aa two", 0.3, "r", None, "Shell_length", "mm", 3.0, 4.0, "AFDW_g", "r", None, 0),
        ("Aa", 0.5, "manual", None, None, None, None, None, None, None, None, 0),
        ("Bb one", None, None, None, "Max_length", "mm", 5.0, 1.0, "WW_g", "r", None, 1),
        ("Unknown", 0.9, "r", None, None, None, None, None, None, None, None, 0),
    ], CONV)


def worms(spark):
    return spark.createDataFrame([
        ("Aa one", "Aa one", 0, "P", "C", "O", "F", "Aa"),
        ("Aa two", "Aa two", 0, "P", "C", "O", "F", "Aa"),
        ("Aa", "Aa", 0, "P", "C", "O", "F", None),
        ("Bb one", "Bb one", 0, "P", "C", "O", "Fb", "Bb"),
    ], WORMS)


def test_split_and_doubles(spark):
    named = bio.attach_names(conv(spark), worms(spark))
    assert rows(bio.unmatched_taxa(named)) == [("Unknown",)]
    assert bio.split_factors(named).count() == 3
    assert bio.split_regressions(named).count() == 3
    twice = conv(spark).unionByName(conv(spark).selectExpr(
        *[f"{c}" if c != "WW_to_AFDW" else "WW_to_AFDW / 2 AS WW_to_AFDW" for c in conv(spark).columns]))
    assert {r["Taxon"] for r in bio.double_factors(bio.split_factors(twice, "Taxon"), "Taxon").collect()} \
        == {"Aa one", "Aa two", "Aa", "Unknown"}


def test_means(spark):
    named = bio.attach_names(conv(spark), worms(spark))
    factors = {(r[0], r[1], r[2]): r[3] for r in bio.mean_factors(named).collect()}
    assert factors[("genus", "Aa", 0)] == pytest.approx(0.2)
    assert factors[("family", "F", 0)] == pytest.approx(0.3)
    assert not any(k[1] == "Bb" for k in factors)
    regs = {(r["level"], r["higher_taxon"], r["Size_dimension"]): r["Output_unit"]
            for r in bio.mean_regressions(named).collect()}
    assert regs[("genus", "Aa", "Shell_length")] == "AFDW_g"       # dry weight preferred
    assert regs[("genus", "Bb", "Max_length")] == "WW_g"           # the only one stays
    combined = bio.mean_conversion(named)
    assert {r["valid_name"] for r in combined.collect()} == {"P", "C", "O", "F", "Aa"}
    assert {r["valid_name"] for r in bio.mean_conversion(named, ("genus",)).collect()} == {"Aa"}


def test_manual_beats_mean(spark):
    factors, regressions = bio.prepare_conversion(conv(spark), worms(spark))
    bio.assert_unique_conversion(factors, regressions)
    by_name = {r["valid_name"]: r for r in factors.collect()}
    assert by_name["Aa"]["WW_to_AFDW"] == 0.5 and by_name["Aa"]["is_Shell_removed"] is False
    assert by_name["F"]["Comment_WW_to_AFDW"] == bio.MEAN_LABEL
    assert "Bb" not in by_name
    assert {r["valid_name"] for r in regressions.collect()} >= {"Aa one", "Aa", "F", "P"}


def test_doubles_raise(spark):
    merged = worms(spark).replace("Aa two", "Aa one", subset=["valid_name"])
    factors, regressions = bio.prepare_conversion(conv(spark), merged)
    with pytest.raises(ValueError, match="Aa one"):
        bio.assert_unique_conversion(factors, regressions)
