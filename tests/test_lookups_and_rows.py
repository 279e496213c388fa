"""Nothing is dropped without a word: broken rows, doubled lookups, names that differ in case."""

import pytest

from benthoframe.operators import bioconversion as bio
from benthoframe.operators.matrix import community_values, get_community_matrix, save_community_matrix
from benthoframe.operators.species import add_conversion_factors
from benthoframe.operators.taxonomy import get_valid_names
from benthoframe.plans import pipeline as pl
from benthoframe.sources import csv_files as csv
from benthoframe.sources.tables import save_table, table_path
from conftest import rows
from pyspark.sql import functions as F

HEADER = "EntryID,StationID,Fraction,is_Fraction_assumed,Species_reported,Count\n"


def test_broken_rows_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '1,s,1,0,Ensis,4\n2,s,1,0,Ensis,4,9,9\n3,s,1,0,Ensis\n4,s,1,FALSE,"En, sis",4\n')
    (tmp_path / "b.csv").write_text("")
    typed, violations = pl.construct_table(spark, str(tmp_path), "species")
    found = rows(violations.filter("rule in ('row_width', 'empty_file', 'not_boolean')").select("File", "rule", "row_key"))
    assert found == [("a.csv", "row_width", "2,s,1,0,Ensis,4,9,9"), ("a.csv", "row_width", "3,s,1,0,Ensis"), ("b.csv", "empty_file", None)]
    assert typed.filter("EntryID = '4'").select("is_Fraction_assumed", "Species_reported").first() == (False, "En, sis")


def test_files_of_different_headers(spark, tmp_path):
    """Columns in another order, fewer, unknown, quoted and repeated ones; rows that are too short or too long for their own header."""
    (tmp_path / "a.csv").write_text('\ufeffCount, "EntryID" ,StationID,"Odd, ""quoted"" name",Species_reported\n4, 1 ,s,x,"Abra ""alba"", sp"\n\n0,2,s,,NA\n')
    (tmp_path / "b.csv").write_text("EntryID,Comment,Comment\r\n7,one,two\r\n8,one\r\n9,\"o,n\",e,x,y,z,z\r\n10,,\r\n")
    headers = csv.read_headers(spark, str(tmp_path))
    assert {r["File"]: r["columns"] for r in headers.collect()} == {
        "a.csv": ["Count", "EntryID", "StationID", 'Odd, "quoted" name', "Species_reported"], "b.csv": ["EntryID", "Comment", "Comment"]}
    typed, violations = pl.construct_table(spark, str(tmp_path), "species")
    got = {r["EntryID"]: (r["File"], r["Count"], r["StationID"], r["Species_reported"], r["Comment"]) for r in typed.collect()}
    assert got == {
        "1": ("a.csv", 4, "s", 'Abra "alba", sp', None), "2": ("a.csv", 0, "s", None, None), "7": ("b.csv", None, None, None, "one"),
        "8": ("b.csv", None, None, None, "one"), "9": ("b.csv", None, None, None, "o,n"), "10": ("b.csv", None, None, None, None)}
    found = {(r["File"], r["rule"], r["row_key"], r["column"]) for r in violations.collect() if r["rule"] in ("row_width", "count_zero", "empty_cell", "required_missing", "weight_missing")}
    assert found == {
        ("b.csv", "row_width", "8,one", None), ("b.csv", "row_width", '9,"o,n",e,x,y,z,z', None), ("a.csv", "count_zero", "2", "Count"),
        ("a.csv", "required_missing", "2", "Species_reported"), ("b.csv", "empty_cell", "10", "Comment")}


def test_cells_of_a_line(spark):
    lines = {"a,b": 2, "": 1, ",,": 3, 'a,"b,c",d': 3, '"a ""x"", y"': 1, '"a,b" , c': 2, 'a"b,c': 2, '"open,b': 2}
    df = spark.createDataFrame([(k, v) for k, v in lines.items()], "line string, n int")
    assert df.filter(csv.count_cells(df["line"]) != df["n"]).collect() == []


def test_lookup_joins_spread_rows_without_a_key(spark):
    """With broadcast off, entries without a name are dealt over all tasks, and find no partner."""
    entries = spark.range(4000).selectExpr("'s' || id AS StationID", "'e' || id AS EntryID", "CASE WHEN id % 4 = 0 THEN 'n' || id % 10 END AS valid_name", "id % 2 = 0 AS is_Shell_removed")
    factors = spark.createDataFrame([(f"n{i}", s, i / 10) for i in range(10) for s in (True, False, None)], "valid_name string, is_Shell_removed boolean, WW_to_AFDW double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = add_conversion_factors(entries, factors)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.filter("valid_name IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1000 and sum(sizes) == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.count() == 4000 and joined.filter("valid_name IS NULL AND WW_to_AFDW IS NOT NULL").count() == 0
    assert joined.filter("valid_name IS NOT NULL AND WW_to_AFDW IS NULL").count() == 0


def test_csv_copy_reads_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("CruiseID,StationID,Date,is_Quantitative\nC,s,31/1/2017,1\nC,t,1/2/2017,0\n")
    typed, _ = pl.construct_table(spark, str(tmp_path / "in"), "stations")
    save_table(typed, str(tmp_path / "out"), "stations", True)
    again = csv.read_typed_folder(spark, table_path(spark, str(tmp_path / "out"), "stations") + "_csv", "stations")
    assert rows(again.drop("File")) == rows(typed.drop("File"))


def test_manual_beats_mean_only_beside_it(spark):
    df = spark.createDataFrame(
        [("a", bio.MEAN_LABEL, 1), ("a", None, 2), ("b", bio.MEAN_LABEL, 3), ("b", bio.MEAN_LABEL, 4), ("c", bio.MEAN_LABEL, 5)],
        "k string, c string, v int",
    )
    assert [r[2] for r in rows(bio.prefer_manual(df, ["k"], "c"), "v")] == [2, 3, 4, 5]
    assert [r[2] for r in rows(bio.prefer_manual(df, ["k"], "c", reference_mode=True), "v")] == [2, 5]


def test_doubled_lookups_are_refused(spark):
    factors = spark.createDataFrame([("a", True)], "valid_name string, is_Shell_removed boolean")
    regressions = spark.createDataFrame([("a", "x", True)], "valid_name string, Size_dimension string, is_Shell_removed boolean")
    worms = spark.createDataFrame([("q",), ("q",), (None,)], "Query string")
    bio.assert_unique_conversion(factors, regressions, worms.distinct())
    with pytest.raises(ValueError, match=r"taxonomy: q \(2 rows\)"):
        bio.assert_unique_conversion(factors, regressions, worms)


def test_match_without_candidate_number(spark):
    record = "name string, cand_id int, valid_name string, status string, isExtinct int, rank string, phylum string, class string, `order` string, family string, genus string"
    taxonomy = spark.createDataFrame([("Abra", None, "Abra alba", "accepted", 0, "Species", *"pcofg")], record)
    found = get_valid_names(spark.createDataFrame([("Abra",), ("Abrs",), ("Zzzz",)], "Query string"), taxonomy)
    assert {r["Query"]: (r["valid_name"], r["isFuzzy"]) for r in found.collect()} == {"Abra": ("Abra alba", 0), "Abrs": ("Abra alba", 1), "Zzzz": (None, 1)}


def test_matrix_names_that_differ_in_case(spark):
    data = [("s", "Abra", 1.0), ("s", "abra", 2.0), ("s", None, 4.0), ("t", "NA", 8.0)]
    database = spark.createDataFrame(data, "StationID string, family string, Density_nr_per_m2 double")
    for c in ("rank", "Species_reported"):
        if c not in database.columns:
            database = database.selectExpr("*", f"'Family' AS {c}")
    wide = get_community_matrix(database, "family", "Density_nr_per_m2")
    assert wide.columns == ["StationID", "Abra", "NA", "abra"]
    assert rows(wide.toDF("s", "a", "n", "b"), "s") == [("s", 1.0, 4.0, 2.0), ("t", 0.0, 8.0, 0.0)]


def test_matrix_in_blocks_of_columns(spark, tmp_path):
    """25,000 taxa, more than a pivot takes: the blocks together hold what the long form has."""
    n, block = 25_000, 5_000
    database = spark.range(30_000).selectExpr(
        "'s' || id % 3 AS StationID", f"CASE WHEN id % {n} <> 7 THEN 'taxon' || lpad(id % {n}, 5, '0') END AS valid_name",
        "CASE WHEN id % 100 <> 1 THEN 1.0D + id % 5 END AS Density_nr_per_m2")
    with pytest.raises(ValueError, match="save_community_matrix|pivotMaxValues"):
        get_community_matrix(database, "all", "Density_nr_per_m2")
    blocks = save_community_matrix(database, "all", "Density_nr_per_m2", str(tmp_path), block).collect()
    assert [r["taxa"] for r in blocks] == [block] * 5
    long = {(r["StationID"], r["taxon"] or "NA"): r["value"] for r in community_values(database, "all", "Density_nr_per_m2").collect()}
    for r in blocks:
        wide = spark.read.parquet(r["path"])
        names = wide.columns[1:]
        assert (names[0], names[-1], len(names)) == (r["first_taxon"], r["last_taxon"], r["taxa"])
        found = wide.collect()
        assert len(found) == 3
        for row in found:
            for taxon, value in zip(names, row[1:]):
                assert value == long.pop((row[0], taxon), 0.0)
    assert not long
