import pytest
from conftest import rows
from pyspark.sql import functions as F

from benthoframe.operators import taxonomy as tx

SCHEMA = ("name string, cand_id int, valid_name string, status string, isExtinct int, rank string,"
          " phylum string, class string, order string, family string, genus string")


def record(name, cand, valid, status="accepted", extinct=0):
    return (name, cand, valid, status, extinct, "Species", "P", "C", "O", "F", "G")


@pytest.fixture(scope="module")
def taxonomy(spark):
    return spark.createDataFrame([
        record("Abra alba", 1, "Abra alba"),
        record("Ensis ensis", 1, "Ensis ensis", extinct=1),           # alone: kept though extinct
        record("Lepas sp", 1, "Lepas old", extinct=1), record("Lepas sp", 2, "Lepas x", "unaccepted"),
        record("Ophiura", 1, "Ophiura a"), record("Ophiura", 2, "Ophiura b"),  # two accepted
        record("Mya", 1, "Mya vera", "unaccepted"), record("Mya", 2, "Mya vera", "alternate"),
        record("Nucula", 1, "Nucula n", "unaccepted"), record("Nucula", 2, "Nucula ok", "accepted", None),
        record("Gone", 1, "Gone a", extinct=1), record("Gone", 2, "Gone b", extinct=1),
    ], SCHEMA)


def resolve(spark, taxonomy, names, k=1):
    df = spark.createDataFrame([(n,) for n in names], "Query string")
    return {r["Query"]: r for r in tx.get_valid_names(df, taxonomy, k).collect()}


def test_resolution_rules(spark, taxonomy):
    names = ["Abra alba", "Ensis ensis", "Lepas sp", "Ophiura", "Mya", "Nucula", "Gone", "Zzz",
             "Abra alb", "Abra alba", None]
    got = resolve(spark, taxonomy, names)
    assert set(got) == set(names) - {None} and len(got) == 9
    valid = {k: (r["valid_name"], r["isFuzzy"], r["hasNoMatch"]) for k, r in got.items()}
    assert valid["Abra alba"] == ("Abra alba", 0, 0)
    assert valid["Ensis ensis"] == ("Ensis ensis", 0, 0)
    assert valid["Lepas sp"] == ("Lepas x", 0, 0)
    assert valid["Ophiura"] == (None, 0, 1)
    assert valid["Mya"] == ("Mya vera", 0, 0)
    assert valid["Nucula"] == ("Nucula ok", 0, 0)
    assert valid["Gone"] == (None, 0, 1)
    assert valid["Zzz"] == (None, 1, 1)
    assert valid["Abra alb"] == ("Abra alba", 1, 0)


def test_exact_only(spark, taxonomy):
    assert resolve(spark, taxonomy, ["Abra alb"], 0)["Abra alb"]["hasNoMatch"] == 1


@pytest.mark.parametrize("k", [1, 2])
def test_fuzzy_equals_cross_join(spark, k):
    words = ["abc", "abd", "bcd", "ab", "a", "abcd", "xabc", "zzzz", "zz", "cab", "aabbc"]
    asked = ["abx", "acb", "b", "zzz", "abcde", "qqqqq", "bc"]
    taxonomy = spark.createDataFrame([record(w, i, w) for i, w in enumerate(words)], SCHEMA)
    names = spark.createDataFrame([(a,) for a in asked], "Query string")
    got = {tuple(r) for r in tx.match_fuzzy(names, taxonomy, k).select("Query", "valid_name").collect()}
    pairs = names.crossJoin(taxonomy.select("name")).withColumn(
        "d", F.levenshtein("Query", "name")).filter(F.col("d") <= k).collect()
    best = {}
    for r in pairs:
        best[r["Query"]] = min(best.get(r["Query"], 99), r["d"])
    assert got == {(r["Query"], r["name"]) for r in pairs if r["d"] == best[r["Query"]]}


def test_phonetic_keys(spark):
    alike = [
        ("Abra alba", "abra albus"), ("Mysella bidentata", "Misela bidentatum"), ("Phaxas pellucidus", "Faxas pelucida"),
        ("Echinocardium", "Ecinocardyum"), ("Psammechinus miliaris", "Samechinus miliarus"), ("Aequipecten", "Equipecten"),
        ("Xantho", "Zanto"), ("Gnathia", "Nathia"), ("Ctena", "Tena"), ("Oerstedia", "Erstedia"),
    ]
    unlike = [("Abra alba", "Abra nitida"), ("Ensis", "Ophiura"), ("Mya", "Nucula"), ("Abra alba", "Abra")]
    keys = lambda pairs: spark.createDataFrame(pairs, "a string, b string").select(tx.phonetic_key(F.col("a")), tx.phonetic_key(F.col("b"))).collect()
    assert all(a == b for a, b in keys(alike)) and all(a != b for a, b in keys(unlike))


def test_names_that_sound_alike(spark, taxonomy):
    asked = ["Abbra allbus", "Ensys ensys", "Nukulla", "Abra alb", "Myyaa", "Abra completely"]
    got = {r["Query"]: (r["valid_name"], r["isFuzzy"]) for r in tx.get_valid_names(
        spark.createDataFrame([(a,) for a in asked], "Query string"), taxonomy, 1, phonetic=True).collect()}
    assert got == {"Abbra allbus": (None, 1), "Ensys ensys": ("Ensis ensis", 1), "Nukulla": ("Nucula ok", 1),
                   "Abra alb": ("Abra alba", 1), "Myyaa": ("Mya vera", 1), "Abra completely": (None, 1)}
    assert resolve(spark, taxonomy, ["Nukulla"])["Nukulla"]["valid_name"] is None


@pytest.mark.parametrize("k", [0, 1, 2])
def test_phonetic_equals_cross_join(spark, k):
    words = ["abra alba", "abra nitida", "ensis ensis", "ensis siliqua", "mya arenaria", "phaxas pellucidus", "aa", "i"]
    asked = ["abbra albus", "ensys", "ensys ensys", "faxas pelucidus", "mia arenarya", "abra nitda", "a", "y", "", "123"]
    taxonomy = spark.createDataFrame([record(w, i, w) for i, w in enumerate(words)], SCHEMA)
    names = spark.createDataFrame([(a,) for a in asked], "Query string")
    got = {tuple(r) for r in tx.match_fuzzy(names, taxonomy, k, phonetic=True).select("Query", "valid_name").collect()}
    query, name = F.col("Query"), F.col("name")
    near = (F.col("d") <= k) | ((tx.phonetic_key(query) == tx.phonetic_key(name)) & tx.sounds_alike(query, name))
    pairs = names.crossJoin(taxonomy.select("name")).withColumn("d", F.levenshtein("Query", "name")).filter(near).collect()
    best = {}
    for r in pairs:
        best[r["Query"]] = min(best.get(r["Query"], 99), r["d"])
    assert got and got == {(r["Query"], r["name"]) for r in pairs if r["d"] == best[r["Query"]]}


def test_distinct_names(spark):
    species = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "Species_reported string")
    conversion = spark.createDataFrame([("b",), ("c",)], "Taxon string")
    assert rows(tx.distinct_names(species, conversion)) == [("a",), ("b",), ("c",)]
