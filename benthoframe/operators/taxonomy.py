"""Resolving reported taxon names against a taxonomy table.

The taxonomy is a table of candidate records: name, cand_id, valid_name, status,
isExtinct, rank, phylum, class, order, family, genus. A name may have several
records (homonyms, synonyms). All work is on distinct names, never on entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = ["valid_name", "rank", "phylum", "class", "order", "family", "genus", "status",
          "isExtinct"]


def distinct_names(species: DataFrame, conversion_data: DataFrame | None = None) -> DataFrame:
    """The distinct names to resolve, as `Query`."""
    names = species.select(F.col("Species_reported").alias("Query"))
    if conversion_data is not None:
        names = names.unionByName(conversion_data.select(F.col("Taxon").alias("Query")))
    return names.filter(F.col("Query").isNotNull()).distinct()


def match_exact(names: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Candidate records of the names that occur in the taxonomy."""
    return names.join(
        taxonomy.withColumnRenamed("name", "Query"), "Query", "inner"
    ).withColumn("isFuzzy", F.lit(0))


def names_without_match(names: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Names that do not occur in the taxonomy."""
    return names.join(taxonomy.select(F.col("name").alias("Query")), "Query", "left_anti")


def _shorter(name: Column) -> Column:
    """The name with each one of its letters left out."""
    return F.when(
        F.length(name) > 0,
        F.transform(
            F.sequence(F.lit(1), F.length(name)),
            lambda i: F.concat(
                F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))
            ),
        ),
    ).otherwise(F.array().cast("array<string>"))


def deletion_variants(name: Column, distance: int) -> Column:
    """The name and everything left of it after up to `distance` deletions."""
    variants = F.array(name)
    for _ in range(distance):
        variants = F.array_distinct(
            F.concat(variants, F.flatten(F.transform(variants, _shorter)))
        )
    return variants


# Spellings of scientific names that sound alike, as published for TAXAMATCH (Rees 2014), in order.
# At the start of a word:
SOUNDS_FIRST = (
    ("ae", "e"), ("cn", "n"), ("ct", "t"), ("cz", "c"), ("dj", "j"), ("ea", "e"), ("eu", "u"), ("gn", "n"), ("kn", "n"),
    ("mn", "n"), ("oe", "e"), ("qu", "q"), ("ps", "s"), ("pt", "t"), ("ts", "s"), ("wr", "r"), ("x", "z"),
)
# Anywhere:
SOUNDS = (("ae", "i"), ("ia", "a"), ("oe", "i"), ("oi", "a"), ("sc", "s"), ("ph", "f"), ("h", ""))
# Letters, one for one:
SOUND_LETTERS = ("eouykz", "iaiicc")
# At the end of a word, where the letters above are replaced already (-is, -us, -ys, -es, -im, -as, -um, -os, -a):
SOUND_ENDING = ("[ai][sm]?$", "a")


def phonetic_key(name: Column) -> Column:
    """What a scientific name sounds like: equal for spellings that differ in like sounds, doubled letters or endings."""
    words = F.split(F.regexp_replace(F.lower(F.trim(name)), "[^a-z ]", ""), " +")

    def sound(word: Column) -> Column:
        first = word
        for heard, written in reversed(SOUNDS_FIRST):
            cut = F.concat(F.lit(written), F.substring(word, F.lit(len(heard) + 1), F.length(word)))
            first = F.when(word.startswith(heard), cut).otherwise(first)
        for heard, written in SOUNDS:
            first = F.replace(first, F.lit(heard), F.lit(written))
        plain = F.regexp_replace(F.translate(first, *SOUND_LETTERS), r"(.)\1+", "$1")
        return F.regexp_replace(plain, *SOUND_ENDING)

    return F.array_join(F.transform(words, sound), " ")


def sounds_alike(a: Column, b: Column) -> Column:
    """Whether two names with equal phonetic keys are near enough: a quarter of the letters, two at least, may differ."""
    return F.levenshtein(a, b) <= F.greatest(F.lit(2), F.floor(F.least(F.length(a), F.length(b)) / 4))


def match_fuzzy(
    names: DataFrame, taxonomy: DataFrame, max_distance: int = 1, phonetic: bool = False
) -> DataFrame:
    """Candidate records at the smallest edit distance, at most `max_distance`.

    With `phonetic` names that sound alike (`phonetic_key`, `sounds_alike`) are candidates too, at any distance that
    allows. The key is one more variant in the join below.

    Two names within distance k share a variant with at most k deletions (the
    symmetric-deletion method, FastSS), so the candidates come from an equi-join
    on variants; `levenshtein` then verifies each pair. Both sides hold distinct
    names, so a variant is shared by few of them: at most (length + 1) x alphabet
    distinct names have a given variant at distance 1.
    """
    def variants(name: Column) -> Column:
        written = deletion_variants(name, max_distance)
        # no name has this mark
        return F.array_append(written, F.concat(F.lit("\u0001"), phonetic_key(name))) if phonetic else written

    asked = names.select("Query", F.explode(variants(F.col("Query"))).alias("_variant"))
    known = taxonomy.select("name").distinct().select(
        "name", F.explode(variants(F.col("name"))).alias("_variant")
    )
    query, name = F.col("Query"), F.col("name")
    if phonetic:
        distance = F.levenshtein(query, name)
        near = (distance <= max_distance) | (F.col("_variant").startswith("\u0001") & sounds_alike(query, name))
    else:
        distance = F.levenshtein(query, name, max_distance)
        near = distance >= 0
    # Exploded sides are larger than their estimate: never broadcast them.
    pairs = (
        asked.join(known.hint("merge"), "_variant")
        .filter(near)
        .select("Query", F.struct(distance.alias("distance"), "name").alias("_pair"))
    )
    # A name has few candidates, see above; each once, and of these the nearest.
    near = pairs.groupBy("Query").agg(F.collect_set("_pair").alias("_near"))
    nearest = F.filter("_near", lambda p: p["distance"] == F.array_min("_near")["distance"])
    return (
        near.select("Query", F.explode(nearest).alias("_pair"))
        .select("Query", F.col("_pair.name").alias("name"))
        .join(taxonomy, "name")
        .drop("name")
        .withColumn("isFuzzy", F.lit(1))
    )


def choose_record(candidates: DataFrame) -> DataFrame:
    """One record per name, NULL fields when there is none or it is ambiguous.

    A single candidate is taken as it is. Of several, extinct ones are dropped;
    then the only accepted one wins, else the first one when all share one valid
    name. The lowest cand_id is first. A row without cand_id only keeps its name.
    """
    record = F.struct("cand_id", *RECORD)
    found = F.col("cand_id").isNotNull()
    alive = found & F.coalesce(F.col("isExtinct") != 1, F.lit(True))
    accepted = alive & F.coalesce(F.col("status") == "accepted", F.lit(False))
    living_name = F.when(alive, F.col("valid_name"))
    counted = candidates.groupBy("Query").agg(
        F.max("isFuzzy").alias("isFuzzy"),
        F.count_if(found).alias("n"),
        F.count_if(alive).alias("n_alive"),
        F.count_if(accepted).alias("n_accepted"),
        F.count(living_name).alias("n_named"),
        F.min(living_name).alias("low_name"),
        F.max(living_name).alias("high_name"),
        F.min(F.when(found, record)).alias("first"),
        F.min(F.when(alive, record)).alias("first_alive"),
        F.min(F.when(accepted, record)).alias("first_accepted"),
    )
    one_name = (F.col("n_named") == 0) | (
        (F.col("n_named") == F.col("n_alive")) & (F.col("low_name") == F.col("high_name"))
    )
    chosen = (
        F.when(F.col("n") == 1, F.col("first"))
        .when(F.col("n_accepted") == 1, F.col("first_accepted"))
        .when((F.col("n_alive") > 0) & one_name, F.col("first_alive"))
    )
    return counted.withColumn("chosen", chosen).select(
        "Query",
        *[F.col("chosen")[c].alias(c) for c in RECORD],
        "isFuzzy",
        F.col("chosen").isNull().cast("int").alias("hasNoMatch"),
    )


def get_valid_names(
    names: DataFrame, taxonomy: DataFrame, max_distance: int = 1, phonetic: bool = False
) -> DataFrame:
    """Exactly one row per distinct name: the accepted record and its flags.

    isFuzzy is 1 for every name without an exact match, hasNoMatch is 1 when no
    record could be chosen (T8). `names` has a column `Query`; with `max_distance`
    0 and without `phonetic` there is no fuzzy matching.
    """
    # A record without a number is a record too, after the numbered ones.
    numbered = F.coalesce("cand_id", F.lit(2**31 - 1)).cast(taxonomy.schema["cand_id"].dataType)
    taxonomy = taxonomy.withColumn("cand_id", numbered)
    queries = names.select("Query").filter(F.col("Query").isNotNull()).distinct()
    known = taxonomy.withColumnRenamed("name", "Query").withColumn("_exact", F.lit(True))
    asked = queries.join(known, "Query", "left")
    candidates = asked.withColumn("isFuzzy", F.col("_exact").isNull().cast("int")).drop("_exact")
    if max_distance > 0 or phonetic:
        unmatched = candidates.filter("isFuzzy = 1").select("Query")
        candidates = candidates.unionByName(match_fuzzy(unmatched, taxonomy, max_distance, phonetic))
    return choose_record(candidates)


def resolve_taxonomy(
    species: DataFrame,
    conversion_data: DataFrame,
    taxonomy: DataFrame,
    max_distance: int = 1,
    phonetic: bool = False,
) -> DataFrame:
    """Resolve every name of the entries and the conversion table."""
    return get_valid_names(distinct_names(species, conversion_data), taxonomy, max_distance, phonetic)
