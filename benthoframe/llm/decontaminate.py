"""Benchmark decontamination by spaced seeds, in built-in expressions only.

A document is contaminated by a benchmark item if, somewhere, `WINDOW` consecutive words of the two are aligned and
at least `ratio` of them are equal (for an item of fewer words: of all its words). Fixed masks choose five word positions
and ignore those between; the masks are such that every window with that many equal words has a place where all five
positions of one mask agree (the tests prove it by trying all patterns). So equal mask hashes of document and item give all
candidates, and around each hit the aligned words are compared.

The hashes of the items are joined to those of the documents as they are exploded, in one stage without a shuffle of the
documents, while the hashes and words of the items measure at most `broadcast_bytes`. Beyond that the bare hashes of the documents are shuffled, and only documents with a hit
are read again.

Texts are told apart by their SHA-256, so a verdict is that of the row's own text, whatever ids other rows have.

Defined results: null and empty texts are clean; items of fewer than `LEAST` words are not looked for; rows with equal or
null ids are judged each by its text; items with equal words are looked for once and
all reported; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.functions.columns import end_method
from benthoframe.session import settle

WINDOW, LEAST = 13, 8
#: Word positions that count, for items of at least WINDOW words and for shorter ones.
LONG_MASKS = ((0, 1, 3, 6, 7),)
SHORT_MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 1, 2, 5, 6))
_REACH = WINDOW - 1
#: Bytes of a broadcast hash beside the letters of its words: row, array of the words around it and padding.
_ROW_BYTES = 512
_SPLIT = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    """Runs of letters, marks and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), "")


def seeded(rows: DataFrame, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Rows (.., words) exploded to (.., words, pos, hash): one row for each place and mask that fits; `pos` from 0."""
    offsets = sorted({o for m in masks for o in m})
    w = F.col("words")
    shifted = F.arrays_zip(*(F.slice(w, 1 + o, F.size(w)).alias(f"w{o}") for o in offsets))
    placed = rows.select("*", F.posexplode(shifted).alias("pos", "at"))

    def digest(n: int, mask: tuple[int, ...]) -> Column:
        return F.when(F.col(f"at.w{mask[-1]}").isNotNull(), F.xxhash64(F.lit(n), *(F.col(f"at.w{o}") for o in mask)))

    hashes = [digest((*LONG_MASKS, *SHORT_MASKS).index(m), m) for m in masks]
    if len(hashes) == 1:
        return placed.withColumn("hash", hashes[0]).drop("at").where(F.col("hash").isNotNull())
    return placed.withColumn("hash", F.explode(F.array(*hashes))).drop("at").where(F.col("hash").isNotNull())


def around(at: Column, w: Column) -> list[Column]:
    """The words from `_REACH` before a place to `_REACH` behind it; null beyond the text."""
    return [F.when(at + d >= 0, F.get(w, at + d)) for d in range(-_REACH, _REACH + 1)]


def near(at: Column, w: Column) -> tuple[Column, Column]:
    """The words of `around` that are in the text, and how many are lacking before them; little code, for the loop over the places."""
    lacking = F.greatest(F.lit(_REACH) - at, F.lit(0))
    return F.slice(w, F.greatest(at - _REACH, F.lit(0)) + 1, F.lit(2 * _REACH + 1) - lacking), lacking


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, words, n): items with equal words once, under their smallest id, if long enough to be looked for."""
    found = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words"))
    return found.groupBy("words").agg(F.min("item_id").alias("item")).select("item", "words", F.size("words").alias("n")).where(F.col("n") >= LEAST)


def text_digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def overlaps(docs: DataFrame, items: DataFrame, ratio: float = 0.8, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(digest, item, equal): the most equal words of an aligned window, of every contaminated pair of a text and an item."""
    long, short = items.where(F.col("n") >= WINDOW), items.where(F.col("n") < WINDOW)
    masks, seeds = LONG_MASKS, seeded(long, LONG_MASKS)
    if not short.isEmpty():
        masks, seeds = LONG_MASKS + SHORT_MASKS, seeds.unionByName(seeded(short, SHORT_MASKS))
    least = F.ceil(F.round(F.lit(ratio) * F.least(F.col("n"), F.lit(WINDOW)), 9))
    seeds = settle(
        seeds.select("hash", "item", least.cast("int").alias("least"), (F.col("n") < WINDOW).alias("short"), F.array(*around(F.col("pos"), F.col("words"))).alias("theirs")),
        "seeds",
    )
    texts = docs.select(text_digest().alias("digest"), words(F.col("text")).alias("words"))
    places = seeded(texts, masks)
    ours, lacking = (c.alias(name) for c, name in zip(near(F.col("pos"), F.col("words")), ("ours", "lacking")))
    letters = F.aggregate("theirs", F.lit(0).cast("long"), lambda n, w: n + F.coalesce(F.octet_length(w), F.lit(0)))
    size = seeds.agg(F.coalesce(F.sum(letters + _ROW_BYTES), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        hits = places.join(F.broadcast(seeds), "hash").select("digest", "item", "least", "short", "theirs", ours, lacking)
    else:
        # copies have the same hits: each once, and one of their rows is read again
        bare = places.select("digest", "pos", "hash").join(seeds.select("hash").distinct(), "hash", "left_semi").distinct()
        again = texts.join(bare.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])
        placed = again.join(bare, "digest").select("digest", "hash", ours, lacking)
        hits = placed.join(seeds, "hash").select("digest", "item", "least", "short", "theirs", "ours", "lacking")
    # else the comparison becomes a part of the join, whose loop over all places is then too long for the JVM to compile
    hits = end_method(hits, "hits")
    plus = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
    same = F.transform("theirs", lambda word, k: F.coalesce((F.get("ours", k - F.col("lacking")) == word).cast("int"), F.lit(0)))
    # a window that holds the hit ends behind the last position of its mask
    first = min(m[-1] for m in masks)
    windows = F.transform(F.sequence(F.lit(first), F.lit(_REACH)), lambda s: plus(F.slice("same", s + 1, WINDOW)))
    equal = F.when(F.col("short"), plus("same")).otherwise(F.array_max(windows))
    checked = hits.withColumn("same", same).withColumn("equal", equal).where(F.col("equal") >= F.col("least"))
    return checked.groupBy("digest", "item").agg(F.max("equal").alias("equal"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, ratio: float = 0.8, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The distinct `digest` of the texts that hold any item, with or without an id."""
    return settle(overlaps(docs, settle(items_of(benchmark), "items"), ratio, broadcast_bytes).select("digest").distinct(), "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, ratio: float = 0.8, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, contaminated, n_items, items (ascending ids of the items found) and most_equal words of every row."""
    items = settle(items_of(benchmark), "items")
    pairs = settle(overlaps(docs, items, ratio, broadcast_bytes), "overlaps")
    every = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words")).distinct()
    named = items.join(every, "words").select("item", "item_id")  # one row per benchmark row
    found = pairs.join(named, "item").groupBy("digest").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("equal").cast("long").alias("most_equal")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
    return rows.join(found, "digest", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("most_equal", F.lit(0)).cast("long").alias("most_equal"),
    )


#: The same rule by comparing every word of every document with every word of every item.
SQL = rf"""
WITH d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_SPLIT}'), lambda x: x <> '') AS w FROM documents)),
i AS (SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_SPLIT}'), lambda x: x <> '') AS w FROM benchmark) WHERE len(w) >= {LEAST}),
m AS (SELECT doc_id, item_id, n, d.pos - i.pos AS diagonal, i.pos AS pos FROM d JOIN i USING (word)),
dense AS (SELECT doc_id, item_id, diagonal FROM m GROUP BY ALL HAVING count(*) >= 6),
c AS (SELECT doc_id, item_id, n, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY pos
  RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS equal FROM m SEMI JOIN dense USING (doc_id, item_id, diagonal)),
found AS (SELECT doc_id, item_id, max(equal) AS equal FROM c WHERE equal >= ceil(round(0.8 * least(n, {WINDOW}), 9)) GROUP BY ALL),
per AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items, max(equal) AS most_equal FROM found GROUP BY doc_id)
SELECT doc_id, items IS NOT NULL AS contaminated, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  coalesce(items, CAST([] AS BIGINT[])) AS items, CAST(coalesce(most_equal, 0) AS BIGINT) AS most_equal
FROM documents LEFT JOIN per USING (doc_id)
"""
