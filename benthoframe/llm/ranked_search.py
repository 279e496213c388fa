"""Ranked lexical search by NRA: impact-sorted lists, sequential reads, score intervals.

The score of a document for an item sums, over the item's terms (repeats included), the weight of the term times its saturated
frequency in the document. Three passes:

1. Every text is read once. Its length and the frequencies of the terms that any item asks for are stored, one row per document.
2. Document frequencies, number and total length of the documents come from that table.
3. Each task takes the rows of its part of the table, a bounded number of postings at a time (a shard), sorts the postings of
   every term by impact, and answers every item by NRA (no random access): all lists of an item are read in step, in blocks. A document's lower
   bound is what was read of it, its upper bound adds the last impact read of each list in which it was not seen. Reading goes on
   until no document outside the result can reach the `k`-th lower bound, ties included, and the interval of every
   document inside is a point. A list is read no further once no open document can still turn up in it. The
   `k`-th score of earlier shards is the least that later shards of the task must reach.

The best `k` of each task are merged per item. Nothing is shuffled but those: `k` rows per task and item. Terms of the items
and their weights are sent to all tasks, for as many items at a time as have `query_bytes` of text; more items are further
blocks of the query set against all documents.

Defined results: null and empty texts have no term, are not counted and never found; an item without a term, or whose terms
occur nowhere, has no rows; rows of documents with equal ids are ranked each, a null id after all others of its score; rows of
items equal in id and text are one item, and different texts of one id are ranked each; empty tables give no row; extra columns are
not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benthoframe.session import settle

K = 10
#: Bytes of a text whose terms are counted at once, postings of a shard, entries of a list read in the first step.
BLOCK, SHARD, FIRST = 1 << 22, 1 << 20, 64
#: Entries of the table of open documents and lists in the second part of `nra`.
_SEEN = 1 << 22
_LOWER = bytes(range(0x41, 0x5B))
_CUT = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Upper-case ASCII letters to lower case, all other ASCII but letters and digits to the blank.
_FLAT = bytes.maketrans(_LOWER + _CUT, _LOWER.lower() + b" " * len(_CUT))
Lists = list[tuple[np.ndarray, np.ndarray]]


def term_counts(text: bytes) -> tuple[int, Counter]:
    """The number of terms of a whole text, and how often each occurs."""
    flat, total, counts, at = text.translate(_FLAT), 0, Counter(), 0
    while at < len(flat):
        end = flat.find(b" ", at + BLOCK)
        end = len(flat) if end < 0 else end
        terms = flat[at:end].split()
        total += len(terms)
        counts.update(terms)
        at = end
    return total, counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, -k)[-k]) if len(values) >= k else 0


def nra(lists: Lists, documents: int, k: int = K, floor: int = 0, first: int = FIRST) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents of the `k` best scores (ties included) that are positive and at least `floor`.

    A list has the places (below `documents`) and impacts of its entries, by falling impact; a place is once in it.
    """
    low, at, step = np.zeros(documents, np.int64), [0] * len(lists), first
    bottom = np.zeros(len(lists), np.int64)
    while True:
        for i, (place, impact) in enumerate(lists):
            part = slice(at[i], at[i] + step)
            low[place[part]] += impact[part]
            at[i] = min(at[i] + step, len(place))
            bottom[i] = impact[at[i] - 1] if at[i] < len(place) else 0
        high = low + bottom.sum()
        for (place, _), end, last in zip(lists, at, bottom):
            if last:
                high[place[:end]] -= last
        least = max(1, floor, _kth(low, k))
        held = np.flatnonzero(high >= least)
        if (high[held] == low[held]).all():
            return held, low[held]
        if len(held) <= max(4 * k, min(4096, _SEEN // len(lists))):
            break
        step *= 4
    # few documents are open: their lists are told apart, and only they are looked for
    slot = np.full(documents, -1, np.int32)
    slot[held] = np.arange(len(held))
    score, seen = low[held], np.zeros((len(held), len(lists)), bool)
    for i, (place, _) in enumerate(lists):
        own = slot[place[: at[i]]]
        seen[own[own >= 0], i] = True
    while True:
        high = score + (~seen) @ bottom
        least = max(least, _kth(score, k))
        alive = high >= least
        unknown = alive & (high > score)
        if not unknown.any():
            return held[alive], score[alive]
        step *= 4
        for i in np.flatnonzero((~seen[unknown]).any(axis=0) & (bottom > 0)):
            place, impact = lists[i]
            part = slice(at[i], at[i] + step)
            own = slot[place[part]]
            hit = own >= 0
            score[own[hit]] += impact[part][hit]
            seen[own[hit], i] = True
            at[i] = min(at[i] + step, len(place))
            bottom[i] = impact[at[i] - 1] if at[i] < len(place) else 0


class Shard:
    """The impact-sorted lists of some documents, which are given by ascending id."""

    def __init__(self, lengths: np.ndarray, of: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, documents: int, total: int):
        self.documents = len(lengths)
        norm = np.array([25 + 75 * int(n) * documents // total for n in lengths], np.int64)
        impact = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * norm[of]))
        order = np.lexsort((of, -impact, terms))
        self.place, self.impact = of[order], impact[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def lists(self, terms: np.ndarray, times: np.ndarray) -> Lists:
        spans = ((slice(self.bounds[t], self.bounds[t + 1]), n) for t, n in zip(terms, times))
        return [(self.place[s], self.impact[s] * n) for s, n in spans if s.start < s.stop]


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, and the terms of `vocabulary` with their frequencies, of every document that has a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, terms, tfs, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary())):
                n, counts = term_counts(text.as_py() or b"")
                if n:
                    asked = vocabulary.keys() & counts.keys()
                    ids.append(doc_id.as_py())
                    lengths.append(n)
                    terms += [vocabulary[t] for t in asked]
                    tfs += [counts[t] for t in asked]
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def best_of_tasks(rows: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int, shard: int) -> DataFrame:
    """(item, doc_id, score): the `k` best documents of each item within each task."""

    def answer(rows: list[pa.RecordBatch], best: list[list[tuple[int, bool, int]]]) -> None:
        table = pa.Table.from_batches(rows).combine_chunks()
        table = table.take(pa.compute.sort_indices(table, [("doc_id", "ascending")]))  # nulls last
        ids, (lists, tfs) = table.column("doc_id").to_pylist(), (table.column(c).combine_chunks() for c in ("terms", "tfs"))
        of = np.repeat(np.arange(len(ids), dtype=np.int32), pa.compute.list_value_length(lists).to_numpy())
        flat = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
        index = Shard(table.column("n").to_numpy(), of, *flat, weights, documents, total)
        for i, (terms, times) in enumerate(items):
            if not (held := index.lists(terms, times)):
                continue
            place, score = nra(held, index.documents, k, -best[i][-1][0] if len(best[i]) == k else 0)
            first = np.lexsort((place, -score))[:k]
            found = [(-int(score[j]), ids[place[j]] is None, ids[place[j]] or 0) for j in first]
            best[i] = sorted([*best[i], *found])[:k]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, size = [[] for _ in items], [], 0
        for batch in batches:
            step = max(1, int(shard * batch.num_rows / max(1, len(batch.column("terms").flatten()))))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                held.append(part)
                size += len(part.column("terms").flatten()) + part.num_rows
                if size >= shard:
                    answer(held, best)
                    held, size = [], 0
        if held:
            answer(held, best)
        out = [(i, None if unknown else doc_id, -score) for i, found in enumerate(best) for score, unknown, doc_id in found]
        types = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] or [pa.array([], t) for t in types], ["item", "doc_id", "score"])

    return rows.mapInArrow(scan, "item int, doc_id long, score long")


def _search_block(docs: DataFrame, asked: list[tuple[int | None, bytes]], k: int, shard: int) -> DataFrame:
    spark = docs.sparkSession
    counts = [term_counts(text)[1] for _, text in asked]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    rows = settle(postings(docs, vocabulary), "postings")
    documents, total = rows.agg(F.count("*"), F.sum("n")).first()
    holding = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    items = []
    for found in counts:
        terms = np.array(sorted(vocabulary[t] for t in found if vocabulary[t] in holding), np.int64)
        by_number = {vocabulary[t]: n for t, n in found.items()}
        items.append((terms, np.array([by_number[t] for t in terms], np.int64)))
    found = best_of_tasks(rows, items, weights, documents, total or 1, k, shard)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(asked)], "number int, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, query_bytes: int = 32 << 20, shard: int = SHARD) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the `k` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    asked = settle(items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct(), "items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / query_bytes))
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else asked
        rows = [(r["item_id"], r["text"].encode()) for r in part.orderBy("item_id", "text").collect()]
        if rows:
            more = _search_block(docs, rows, k, shard)
            found = more if found is None else found.unionByName(more)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
#: The same scores of all documents that share a term with an item.
SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS documents, CAST(coalesce(sum(len(terms)), 0) AS BIGINT) AS total FROM d),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, size GROUP BY term, documents),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term), size GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {K}
"""
