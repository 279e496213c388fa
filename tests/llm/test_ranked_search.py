"""Ranked search: against the score of every document, and its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from benthoframe.llm import ranked_search as rs
from benthoframe.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) of lists of (id, text)."""
    terms = [(d, plain_terms(t)) for d, t in docs]
    n_docs, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    out = []
    for item_id, text in items:
        asked, scores = plain_terms(text), []
        for d, words in terms:
            tf = Counter(words)
            score = 0
            for t in asked:
                if tf[t]:
                    m = 100 - 75 + (75 * len(words) * n_docs) // total
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item_id, i, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, x or 0) for x in t))


def test_query_and_sql(spark, docs):
    found = QUERIES["op11_ranked_search"](spark, SF)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows = ordered(found.collect())
    assert rows == ordered(plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items]))
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows == ordered(db.execute(ORACLE["op11_ranked_search"]).fetchall())


def test_shards_blocks_and_ties(spark):
    """Many equal scores, tasks of several shards, and items in several blocks."""
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.choice([3, 3, 8])))) for i in range(400)]
    docs += [(1000 + i, "a b c É 日本 x1") for i in range(40)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choice(["a", "b", "cc", "É", "日本", "d", "zz", "X1", "A", "e"]) for _ in range(rng.randint(1, 6)))) for i in range(30)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ordered(plain_search(docs, items, 7))
    for shard, size in ((50, 1 << 20), (1 << 20, 60), (100, 100)):
        assert ordered(rs.search(table, asked, k=7, shard=shard, query_bytes=size).collect()) == want


def test_odd_rows(spark, odd, empty):
    items = [(1, "the quick"), (2, None), (None, "same WORDS words"), (3, ""), (3, "fox"), (3, "é"), (4, "absent"), (1, "the quick"), (5, "日本 STRASSE straße")]
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score long")
    want = plain_search([(r.doc_id, r.text) for r in odd.collect()], dict.fromkeys(items))
    assert ordered(rs.search(odd, asked).collect()) == ordered(want)
    assert rs.search(empty, asked).count() == 0 and rs.search(odd, asked.limit(0)).count() == 0


def test_long_texts(monkeypatch):
    text = "Ab, cd é1 " * 1000
    whole = rs.term_counts(text.encode())
    monkeypatch.setattr(rs, "BLOCK", 7)
    assert rs.term_counts(text.encode()) == whole == (3000, Counter({b"ab": 1000, b"cd": 1000, "é1".encode(): 1000}))


def test_nra_is_exact():
    """Against sums over whole lists, from any first step and with a floor."""
    rng = np.random.default_rng(2)
    for _ in range(400):
        n, k = int(rng.integers(1, 300)), int(rng.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            place = rng.permutation(n)[: rng.integers(1, n + 1)].astype(np.int32)
            impact = -np.sort(-rng.integers(0, rng.choice([3, 1000]), len(place)))
            lists.append((place, impact))
            total[place] += impact
        floor = int(rng.choice([0, total.max() // 2, total.max()]))
        place, score = rs.nra(lists, n, k, floor, first=int(rng.choice([1, 4, 64])))
        least = max(1, floor, sorted(total)[-k] if n >= k else 0)
        assert dict(zip(place.tolist(), score.tolist())) == {i: int(t) for i, t in enumerate(total) if t >= least}


def test_nra_reads_little_where_scores_part():
    """One document far ahead in every list: what is behind the first blocks is not added up."""

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            found = super().__getitem__(key)
            Counted.read += np.size(found)
            return found

    n = 100_000
    lists = [(np.arange(n, dtype=np.int32), np.concatenate([[10**6], np.sort(np.arange(n - 1))[::-1] // 1000]).view(Counted)) for _ in range(3)]
    place, score = rs.nra(lists, n, 1)
    assert place.tolist() == [0] and score.tolist() == [3 * 10**6] and Counted.read < n
