"""Merkle manifest: against a plain tree, and its SQL."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from benthoframe.llm import merkle


def plain_hash(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    values = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return plain_hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """The root, and for every leaf the run of siblings with its own place, level by level."""
    paths, now, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(now) > 1:
        for i, at in enumerate(where):
            paths[i].append((now[at - at % 3 : at - at % 3 + 3], at % 3))
        now = [plain_hash(*now[i : i + 3]) for i in range(0, len(now), 3)]
        where = [at // 3 for at in where]
    return now[0], paths


def plain_proofs(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        kept = sorted(by[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text)))
        trees[source] = (kept, *plain_tree([plain_leaf(r, r.text) for r in kept]))
    root, above = plain_tree([trees[s][1] for s in order])
    out = []
    for source, top in zip(order, above):
        kept, subroot, paths = trees[source]
        for r, path in zip(kept, paths):
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, siblings = plain_leaf(r, text), []
            for run, at in [*path, *top]:
                siblings += [x for i, x in enumerate(run) if i != at]
                folded = plain_hash(*run[:at], folded, *run[at + 1 :])
            out.append((r.doc_id, plain_leaf(r, r.text), subroot, root, plain_hash(*siblings), folded, folded == root))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: (t[0] is None, t[0] or 0, *map(str, t[1:])))


def proofs(df, levels=7):
    return merkle.prove(merkle.manifest(df, merkle.without_line_ends(), levels))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_a_plain_tree(spark, docs, levels):
    found = proofs(docs, levels).collect()
    assert ordered(found) == ordered(plain_proofs(docs.collect()))
    assert {r.verified for r in found} == {True, False}


def test_shapes_of_sources(spark):
    """Sources of 1 to 28 rows, one without a name, one of a third of the rows."""
    rng, rows = random.Random(5), []
    for source, n in [(None, 4), ("", 1), ("b", 2), ("B", 3), ("é", 10), ("hot", 28), ("z", 9), ("日本", 5)]:
        rows += [(rng.randrange(10**6), source, None if i % 3 else "xx", i or None, None if i == 2 else f"a\n{i}é") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert ordered(proofs(df, 1).collect()) == ordered(plain_proofs(df.collect()))


def test_odd_rows(spark, odd, empty):
    found = proofs(odd)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert ordered(found.collect()) == ordered(plain_proofs(odd.collect()))
    assert proofs(empty).count() == 0 and merkle.manifest(empty).root is None
    one = odd.where("doc_id = 4")
    assert ordered(proofs(one).collect()) == ordered(plain_proofs(one.collect()))


def test_missing_is_minimal():
    """Every coordinate is needed, none can be derived, and together with the known leaves they give the root."""
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 60)
        levels = merkle.climb([merkle.digest_of(str(i)) for i in range(n)], len(merkle.sizes(n)) - 1)
        known = set(rng.sample(range(n), rng.randint(1, n)))
        asked = merkle.missing(known, n)
        assert len(asked) == len(set(asked))
        have = {(0, i) for i in known}
        assert not have & set(asked)
        have |= set(asked)
        for level, size in enumerate(merkle.sizes(n)[:-1]):
            for run in range(-(-size // 3)):
                inside = [(level, i) for i in range(3 * run, min(3 * run + 3, size))]
                if all(x in have for x in inside):
                    assert (level + 1, run) not in asked
                    have.add((level + 1, run))
        assert (len(levels) - 1, 0) in have


def test_a_partition_fetches_little(spark, docs):
    """All interiors of the leaf partitions are derived: no node below LEVELS is stored for fetching."""
    found = merkle.manifest(docs)
    assert found.nodes.where(F.col("tree") != merkle.TOP).count() == 0
    assert found.parts.count() == docs.select("source").distinct().count()


def test_sql(spark):
    import duckdb

    from benthoframe.llm.queries import ORACLE, QUERIES
    from tests.llm.conftest import SF

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert ordered(db.execute(ORACLE["op12_merkle_manifest"]).fetchall()) == ordered(QUERIES["op12_merkle_manifest"](spark, SF).collect())
