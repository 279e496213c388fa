"""Near-duplicates, decontamination, repeated strings and the pipeline: against brute force."""

import hashlib
import itertools
import random
import re
import uuid
from collections import Counter

import duckdb
import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from benthoframe.llm import decontaminate, pii, simhash, suffix_dedup
from benthoframe.llm.queries import ORACLE, QUERIES
from benthoframe.session import scratch_root
from tests.llm.conftest import SF
from tests.test_queries import largest_method


def plain_print(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), seed=42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, distance):
    """Rows of (doc_id, fingerprint) to {doc_id: smallest reachable}."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(prints, 2):
        if (x ^ y).bit_count() <= distance:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: find(d) for d in root}


def test_simhash(spark, docs, odd, empty):
    prints = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = plain_components(prints, 2)
    found = QUERIES["op10_simhash"](spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {d: (p, want[d]) for d, p in prints}
    assert all(len(r.fingerprint) == 16 for r in found)
    strange = simhash.near_duplicates(odd).collect()
    assert len(strange) == 10 and {r.component_id for r in strange if r.doc_id in (None, 1, 2, 3)} == {1}
    assert simhash.near_duplicates(empty).count() == 0


def test_links_lose_nothing(spark):
    rng = random.Random(3)
    values = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            v = base
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    for distance, hot in ((1, 3), (2, 3), (2, 10**6), (3, 3)):
        got = sorted((r.a, r.b) for r in simhash.links(df, distance, hot).collect())
        assert got == sorted((min(p), max(p)) for p in itertools.combinations(signed, 2) if ((p[0] ^ p[1]) & (2**64 - 1)).bit_count() <= distance)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    touched = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root[n] for n in touched}


def test_masks_lose_no_window():
    for n in range(decontaminate.LEAST, decontaminate.WINDOW + 1):
        masks = decontaminate.LONG_MASKS if n == decontaminate.WINDOW else decontaminate.SHORT_MASKS
        changed = n - -(-8 * n // 10)
        for wrong in itertools.combinations(range(n), changed):
            assert any(all(o + x not in wrong for x in m) for m in masks for o in range(n - m[-1]))


def oracle(db_tables):
    db = duckdb.connect()
    for name, rows, schema in db_tables:
        db.execute(f"CREATE TABLE {name} ({schema})")
        db.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(rows[0]))})", rows)
    return sorted(db.execute(ORACLE["op5_decontamination"]).fetchall())


def test_decontamination(spark, docs, odd, empty):
    rng = random.Random(6)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randrange(30))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((40, 25, 13, 12, 9, 8, 7, 20))]
    items += [(8, items[1][1].upper()), (9, None), (10, "")]
    texts = []
    for i in range(150):
        item = (items[i % 8][1]).split()
        a = rng.randrange(max(1, len(item) - 12)) if i % 3 else 0
        cut = item[a : a + 14] if i % 2 else item
        for _ in range(rng.randint(0, 4)):
            cut[rng.randrange(len(cut))] = word()
        texts.append((i, " ".join([*(word() for _ in range(rng.randrange(9))), *cut, *(word() for _ in range(rng.randrange(9)))])))
    texts += [(500, None), (501, "")]
    want = oracle([("documents", texts, "doc_id BIGINT, text VARCHAR"), ("benchmark", items, "item_id BIGINT, text VARCHAR")])
    df, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert any(r[1] for r in want) and not all(r[1] for r in want)
    for limit in (10**8, 0):
        assert sorted(map(tuple, decontaminate.decontaminate(df, benchmark, broadcast_bytes=limit).collect())) == want
    assert len(decontaminate.decontaminate(odd, benchmark).collect()) == 10
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    assert not decontaminate.decontaminate(docs, benchmark.limit(0)).where("contaminated").count()


def test_decontamination_runs_no_python(spark):
    plan = QUERIES["op5_decontamination"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decontamination_is_compiled(spark):
    """The JVM compiles no method of more than 8,000 bytes, such as one of the places, the join and the comparison together."""
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k l m n"), (2, "a b c d e f g h")], "item_id long, text string")
    for limit in (10**8, 0):
        found = decontaminate.overlaps(df, decontaminate.items_of(benchmark), broadcast_bytes=limit)
        assert 0 < largest_method(spark, found) < 8000
        assert sorted((r.item, r.equal) for r in found.collect()) == [(1, 13), (2, 8)]


def plain_removal(texts):
    seen, out = set(), []
    for doc_id, text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_repeated_strings(spark, docs, odd, empty):
    rng = random.Random(5)
    some = lambda k: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(k))
    passages = [some(rng.randint(20, 60)) for _ in range(6)]
    texts = [(i, some(rng.randint(0, 40)) + rng.choice(passages)[rng.randint(0, 20) :] + some(rng.randint(0, 30)) + rng.choice(passages)) for i in range(60)]
    texts += [(200, "a" * 700), (201, "ab" * 300), (202, None), (203, "b" + "a" * 300), (204, "x" * 99)]
    df, want = spark.createDataFrame(texts, "doc_id long, text string"), plain_removal(texts)
    for hot in (50_000, 2):
        found = suffix_dedup.remove_repeats(df, bucket_bytes=4000, hot=hot).drop("changed").collect()
        assert sorted(map(tuple, found)) == want
    given = sorted([(r.doc_id, r.text) for r in odd.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = suffix_dedup.remove_repeats(odd).drop("changed").collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_removal(given), key=key)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_contexts_of_every_document(spark):
    """One line in every text, with other words around it each time: no task gets more than a row a batch, or `hot` entries, of its keys."""
    rng = random.Random(9)
    some = lambda k: "".join(rng.choice("abcdef ") for _ in range(k))
    line, copies = some(70), [some(60) for _ in range(5)]
    texts = [(i, some(50) + rng.choice(["", *copies]) + line + rng.choice(["", *copies]) + some(50)) for i in range(400)]
    df, want = spark.createDataFrame(texts, "doc_id long, text string").repartition(3), plain_removal(texts)
    for sizes in ({"crowd": 20}, {"crowd": 20, "hot": 30, "hold": 0}, {"hot": 3, "hold": 0}, {"crowd": 0}):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
        try:
            found = suffix_dedup.remove_repeats(df, **{"bucket_bytes": 8000, **sizes}).drop("changed").collect()
            blocks = suffix_dedup._blocks(df.withColumn("rid", F.col("doc_id")), 4, sizes.get("crowd", 10**9)).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(map(tuple, found)) == want
        keys = Counter(int(k) for b in blocks for k in np.frombuffer(b.phrases, suffix_dedup._PHRASE)["key"])
        if "crowd" in sizes:  # nine batches or so, each with `crowd` entries at most
            assert max(keys.values()) <= 12 * max(1, sizes["crowd"])
            assert any(b.flags for b in blocks)
        else:
            assert max(keys.values()) > 150  # what the bound is for


def test_buckets_let_hot_keys_go():
    rows = np.zeros(3000, suffix_dedup._PHRASE)
    rows["key"], rows["entry"], rows["doc"], rows["n"] = 7, np.arange(3000) % 2000, np.arange(3000), 1
    rows["key"][::10] = 100 + np.arange(300)
    parts = list(suffix_dedup.merge_bucket(iter(np.array_split(rows, 30)), hot=50, hold=0))
    flags = [{d: np.frombuffer(x, suffix_dedup._FLAG) for d, x in f.items()} for _, f in parts]
    later = {d for r, _ in parts for d in r}
    seen = {d for f in flags for d in f}
    assert seen | later == {d for d in range(3000) if d % 10} and all(x["hot"].all() for f in flags for x in f.values())
    assert max(map(len, flags)) <= 400  # let go as they come: a chunk of 100, and as many as the 300 other keys that are held


def test_repeats_over_long_texts(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abc ") for _ in range(3000))
    texts = [(1, text), (2, text[1000:2500] + "!" + text[:900])]
    monkeypatch.setattr(suffix_dedup, "_SPAN", 256)
    raw = [t.encode() for _, t in texts]
    found = suffix_dedup.phrases(raw, [1, 2])
    monkeypatch.setattr(suffix_dedup, "_SPAN", 1 << 20)
    assert int(found["n"].sum()) == sum(len(r) - 99 for r in raw)  # every string has one phrase
    got = sorted(map(tuple, suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).drop("changed").collect()))
    assert got == plain_removal(texts)


def test_pipeline(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        had, has = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in kept.collect()}
        assert has.keys() <= had.keys()
        if name == "simhash_near_dedup":
            classes = plain_components([(d, plain_print(r.text, 3)) for d, r in had.items()], 2)
            assert has.keys() == set(classes.values())
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            want = oracle([("documents", [(d, r.text) for d, r in had.items()], "doc_id BIGINT, text VARCHAR"), ("benchmark", items, "item_id BIGINT, text VARCHAR")])
            assert has.keys() == {r[0] for r in want if not r[1]}
        elif name == "pii":
            assert has.keys() == had.keys() and not any(pii.base_spans(r.text) for r in has.values())
        else:
            assert 0 < len(had) - len(has) < 0.2 * len(had)
    pieces = QUERIES["pipeline"](spark, SF).collect()
    assert {r.doc_id for r in pieces} == set(has)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=key)


def test_near_copies_of_repeated_ids(spark):
    x, a, b = ("one two three four five six", "seven eight nine ten eleven twelve", "red green blue black white grey")
    texts = [(3, x), (7, x), (7, a), (9, a), (8, b), (8, b), (None, x), (None, None), (5, None), (5, ""), (4, b + " pink"), (None, "n n o o p"), (None, "n n o o p")]
    df = spark.createDataFrame([(*t, 1, "z") for t in texts], "doc_id long, text string, row int, loser string")
    kept = corpus_pipeline.drop_near_copies(spark, df, SF)
    assert kept.columns == df.columns
    classes = plain_components([(i, plain_print(t)) for i, (_, t) in enumerate(texts)], 2)
    want = []
    for root in set(classes.values()):
        rows = {texts[i] for i, r in classes.items() if r == root}
        least = min((d is None, d or 0) for d, _ in rows)
        want.append([t for t in rows if (t[0] is None, t[0] or 0) == least])
    got = rows_of(kept)
    assert len(got) == len(want) and all(any(g in rows for g in got) for rows in want)
    assert (3, x) in got and (7, a) in got and got.count((8, b)) == 1 and got.count((None, "n n o o p")) == 1


def test_decontamination_by_row(spark):
    passage = " ".join(f"word{i}" for i in range(20))
    texts = [(7, "some " + passage), (7, "clean seven"), (None, passage + " more"), (None, "clean one"), (None, "clean two"), (8, "clean eight"), (9, None), (7, "some " + passage)]
    df = spark.createDataFrame([(*t, 0) for t in texts], "doc_id long, text string, digest int")
    clean = [t for t in texts if passage not in (t[1] or "")]
    for items in ([(1, passage)], [(None, passage)]):
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        for limit in (10**8, 0):
            bad = decontaminate.contaminated_texts(df, benchmark, broadcast_bytes=limit)
            assert rows_of(df.join(bad, decontaminate.text_digest() == bad["digest"], "left_anti")) == sorted(clean, key=key)
    for limit in (10**8, 0):
        found = decontaminate.decontaminate(df, spark.createDataFrame([(1, passage)], "item_id long, text string"), broadcast_bytes=limit)
        assert sorted((r.doc_id is None, r.doc_id or 0, r.contaminated) for r in found.collect()) == sorted((d is None, d or 0, passage in (t or "")) for d, t in texts)


def test_pipeline_of_odd_tables(spark, odd, empty):
    """Nulls, repeated and empty rows, a very long text and extra columns go through every stage."""
    for given in (odd, empty, odd.drop("n_chars")):
        kept = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.schema.names == given.schema.names, name
            path = f"{scratch_root(spark)}/odd-{uuid.uuid4().hex}"
            kept.write.parquet(path)
            kept = spark.read.parquet(path)
        ids = {r.doc_id for r in kept.collect()}
        assert {r.doc_id for r in corpus_pipeline.pack(spark, kept, SF).collect()} == ids
        if given is not empty:
            assert len(ids) == kept.count() and {1, 4, 6, 7, 8} <= ids
