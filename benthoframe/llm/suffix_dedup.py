"""Removal of repeated byte strings by prefix-free parsing and suffix sorting of what repeats.

A rolling hash of eight bytes triggers phrases: of the places in the middle of a string of `SIZE` bytes, the one with the least
hash is its trigger, so equal strings have the same trigger and no string is without one. A phrase is the run of strings with one
trigger; with the bytes up to the end of its last string it is an entry of the dictionary, and the phrases of a
document one after another are its parse.

1. Every phrase is described by two hashes, of the bytes around its trigger (key) and of its whole entry. Entries that were
   seen before are repeats as a whole, first within an Arrow batch, then within a bucket of keys: this is where the copies of highly
   repetitive text go, at one row per batch whatever their number. A key with one entry repeats nothing else.
2. Only the other entries (same key, different bytes) are fetched. Their suffixes of `SIZE` bytes are sorted, key by
   key: neighbours that agree over `SIZE` bytes, ordered by document and place, are repeats except for the first.
   A key with over `hot` entries, or over `crowd` in one Arrow batch, is dealt out by whole strings instead, so no task holds it
   alone: in step 1 each batch sends one row for it, and a bucket lets its entries go as soon as they are too many.
3. The strings found cover the bytes to remove.

All strings are judged on the input. Hashes of step 1 have 128 bits together; step 2 compares bytes.

Defined results: null text is empty; rows are ordered by `doc_id` (null first), rows with equal ids by text, and equal rows
count as later copies of each other; texts under `SIZE` bytes lose nothing; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benthoframe.session import settle

SIZE = 100
_LEFT, _RIGHT = 12, 20  # bytes around a trigger that are within every string it stands for
_PLACES = SIZE - _LEFT - _RIGHT + 1
_SPAN = 1 << 20
_BITS = 22  # of a place within a piece
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]
_R = np.uint64(0x5851F42D4C957F2D)
_R_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_PHRASE = np.dtype([("key", "<u8"), ("entry", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("n", "u1"), ("lead", "u1")])
_FLAG = np.dtype([("key", "<u8"), ("at", "<i8"), ("n", "u1"), ("lead", "u1"), ("hot", "u1")])
_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("n", "u1"), ("lead", "u1")])
_RUN = np.dtype([("first", "<i8"), ("last", "<i8")])  # first bytes of repeated strings
_powers: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _C[0]
    x ^= x >> np.uint64(32)
    x *= _C[1]
    return x ^ (x >> np.uint64(29))


def _table() -> list[np.ndarray]:
    if not _powers:
        for r in (_R, _R_INVERSE):
            p = np.full(1 << _BITS, r, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def phrases(texts: list[bytes], docs: list[int]) -> np.ndarray:
    """The phrases of all texts (`_PHRASE` rows): `n` strings that begin at `at`, the trigger `lead` bytes behind it."""
    out, held, size = [], [], 0
    for text, doc in zip(texts, docs):
        for base in range(0, max(0, len(text) - SIZE + 1), _SPAN):
            part = text[base : base + _SPAN + SIZE - 1]
            held.append((part, doc, base))
            size += len(part)
            if size > _SPAN:
                out.append(_parse(held))
                held, size = [], 0
    if held:
        out.append(_parse(held))
    return np.concatenate(out) if out else np.zeros(0, _PHRASE)


def _parse(parts: list[tuple[bytes, int, int]]) -> np.ndarray:
    raw = b"".join(p for p, _, _ in parts)
    n = len(raw)
    buffer = raw + bytes(_PLACES + SIZE)
    total = n + _PLACES
    word = np.ndarray((total,), "<u8", buffer, 0, (1,)).copy()
    mixed = _mix(word)
    value = ((mixed >> np.uint64(_BITS)) << np.uint64(_BITS)) | np.arange(total, dtype=np.uint64)
    # least value of every run of _PLACES places, from the running minima of blocks in both directions
    value = np.concatenate([value, np.full(-total % _PLACES, np.uint64(2**64 - 1))]).reshape(-1, _PLACES)
    ahead = np.minimum.accumulate(value, axis=1).ravel()
    back = np.ascontiguousarray(np.minimum.accumulate(value[:, ::-1], axis=1)[:, ::-1]).ravel()
    least = np.minimum(back[: n - _LEFT], ahead[_PLACES - 1 : _PLACES - 1 + n - _LEFT])
    trigger = (least & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    sizes = np.array([len(p) for p, _, _ in parts])
    ends = np.cumsum(sizes)
    starts = np.concatenate([np.arange(e - s, e - SIZE + 1) for s, e in zip(sizes, ends)])
    at_trigger = trigger[starts + _LEFT]
    new = np.flatnonzero(np.concatenate([[True], (at_trigger[1:] != at_trigger[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first = starts[new]
    count = np.diff(np.append(new, len(starts)))
    place = at_trigger[new]
    power, inverse = _table()
    sums = np.concatenate([[np.uint64(0)], np.cumsum((mixed * _C[2])[:n] * power[:n])])
    end = first + count - 1 + SIZE - 7  # entries as overlapping words
    out = np.zeros(len(first), _PHRASE)
    out["entry"] = _mix((sums[end] - sums[first]) * inverse[first] + count.astype(np.uint64))
    key = word[place - _LEFT]
    for offset in (-4, 4, 12):
        key = _mix(key) ^ word[place + offset]
    out["key"] = _mix(key)
    part = np.searchsorted(ends, first, side="right")
    out["doc"] = np.array([d for _, d, _ in parts], np.int64)[part]
    out["at"] = first - (ends - sizes)[part] + np.array([b for _, _, b in parts], np.int64)[part]
    out["n"], out["lead"] = count, place - first
    return out


def split_repeats(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places of each entry, sorted by key; later places of entries)."""
    found = found[np.lexsort((found["at"], found["doc"], found["entry"], found["key"]))]
    if not len(found):
        return found, found
    first = np.concatenate([[True], (found["key"][1:] != found["key"][:-1]) | (found["entry"][1:] != found["entry"][:-1])])
    return found[first], found[~first]


def _runs(found: np.ndarray) -> np.ndarray:
    out = np.zeros(len(found), _RUN)
    out["first"], out["last"] = found["at"], found["at"] + found["n"] - 1
    return out


def _by_doc(docs: np.ndarray, rows: np.ndarray) -> dict[int, bytes]:
    order = np.argsort(docs, kind="stable")
    docs, rows = docs[order], rows[order]
    cut = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    raw, size = rows.tobytes(), rows.dtype.itemsize
    edges = [*(cut * size).tolist(), len(raw)]
    return {d: raw[a:b] for d, a, b in zip(docs[cut].tolist(), edges, edges[1:])}


def _shared(first: np.ndarray) -> np.ndarray:
    """Of entries sorted by key: how many have the key of each."""
    if not len(first):
        return np.zeros(0, np.int64)
    size = np.diff(np.append(np.flatnonzero(np.concatenate([[True], first["key"][1:] != first["key"][:-1]])), len(first)))
    return np.repeat(size, size)


def _flags(entries: np.ndarray, hot: np.ndarray) -> dict[int, bytes]:
    out = np.zeros(len(entries), _FLAG)
    for c in ("key", "at", "n", "lead"):
        out[c] = entries[c]
    out["hot"] = hot
    return _by_doc(entries["doc"], out)


def merge_bucket(chunks: Iterator[np.ndarray], hot: int, hold: int = 64 << 20) -> Iterator[tuple[dict[int, bytes], dict[int, bytes]]]:
    """Of the phrases of some keys, in chunks: runs of repeated strings, and the entries to look into, by document.

    A chunk row without strings (`n` 0) says that its key is hot. Entries of a hot key are let go at once, so what is held are
    at most `hot` entries of a key, and `hold` bytes before they are reduced to those.
    """
    held, waiting, marked = np.zeros(0, _PHRASE), [], np.zeros(0, np.uint64)

    def reduce(last: bool) -> tuple[dict[int, bytes], dict[int, bytes]]:
        nonlocal held, marked
        found = np.concatenate([held, *waiting])
        waiting.clear()
        first, later = split_repeats(found[found["n"] > 0])
        shared = _shared(first)
        marked = np.unique(np.concatenate([marked, found["key"][found["n"] == 0], first["key"][shared > hot]]))
        is_hot = np.isin(first["key"], marked)
        go = is_hot | (shared > 1) if last else is_hot
        held = first[~go]
        return _by_doc(later["doc"], _runs(later)), _flags(first[go], is_hot[go])

    for chunk in chunks:
        waiting.append(chunk)
        if sum(w.nbytes for w in waiting) > max(hold, held.nbytes):
            yield reduce(False)
    yield reduce(True)


def repeated_strings(rows: np.ndarray, raw: bytes, chunk: int = 100_000) -> dict[int, bytes]:
    """Runs of strings, by document, that also start earlier among the entries given; `raw` has their bytes in order."""
    if not len(rows):
        return {}
    n = rows["n"].astype(np.int64)
    offset = np.concatenate([[0], np.cumsum(n + SIZE - 1)])[:-1]
    owner = np.repeat(np.arange(len(rows)), n)
    j = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    # equal strings have the same key and distance to the trigger
    distance = rows["lead"].astype(np.int64)[owner] - j
    group = _mix(rows["key"])[owner] ^ distance.astype(np.uint64)
    order = np.argsort(group, kind="stable")
    owner, j, group = owner[order], j[order], group[order]
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    single = np.diff(np.append(start, len(group))) == 1
    keep = np.ones(len(group), bool)
    keep[start[single]] = False
    owner, j, group = owner[keep], j[keep], group[keep]
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else start[:0]
    edges, docs, runs = np.append(start, len(group)), [], []
    data = np.frombuffer(raw, np.uint8)
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + chunk, side="right")) - 1)
        o, k = owner[edges[at] : edges[to]], j[edges[at] : edges[to]]
        windows = np.lib.stride_tricks.sliding_window_view(data, SIZE)[offset[o] + k]
        suffix = np.ascontiguousarray(windows).view(f"S{SIZE}").ravel()
        doc, place = rows["doc"][o], rows["at"][o] + k
        early = np.lexsort((place, doc))
        sorted_ = early[np.argsort(suffix[early], kind="stable")]
        same = suffix[sorted_][1:] == suffix[sorted_][:-1]
        later = sorted_[1:][same]
        docs.append(doc[later])
        runs.append(place[later])
        at = to
    doc, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, runs))
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    if not len(doc):
        return {}
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1)])
    out = np.zeros(int(new.sum()), _RUN)
    out["first"] = place[new]
    out["last"] = place[np.append(np.flatnonzero(new)[1:] - 1, len(place) - 1)]
    return _by_doc(doc[new], out)


def remove(text: bytes, runs: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes that no string of the runs covers, the number of removed bytes and of their maximal spans."""
    if not len(runs):
        return text, 0, 0
    runs = runs[np.argsort(runs["first"], kind="stable")]
    end = np.maximum.accumulate(runs["last"] + SIZE)
    new = np.concatenate([[True], runs["first"][1:] > end[:-1]])
    starts, ends = runs["first"][new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    kept, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), int((ends - starts).sum()), len(starts)


_BLOCKS = "bucket int, phrases binary, repeats map<long,binary>, flags map<long,binary>"


def _blocks(docs: DataFrame, buckets: int, crowd: int) -> DataFrame:
    """Step 1 within each Arrow batch: first places of entries by bucket of their key, and later places by document.

    Of a key with over `crowd` entries in the batch, only a row without strings goes to its bucket; the entries are flagged here.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            first, later = split_repeats(phrases(texts, batch.column("rid").to_pylist()))
            many = _shared(first) > crowd
            flags = _flags(first[many], np.ones(int(many.sum()), np.uint8))
            marks = np.zeros(len(np.unique(first["key"][many])), _PHRASE)
            marks["key"] = np.unique(first["key"][many])
            first = np.concatenate([first[~many], marks])
            bucket = (first["key"] % np.uint64(buckets)).astype(np.int64)
            first, bucket = first[np.argsort(bucket, kind="stable")], np.sort(bucket)
            there = np.unique(bucket)
            edges = np.append(np.searchsorted(bucket, there), len(bucket))
            blocks = [first[a:b].tobytes() for a, b in zip(edges, edges[1:])]
            repeats = [list(_by_doc(later["doc"], _runs(later)).items()), *[[]] * len(blocks)]
            flagged = [list(flags.items()), *[[]] * len(blocks)]
            # repeats and flags ride along in the bucket of the batch's first document
            where = [hash(batch.column("rid")[0].as_py()) % buckets if batch.num_rows else 0, *there.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), pa.array([b"", *blocks], pa.binary()), *(pa.array(x, pa.map_(pa.int64(), pa.binary())) for x in (repeats, flagged))],
                ["bucket", "phrases", "repeats", "flags"],
            )

    return docs.select("rid", "text").mapInArrow(parse, _BLOCKS)


_MARKS = "rid long, runs binary, flags binary"


def _pairs(maps: pd.Series) -> Iterator[tuple[int, bytes]]:
    for m in maps:
        if m is not None:
            yield from m.items() if isinstance(m, dict) else m


def _marks(blocks: DataFrame, hot: int, hold: int) -> DataFrame:
    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, bytes, bytes]] = []

        def chunks() -> Iterator[np.ndarray]:
            for rows in parts:
                out.extend((d, x, b"") for d, x in _pairs(rows["repeats"]))
                out.extend((d, b"", x) for d, x in _pairs(rows["flags"]))
                yield np.frombuffer(b"".join(rows["phrases"]), _PHRASE)

        for runs, flags in merge_bucket(chunks(), hot, hold):
            out.extend((d, runs.get(d, b""), flags.get(d, b"")) for d in runs.keys() | flags.keys())
            yield pd.DataFrame(out, columns=["rid", "runs", "flags"])
            out.clear()

    return blocks.groupBy("bucket").applyInPandas(merge, _MARKS)


def _entries(flagged: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the entries to look into, by bucket of their key; strings of hot keys on their own."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            known: dict[bytes, tuple[int, int]] = {}
            repeats: dict[int, list[tuple[int, int]]] = {}
            for rid, text, flags in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist(), batch.column("flags").to_pylist()):
                text = text.encode()
                for key, at, n, lead, hot in sorted(np.frombuffer(b"".join(flags), _FLAG).tolist(), key=lambda x: x[1]):
                    if not hot:
                        rows.append((key, rid, at, n, lead, text[at : at + n + SIZE - 1]))
                        continue
                    for s in range(at, at + n):
                        string = text[s : s + SIZE]
                        before = known.get(string)
                        if before is None or (rid, s) < before:
                            known[string] = (rid, s)
                            string, later = None, before
                        else:
                            later = (rid, s)
                        if later:
                            repeats.setdefault(later[0], []).append((later[1], later[1]))
            for string, (rid, s) in known.items():
                rows.append((int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little"), rid, s, 1, 0, string))
            rows.sort(key=lambda r: r[0] % buckets)
            heads = np.array([r[:5] for r in rows], _ENTRY) if rows else np.zeros(0, _ENTRY)
            bucket = (heads["key"] % np.uint64(buckets)).astype(np.int64)
            there = np.unique(bucket)
            edges = np.append(np.searchsorted(bucket, there), len(bucket)).tolist()
            blocks = [(int(b), heads[x:y].tobytes(), b"".join(r[5] for r in rows[x:y]), []) for b, x, y in zip(there, edges, edges[1:])]
            if repeats:
                blocks.append((0, b"", b"", [(d, np.array(x, _RUN).tobytes()) for d, x in repeats.items()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[i] for b in blocks], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.map_(pa.int64(), pa.binary())))],
                ["bucket", "heads", "bytes", "repeats"],
            )

    return flagged.mapInArrow(fetch, "bucket int, heads binary, bytes binary, repeats map<long,binary>")


def _strings(entries: DataFrame) -> DataFrame:
    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        found = repeated_strings(np.frombuffer(b"".join(rows["heads"]), _ENTRY), b"".join(rows["bytes"]))
        return pd.DataFrame([*_pairs(rows["repeats"]), *found.items()], columns=["rid", "runs"])

    return entries.groupBy("bucket").applyInPandas(sort, "rid long, runs binary")


def ordered(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text) with unique `rid` in corpus order: `doc_id` itself where it is unique and never null.

    Otherwise the rows are sorted by id and text once and numbered in that order on a written table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    twice = docs.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if twice.isEmpty():
        return docs.withColumn("rid", F.col("doc_id"))
    ranged = docs.repartitionByRange(F.col("doc_id").asc_nulls_first(), "text").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return settle(ranged.withColumn("rid", F.monotonically_increasing_id()), "ordered")


def remove_repeats(docs: DataFrame, bucket_bytes: int = 16 << 20, hot: int = 50_000, crowd: int = 256, hold: int = 64 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, where bytes were removed, those left (`changed`) of every row."""
    docs = ordered(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // bucket_bytes)
    marks = settle(_marks(_blocks(docs, buckets, crowd), hot, hold), "marks")
    lists = marks.where(F.length("flags") > 0).groupBy("rid").agg(F.collect_list("flags").alias("flags"))
    texts = docs.select("rid", "doc_id", "text")
    flagged = texts.join(lists, "rid").select("rid", "text", "flags")
    found = _strings(_entries(flagged, buckets))
    runs = marks.where(F.length("runs") > 0).select("rid", "runs").unionByName(found).groupBy("rid").agg(F.collect_list("runs").alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                raw = text.encode()
                kept, gone, spans = remove(raw, np.frombuffer(b"".join(parts or []), _RUN))
                rows.append((len(raw), gone, spans, hashlib.sha256(kept).hexdigest(), kept if gone else None))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "changed"],
            )

    return texts.join(runs, "rid", "left").select("doc_id", "text", "runs").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, changed binary"
    )
