"""Language mixtures by expectation-maximisation over character n-gram likelihoods.

Letters in lower case make trigrams within and at the edges of words, hashed into `BUCKETS` bins. Training counts them per
language over all learning rows, one small table of (language, bucket, count) added up before and after the shuffle. A document is a mixture of languages:
EM estimates the proportions of all languages from its trigrams, then of the sets of its 1, 2, ... strongest languages, and the
set with the best likelihood less a penalty per language wins. Trigrams overlap, so a third of the log likelihood counts.

Defined results: `und`, score 0 and an empty mixture for null or letter-free text, and for every text when nothing could be
learnt; rows with null language teach nothing; ties go to the language first in the alphabet; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.llm.tables import pieces
from benthoframe.session import settle

BUCKETS = 1 << 15
#: More languages than this are refused: the model has one row of BUCKETS per language.
MAX_LANGUAGES = 1000
_SPAN = 1 << 20


def _letters() -> np.ndarray:
    """Code point to 1 where it is a letter; made once in a worker."""
    if "table" not in _cache:
        _cache["table"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _cache["table"]


_cache: dict[str, np.ndarray] = {}


def bucket_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the trigrams of each text: text index, bucket and count, sorted; long texts are taken in spans."""
    runs = []
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        at, ended = 0, not text
        while not ended:
            # two characters more than a span, so that no trigram is lost between spans
            ended = at + _SPAN + 2 >= len(text)
            part = "\0" * (at == 0) + text[at : at + _SPAN + 2].lower() + "\0" * ended
            at += _SPAN
            held.append(part)
            owners.append(i)
            size += len(part)
            if size >= _SPAN:
                runs.append(_count(held, owners))
                held, owners, size = [], [], 0
    if held:
        runs.append(_count(held, owners))
    if not runs:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    key, n = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
    if len(runs) > 1:
        key, where = np.unique(key, return_inverse=True)
        n = np.bincount(where, n).astype(np.int64)
    return key // BUCKETS, key % BUCKETS, n


def _count(parts: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    c = np.where(letter, points, 0).astype(np.uint64)
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
    owner = np.repeat(np.array(owners, np.int64), [len(p) for p in parts])
    ok = letter[1:-1] & (owner[:-2] == owner[2:])
    return np.unique(owner[:-2][ok] * BUCKETS + h[ok].astype(np.int64), return_counts=True)


def train(docs: DataFrame, learns: Column, lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and the smoothed log likelihood of each bucket, BUCKETS by languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in pieces(batch):
                owner, bucket, n = bucket_counts(texts)
                names = np.array(langs[start : start + len(texts)], object)[owner]
                for name in set(names):
                    mine = names == name
                    total.setdefault(name, np.zeros(BUCKETS, np.int64))
                    total[name] += np.bincount(bucket[mine], n[mine], BUCKETS).astype(np.int64)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])

    rows = docs.where(learns).select(F.col(lang).alias("lang"), "text").where("lang IS NOT NULL")
    counts = settle(
        rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams"
    )
    names = [r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names.sort()
    matrix = np.zeros((BUCKETS, len(names)), np.float64)
    at = {name: i for i, name in enumerate(names)}
    of_one = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("found"))  # at most BUCKETS each
    for name, found in of_one.toLocalIterator():
        for bucket, n in found:
            matrix[bucket, at[name]] = n
    smooth = 0.5
    return names, ((matrix + smooth) / (matrix.sum(0) + smooth * BUCKETS)).astype(np.float32)


def mixtures(
    owner: np.ndarray, n: np.ndarray, p: np.ndarray, texts: int, least: float = 0.02, rounds: int = 12, penalty: float = 1.0, overlap: float = 3.0
) -> np.ndarray:
    """Proportions of the chosen languages (texts by languages) from likelihoods `p` (trigrams by languages).

    Sets are the strongest languages of the mixture of all; a language below the share `least` starts no larger set.
    """
    whole, _ = _fit(owner, n, p, np.ones((texts, p.shape[1])), rounds)
    order = np.argsort(-whole, axis=1, kind="stable")
    chosen = np.zeros_like(whole)
    chosen[np.arange(texts), order[:, 0]] = 1
    total = np.bincount(owner, n, texts)
    worth = (whole >= least).sum(1)
    if not (worth > 1).any():
        return chosen
    # only the trigrams of texts with a second language worth a set
    best = np.full(texts, -np.inf)
    for k in range(1, int(worth.max()) + 1):
        rows = np.flatnonzero(worth >= max(k, 2))
        place = np.full(texts, -1)
        place[rows] = np.arange(len(rows))
        mine = place[owner] >= 0
        start = np.zeros((len(rows), p.shape[1]))
        top = order[rows, :k]
        np.put_along_axis(start, top, np.take_along_axis(whole[rows], top, 1), 1)
        weights, like = _fit(place[owner[mine]], n[mine], p[mine], start, 0 if k == 1 else rounds)
        value = like / overlap - penalty * (k - 1) * np.log(np.maximum(total[rows], 1))
        better = value > best[rows]
        best[rows[better]] = value[better]
        chosen[rows[better]] = weights[better]
    return chosen


def _fit(owner: np.ndarray, n: np.ndarray, p: np.ndarray, weights: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM from the given proportions; languages with none stay out. Proportions and log likelihood of each text."""
    texts = len(weights)
    n = n.astype(np.float32)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    there = owner[first]
    weights = (weights / np.maximum(weights.sum(1, keepdims=True), 1e-30)).astype(np.float32)
    for _ in range(rounds):
        w = weights[owner]
        w *= p
        w *= (n / np.maximum(w.sum(1), 1e-30))[:, None]
        part = np.add.reduceat(w, first, axis=0) if len(first) else w
        weights[there] = part / np.maximum(part.sum(1, keepdims=True), 1e-30)
    like = np.zeros(texts)
    if len(first):
        like[there] = np.add.reduceat(n * np.log(np.maximum((weights[owner] * p).sum(1), 1e-30)), first)
    return weights.astype(np.float64), like


def identify(docs: DataFrame, names: list[str], model: np.ndarray, **options) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and the whole mixture of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats, bounded by MAX_LANGUAGES

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        # a trigram has a float for every language, in several arrays
        chars = max(20_000, min(1_000_000, 4_000_000 // max(len(names), 1)))
        for batch in batches:
            for start, texts in pieces(batch, chars=chars):
                owner, bucket, n = bucket_counts(texts)
                known = np.bincount(owner, n, len(texts)) > 0 if names else np.zeros(len(texts), bool)
                share = mixtures(owner, n, p[bucket], len(texts), **options) if names and len(owner) else np.zeros((len(texts), 1))
                top = share.argmax(1)
                found = [
                    [{"lang": names[j], "share": float(share[i, j])} for j in np.argsort(-share[i], kind="stable") if share[i, j] > 0] if known[i] else []
                    for i in range(len(texts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.array([names[t] if k else "und" for t, k in zip(top, known)], pa.string()),
                        pa.array(np.where(known, np.clip(share[np.arange(len(texts)), top], 0, 1), 0.0)),
                        pa.array(found, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                    ],
                    ["doc_id", "lang_pred", "score", "mixture"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>"
    )
