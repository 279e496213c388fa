"""Quality by tokeniser fertility: characters per token, byte-fallback share and token entropy, with bands per language.

Every word of a text is encoded once per task by a public vocabulary with byte fallback. The three measures of all documents of
a language give its bands: quartiles by a sketch, widened by a multiple of their distance. A document whose base rules hold
is kept if its characters per token lie within the band, its byte share not above and its entropy not below it. Few tokens
cannot have a high entropy, so `least_evenness` of the most that they could have is always enough.

Defined results: null text has no word and fails the base rules; a null language is a group of its own; a language with
fewer than `least` measured documents is judged by the band of all documents, and if these are fewer too, nothing is rejected; repeated rows count and give equal results; extra
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.llm.word_memo import WordMemo
from benthoframe.session import settle

_SYMBOL = re.compile(r"[#*$%&|<>]+")
_WHITE = " \t\n\v\f\r"


class Vocabulary:
    """A sentencepiece model, word by word: ids of each word with its leading space, little-endian uint32."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.memo = WordMemo(lambda w: np.array(self.model.encode(w.decode(), num_threads=1), "<u4").tobytes())

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(self.memo.joined(words), "<u4")


def repeat_words(words: list[bytes], n: int = 3) -> int:
    """Words in windows of `n` words that are found twice or more in the text, the first place included."""
    if len(words) <= n:
        return 0
    windows = list(zip(*(words[i:] for i in range(n))))
    count = Counter(windows)
    if len(count) == len(windows):
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter(map(count.__getitem__, windows), np.int64, len(windows)) > 1)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + n, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    chars = len(text) - sum(map(text.count, _WHITE))
    symbols = sum(map(len, _SYMBOL.findall(text)))
    lines = text.split("\n")
    real = [x for x in lines if x.strip(_WHITE)]
    return chars, symbols, len(real) - len(set(real)), repeat_words(words)


def measures(ids: np.ndarray, chars: int, is_byte: np.ndarray) -> tuple[float | None, float | None, float | None]:
    """Characters per token, share of byte tokens, entropy of the tokens in bits."""
    if not len(ids):
        return None, None, None
    n = np.unique(ids, return_counts=True)[1] / len(ids)
    return chars / len(ids), float(is_byte[ids].mean()), float(max(0.0, -(n * np.log2(n)).sum()))


def measure(docs: DataFrame, vocabulary: str, lang: str = "lang") -> DataFrame:
    """Counts and measures of every row, with its language."""
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    floats = ["chars_per_token", "byte_share", "entropy"]
    named = [("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in numbers), *((c, pa.float64()) for c in floats)]
    kept: list[Vocabulary] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Vocabulary(vocabulary))
        known = kept[0]
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text")):
                if i % 500 == 0:
                    known.memo.turn()
                text = text.as_py() or ""
                words = text.encode().split()
                base = base_counts(text, words)
                rows.append((len(words), *base, *measures(known.ids(words), base[0], known.is_byte)))
            columns = list(zip(*rows)) or [()] * (len(named) - 2)
            given = [batch.column("doc_id"), batch.column("lang")]
            yield pa.RecordBatch.from_arrays([*given, *(pa.array(c, t) for c, (_, t) in zip(columns, named[2:]))], schema=pa.schema(named))

    schema = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in numbers) + ", " + ", ".join(f"{c} double" for c in floats)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), "text")
    return rows.mapInArrow(count, schema)


def bands(measured: DataFrame, wide: float = 3.0, least: int = 30) -> DataFrame:
    """One row per language: the bounds of its measures from quartiles of all its documents that pass the base rules."""
    quartiles = lambda c: F.percentile_approx(c, [0.25, 0.75], 10_000)
    found = measured.where(~F.col("base_failed") & F.col("entropy").isNotNull()).groupBy("lang").agg(
        F.count("*").alias("n"), *(quartiles(c).alias(c) for c in ("chars_per_token", "byte_share", "entropy"))
    )

    def bound(c: str, side: int, floor: float) -> Column:
        distance = F.greatest(F.col(c)[1] - F.col(c)[0], F.lit(floor))
        return F.col(c)[1] + wide * distance if side > 0 else F.col(c)[0] - wide * distance

    return found.where(F.col("n") >= least).select(
        F.col("lang").alias("band_lang"), bound("chars_per_token", -1, 0.1).alias("least_chars"), bound("chars_per_token", 1, 0.1).alias("most_chars"),
        bound("byte_share", 1, 0.01).alias("most_bytes"), bound("entropy", -1, 0.5).alias("least_entropy"),
    )


def judge(docs: DataFrame, vocabulary: str, lang: str = "lang", wide: float = 3.0, least: int = 30, least_evenness: float = 0.75) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the measures of every row."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = settle(measure(docs, vocabulary, lang).withColumn("base_failed", failed), "fertility")
    limits = settle(bands(measured, wide, least), "bands")
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["band_lang"]), "left")
    whole = bands(measured.withColumn("lang", F.lit(None).cast("string")), wide, least).drop("band_lang").first()
    if whole:
        joined = joined.withColumns({c: F.coalesce(c, F.lit(whole[c])) for c in whole.asDict()})
    within = (
        F.col("chars_per_token").between(F.col("least_chars"), F.col("most_chars"))
        & (F.col("byte_share") <= F.col("most_bytes"))
        & (F.col("entropy") >= F.least("least_entropy", least_evenness * F.log2(F.col("word_chars") / F.col("chars_per_token"))))
    )
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("least_chars").isNull() | F.coalesce(within, F.lit(False)))).alias("kept"), "chars_per_token", "byte_share", "entropy",
    )
