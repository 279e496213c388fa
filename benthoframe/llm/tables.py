"""Helpers that the text operators share: reading, folds, Arrow batches in pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def pieces(batch: pa.RecordBatch, column: str = "text", chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch (null: empty) in runs of about so many characters, with the first row of each."""
    start, held, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= chars:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held
