"""Token ids in Parquet list columns that allow reading metadata or a few documents only.

Documents are dealt into ranges of ascending ids, encoded where they lie, and written by Spark's own writer: one sorted
file per range, so each range has its min and max in the footer and each page in the page index. Ids are a list column
whose pages hold dictionary codes (a vocabulary fits the dictionary page); past the dictionary the version 2 writer
falls back to delta encoding, as it does for the ascending metadata columns. A query that wants counts reads only the metadata
columns, one that wants a few documents skips row groups and pages by `doc_id`.

Defined results: null text is the empty text and has the end id alone; a null `doc_id` sorts first; rows with equal ids follow
by text, equal rows in any order; extra columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benthoframe.llm.tables import pieces
from benthoframe.llm.word_memo import encoder
from benthoframe.session import scratch_root

SCHEMA = "shard int, doc_id long, n_tokens long, shard_start long, ids array<int>"
_ARROW = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("shard_start", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of `SCHEMA` in ascending `doc_id` order within and across shards."""
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, seen, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in batches:
            for start, texts in pieces(batch):
                raw = [ids + end for ids in enc.encode(texts)]
                n = np.array([len(r) // 4 for r in raw], np.int64)
                offsets = np.concatenate([[0], np.cumsum(n)])
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), "<i4"))
                )
                doc_id = batch.column("doc_id").slice(start, len(texts))
                columns = [pa.array(np.full(len(n), shard, np.int32)), doc_id, pa.array(n), pa.array(seen + offsets[:-1]), ids]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)
                seen += int(offsets[-1])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # rows that share an id, or have none, are dealt by the beginnings of their texts
    ordered = ordered.repartitionByRange(F.col("doc_id"), F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(encode, SCHEMA)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10
) -> None:
    """Encode every document and write the token files under `path`."""
    (
        encode_documents(docs, tokenizer, end_id).write
        .option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", str(1 << 20))
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .parquet(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All stored columns; select what is needed, filter by `doc_id`, and the scan reads no more than that."""
    return spark.read.schema(SCHEMA).parquet(path)


def shard_offsets(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: the number of ids before it. Reads three metadata columns, no ids.

    The window has one row per file of the table.
    """
    shards = read_documents(spark, path).groupBy("shard").agg(
        F.min("doc_id").alias("first_id"), F.sum("n_tokens").alias("tokens")
    )
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from the files alone."""

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            kept = [batch.column(c) for c in ("shard", "doc_id", "n_tokens", "shard_start")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], ["shard", "doc_id", "n_tokens", "shard_start", "ids_crc32"])

    stored = read_documents(spark, path).mapInArrow(
        checksums, "shard int, doc_id long, n_tokens long, shard_start long, ids_crc32 long"
    )
    return stored.join(shard_offsets(spark, path), "shard").select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write token files (below the shared scratch folder by default) and index them by reading them back."""
    spark = docs.sparkSession
    path = path or f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer, end_id)
    return token_index(spark, path)
