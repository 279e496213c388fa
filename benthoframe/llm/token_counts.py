"""Token counts through a digest cache.

The key of a count is two SHA-256 digests: of the tokenizer (file, library version, how texts are normalised) and of
the normalised content. Counts lie in an append-only table, partitioned by the tokenizer's digest. A call reads the texts once
for their digests, takes from the distinct digests those that the cache lacks, fetches one text for each of these, encodes it and
appends its count; then all rows get their counts from the cache. Copies, and texts that differ only in what normalising
removes, are encoded once, whichever call they came in.

Content is normalised only where the tokenizer's own rules make it safe (`WordEncoder.by_word`): a run of ASCII white space
becomes one space. For any other tokenizer it is the text itself.

A failed or repeated append cannot change a result: Spark publishes an append as a whole, and a digest that was appended
twice (two calls at the same time) is read once. `compact` rewrites such a cache into another folder.

Defined results: null is the empty text, with 0 bytes and 0 tokens; rows with equal ids are counted each; an empty table
gives no row and appends nothing; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benthoframe.llm.word_memo import WordEncoder, encoder
from benthoframe.session import settle

SCHEMA = "digest binary, n_tokens long, version string"
#: Characters of a text that are encoded at once, where words are encoded one by one.
BLOCK = 1 << 20
_SPACES = r"[\x09-\x0D\x20]+"


def tokenizer_version(path: str) -> str:
    """SHA-256 (hex) of all that a count depends on besides the content."""
    import tokenizers

    with open(path, "rb") as f:
        digest = hashlib.file_digest(f, "sha256")
    digest.update(f"tokenizers {tokenizers.__version__}; whole text, no added tokens; by word {encoder(path).by_word}".encode())
    return digest.hexdigest()


def normalised(text: Column, by_word: bool) -> Column:
    """The content whose digest is the key; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, _SPACES, " ")) if by_word else text


def content_digest(text: Column, by_word: bool) -> Column:
    return F.unhex(F.sha2(normalised(text, by_word), 256))


def count_text(enc: WordEncoder, text: str) -> int:
    """Tokens of a whole text; a long one is encoded in blocks that end between words, where words are independent."""
    if not enc.by_word:
        return len(enc.encode([text])[0]) // 4
    total, at = 0, 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        total += len(enc.encode([text[at:end]])[0]) // 4
        at = end
    return total


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_cache(spark: SparkSession, cache: str, version: str | None = None) -> DataFrame:
    """(digest, n_tokens, version), one row per key; of one tokenizer version, or of all."""
    if not _exists(spark, cache):
        return spark.createDataFrame([], SCHEMA)
    stored = spark.read.schema(SCHEMA).parquet(cache)
    if version is not None:
        stored = stored.where(F.col("version") == version)
    return stored.groupBy("version", "digest").agg(F.max("n_tokens").alias("n_tokens")).select("digest", "n_tokens", "version")


def compact(spark: SparkSession, cache: str, target: str) -> None:
    """The cache without repeated keys, written to a new folder."""
    read_cache(spark, cache).write.partitionBy("version").parquet(target)


def append_misses(docs: DataFrame, digests: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """Encode one text for each distinct digest that the cache lacks, and append the counts; the misses are returned.

    `digests` has (doc_id, digest) of every row. The row that stands for a digest is chosen there, by its smallest doc_id,
    and fetched by both, so the copies of a very frequent text do not meet in one task.
    """
    spark, by_word = docs.sparkSession, encoder(tokenizer).by_word
    version = tokenizer_version(tokenizer)
    least = digests.groupBy("digest").agg(F.min("doc_id").alias("stands"))
    misses = settle(least.join(read_cache(spark, cache, version), "digest", "left_anti"), "misses")
    if misses.isEmpty():
        return misses

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            counts = [count_text(enc, text.as_py()) for text in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), content_digest(F.col("text"), by_word).alias("of"), "text")
    chosen = texts.join(misses, (F.col("of") == F.col("digest")) & F.col("id").eqNullSafe(F.col("stands")), "left_semi")
    counted = chosen.select(F.col("of").alias("digest"), normalised(F.col("text"), by_word).alias("content")).mapInArrow(encode, "digest binary, n_tokens long")
    # rows that share both text and id (or have none) were all fetched
    counted = counted.dropDuplicates(["digest"]).withColumn("version", F.lit(version))
    counted.write.mode("append").partitionBy("version").parquet(cache)
    return misses


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, from the cache in the (shared) folder `cache`, which is filled first."""
    spark, by_word = docs.sparkSession, encoder(tokenizer).by_word
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), content_digest(F.col("text"), by_word).alias("digest")),
        "digests",
    )
    append_misses(docs, rows.select("doc_id", "digest"), tokenizer, cache)
    stored = read_cache(spark, cache, tokenizer_version(tokenizer)).select("digest", "n_tokens")
    return rows.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
