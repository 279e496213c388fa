"""From raw documents to packed training sequences in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last return the columns of
`documents`. Rejected are documents that the classifier calls toxic, all but the first document of each component of
near-duplicates (fingerprints of three-word shingles linked at two or fewer differing bits, as op10 has them), and documents with
a benchmark passage; personal data is replaced in the text; the rest is packed.

Defined results: a row is told apart by id and text. The first row of a component has the smallest id, null ids last, then the
smallest digest of its text; of rows equal in id and text one stays. Every text is judged for benchmark passages by itself, so rows
that share an id, or have none, share no verdict. An empty table gives no sequence; extra columns pass through to the
packing, and `n_chars` is brought up to date by redaction where the table has it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benthoframe.llm import decontaminate as passages
from benthoframe.llm import packing, pii, simhash, toxicity
from benthoframe.llm.queries import WORD_VOCABULARY, vocabulary
from benthoframe.llm.tables import fold, table
from benthoframe.session import scratch_root, settle

#: Words of a shingle and most differing bits of a link, those of op10.
WORDS, DISTANCE = 3, 2


def row_digest() -> Column:
    """The 32 bytes that tell a row apart: of its id and its text, either of which may be null."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.sha2(F.concat(doc_id, F.when(F.col("text").isNull(), "-").otherwise(F.concat(F.lit(":"), F.col("text")))), 256))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = toxicity.train(docs, labels)
    return docs.where(toxicity.score_column(model)("text") < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "text", row_digest().alias("row"))
    found = settle(simhash.near_duplicates(rows, WORDS, DISTANCE, carry=["row"]).select("doc_id", "root", "row"), "near")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first"))
    first = settle(first.select("root", F.col("first.row").alias("stays")), "first")
    losers = settle(found.join(first, "root").where("row <> stays").select(F.col("row").alias("loser")).distinct(), "losers")
    # the same join at every size: losers grow with the documents
    kept = docs.join(losers.hint("merge"), row_digest() == losers["loser"], "left_anti")
    twice = settle(found.groupBy("row").count().where("count > 1").select(F.col("row").alias("twice")).join(losers, F.col("twice") == losers["loser"], "left_anti"), "twice")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, row_digest() == twice["twice"], "left_anti")
    repeated = kept.join(twice, row_digest() == twice["twice"], "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bad = passages.contaminated_texts(docs, table(spark, sf_dir, "benchmark")).withColumnRenamed("digest", "bad_digest")
    return docs.join(bad, passages.text_digest() == bad["bad_digest"], "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = pii.redact_column(pii.train_field(pii.labelled_table(spark)))
    text = docs.withColumn("text", cleaned("text"))
    if "n_chars" not in docs.columns:
        return text
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(WORD_VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact),
    ("packing", pack),
]
ORACLE_SQL = None  # trained models and a tokenizer: see the brute-force tests


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; between them the kept documents lie in the session's scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_root(spark)}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
