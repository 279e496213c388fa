"""Registered queries of the text operators, each over its whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benthoframe.llm import decontaminate, fertility, language_id, licenses, merkle, pii, ranked_search, suffix_dedup, toxicity
from benthoframe.llm.packing import pack
from benthoframe.llm.simhash import near_duplicates
from benthoframe.llm.tables import fold, table
from benthoframe.llm.token_counts import count_tokens
from benthoframe.llm.token_files import token_files
from benthoframe.session import scratch_root

WORD_VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, fold("doc_id", 3) != 1)
    found = language_id.identify(docs, *model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "mixture")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train_field(pii.labelled_table(spark))
    found = pii.find_pii(table(spark, sf_dir, "documents"), field).drop("redacted_text")
    every = F.filter(F.split("spans", ","), lambda s: s != "")
    secrets = F.filter(every, lambda s: s.startswith("secret:"))
    return found.withColumns({"n_secret": F.size(secrets).cast("long"), "n_spans": F.size(every).cast("long")})


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(fold("doc_id", 5) != 0))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("changed")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_line_ends()))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call, so that what an earlier call stored makes no difference
    cache = f"{scratch_root(spark)}/token-counts-{uuid.uuid4().hex}"
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY), cache)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mixture": op1_language_mixture,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_decontamination": op5_decontamination,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_licenses": op8_licenses,
    "op9_fertility": op9_fertility,
    "op10_simhash": op10_simhash,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
    "pipeline": pipeline,
}
ORACLE: dict[str, str] = {
    "op5_decontamination": decontaminate.SQL,
    "op11_ranked_search": ranked_search.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
