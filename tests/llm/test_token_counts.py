"""Token counts: against the library on whole texts, and what the cache saves."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from benthoframe.llm import token_counts as tc
from benthoframe.llm.queries import QUERIES
from tests.llm.conftest import SF

WORDS = public_tokenizers.path("word_bpe_49k.json")


def library_count(text, path=WORDS):
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


def test_counts_of_the_library(spark, docs):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    tokenizer = Tokenizer.from_file(WORDS)
    for r in docs.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        assert found.pop(r.doc_id) == (len((r.text or "").encode()), n, n > 2048)
    assert not found


def test_odd_texts(spark, odd, empty, tmp_path):
    texts = [
        "a<|endoftext|>b", "<|ENDOFTEXT|> x", "<|endoftext|>", " lead and trail \n", "tab\tand\x0b\x0cmore", "\x1c\x1d odd \x85 spaces    here",
        "İstanbul ΣΑΣ ﬁ é", "don't we'll", "日本語 テキスト", "x" * 5000, "\U0001f600 �", "a  b", "a b", " a\nb ",
    ]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in tc.count_tokens(table, WORDS, str(tmp_path / "a")).collect()}
    assert found == {i: library_count(t) for i, t in enumerate(texts)}
    strange = tc.count_tokens(odd, WORDS, str(tmp_path / "b"))
    assert strange.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in strange.collect()))
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), library_count(r.text)) for r in odd.collect())
    assert rows == want
    assert tc.count_tokens(empty, WORDS, str(tmp_path / "c")).count() == 0


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    first = spark.createDataFrame([(1, "one two"), (2, "one  two\n"), (3, "three"), (None, "three"), (None, "three"), (3, "three")], "doc_id long, text string")
    by_word = tc.encoder(WORDS).by_word
    assert by_word

    def digests(df):
        return df.select("doc_id", tc.content_digest(df["text"], by_word).alias("digest"))

    assert tc.append_misses(first, digests(first), WORDS, cache).count() == 2
    assert spark.read.parquet(cache).count() == 2
    assert tc.append_misses(first, digests(first), WORDS, cache).count() == 0
    more = first.unionByName(spark.createDataFrame([(9, "four"), (10, None)], "doc_id long, text string"))
    assert tc.append_misses(more, digests(more), WORDS, cache).count() == 2
    assert spark.read.parquet(cache).count() == 4
    # what is stored is what is returned: a planted count shows that hits are not encoded again
    planted = str(tmp_path / "planted")
    tc.read_cache(spark, cache).selectExpr("digest", "n_tokens + 1000 AS n_tokens", "version").write.partitionBy("version").parquet(planted)
    assert {r.n_tokens for r in tc.count_tokens(first, WORDS, planted).collect()} == {1002, 1001}


def test_versions_and_repeated_appends(spark, tmp_path):
    cache, other = str(tmp_path / "cache"), public_tokenizers.path("byte_bpe_50k.json")
    table = spark.createDataFrame([(1, "One  two\n three"), (2, "One two three")], "doc_id long, text string")
    assert [r.n_tokens for r in tc.count_tokens(table, WORDS, cache).collect()] == [3, 3]
    # another tokenizer has its own digest, and white space counts there
    found = {r.doc_id: r.n_tokens for r in tc.count_tokens(table, other, cache).collect()}
    assert found == {r.doc_id: library_count(r.text, other) for r in table.collect()} and len(set(found.values())) == 2
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    again = tc.read_cache(spark, cache).collect()
    spark.createDataFrame(again, tc.SCHEMA).write.mode("append").partitionBy("version").parquet(cache)
    assert spark.read.parquet(cache).count() == 6 and tc.read_cache(spark, cache).count() == 3
    assert tc.count_tokens(table, WORDS, cache).count() == 2
    tc.compact(spark, cache, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 3


@pytest.mark.parametrize("block", [1, 7, 64])
def test_blocks(block, monkeypatch):
    monkeypatch.setattr(tc, "BLOCK", block)
    text = "The quick brown fox don't <|endoftext|> jump ΣΑΣ over 12 lazy-dogs, " * 5
    assert tc.count_text(tc.encoder(WORDS), text) == library_count(text)
