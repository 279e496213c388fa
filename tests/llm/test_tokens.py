import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from benthoframe.llm.packing import BestFit, _Piece, pack
from benthoframe.llm.queries import WORD_VOCABULARY, vocabulary
from benthoframe.llm.token_files import encode_documents, read_documents, token_files, write_token_files
from benthoframe.llm.word_memo import WordEncoder

PATH = vocabulary(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def raw(ids_):
    return np.array(ids_, "<u4").tobytes()


def test_words_encode_as_whole_texts(ids):
    rng, encoder = random.Random(1), WordEncoder(PATH, words=40)
    texts = ["", " ", "It's don't 's 're!! ΣΑΣ İstanbul éa ́b <|endoftext|> <|ENDOFTEXT|>x", "12.5, a b\x1cc\x85d 日本語。"]
    texts += ["".join(rng.choice("ab'stremdlv01.,!|_<>=éßÉö×µ½² \n\t\x1f\xa0") for _ in range(50)) for _ in range(500)]
    for text in texts:
        assert encoder.encode([text])[0] + raw([2]) == raw(ids(text)), text
    assert len(encoder.memo) + len(encoder.memo.old) < 400  # bounded


def test_other_tokenizers_encode_whole_texts():
    path = vocabulary("byte_bpe_50k.json")
    encoder = WordEncoder(path)
    assert not encoder.by_word
    assert encoder.encode([" Two  words"])[0] == raw(Tokenizer.from_file(path).encode(" Two  words", add_special_tokens=False).ids)


def expected_index(rows, ids):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        n = ids(text)
        out.append((doc_id, start, len(n), zlib.crc32(raw(n))))
        start += len(n)
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_token_index(spark, docs, odd, empty, ids):
    for df in (docs.limit(60), odd):
        df = df.cache()
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = [tuple(r) for r in token_files(df, PATH).collect()]
        assert sorted(got, key=key) == sorted(expected_index(rows, ids), key=key)
        df.unpersist()
    assert token_files(empty, PATH).count() == 0


def test_selective_reads(spark, docs, tmp_path, ids):
    path = str(tmp_path / "tokens")
    write_token_files(docs, path, PATH)
    one = read_documents(spark, path).where("doc_id = 7").select("ids").first().ids
    assert one == ids(docs.where("doc_id = 7").first().text)
    plan = read_documents(spark, path).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan and "ids" not in plan.split("ReadSchema")[1]
    stored = [r.doc_id for r in encode_documents(docs, PATH, 2).select("doc_id").collect()]
    assert stored == sorted(stored)


def test_row_groups_encodings_and_indexes(spark, docs, tmp_path):
    path = tmp_path / "tokens"
    write_token_files(docs.coalesce(1), str(path), PATH, row_group_bytes=64 << 10, page_bytes=8 << 10)
    files = [pq.ParquetFile(f).metadata for f in sorted(path.glob("*.parquet"))]
    assert sum(m.num_row_groups for m in files) > len(files)
    for m in files:
        for g in range(m.num_row_groups):
            columns = [m.row_group(g).column(c) for c in range(m.num_columns)]
            assert all(c.has_offset_index and c.has_column_index and c.compression == "ZSTD" for c in columns)
            ids = next(c for c in columns if c.path_in_schema.startswith("ids"))
            assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(ids.encodings)


def test_rows_without_an_id_are_dealt_out(spark, ids):
    texts = [f"{i * 7919 % 1000} some words of a text" for i in range(400)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        encoded = encode_documents(docs, PATH, 2).select("shard").groupBy("shard").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(encoded) > 1 and max(r["count"] for r in encoded) < 200
    got = [tuple(r) for r in token_files(docs, PATH).orderBy("start").collect()]
    assert got == expected_index([(None, t) for t in texts], ids)


def check_packing(rows, texts, ids, length=4096):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    total = padding = 0
    for pieces in sequences.values():
        offset = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == offset and p.length > 0
            offset += p.length
        assert offset <= length
        total += offset
        padding += length - offset if offset & (offset - 1) else 0
    for doc_id, text in texts.items():
        known, at = ids(text), 0
        for p in sorted(documents[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(known))
            assert p.ids_crc32 == zlib.crc32(raw(known[at : at + p.length]))
            at += p.length
        assert at == len(known)
    assert documents.keys() == texts.keys()
    return padding / total


def test_packing(docs, odd, empty, ids):
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check_packing(pack(docs, PATH).collect(), texts, ids) < 0.01
    check_packing(pack(docs.repartition(7), PATH, length=64, windows=3, group=2).collect(), texts, ids, 64)
    strange = odd.where("doc_id <> 8 or doc_id is null")
    check_packing(pack(strange, PATH).collect(), {r.doc_id: r.text for r in strange.collect()}, ids)
    repeated = pack(odd.where("doc_id = 8"), PATH).collect()
    assert sum(r.length for r in repeated) == 2 * len(ids("same words here " * 60))
    assert pack(empty, PATH).count() == 0


def test_best_fit_emits_the_fullest():
    packer = BestFit(10, 2)
    for n in (6, 7, 4, 5):  # 6 | 7 | 4 fits the first, which is full; 5 opens one
        packer.add(_Piece(n, 0, bytes(4 * n), n))
    assert [[p.doc_id for p in s] for s in packer.full] == [[6, 4]]
    packer.add(_Piece(8, 0, bytes(32), 8))  # fits none: the one with 7 is the fullest
    assert [[p.doc_id for p in s] for s in packer.full] == [[6, 4], [7]]
    assert len(packer.free) == 2
