"""Packing of token ids into sequences: online best fit with a bounded number of open windows.

A task reads its documents once. Ids of a document beyond the sequence length are cut off as full sequences; the rest is
placed whole in the open window that it fits best. When it fits none and all windows are in use, the fullest window is
emitted. What is open at the end of a task is merged: its pieces are chained and cut at the sequence length, and
the last unfinished sequences of the tasks meet, some hundred tasks to a group, in a second small step. The very last
sequence of a group is dealt into lengths that are powers of two, which need no padding.

Defined results: null text is the empty text and has the end id alone; rows with equal ids are packed like
any others; sequence ids are unique, not dense; an empty table has no sequence; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benthoframe.llm.tables import pieces
from benthoframe.llm.word_memo import encoder
from benthoframe.session import settle

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_ARROW = pa.schema([(c, pa.int64()) for c in COLUMNS] + [("ids", pa.binary()), ("task", pa.int64())])
_SCHEMA = ", ".join(f"{c} long" for c in COLUMNS) + ", ids binary, task long"
#: Sequence ids of the merging step have this bit.
MERGED = 1 << 62


class _Piece:
    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def split(self, n: int) -> tuple[_Piece, _Piece]:
        head = _Piece(self.doc_id, self.start, self.ids[: 4 * n], self.doc_tokens)
        return head, _Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.doc_tokens)

    def __len__(self) -> int:
        return len(self.ids) // 4


class BestFit:
    """At most `windows` open windows of `length` ids each; `full` gets what is emitted."""

    def __init__(self, length: int, windows: int):
        self.length, self.windows = length, windows
        self.free: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.held: dict[int, list[_Piece]] = {}
        self.made = 0
        self.full: list[list[_Piece]] = []

    def add(self, piece: _Piece) -> None:
        while len(piece) >= self.length:
            head, piece = piece.split(self.length)
            self.full.append([head])
        if not len(piece):
            return
        at = bisect_left(self.free, (len(piece), -1))
        if at < len(self.free):
            free, window = self.free.pop(at)
        else:
            if len(self.free) >= self.windows:
                self.full.append(self.held.pop(self.free.pop(0)[1]))
            free, window = self.length, self.made
            self.made += 1
            self.held[window] = []
        self.held[window].append(piece)
        if free == len(piece):
            self.full.append(self.held.pop(window))
        else:
            insort(self.free, (free - len(piece), window))

    def leftovers(self) -> list[_Piece]:
        return [p for _, w in self.free for p in self.held[w]]


def chain(pieces_: list[_Piece], length: int) -> tuple[list[list[_Piece]], list[_Piece]]:
    """Pieces one after another in sequences of exactly `length`, and the pieces of the unfinished one."""
    done, now, room = [], [], length
    for piece in pieces_:
        while len(piece) >= room:
            head, piece = piece.split(room)
            done.append([*now, head])
            now, room = [], length
        if len(piece):
            now.append(piece)
            room -= len(piece)
    return done, now


def in_powers(pieces_: list[_Piece]) -> list[list[_Piece]]:
    """The same ids in sequences whose lengths are the powers of two of their number, largest first."""
    total, out = sum(map(len, pieces_)), []
    while total:
        part = 1 << (total.bit_length() - 1)
        (head, *_), rest = chain(pieces_, part)
        later = chain(pieces_, part)[0][1:]
        pieces_ = [*(p for s in later for p in s), *rest]
        out.append(head)
        total -= part
    return out


def _rows(sequence: list[_Piece], sequence_id: int) -> Iterator[tuple]:
    offset = 0
    for p in sequence:
        yield p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, sequence_id, offset
        offset += len(p)


def pack(docs: DataFrame, tokenizer: str, length: int = 4096, windows: int = 128, end_id: int = 2, group: int = 256) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and the checksum of its ids."""
    end = int(end_id).to_bytes(4, "little")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, enc, packer = TaskContext.get().partitionId(), 0, encoder(tokenizer), BestFit(length, windows)

        def emit(sequences) -> pa.RecordBatch:
            nonlocal made
            rows = []
            for s in sequences:
                rows += _rows(s, (task << 32) | made)
                made += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64()) for _ in COLUMNS]
            empty = pa.nulls(len(rows))
            return pa.RecordBatch.from_arrays([*columns, empty.cast(pa.binary()), empty.cast(pa.int64())], schema=_ARROW)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, texts in pieces(batch):
                for doc_id, raw in zip(ids[start:], enc.encode(texts)):
                    packer.add(_Piece(doc_id, 0, raw + end, len(raw) // 4 + 1))
                yield emit(packer.full)
                packer.full.clear()
        done, rest = chain(packer.leftovers(), length)
        yield emit(done)
        left = [(p.doc_id, p.start, len(p), 0, p.doc_tokens, 0, 0, p.ids, task) for p in rest]
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*left), _ARROW)], schema=_ARROW)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["task", "start", "doc_id"], na_position="first")
        held = [
            _Piece(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), bytes(r.ids), int(r.doc_tokens))
            for r in rows.itertuples()
        ]
        done, rest = chain(held, length)
        first = MERGED | (int(rows["task"].iloc[0]) // group << 32)
        out = [x for i, s in enumerate([*done, *in_powers(rest)]) for x in _rows(s, first | i)]
        return pd.DataFrame(out, columns=list(COLUMNS)).astype({"doc_id": "Int64"})

    placed = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(place, _SCHEMA), "packed")
    open_ones = placed.where("ids IS NOT NULL").groupBy(F.floor(F.col("task") / group).alias("group"))
    merged = open_ones.applyInPandas(merge, ", ".join(f"{c} long" for c in COLUMNS))
    return placed.where("ids IS NULL").select(*COLUMNS).unionByName(merged)
