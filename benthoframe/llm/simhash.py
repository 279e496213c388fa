"""SimHash near-duplicates: pigeonring candidates, exact Hamming check, components.

The 64 bits of a fingerprint lie on a ring of segments. If two fingerprints differ in at most `d` bits, then from some
segment on every chain of consecutive segments stays within its proportional budget, floor(d * chain / segments). With
2 d + 1 segments the first two segments of that chain are equal: they are the join key. The longer chains are checked
in the join condition, before the full distance. Only distinct fingerprints are joined, so copies make no pairs. A key
that many distinct fingerprints share is divided by a third equal segment, of which there must be one, so a hot
bucket is split without losing a pair. Links are contracted to components by rounds of large-star and small-star joins
on written tables.

Defined results: null, empty and white-space texts have fingerprint zero and are linked like any other; a null `doc_id`
is kept and counts as no candidate for the smallest; repeated rows stay; extra columns are not read, but for those to `carry`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benthoframe.session import settle

_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text, lower-cased in A-Z only."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    total, ones = len(found) - words + 1, np.zeros(64, np.int64)
    for at in range(0, total, _BLOCK):
        part = found[at : at + _BLOCK + words - 1]
        digest = xxhash.xxh64_intdigest
        h = [digest(b" ".join(s), seed) for s in zip(*(part[i:] for i in range(words)))]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, fingerprint (the 64 bits as a long) and the columns to carry of every row."""
    names = ["doc_id", "fingerprint", *carry]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), *map(batch.column, carry)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    carried = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(compute, "doc_id long, fingerprint long" + carried)


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def segment_masks(segments: int) -> list[int]:
    """The bits of each segment, of nearly equal length."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def links(nodes: DataFrame, distance: int = 2, hot: int = 256) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct `fingerprint` values that differ in at most `distance` bits."""
    segments = max(3, 2 * distance + 1)
    masks = segment_masks(segments)
    run = 2 if distance * 2 < segments else 1

    def chain(start: int, n: int) -> int:
        return sum(masks[(start + j) % segments] for j in range(n))

    value = F.col("fingerprint")
    keys = F.array(*(F.struct(F.lit(i).alias("seg"), value.bitwiseAND(_signed(chain(i, run))).alias("key")) for i in range(segments)))
    keyed = nodes.select("fingerprint", F.explode(keys).alias("k")).select("fingerprint", "k.*")
    sub = F.array(F.struct(F.lit(-1).alias("third"), F.lit(0).cast("long").alias("extra")))
    if segments - run > distance:
        crowded = keyed.groupBy("seg", "key").count().where(F.col("count") > hot).select("seg", "key", F.lit(True).alias("hot"))
        keyed = keyed.join(crowded, ["seg", "key"], "left")
        thirds = [
            F.when(
                ~F.array_contains(F.array(*(F.lit(j) for j in range(run))), F.pmod(F.lit(t) - F.col("seg"), F.lit(segments))),
                F.struct(F.lit(t).alias("third"), value.bitwiseAND(_signed(masks[t])).alias("extra")),
            )
            for t in range(segments)
        ]
        sub = F.when(F.col("hot"), F.filter(F.array(*thirds), lambda x: x.isNotNull())).otherwise(sub)
    keyed = keyed.select("fingerprint", "seg", "key", F.explode(sub).alias("s")).select("fingerprint", "seg", "key", "s.*")
    a, b = keyed.alias("a"), keyed.alias("b")
    differs = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
    within = F.lit(False)
    for i in range(segments):
        ring = F.col("a.seg") == i
        for n in range(run + 1, segments):
            ring &= F.bit_count(differs.bitwiseAND(_signed(chain(i, n)))) <= distance * n // segments
        within |= ring
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("seg", "key", "third", "extra")]
    found = a.join(b, [*same, F.col("a.fingerprint") < F.col("b.fingerprint"), F.bit_count(differs) <= distance, within])
    return found.select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of `edges` (a, b) with the smallest node of its component.

    Each round hangs neighbours below the smallest node around (large star, then small star); stars of all components
    are reached after about log2 of the longest path rounds, and a round that changes nothing ends the loop.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = settle(small.unionByName(least.select("v", F.col("m").alias("u"))).where("u < v").distinct(), "edges")
        state = now.select(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    hung = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    With columns to carry, also these and `root`, the smallest fingerprint (signed) of the component, which tells components
    apart even where no row has an id.
    """
    prints = settle(fingerprints(docs, words, carry), "fingerprints")
    nodes = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    member = components(links(nodes, distance))
    rooted = nodes.join(member, nodes["fingerprint"] == member["node"], "left")
    rooted = rooted.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = settle(rooted.join(least, "root").select("fingerprint", "component_id", "root"), "classes")
    return prints.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", *(["root", *carry] if carry else [])
    )
