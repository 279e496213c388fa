"""Merkle manifest of a dataset, and a proof for every row by octopus multiproofs.

Every row is a leaf: SHA-256 of its fields. The leaves of one source, ascending by `doc_id`, form a tree in which every
`FANOUT` consecutive nodes have a parent; the roots of the sources, ordered by source, form a tree above them with the same rule. H is
the lower-case hex SHA-256 of its inputs one after another, digests as hex text.

A leaf partition holds 3^levels consecutive leaves of a tree at most, so every interior node up to that level lies in one
partition and is derived there. What is above is built in the same way from the partitions' roots, tier by tier, each of a
3^levels-th of the rows. For the proofs a leaf partition takes all its leaves as known, computes the minimal union of
node coordinates that can't be derived from them (`missing`), fetches those in one join for all its leaves, derives the shared
interiors again, and expands the proof of each leaf locally. No sibling within a partition is ever stored or moved.

Places of leaves come from a range sort by (source, id) and counts per source and sorted partition, so a source with a third of all rows
lies in many tasks everywhere.

Defined results: a null field is `-`; null sources come first and are one source, null ids come first in their source; rows
with equal ids are ordered by their leaf, and rows equal in all fields are leaves of their own; an empty table has no row and
no root; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthoframe.session import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node; levels of parents within a leaf partition (2,187 leaves).
FANOUT, LEVELS = 3, 7
#: Name of the tree of the sources' roots; those of the sources begin with 0 (no source) or 1.
TOP = ""
_NODES = "tree string, level int, at long, n long, digest binary, top boolean"
_ARROW_NODES = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("top", pa.bool_())])
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Manifest(NamedTuple):
    """parts: leaf partitions; nodes: interior nodes above them by coordinate; places: (tree, top_at, top_n, subroot); root: its hex digest."""

    levels: int
    parts: DataFrame
    nodes: DataFrame
    places: DataFrame
    root: str | None


# --- trees ---------------------------------------------------------------------

def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def sizes(n: int) -> list[int]:
    """Nodes by level of a tree of n leaves, from the leaves to the single root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FANOUT))
    return out


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and `levels` levels of parents above them; the first of `nodes` begins a run."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest_of("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return out


def missing(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """(level, place) of all nodes that proofs of the known leaves need and that can't be derived from these, from below."""
    known, out = set(known), []
    for level, size in enumerate(sizes(n)[:-1]):
        runs = {i // FANOUT for i in known}
        out += [(level, i) for run in sorted(runs) for i in range(FANOUT * run, min(FANOUT * (run + 1), size)) if i not in known]
        known = runs
    return out


def neighbours(run: list[str], i: int) -> tuple[str, str]:
    """Digests before and after the i-th node of a run, as one text each."""
    return "".join(run[:i]), "".join(run[i + 1 :])


def path_above(level: int, at: int, n: int, fetched: dict[tuple[int, int], str]) -> list[tuple[str, str]]:
    """The neighbours on the way from a node to the root of its tree, out of fetched nodes."""
    out = []
    for up, size in enumerate(sizes(n)[level:-1], level):
        first = at // FANOUT * FANOUT
        run = range(first, min(first + FANOUT, size))
        out.append(tuple("".join(fetched[up, i] for i in run if (i < at) == before and i != at) for before in (True, False)))
        at //= FANOUT
    return out


def fold(digest: str, path: Iterable[tuple[str, str]]) -> str:
    for before, after in path:
        digest = digest_of(before + digest + after)
    return digest


# --- manifest --------------------------------------------------------------------

def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column | None = None) -> Column:
    """The 32 bytes of a row's leaf; with `text` in the place of the row's own."""
    fields = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds `at`, the place of a row in its `tree` by `order`, and `n`, the rows of the tree, without gathering a tree."""
    by = ["tree", *order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = settle(ranged.withColumn("_row", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_row", 33)
    runs = ranged.groupBy(F.col("tree").alias("of"), part.alias("part")).agg(F.count("*").alias("rows"), F.min("_row").alias("first"))
    whole = Window.partitionBy("of")
    runs = runs.select("of", "part", "first", (F.sum("rows").over(whole.orderBy("part")) - F.col("rows")).alias("before"), F.sum("rows").over(whole).alias("n"))
    found = ranged.join(runs, (F.col("tree") == F.col("of")) & (part == F.col("part")))
    return found.select(*rows.columns, (F.col("before") + F.col("_row") - F.col("first")).alias("at"), "n")


def _grouped(rows: DataFrame, levels: int, *value: str) -> DataFrame:
    """One row per partition of a tree's level: its nodes (or leaves) in order."""
    block = F.expr(f"at div {FANOUT**levels}").alias("block")
    return rows.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(F.struct("at", *value))).alias("nodes"))


def _climbing(levels: int, level: int, column: str, interior: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partitions to their roots (`top`), and with `interior` to all nodes below those."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, n, block, nodes in zip(*(batch.column(c) for c in ("tree", "n", "block", "nodes"))):
                tree, n, block = tree.as_py(), n.as_py(), block.as_py()
                size = sizes(n)
                tree_levels = climb([x[column].hex() for x in nodes.as_py()], min(levels, len(size) - 1))
                for up, made in enumerate(tree_levels):
                    top = up == len(tree_levels) - 1
                    if interior or top:
                        first = block * FANOUT ** (levels - up)
                        rows += [(tree, level + up, first + i, size[up], bytes.fromhex(d), top) for i, d in enumerate(made)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW_NODES)] or [pa.array([], f.type) for f in _ARROW_NODES], schema=_ARROW_NODES)

    return step


def _tiers(roots: DataFrame, levels: int, level: int) -> list[DataFrame]:
    """The given roots of partitions, and the nodes of every tier above, until each tree has one root."""
    found = [roots]
    while not (more := found[-1].where("top AND n > 1")).isEmpty():
        found.append(settle(_grouped(more, levels, "digest").mapInArrow(_climbing(levels, level, "digest", True), _NODES), "nodes"))
        level += levels
    return found


def manifest(docs: DataFrame, altered: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The trees over all rows. `altered` is the text that a verifier is given instead of the row's own."""
    leaf = leaf_digest()
    leaves = docs.select(
        F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source"))).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
        (leaf if altered is None else leaf_digest(altered)).alias("shown"), F.monotonically_increasing_id().alias("row"),
    )
    leaves = placed(settle(leaves, "leaves"), "doc_id", "leaf", "row")
    parts = settle(_grouped(leaves, levels, "doc_id", "leaf", "shown"), "leaf-parts")
    roots = settle(parts.mapInArrow(_climbing(levels, 0, "leaf", False), _NODES), "part-roots")
    tiers = _tiers(roots, levels, levels)
    nodes = [t.where("NOT top") for t in tiers[1:]]
    subroots = [t.where("top AND n = 1").select(F.col("tree").alias("name"), "digest") for t in tiers]
    named = subroots[0]
    for more in subroots[1:]:
        named = named.unionByName(more)
    places = settle(placed(named.withColumn("tree", F.lit(TOP)), "name"), "places")
    above = _tiers(places.select("tree", F.lit(0).alias("level"), "at", "n", "digest", F.lit(True).alias("top")), levels, 0)
    for tier in above[1:]:
        nodes.append(tier.where("NOT top"))
    root = above[-1].where("top AND n = 1").first()
    coordinates = above[0].where("false")
    for more in nodes:
        coordinates = coordinates.unionByName(more)
    return Manifest(
        levels, parts, coordinates.select("tree", "level", "at", "digest"),
        places.select(F.col("name").alias("tree"), F.col("at").alias("top_at"), F.col("n").alias("top_n"), F.col("digest").alias("subroot")),
        root["digest"].hex() if root else None,
    )


# --- proofs ----------------------------------------------------------------------

_WANTED = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("want", pa.string()), ("level", pa.int32()), ("place", pa.int64())])


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each leaf partition must fetch: the missing nodes of its own tree, and of the tree of the sources."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            own = range(r["first"], r["first"] + r["rows"])
            rows += [(r["tree"], r["block"], r["tree"], *node) for node in missing(own, r["n"])]
            rows += [(r["tree"], r["block"], TOP, *node) for node in missing([r["top_at"]], r["top_n"])]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _WANTED)] or [pa.array([], f.type) for f in _WANTED], schema=_WANTED)


def expand(leaves: list[str], shown: list[str], first: int, n: int, top_at: int, top_n: int, fetched: dict[tuple[bool, int, int], str], most: int = LEVELS) -> tuple[str, list[tuple[str, str]]]:
    """The subroot, and (proof digest, folded root) of each leaf of one partition."""
    levels = climb(leaves, min(most, len(sizes(n)) - 1))
    own = {(level, at): d for (top, level, at), d in fetched.items() if not top}
    up = len(levels) - 1
    in_tree = path_above(up, first // FANOUT**up, n, own)
    above = in_tree + path_above(0, top_at, top_n, {(level, at): d for (top, level, at), d in fetched.items() if top})
    tail = "".join(before + after for before, after in above)
    beside = [[neighbours(nodes[i - i % FANOUT : i - i % FANOUT + FANOUT], i % FANOUT) for i in range(len(nodes))] for nodes in levels[:-1]]
    out = []
    for i, given in enumerate(shown):
        path, at = [], i
        for level in beside:
            path.append(level[at])
            at //= FANOUT
        proof = digest_of("".join(before + after for before, after in path) + tail)
        out.append((proof, fold(fold(given, path), above)))
    return fold(levels[-1][0], in_tree), out


def prove(found: Manifest) -> DataFrame:
    """The proof of every leaf, and the root that its shown form folds to."""
    root, levels = found.root, found.levels
    names = [c.split()[0] for c in PROOF.split(", ")]
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    asked = found.parts.select("tree", "block", "n", F.get("nodes", F.lit(0))["at"].alias("first"), F.size("nodes").alias("rows"))
    asked = asked.join(found.places.select("tree", "top_at", "top_n"), "tree")
    wanted = asked.mapInArrow(_wanted, "tree string, block long, want string, level int, place long")
    nodes = found.nodes.select(F.col("tree").alias("want"), "level", F.col("at").alias("place"), "digest")
    got = wanted.join(nodes, ["want", "level", "place"]).groupBy("tree", "block").agg(
        F.collect_list(F.struct((F.col("want") == TOP).alias("top"), "level", F.col("place").alias("at"), "digest")).alias("fetched")
    )
    whole = found.parts.join(settle(got, "fetched"), ["tree", "block"], "left").join(found.places, "tree")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                leaves = [x["leaf"].hex() for x in row["nodes"]]
                fetched = {(x["top"], x["level"], x["at"]): x["digest"].hex() for x in row["fetched"] or []}
                subroot, proofs = expand(leaves, [x["shown"].hex() for x in row["nodes"]], row["nodes"][0]["at"], row["n"], row["top_at"], row["top_n"], fetched, levels)
                if subroot != row["subroot"].hex():
                    raise ValueError("The fetched nodes do not lead to the manifest's root of the source.")
                n = len(leaves)
                columns = [
                    [x["doc_id"] for x in row["nodes"]], leaves, [subroot] * n, [root] * n,
                    [p for p, _ in proofs], [f for _, f in proofs], [f == root for _, f in proofs],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return whole.mapInArrow(each, PROOF)


def without_line_ends(folds: int = 2) -> Column:
    """A tampered text: no line ends where the checksum of the id is divisible by `folds`."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0
    return F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


_CODE = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', {0}) END"
_HEAD = "concat(" + ", ".join(_CODE.format(c) for c in FIELDS[:-1]) + ", "
#: The same trees level by level. The checksum of an id, of which one bit is wanted, is computed from its polynomial.
SQL = f"""
WITH RECURSIVE leaf AS (SELECT doc_id, coalesce(concat('1', source), '0') AS tree, sha256({_HEAD}{_CODE.format('text')})) AS leaf,
    CASE WHEN list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) & 1 = 1
    THEN sha256({_HEAD}{_CODE.format("replace(text, chr(10), '')")})) ELSE NULL END AS altered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
up AS (SELECT tree, 0 AS level, place, n, leaf AS h FROM placed
  UNION ALL SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM up WHERE n > 1 GROUP BY tree, level, place // 3, n),
sub AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, place, n, h FROM sub
  UNION ALL SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE n > 1 GROUP BY level, place // 3, n),
run AS (SELECT tree, level, place // 3 AS run, list(h ORDER BY place) AS hs FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT '' AS tree, level, place // 3 AS run, list(h ORDER BY place) AS hs FROM top WHERE n > 1 GROUP BY ALL),
walk AS (SELECT doc_id, tree, 0 AS level, place, coalesce(altered, leaf) AS folded, '' AS proof FROM placed
  UNION ALL SELECT doc_id, tree, level + 1, place // 3, sha256(concat(array_to_string(hs[1:place % 3], ''), folded, array_to_string(hs[place % 3 + 2:], ''))),
    concat(proof, array_to_string(hs[1:place % 3], ''), array_to_string(hs[place % 3 + 2:], '')) FROM walk JOIN run USING (tree, level) WHERE run = place // 3),
own AS (SELECT doc_id, w.tree, folded, proof, sub.place, sub.h AS subroot FROM walk w JOIN up USING (tree, level, place) JOIN sub ON sub.tree = w.tree WHERE up.n = 1),
rise AS (SELECT doc_id, subroot, 0 AS level, place, folded, proof FROM own
  UNION ALL SELECT doc_id, subroot, level + 1, place // 3, sha256(concat(array_to_string(hs[1:place % 3], ''), folded, array_to_string(hs[place % 3 + 2:], ''))),
    concat(proof, array_to_string(hs[1:place % 3], ''), array_to_string(hs[place % 3 + 2:], '')) FROM rise JOIN run USING (level) WHERE run.tree = '' AND run = place // 3)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = top.h AS verified
FROM rise JOIN leaf USING (doc_id) JOIN top ON top.n = 1 AND top.level = rise.level
"""
