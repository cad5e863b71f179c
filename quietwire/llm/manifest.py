"""Merkle manifest of a dataset, and proofs of many rows at once by octopus multiproofs.

Every row is a leaf: H (SHA-256 in lower-case hex) of doc_id, source, lang, n_chars and text, each ``-`` if null,
else its number of UTF-8 bytes, ``:`` and its value. The leaves of a source ascend by doc_id; every 16 consecutive
nodes (the last run may hold fewer, even one) become the H of their joined hex digests, until one is left, the
subroot. The subroots in the order of the sources (null first, then by UTF-8 bytes) become the root likewise. A lone
leaf is its subroot, a lone subroot the root.

To prove rows, each partition of leaves finds the nodes it lacks: the union of its leaves' siblings, level by level,
less those that it can derive from its own leaves. It fetches each of them once, derives what several of its
proofs share, and expands the proofs where they are used, so no proof is ever shuffled.

Null ids come first, rows with one id go by their leaf, and repeated rows are a leaf each. An empty table has
no root and gives no rows. Other columns are no part of a leaf and are not handed on.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import numbered, prepare
from quietwire.operators.skew import hot_keys, lookup_join, salted_join
from quietwire.session import stage

FAN = 16
_SHIFT = 4
# Leaves that one group of the proving step holds.
CHUNK = 4096
# The tree over the subroots; sources are numbered from 0.
TOP = -1
_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other sign as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    parts = []
    for value in (doc_id, source, lang, n_chars, text):
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, changed_text: Column | None = None) -> DataFrame:
    """(doc_id, key, leaf, bent): ``bent`` is the leaf with ``changed_text`` where ``tampered``, else null."""
    columns = {c: F.col(c) for c in _FIELDS}
    bent = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(**columns | {"text": changed_text}))
    # Keeps the order of the sources by bytes, null first, without a null.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), key.alias("key"), leaf(**columns).alias("leaf"), bent.alias("bent"))
    return stage(rows, "leaves")


def _levels(nodes: DataFrame, label: str) -> DataFrame:
    """(tree, level, at, size, hash) of all nodes above and including ``nodes`` (tree, at, size, hash).

    One exchange a level, of a sixteenth of the level before; a run of 16 is the largest group.
    """
    row = nodes.agg(F.max("size")).first()
    most, level, done = row[0] or 0, 0, []
    here = nodes
    while True:
        done.append(here.withColumn("level", F.lit(level)))
        if most <= 1:
            break
        run = F.sort_array(F.collect_list(F.struct("at", "hash")))
        joined = F.array_join(F.transform(run, lambda x: x["hash"]), "")
        above = here.where("size > 1").groupBy("tree", F.shiftright("at", _SHIFT).alias("up"), "size").agg(F.sha2(joined, 256).alias("hash"))
        above = above.select("tree", F.col("up").alias("at"), F.shiftright(F.col("size") + (FAN - 1), _SHIFT).alias("size"), "hash")
        here = stage(above, label)
        most, level = -(-most // FAN), level + 1
    all_levels = done[0]
    for more in done[1:]:
        all_levels = all_levels.unionByName(more)
    return all_levels.select("tree", "level", "at", "size", "hash")


@dataclass(frozen=True)
class Manifest:
    """``rows``: (doc_id, leaf, bent, tree, at, size, trees, chunk) in order; ``nodes``: (tree, level, at, size, hash)."""

    rows: DataFrame
    nodes: DataFrame

    def subroots(self) -> DataFrame:
        """(tree, subroot) of every source."""
        return self.nodes.where((F.col("size") == 1) & (F.col("tree") != TOP)).select("tree", F.col("hash").alias("subroot"))

    def root(self) -> str | None:
        top = self.nodes.where((F.col("size") == 1) & (F.col("tree") == TOP)).first()
        return top and top["hash"]


def build(leaf_rows: DataFrame) -> Manifest:
    """The tree over the rows of ``leaves``."""
    prepare(leaf_rows.sparkSession)
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = numbered(leaf_rows, order, [], "place", "placed-leaves", few=True)
    sources = placed.groupBy("key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    sources = stage(numbered(sources, [F.col("key")], [], "tree", "sources", few=True), "numbered-sources")
    trees = sources.count()
    rows = lookup_join(placed, sources, ["key"], F.col("place")).select(
        "doc_id", "leaf", "bent", "tree", (F.col("place") - F.col("first")).alias("at"), "size",
        F.lit(trees).cast("bigint").alias("trees"), F.floor(F.col("place") / CHUNK).alias("chunk"),
    )
    rows = stage(rows, "manifest-rows")
    below = _levels(rows.select("tree", "at", "size", F.col("leaf").alias("hash")), "source-level")
    subroots = below.where("size = 1").select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(trees).cast("bigint").alias("size"), "hash"
    )
    return Manifest(rows, stage(below.unionByName(_levels(stage(subroots, "subroots"), "top-level")), "nodes"))


def missing(size: int, at: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(level, places) of the fewest nodes of a tree of ``size`` leaves that prove the leaves ``at`` together."""
    lacking, level, known = [], 0, np.unique(at)
    while size > 1:
        up = np.unique(known >> _SHIFT)
        run = (up[:, None] << _SHIFT) + np.arange(FAN)
        run = run[run < size]
        lacking.append((level, np.setdiff1d(run, known, assume_unique=True)))
        known, size, level = up, -(-size // FAN), level + 1
    return lacking


def _by_tree(tree: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(tree, its rows), rows in their order."""
    by = np.argsort(tree, kind="stable")
    cuts = np.flatnonzero(np.diff(tree[by])) + 1
    return [(int(tree[part[0]]), part) for part in np.split(by, cuts) if len(part)]


def _needs(table: pa.Table) -> pa.Table:
    """(chunk, tree, level, at) that the leaves of a chunk lack, those of the tree over the subroots included."""
    chunk, tree, at, size, trees = (table.column(i).to_numpy() for i in range(5))
    found = [(t, *x) for t, part in _by_tree(tree) for x in missing(int(size[part[0]]), at[part])]
    found += [(TOP, *x) for x in missing(int(trees[0]), tree)]
    places = [x[2] for x in found]
    counts = [len(x) for x in places]
    arrays = [
        np.full(sum(counts), chunk[0], np.int64),
        np.repeat(np.array([x[0] for x in found], np.int64), counts),
        np.repeat(np.array([x[1] for x in found], np.int32), counts),
        np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int64),
    ]
    return pa.table(arrays, ["chunk", "tree", "level", "at"])


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class _Known:
    """The nodes of one chunk: its leaves, what it has fetched, and what follows from both."""

    def __init__(self, fetched: pa.Table) -> None:
        columns = [fetched.column(c).to_pylist() for c in ("tree", "level", "at", "hash")]
        self.hash = {(t, level, at): h for t, level, at, h in zip(*columns)}

    def climb(self, tree: int, size: int, at: list[int], hashes: list[str]) -> str:
        """Adds the leaves and all that is above them; gives the root of the tree."""
        self.hash |= {(tree, 0, i): h for i, h in zip(at, hashes)}
        level, known = 0, set(at)
        while size > 1:
            known = {i >> _SHIFT for i in known}
            for i in known:
                run = range(i << _SHIFT, min(size, (i + 1) << _SHIFT))
                self.hash[tree, level + 1, i] = _h("".join(self.hash[tree, level, j] for j in run))
            size, level = -(-size // FAN), level + 1
        return self.hash[tree, level, 0]

    def siblings(self, tree: int, size: int, at: int) -> list[tuple[str, str]]:
        """What stands before and behind the node in its run, from level to level."""
        out, level = [], 0
        while size > 1:
            first = at & ~(FAN - 1)
            before = "".join([self.hash[tree, level, j] for j in range(first, at)])
            behind = "".join([self.hash[tree, level, j] for j in range(at + 1, min(size, first + FAN))])
            out.append((before, behind))
            at, size, level = at >> _SHIFT, -(-size // FAN), level + 1
        return out


def fold(leaf_hash: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, behind in path:
        leaf_hash = _h(before + leaf_hash + behind)
    return leaf_hash


_PROVED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(rows: pa.Table, fetched: pa.Table) -> pa.Table:
    names = [part.split(" ")[0] for part in _PROVED.split(", ")]
    if not rows.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), *[pa.string()] * 5, pa.bool_())], names)
    tree, at, size = (rows.column(c).to_numpy() for c in ("tree", "at", "size"))
    leaf_of, bent = rows.column("leaf").to_pylist(), rows.column("bent").to_pylist()
    trees, known = rows.column("trees")[0].as_py(), _Known(fetched)
    parts = [(t, int(size[part[0]]), part.tolist()) for t, part in _by_tree(tree)]
    subroots = [known.climb(t, n, at[part].tolist(), [leaf_of[i] for i in part]) for t, n, part in parts]
    root = known.climb(TOP, trees, [t for t, _, _ in parts], subroots)
    out: list[list] = [[None] * rows.num_rows for _ in range(4)]
    for (t, n, part), subroot in zip(parts, subroots):
        upper = known.siblings(TOP, trees, t)
        for i in part:
            path = known.siblings(t, n, int(at[i])) + upper
            proof = _h("".join([side for pair in path for side in pair]))
            folded = fold(leaf_of[i] if bent[i] is None else bent[i], path)
            for column, value in zip(out, (subroot, proof, folded, folded == root)):
                column[i] = value
    subroot, proof, folded, verified = out
    roots = pa.array([root] * rows.num_rows, pa.string())
    arrays = [rows.column("doc_id"), pa.array(leaf_of, pa.string()), pa.array(subroot, pa.string()), roots]
    return pa.table([*arrays, pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array(verified, pa.bool_())], names)


def prove(manifest: Manifest, rows: DataFrame | None = None) -> DataFrame:
    """The proof of every one of ``rows`` (some or all rows of the manifest), checked against the root.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): ``proof_sha256`` is H of the siblings from
    level to level; ``folded_root`` comes from the bent leaf where there is one, else from the leaf.
    """
    rows = manifest.rows if rows is None else rows
    cells = rows.select("chunk", "tree", "at", "size", "trees")
    needs = stage(cells.groupBy("chunk").applyInArrow(_needs, "chunk bigint, tree bigint, level int, at bigint"), "needs")
    keys = ["tree", "level", "at"]
    # The upper nodes are needed by many chunks.
    counts = needs.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    fetched = salted_join(needs, manifest.nodes.drop("size"), keys, hot_keys(counts, keys, "rows"), F.col("chunk"))
    return rows.groupBy("chunk").cogroup(fetched.groupBy("chunk")).applyInArrow(_prove, _PROVED)
