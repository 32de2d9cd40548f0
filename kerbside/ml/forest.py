"""Nearest neighbours by a forest of random projections.

A tree cuts the vectors by hyperplanes (a random direction, the median of the projections) until a leaf
holds at most ``leaf`` of them. A vector's candidates are the vectors that share a leaf with it in any
tree; their exact distances rank them. Work grows with rows x trees x leaf, never with the square of the
rows, and a class that fits into one leaf is searched exactly.

Trees grow by whole passes. For every node that is too large a bounded sample (the smallest digests) is
cut up in one task, many levels at once, and all its vectors are led through those cuts: by a broadcast
while the cuts are few and small, else streamed behind them in order of the node, so that no node is
held in a task. Nodes multiply by about ``SAMPLE / 16`` a pass.

Vectors must be distinct; what is equal is counted as copies before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.operators.ordered import first_per_key
from kerbside.session import SMALL_BYTES, durable

TREES = 8
LEAF = 256              # vectors a leaf holds at most
SAMPLE = 512            # vectors of a node its cuts are made from
LEAST = 16              # of the sample left in a part, at least, before it is cut no further
WIDTH = 1024            # numbers a node's parts may take up


def vectors_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


# ---- cutting one node ------------------------------------------------------------------
@dataclass(frozen=True)
class Cuts:
    """A small tree: per inner place a direction and a threshold; negative children are parts."""

    normals: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray        # inner places x 2

    def part(self, v: np.ndarray) -> np.ndarray:
        """The part each vector belongs to."""
        at = np.zeros(len(v), np.int64)
        inner = at >= 0
        while inner.any():
            rows = np.flatnonzero(inner)
            here = at[rows]
            right = (v[rows] * self.normals[here]).sum(1) > self.thresholds[here]
            at[rows] = self.children[here, right.astype(int)]
            inner = at >= 0
        return -at - 1


def cut(v: np.ndarray, most: int, seed: int) -> Cuts:
    """Cut distinct vectors into parts of at most ``most``, at the median of random projections."""
    rng = np.random.default_rng(seed)
    normals, thresholds, children = [], [], []
    parts = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal parts
        if len(rows) <= max(1, most):
            parts += 1
            return -parts
        own = v[rows]
        normal = rng.standard_normal(v.shape[1])
        at = (own * normal).sum(1)
        if at.max() == at.min():                        # no spread: distinct vectors differ along some axis
            normal = np.zeros(v.shape[1])
            normal[np.argmax(own.max(0) - own.min(0))] = 1.0
            at = (own * normal).sum(1)
        threshold = np.partition(at, (len(at) - 1) // 2)[(len(at) - 1) // 2]
        if threshold == at.max():
            threshold = at[at < threshold].max()
        place = len(normals)
        normals.append(normal)
        thresholds.append(threshold)
        children.append([0, 0])
        children[place] = [grow(rows[at <= threshold]), grow(rows[at > threshold])]
        return place

    grow(np.arange(len(v)))
    if not normals:
        return Cuts(np.zeros((1, v.shape[1])), np.zeros(1), np.array([[-1, -1]]))
    return Cuts(np.array(normals), np.array(thresholds), np.array(children))


CUTS = "tree int, node long, dims int, normals binary, thresholds binary, children binary"


def _packed(tree: int, node: int, c: Cuts) -> tuple:
    return (tree, node, c.normals.shape[1], c.normals.tobytes(), c.thresholds.tobytes(), c.children.astype(np.int64).tobytes())


def _unpacked(dims: int, normals: bytes, thresholds: bytes, children: bytes) -> Cuts:
    return Cuts(np.frombuffer(normals).reshape(-1, dims), np.frombuffer(thresholds), np.frombuffer(children, np.int64).reshape(-1, 2))


def node_cuts(members: DataFrame, large: DataFrame, leaf: int, seed: int) -> DataFrame:
    """Cuts of every large node, made from a sample of its members."""
    inside = members.join(large, ["tree", "node"])
    sample = first_per_key(inside.select("tree", "node", "size", "id", "v"), ["tree", "node"],
                           [F.xxhash64(F.lit(seed), "id"), F.col("id")], SAMPLE)

    def build(table: pa.Table) -> pa.Table:
        rows = table.sort_by("id")
        tree, node, size = (rows.column(c)[0].as_py() for c in ("tree", "node", "size"))
        v = vectors_of(rows.column("v").combine_chunks())
        whole = len(v) == size
        most = leaf if whole else max(LEAST, leaf * len(v) // (2 * size))
        made = cut(v, most, seed * 1_000_003 + tree * 7919 + node % 1_000_003)
        return pa.table(dict(zip(["tree", "node", "dims", "normals", "thresholds", "children"],
                                 [[x] for x in _packed(tree, node, made)])), schema=_SCHEMA)

    return sample.groupBy("tree", "node").applyInArrow(build, CUTS)


_SCHEMA = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("dims", pa.int32()), ("normals", pa.binary()),
                     ("thresholds", pa.binary()), ("children", pa.binary())])
MEMBERS = "tree int, node long, id long, v array<double>, copies long"
_MEMBERS = ["tree", "node", "id", "v", "copies"]


def _moved(batch: pa.RecordBatch, cuts_of: Callable[[int, int], Cuts | None]) -> pa.RecordBatch:
    """Members with the part of their node as their node; others as they are."""
    tree, node = (batch.column(c).to_numpy() for c in ("tree", "node"))
    v, out = vectors_of(batch.column("v")), node.copy()
    for t, n in {(int(t), int(n)) for t, n in zip(tree, node)}:
        cuts = cuts_of(t, n)
        if cuts is not None:
            rows = np.flatnonzero((tree == t) & (node == n))
            out[rows] = n * WIDTH + 1 + cuts.part(v[rows])
    return pa.RecordBatch.from_arrays([batch.column("tree"), pa.array(out), *[batch.column(c) for c in _MEMBERS[2:]]], names=_MEMBERS)


def _by_broadcast(members: DataFrame, cuts: DataFrame) -> DataFrame:
    found = {(r["tree"], r["node"]): tuple(r)[2:] for r in cuts.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: _unpacked(*c) for k, c in found.items()}
        for b in batches:
            yield _moved(b, lambda t, n: known.get((t, n)))

    return members.mapInArrow(run, MEMBERS)


def _by_order(members: DataFrame, cuts: DataFrame) -> DataFrame:
    """Each node's cuts first, then its members, streamed: a task holds the cuts of one node."""
    extra = ["dims", "normals", "thresholds", "children"]
    both = cuts.unionByName(members, allowMissingColumns=True)
    placed = both.repartition("tree", "node").sortWithinPartitions("tree", "node", F.col("dims").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            heads = b.filter(b.column("dims").is_valid())
            fresh = {(r["tree"], r["node"]): _unpacked(*(r[c] for c in extra)) for r in heads.to_pylist()}
            held |= fresh
            rest = b.filter(b.column("id").is_valid())
            if rest.num_rows:
                yield _moved(rest.select(_MEMBERS), lambda t, n: held.get((t, n)))
            last = (b.column("tree")[-1].as_py(), b.column("node")[-1].as_py())
            held = {last: held[last]} if last in held else {}

    return placed.mapInArrow(run, MEMBERS)


# ---- the forest ------------------------------------------------------------------------
def leaves(distinct: DataFrame, trees: int = TREES, leaf: int = LEAF, seed: int = 42,
           broadcast_bytes: int = SMALL_BYTES) -> DataFrame:
    """(tree, node, id, v, copies): every vector in its leaf of every tree."""
    rows = distinct.select("id", F.col("v").cast("array<double>").alias("v"), F.col("copies").cast("long").alias("copies"))
    n = rows.count()
    # a single leaf holds all: one tree is the exact search
    tree = F.explode(F.sequence(F.lit(0), F.lit(0 if n <= leaf else trees - 1)))
    members = durable(rows.select(tree.alias("tree"), F.lit(0).cast("long").alias("node"), "id", "v", "copies"))
    level = 0
    while True:
        large = durable(members.groupBy("tree", "node").agg(F.count("*").alias("size")).where(F.col("size") > leaf))
        nodes = large.count()
        if not nodes:
            return members
        cuts = durable(node_cuts(members, large, leaf, seed + level))
        width = cuts.agg(F.sum(F.octet_length("normals") + F.octet_length("thresholds") + F.octet_length("children"))).first()[0]
        move = _by_broadcast if width <= broadcast_bytes else _by_order
        members = durable(move(members, cuts))
        level += 1


def _leaf_neighbours(k: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k nearest within each leaf, leaves streamed in order."""
    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, tree = (table.column(c).to_numpy() for c in ("node", "tree"))
        ids, copies = (table.column(c).to_numpy() for c in ("id", "copies"))
        v = vectors_of(table.column("v").combine_chunks())
        ends = np.append(np.flatnonzero((np.diff(node) != 0) | (np.diff(tree) != 0)) + 1, len(node))
        start = 0
        for end in ends:
            own, own_ids = v[start:end], ids[start:end]
            d = np.stack([np.sqrt(((own - p) ** 2).sum(1)) for p in own])
            np.fill_diagonal(d, np.inf)
            order = np.lexsort((np.broadcast_to(own_ids, d.shape), d), axis=1)[:, :k]
            pick = np.take_along_axis(d, order, 1)
            at = np.nonzero(np.isfinite(pick))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own_ids[at[0]]), pa.array(own_ids[order[at]]), pa.array(pick[at]), pa.array(copies[start:end][order[at]])],
                names=["id", "near", "distance", "near_copies"])
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            table = pa.Table.from_batches(held).combine_chunks()
            node, tree = (table.column(c).to_numpy() for c in ("node", "tree"))
            cuts = np.flatnonzero((np.diff(node) != 0) | (np.diff(tree) != 0))
            if len(cuts):
                last = int(cuts[-1]) + 1
                yield from solve(table.slice(0, last))
                held = table.slice(last).to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    return run


def neighbours(distinct: DataFrame, k: int, seed: int = 42, trees: int = TREES, leaf: int = LEAF,
               broadcast_bytes: int = SMALL_BYTES) -> DataFrame:
    """(id, near, distance, near_copies, place): the k nearest of each vector's candidates.

    ``distinct`` holds (id bigint, v array<double>, copies), every v once. Distances are exact; a
    neighbour is missed only if no tree keeps the two together.
    """
    members = leaves(distinct, trees, leaf, seed, broadcast_bytes)
    ordered = members.repartition("tree", "node").sortWithinPartitions("tree", "node", "id")
    found = ordered.mapInArrow(_leaf_neighbours(k, leaf), "id long, near long, distance double, near_copies long")
    # trees repeat pairs: equal ranks, of which one row stays
    w = W.partitionBy("id").orderBy("distance", "near")
    return (found.withColumn("place", F.dense_rank().over(w)).filter(F.col("place") <= k)
            .groupBy("id", "place").agg(F.first("near").alias("near"), F.first("distance").alias("distance"),
                                        F.first("near_copies").alias("near_copies"))
            .select("id", "near", "distance", "near_copies", "place"))
