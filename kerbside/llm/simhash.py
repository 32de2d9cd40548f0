"""SimHash near-dedup by multi-index hashing.

Texts become 64-bit fingerprints; equal fingerprints are one node. Fingerprints are cut into m
segments. If two differ in at most r bits and the segments' radii t_i sum to r - m + 1, some
segment differs in at most t_i bits (were all to differ in t_i + 1 or more, the total would pass
r). So each fingerprint is stored in one table per segment, every member of the Hamming ball of
radius t_i around a segment is looked up there, and complete distances are verified. m follows
from the number of fingerprints: the split of least expected work. Any m is exact.

A segment value shared by many fingerprints (near copies by the thousand) is not joined pair by
pair: its table and its lookups are cut into blocks, each pair of blocks is one task's arrays,
and a block yields links that keep what it connects connected, at most one per row, not all
pairs. Groups are connected components over both kinds of links.

Null and empty texts, and texts without words, have fingerprint zero and are linked like any
other. Repeated rows and ids are kept; a null id never names a component unless it has no other.
Empty tables give empty results; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import components, fresh, slices, stored

HOT = 256           # fingerprints under one segment value from which it is worked on in blocks
BLOCK = 2048        # fingerprints of a table's block
PROBES = 16384      # lookups of a block


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """SimHash of UTF-8 text: lower-case A-Z, shingles of ``words`` words, XXH64, bits set in over half."""
    found = text.lower().split()      # of bytes: A-Z only, white space is x20 and x09 to x0D
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    ends = (ends[min(words, len(found)) - 1:] - 1).tolist()
    digest, sums = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for a in range(0, n, 65536):
        h = np.array([digest(line[i:j], seed) for i, j in zip(starts[a:a + 65536], ends[a:a + 65536])], np.uint64)
        sums += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in slices(batches):
            text = batch.column(1).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"", words) for t in text], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def plan(n: int, bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) per segment, of least expected work for ``n`` fingerprints."""
    def cost(m):
        base, more = divmod(64, m)
        widths = [base + (i < more) for i in range(m)]
        slack = bits - m + 1
        radii = [max(0, slack) // m + (i >= m - max(0, slack) % m) for i in range(m)]
        if slack < 0:     # more segments than needed: the first bits + 1 at radius zero suffice
            widths, radii = widths[:bits + 1], [0] * (bits + 1)
        balls = [sum(math.comb(w, k) for k in range(t + 1)) for w, t in zip(widths, radii)]
        return sum(b + b * n / 2 ** w for b, w in zip(balls, widths)), widths, radii
    _, widths, radii = min((cost(m) for m in range(1, bits + 2)), key=lambda x: x[0])
    shifts = itertools.accumulate([0, *widths[:-1]])
    return list(zip(shifts, widths, radii))


def _entries(nodes: DataFrame, segments, balls: bool) -> DataFrame:
    """(seg, key, fp) of the tables, or of the lookups around each segment but the segment itself."""
    flips = []
    for i, (shift, width, radius) in enumerate(segments):
        ones = (1 << width) - 1
        for k in range(1, radius + 1) if balls else (0,):
            for bits in itertools.combinations(range(width), k):
                flips.append((i, shift, _signed(ones), _signed(sum(1 << b for b in bits))))
    if not flips:       # no radius above zero: nothing to look up but the segments themselves
        return nodes.select(F.lit(0).alias("seg"), F.lit(0).cast("long").alias("key"), "fp").where("false")
    # a constant array of at most some hundred flips
    flips = F.array(*[F.struct(F.lit(i).alias("seg"), F.lit(shift).alias("shift"),
                               F.lit(ones).cast("long").alias("ones"), F.lit(flip).cast("long").alias("flip"))
                      for i, shift, ones, flip in flips])
    return (nodes.select("fp", F.explode(flips).alias("e"))
            .select("e.seg", F.expr("(shiftrightunsigned(fp, e.shift) & e.ones) ^ e.flip").alias("key"), "fp"))


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _block_links(bits: int):
    def run(table: pa.Table) -> pa.Table:
        fp, probe = table.column("fp").to_numpy().view(np.uint64), table.column("probe").to_numpy(False).astype(bool)
        base, asked = np.unique(fp[~probe]), np.unique(fp[probe])
        group = np.arange(len(base))         # table entries connected so far
        a, b = [], []
        for lo in range(0, len(asked), 512):
            near = np.bitwise_count(asked[lo:lo + 512, None] ^ base[None, :]) <= bits
            for row in np.flatnonzero(near.any(1)):
                hit = np.flatnonzero(near[row])
                roots, first = np.unique(group[hit], return_index=True)
                a += [asked[lo + row]] * len(roots)
                b += base[hit[first]].tolist()
                if len(roots) > 1:
                    group[np.isin(group, roots)] = roots[0]
        return pa.table({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})
    return run


def links(nodes: DataFrame, bits: int) -> DataFrame:
    """(a, b) between distinct fingerprints at most ``bits`` bits apart, whose components are those of all such pairs."""
    segments = plan(nodes.count(), bits)
    base, balls = _entries(nodes, segments, False), _entries(nodes, segments, True)
    sizes = base.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = stored(sizes, "hot-segments")
    cold = base.join(hot.select("seg", "key"), ["seg", "key"], "left_anti")
    other = cold.select("seg", "key", F.col("fp").alias("other"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= bits
    same = cold.join(other, ["seg", "key"]).where(F.col("fp") < F.col("other")).where(close)
    near = balls.join(other, ["seg", "key"]).where(close)
    found = same.unionByName(near).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    # blocks of a hot value: table block i against lookup block j
    asked = balls.select("seg", "key", "fp").unionByName(base)
    lookups = asked.join(hot, ["seg", "key"])
    counts = lookups.groupBy("seg", "key").agg(F.count("*").alias("asked")).join(hot, ["seg", "key"])
    grid = stored(counts.select("seg", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"),
                                F.ceil(F.col("asked") / PROBES).cast("int").alias("cols")), "hot-grid")

    def part(n):
        return F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    tables = (base.join(grid, ["seg", "key"]).withColumn("i", part("rows")).withColumn("j", every("cols"))
              .select("seg", "key", "i", "j", "fp", F.lit(False).alias("probe")))
    probes = (asked.join(grid, ["seg", "key"]).withColumn("j", part("cols")).withColumn("i", every("rows"))
              .select("seg", "key", "i", "j", "fp", F.lit(True).alias("probe")))
    dense = (tables.unionByName(probes).groupBy("seg", "key", "i", "j")
             .applyInArrow(_block_links(bits), "a long, b long"))
    return found.unionByName(dense).where("a <> b").distinct()


def groups(docs: DataFrame, words: int = 5, bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) per row: component_id is the smallest doc_id reachable over links."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    joined = components(links(nodes.select("fp"), bits))
    whole = joined.join(nodes, joined.node == nodes.fp)
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = joined.join(least, "root").select(F.col("node").alias("fp"), F.col("component_id").alias("least"))
    named = stored(nodes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")),
                   "fingerprint-components")
    return rows.join(named, "fp")


def one_per_group(docs: DataFrame, words: int = 5, bits: int = 3) -> DataFrame:
    """The document of each group with the smallest id, with its columns.

    Rows are told by their id: an id stays with all its rows if it names the group of any.
    """
    stays = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    name = fresh(docs, "_dropped")
    dropped = stored(groups(docs.select("doc_id", "text"), words, bits).where("doc_id is not null")
                     .groupBy(F.col("doc_id").alias(name)).agg(stays.alias("_stays")).where("not _stays").select(name), "near-copies")
    return docs.join(dropped, F.col("doc_id") == F.col(name), "left_anti")
