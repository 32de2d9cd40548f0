"""Best-fit packing after Martello-Toth dominance reduction.

Documents become token ids with an end id; only those longer than a sequence are cut. Lengths are
whole numbers up to the sequence length, so an instance is its table of counts per length, at
most ``size`` rows however many documents there are. On that table, sets of items that dominate
every other choice for the largest open item are fixed for good (the item alone, with an exact
partner, with the largest fitting partner if no three fit beside it and no pair is larger), as
often as the counts allow. The rest is packed best-fit by falling length, whole runs of equal
bins at a time; if that takes more sequences than the tokens need at least, the fullest patterns
(subset sums beside the largest open length) are tried too, and the fewer sequences count. The plan
is a list of patterns (lengths in a bin, number of such bins).

Pieces get their places by joining their number within their length to the patterns' ranges. They
are numbered by length and salt, with offsets per salt and as many salts as a length's count asks
for, so a length that holds a third of all pieces is not one task's.

A null text counts as empty: one piece, the end id alone. Rows are packed one by one, repeated
ones too; ties in length go by doc_id, piece and content. An empty table gives no rows; extra
columns are ignored; texts are read whole.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored

SIZE = 2048
END_ID = 0
SHARE_ROWS = 256          # pieces of one length numbered together, at least; more once there are more than
MOST_SHARES = 1 << 16     # this many such shares
# texts of these signs only are cut at white space; others go to the tokenizer whole
PLAIN = re.compile("[\\t\\n\\r -~À-ÖØ-öø-įĲ-ſ]*")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
ENDS = frozenset(".,;:!?")     # signs that end a word and stand alone after letters


def byte_signs() -> dict[int, str]:
    """The sign of each byte in a byte-level vocabulary: itself if it prints, else the next free one."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of a text as little-endian bytes; words are looked up, new ones go through the model."""

    LIMIT = 120_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
                                  or "(?!)")
        self.model, self.signs = self.tokenizer.model, byte_signs()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def parts(self, parts: Iterable[str]) -> bytes:
        """Ids of parts without blanks; what prints in ASCII is its own sign."""
        ids = [t.id for part in parts
               for t in self.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(self.signs))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, w: str) -> bytes:
        found = self.old.get(w)
        if found is None:
            stem = w[:-1]
            if w[-1] in ENDS and stem.isalpha():             # the sign is a part of its own
                found = self.young.get(stem) or self.old.get(stem) or self.parts((stem,))
                found += self.young.get(w[-1]) or self.word(w[-1])
            else:
                found = self.parts((w,) if w.isalpha() else PARTS.findall(w))
        if len(self.young) > self.LIMIT:
            self.old, self.young = self.young, {}
        self.young[w] = found
        return found

    def encode(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text) or self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known, word = self.young, self.word
        out = []
        for w in text.lower().split():
            b = known.get(w)
            if b is None:
                b = word(w)
                known = self.young
            out.append(b)
        return b"".join(out)


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) per piece; ids as little-endian 32-bit numbers, if asked for."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        encoder = Encoder(path)
        for batch in slices(batches):
            out, held = [[] for _ in names], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    for column, v in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part),
                                               part if with_ids else None)):
                        column.append(v)
                    held += len(part)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)
                    out, held = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def reduce_instance(counts: dict[int, int], size: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed patterns, what is left): Martello-Toth dominance with sets of at most three items."""
    left = {w: n for w, n in counts.items() if n}
    order = sorted(left)
    fixed = []

    def take(pattern, times):
        fixed.append((pattern, times))
        for w in set(pattern):
            left[w] -= times * pattern.count(w)
            if not left[w]:
                del left[w]
                order.pop(bisect.bisect_left(order, w))

    def best_pair(room):
        """Largest sum of two open items within ``room``."""
        i, j, best = 0, len(order) - 1, 0
        while i <= j:
            s = order[i] + order[j]
            if s > room:
                j -= 1
            elif i == j and left[order[i]] < 2:
                break
            else:
                best = max(best, s)
                i += 1
        return best

    def three_fit(room):
        """Whether the three smallest open items fit into ``room``."""
        n = total = 0
        for w in order[:3]:
            k = min(3 - n, left[w])
            n, total = n + k, total + k * w
        return n == 3 and total <= room

    for w in sorted(left, reverse=True):
        while w in left:
            room = size - w
            at = bisect.bisect_right(order, room)
            k = order[at - 1] if at else None
            if k == w and left[w] < 2:
                k = order[at - 2] if at > 1 else None
            if k is None:
                take((w,), left[w])                                   # nothing fits beside it
                continue
            times = left[w] // 2 if k == w else min(left[w], left[k])
            if k == room or k >= best_pair(room) and not three_fit(room):
                # an exact partner, or one that no pair can beat where no three fit
                if w == k and 3 * w <= size:
                    break                                             # several of its own size fit
                take((w, k), times)
                continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of best-fit decreasing, runs of equal bins at a time."""
    bins: dict[int, list[list]] = defaultdict(list)      # room left -> [pattern, number of bins]
    rooms: list[int] = []

    def put(pattern, times):
        room = size - sum(pattern)
        if room not in bins:
            bisect.insort(rooms, room)
        for group in bins[room]:
            if group[0] == pattern:
                group[1] += times
                return
        bins[room].append([pattern, times])

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect.bisect_left(rooms, w)
            if at == len(rooms):
                per = size // w
                if n >= per:
                    put((w,) * per, n // per)
                if n % per:
                    put((w,) * (n % per), 1)
                break
            room = rooms[at]
            pattern, times = bins[room].pop()
            per = room // w                                # the fullest bin stays the fullest while it fits
            whole = min(times, n // per)
            if whole:
                put(pattern + (w,) * per, whole)
                n -= whole * per
                times -= whole
            if times and n and n < per:
                put(pattern + (w,) * n, 1)
                n, times = 0, times - 1
            if times:
                bins[room].append([pattern, times])
            elif not bins[room]:
                del bins[room]
                rooms.remove(room)
    return [(p, t) for groups in bins.values() for p, t in groups]


def fullest(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that fill up the room beside the largest open length as far as any sum of open lengths can.

    Reachable sums are the bits of whole numbers, one per length; a pattern is used until one of
    its lengths runs out.
    """
    left = {w: n for w, n in counts.items() if n}
    out = []
    for w in sorted(left, reverse=True):
        while w in left:
            left[w] -= 1
            room, mask = size - w, (1 << size - w + 1) - 1
            lengths = [x for x in sorted(left) if x <= room and left[x]]
            reach = [1]
            for x in lengths:
                sums, n, step = reach[-1], min(left[x], room // x), 1
                while n:                                  # counts by halves: 1, 2, 4 and the rest
                    k = min(step, n)
                    sums |= sums << k * x & mask
                    n, step = n - k, 2 * step
                reach.append(sums)
            total, pattern = reach[-1].bit_length() - 1, [w]
            for i in range(len(lengths) - 1, -1, -1):     # as many of the larger lengths as possible
                x = lengths[i]
                k = next(k for k in range(min(left[x], total // x), -1, -1) if reach[i] >> total - k * x & 1)
                pattern += [x] * k
                total -= k * x
            left[w] += 1
            used = Counter(pattern)
            times = min(left[x] // k for x, k in used.items())
            out.append((tuple(pattern), times))
            for x, k in used.items():
                left[x] -= k * times
                if not left[x]:
                    del left[x]
    return out


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Reduce, then best-fit what is left; if that is not the least thinkable, the fullest patterns may be fewer."""
    fixed, left = reduce_instance(counts, size)
    rest = best_fit(left, size)
    if sum(t for _, t in rest) > -(-sum(w * n for w, n in left.items()) // size):
        rest = min(rest, fullest(left, size), key=lambda found: sum(t for _, t in found))
    return fixed + rest


def slots(patterns) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, past, per, sequence, offset): numbers first to past of a length go, ``per`` to a bin."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for w in sorted(set(pattern), reverse=True):
            per = pattern.count(w)
            out.append((w, taken[w], taken[w] + per * times, per, sequence, offset))
            taken[w] += per * times
            offset += per * w
        sequence += times
    return out


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (doc_id, piece, length, ids_crc32 and more) with sequence_id and offset.

    The table of counts per length (at most ``size`` rows) and the plan go through the driver;
    pieces do not. The plan has at most a few patterns per length.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = slots(plan(counts, size))
    places = spark.createDataFrame(rows or [(0, 0, 0, 1, 0, 0)],
                                   "length long, first long, past long, per long, sequence long, at long")
    # each length has shares by its own count, so that no group of rows stands out
    share = max(SHARE_ROWS, sum(counts.values()) // MOST_SHARES)
    shares = spark.createDataFrame([(w, -(-n // share)) for w, n in counts.items()] or [(0, 1)], "length long, _shares long")
    salted = cut.join(F.broadcast(shares), "length").withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_shares"))).drop("_shares")
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_salt", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = (salted.withColumn("_k", number).join(before, ["length", "_salt"])
                .withColumn("_k", F.col("_k") + F.col("_before") - 1))
    place = F.col("_k") - F.col("first")
    return (numbered.join(F.broadcast(places), "length")
            .where((F.col("_k") >= F.col("first")) & (F.col("_k") < F.col("past")))
            .withColumn("sequence_id", F.col("sequence") + F.expr("(_k - first) div per"))
            .withColumn("offset", F.col("at") + place % F.col("per") * F.col("length"))
            .select(*[c for c in cut.columns if c not in ("sequence_id", "offset")], "sequence_id", "offset"))


def packed(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Every piece of ``docs`` with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(pieces(docs, path, size, end_id, with_ids=False).drop("ids"), "pieces"), size)


def sequences(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves; a sequence's pieces fit in ``size`` ids."""
    placed = pack(stored(pieces(docs, path, size, end_id), "pieces"), size)
    return (placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p.ids)).alias("ids")))
