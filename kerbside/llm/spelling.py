"""Spelling variants: words one edit apart, found by blocked Gram matrices of their letter counts.

A word is its vector of letter counts. One edit changes the squared distance of two such vectors by
at most two (one letter more or less: one; one letter for another: two, or none where both words have
the letter), so near words are at distance two or less, with lengths that differ by one at most.
The distances of a block of words are NumPy matrix products; words of one length meet those of the
same and of the next length, and what is left is compared letter by letter.

Which words share a block: the letters fall into four parts, and one edit touches two parts at most,
so near words agree in all counts of two parts. Each word goes to six blocks, one per two parts,
named by its counts in them; the products take the counts of the other two parts. A pair is reported
by the first block its words share, so none is lost and none comes twice. A block of more than
``TILE`` words is cut into tiles by a hash of the word, and every two tiles meet in a task of their
own: no block is held whole, and its products are spread over the cluster.

Words are counted per task before the shuffle, so a frequent word or a hot source is a count. Forms
lead from word to word with counts that grow ``ratio`` times, so a chain is short; roots are found by
doubling jumps, with a join per round.

Null and empty texts have no words; a null id counts as empty text; repeated rows count each time;
words of equal count are ordered by code point; very long words and texts are taken whole; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fits_broadcast, slices, stored

LETTERS = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]     # after A-Z are lower-cased
PARTS = 4
AGREE = list(combinations(range(PARTS), 2))      # the parts whose counts name a block
PART_OF = np.array([ord(c) % PARTS for c in LETTERS])
OTHERS = [np.flatnonzero(~np.isin(PART_OF, agree)) for agree in AGREE]
TILE = 8192              # words of a block that one task holds at a time, about
CHUNK = 32_768           # rows taken together in a task
SIDE = 1024              # words on each side of a matrix product
SHORT = 64               # letters up to which words are compared in arrays
COUNTED = 100_000        # distinct words a task counts before it passes them on
_NUMBER = np.random.default_rng(11).integers(1, 1 << 62, len(LETTERS), dtype=np.uint64)


# ---- words and their counts ---------------------------------------------------------
def words(df: DataFrame, id_column: str, text: str, least: int, times: int, slips: int | None) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of ``least`` code points, met ``times`` times.

    With ``slips``, the runs of a document whose crc32 of ``<id>:<run>`` is divisible by it have lost
    the code point at that number modulo their length, as by a slip of the keyboard.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = re.compile(f"[a-zÀ-ÿ]{{{least},}}")
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["word", "n"])
            found.clear()
            return out

        for batch in slices(batches):
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not raw:
                    continue
                # bytes lower-case A-Z alone
                own = Counter(run.findall(raw.lower().decode("utf-8", "replace")))
                if slips is None:
                    found.update(own)
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slips == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    found[word] += n
            if len(found) > COUNTED:
                yield flush()
        yield flush()

    columns = df.select(F.col(id_column).cast("string"), F.col(text).cast("binary"))
    return columns.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Vectors:
    """Letter counts and part hashes of a list of words."""

    def __init__(self, found: list[str]):
        self.words = found
        self.length = np.fromiter(map(len, found), np.int64, len(found))
        code = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.letter = np.where(code < 0xC0, code - ord("a"), code - 0xC0 + 26)
        self.row = np.repeat(np.arange(len(found)), self.length)
        counts = np.bincount(self.row * len(LETTERS) + self.letter, minlength=len(found) * len(LETTERS))
        # sums of squares of counts are whole numbers: exact in the smaller type up to 2^24
        kind = np.float32 if self.length.max(initial=0) < 2048 else np.float64
        self.counts = counts.reshape(len(found), len(LETTERS)).astype(kind)
        whole = counts.reshape(len(found), len(LETTERS)).astype(np.uint64)
        self.hashes = np.stack([(whole[:, PART_OF == p] * _NUMBER[PART_OF == p]).sum(1, dtype=np.uint64) for p in range(PARTS)], 1)

    def keys(self) -> np.ndarray:
        """Name of the block of each word for each two parts; equal hashes of both parts give equal names."""
        return np.stack([self.hashes[:, a] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[:, b] for a, b in AGREE], 1).view(np.int64)

    def spelled(self) -> np.ndarray:
        """Letters by place, one more than their number; zero past the end and for long words."""
        out = np.zeros((len(self.words), SHORT + 2), np.uint8)
        start = np.cumsum(self.length) - self.length
        place = np.arange(len(self.row)) - start[self.row]
        fits = (self.length <= SHORT)[self.row]
        out[self.row[fits], place[fits]] = self.letter[fits] + 1
        return out


def blocks(found: DataFrame) -> DataFrame:
    """(agree, key, word, n): a word in its six blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            if batch.num_rows:
                keys = Vectors(batch.column(0).to_pylist()).keys()
                again = np.repeat(np.arange(len(keys)), len(AGREE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(AGREE), dtype=np.int32), len(keys))), pa.array(keys.ravel()),
                     batch.column(0).take(pa.array(again)), batch.column(1).take(pa.array(again))],
                    names=["agree", "key", "word", "n"])

    return found.select("word", "n").mapInArrow(run, "agree int, key long, word string, n long")


def tiled(found: DataFrame, tile: int) -> DataFrame:
    """Blocks with their tiles: rows (agree, key, a, b, tile, word, n), a <= b the tiles that meet there."""
    rows = blocks(found)
    hot = (rows.groupBy("agree", "key").agg(F.count("*").alias("size")).where(F.col("size") > tile)
           .select("agree", "key", F.ceil(F.col("size") / tile).cast("int").alias("tiles")))
    hot = stored(hot, "hot-blocks")
    if fits_broadcast(hot.count(), 32):
        hot = F.broadcast(hot)
    tiles = F.coalesce("tiles", F.lit(1))
    own = rows.join(hot, ["agree", "key"], "left").select(
        "agree", "key", "word", "n", F.pmod(F.xxhash64("word"), tiles).cast("int").alias("tile"), tiles.alias("tiles"))
    meets = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                        lambda t: F.struct(F.least(t, F.col("tile")).alias("a"), F.greatest(t, F.col("tile")).alias("b")))
    return own.select("agree", "key", "tile", "word", "n", F.inline(meets))


# ---- near words inside a block -------------------------------------------------------
def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at:] == b[at + 1:] or a[at + 1:] == b[at + 1:]


class Pairs:
    """Candidate pairs of a chunk, verified as they come."""

    def __init__(self, found: list[str], agree: np.ndarray):
        self.v, self.agree = Vectors(found), agree
        self.letters = self.v.spelled()
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        v = self.v
        same = v.hashes[i] == v.hashes[j]
        shared = np.stack([same[:, a] & same[:, b] for a, b in AGREE], 1)
        here = shared.any(1) & (shared.argmax(1) == self.agree[i])
        i, j = i[here], j[here]
        swap = v.length[i] > v.length[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)           # i is the shorter one
        gap = v.length[j] - v.length[i]
        short = v.length[j] <= SHORT
        a, b = self.letters[i][:, :-1], self.letters[j]
        unlike = a != b[:, :-1]
        replaced = unlike.sum(1) == 1
        width = unlike.shape[1]
        start = np.where(unlike.any(1), unlike.argmax(1), width)    # letters alike from the front
        shifted = (a != b[:, 1:])[:, ::-1]
        end = np.where(shifted.any(1), width - shifted.argmax(1), 0)
        good = short & (gap <= 1) & np.where(gap == 0, replaced, end <= start)
        for k in np.flatnonzero(~short):
            good[k] = one_edit(v.words[i[k]], v.words[j[k]])
        self.left.append(i[good])
        self.right.append(j[good])

    def within(self, rows: np.ndarray, agree: int) -> None:
        """Pairs of a list of rows, by length and the next length."""
        self.between(rows, rows, agree)

    def between(self, one: np.ndarray, two: np.ndarray, agree: int) -> None:
        """Pairs across two lists of rows (or inside one), by adjacent lengths in square blocks."""
        alone = one is two
        by_one, by_two = self.by_length(one), self.by_length(two)
        for n, left in by_one.items():
            for m in (n, n + 1) if alone else (n - 1, n, n + 1):
                right = by_two.get(m)
                if right is None:
                    continue
                for p in range(0, len(left), SIDE):
                    for q in range(p if alone and m == n else 0, len(right), SIDE):
                        i, j = self.close(left[p:p + SIDE], right[q:q + SIDE], agree)
                        if alone and m == n and p == q:
                            i, j = i[i < j], j[i < j]
                        if len(i):
                            self.add(left[p + i], right[q + j])

    def by_length(self, rows: np.ndarray) -> dict[int, np.ndarray]:
        rows = rows[np.argsort(self.v.length[rows], kind="stable")]
        n = self.v.length[rows]
        cut = np.flatnonzero(np.diff(n)) + 1
        return {int(self.v.length[r[0]]): r for r in np.split(rows, cut) if len(r)}

    def close(self, left: np.ndarray, right: np.ndarray, agree: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs whose letter counts are at squared distance two or less, by one product."""
        x, y = (self.v.counts[rows][:, OTHERS[agree]] for rows in (left, right))
        d = x @ y.T
        d *= -2
        d += (x * x).sum(1)[:, None]
        d += (y * y).sum(1)[None]
        return np.nonzero(d <= 2)

    def small(self, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Many small blocks of one padded size at once: a stack of products."""
        width = 1 << int(sizes.max() - 1).bit_length()
        place = np.arange(width)
        real = place < sizes[:, None]
        rows = np.where(real, starts[:, None] + place, starts[:, None])
        x = self.v.counts[rows]
        size = (x * x).sum(2)
        d = size[:, :, None] + size[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        k, i, j = np.nonzero((d <= 2) & real[:, :, None] & real[:, None, :] & (place[:, None] < place))
        if len(k):
            self.add(rows[k, i], rows[k, j])


def near(units: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words one edit apart, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                table = pa.Table.from_batches(held).combine_chunks()
                cut = _starts(table)[-1]
                if cut:
                    yield from _solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if sum(b.num_rows for b in held):
            yield from _solve(pa.Table.from_batches(held).combine_chunks())

    keys = ["agree", "key", "a", "b"]
    placed = units.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "word string, near string, near_n long")


def _starts(table: pa.Table) -> np.ndarray:
    """First row of each block (or pair of tiles) in sorted rows."""
    keys = [table.column(c).to_numpy() for c in ("agree", "key", "a", "b")]
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
    starts = _starts(table)
    sizes = np.diff(np.append(starts, table.num_rows))
    agree, a, b, tile = (table.column(c).to_numpy() for c in ("agree", "a", "b", "tile"))
    found = Pairs(table.column("word").to_pylist(), agree)
    crossed = a[starts] != b[starts]
    for low in (2, 3, 5, 9, 17):        # padded to 2, 4, 8, 16 and 32 rows
        own = np.flatnonzero((sizes >= low) & (sizes <= max(2, 2 * (low - 1))) & ~crossed)
        step = max(1, 200_000 // low ** 2)
        for k in range(0, len(own), step):
            found.small(starts[own[k:k + step]], sizes[own[k:k + step]])
    for k in np.flatnonzero((sizes > 32) | (crossed & (sizes > 1))):
        rows = np.arange(starts[k], starts[k] + sizes[k])
        if crossed[k]:
            found.between(rows[tile[rows] == a[rows[0]]], rows[tile[rows] == b[rows[0]]], int(agree[rows[0]]))
        else:
            found.within(rows, int(agree[rows[0]]))
    if found.left:
        i, j = np.concatenate(found.left), np.concatenate(found.right)
        one, two = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
        yield pa.RecordBatch.from_arrays([word.take(one), word.take(two), n.take(two)], names=["word", "near", "near_n"])


# ---- forms and roots --------------------------------------------------------------------
def roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, jumps doubled each round."""
    hops = max(1, int(math.log(max(1, most), ratio)) + 1)      # counts grow ``ratio`` times a hop
    out = stored(links.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(hops))):
        onward = out.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        out = stored(out.join(onward, F.col("root") == F.col("_at"), "left")
                     .select("word", F.coalesce("_to", "root").alias("root")), "forms")
    return out


def variants(df: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = 7, times: int = 2,
             ratio: int = 10, slips: int | None = None, tile: int = TILE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``df``.

    ``form`` is the near word of largest count (of these the smallest), if that count is ``ratio``
    times the word's own or more; ``root`` is where forms lead, the word itself without one.
    """
    if ratio < 2:
        raise ValueError("counts must grow along a chain of forms: ratio is at least two")
    found = stored(words(df, id_column, text, least, times, slips), "words")
    # the smallest of (-count, word): the largest count, then the first word
    pairs = near(tiled(found, tile)).groupBy(F.col("word").alias("_word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    formed = found.join(pairs, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.n")).alias("form_n"))).alias("_form"))
    formed = stored(formed.select("word", "n", "n_near", "_form.form", "_form.form_n"), "variants")
    most = found.agg(F.max("n")).first()[0] or 1
    ends = roots(formed.where(F.col("form").isNotNull()), most, ratio).withColumnRenamed("word", "_word")
    return formed.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
