"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other parameters has the
same template. A number or name of several words ("twenty one", "New York") is one placeholder. A
capitalised word inside a sentence is a name; at the beginning of one it is if the corpus does not hold
it in lower case (``COMMON`` words at most do: counted over all texts, and a bound on what tasks hold). Windows of ``window`` template tokens of the benchmark are hash-joined with those
of the documents. A window of placeholders alone says nothing by its template: it is met word for
word, or by its template at its distance from the nearest window with a word. A document's windows are looked up in a bitmap of fixed size first (built from
the benchmark's hashes), so that only possible hits are shuffled; the join compares hashes and the
window's literal words decide. Matches on one alignment (document position minus item position)
are put together. A window whose original tokens are those of the item counts in any case; another
one only if its slots agree with what most places of the alignment say, that is, each benchmark
value is replaced by the value that stands at more than half of its places. A document holds an item if the windows found cover
``share`` of the item's or at least ``run`` of them.

Null and empty texts hold nothing; items without words are ignored; an item shorter than a window
is one window of its own. Repeated rows are judged alike. Empty tables give empty results; extra
columns are ignored (or kept, by ``clean_documents``). Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fresh, slices, stored

WINDOW = 8
SHARE = 0.5         # of an item's windows
RUN = 6             # windows, thirteen words in a row
CHUNK = 500_000     # signs of the texts coded at a time
BITMAP_BITS = 24    # 2 MB, whatever the benchmark's size
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|\x02")
CAPITAL = "A-ZÀ-ÖØ-Þ"
# a capitalised word after a word and one space, so that it begins no sentence
NAME_AT = re.compile(rf"[{CAPITAL}](?<=[^\W_] [{CAPITAL}])[^\W\d_{CAPITAL}]+(?![^\W\d_])")
# one that may begin a sentence or a line: a name if its lower-case form is no common word
# (the capital comes first in the pattern: it is found fast, and what stands before it is looked at then)
START_AT = re.compile(rf"[{CAPITAL}](?:(?<=[.!?:;] [{CAPITAL}])|(?<=\n[{CAPITAL}])|(?<![\s\S][{CAPITAL}]))"
                      rf"[^\W\d_{CAPITAL}]+(?![^\W\d_])")
COMMON = 1 << 17    # words met in lower case that count as common, at most
COMMON_CHARS = 32   # of such a word
# fixed values: units of measure and currency, and number words
UNITS = frozenset("mm cm m km mg g kg t ml l s sec second seconds min minute minutes h hour hours day days week weeks "
                  "month months year years inch inches ft foot feet mile miles yard yards lb lbs pound pounds oz "
                  "dollar dollars euro euros cent cents percent kph mph hz khz mhz watt watts volt volts".split())
NUMBERS = frozenset("one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty "
                    "seventy eighty ninety hundred thousand million".split())
NUM, NAME, UNIT = "\x01num", "\x01name", "\x01unit"


def common_words(texts: DataFrame, most: int = COMMON) -> frozenset[str]:
    """The words that the column ``text`` holds in lower case between blanks, the most frequent levels of ``most``."""
    def run(batches):
        found = Counter()

        def flush():
            words = [w for w in found if len(w) <= COMMON_CHARS and w.isalpha() and w.islower()]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[w] for w in words], pa.int64())],
                                             names=["word", "n"])
            found.clear()
            return out

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                found.update((text or "").split())
            if len(found) > 300_000:
                yield flush()
        yield flush()

    counts = texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    levelled = stored(counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "lower-case-words")
    sizes = {r["level"]: r["words"] for r in levelled.groupBy("level").agg(F.count("*").alias("words")).collect()}     # a few hundred
    least = None
    for level in sorted(sizes, reverse=True):
        most -= sizes[level]
        if most < 0:
            break
        least = level
    return frozenset() if least is None else frozenset(
        levelled.where(F.col("level") >= least).select("word").toArrow().column("word").to_pylist())


def template(text: str, common: frozenset[str] | None = None) -> tuple[list[str], list[str]]:
    """(template tokens, original tokens); words of one number, or of one name, are one token.

    ``common``: the words that begin a sentence without being names; None: no such word is a name.
    """
    names = {m.start() for m in NAME_AT.finditer(text)}
    if common is not None:
        names |= {m.start() for m in START_AT.finditer(text) if m[0].lower() not in common}
    out, original = [], []
    before = -1
    for m in TOKEN.finditer(text):
        w = m[0].lower()
        if w == "\x02":
            continue
        kind = NAME if m.start() in names else NUM if w[0].isdigit() or w in NUMBERS else None
        joins = out and m.start() == before + 1 and text[before] in " -" and (
            kind == NAME == out[-1] or kind == NUM == out[-1] and w in NUMBERS)
        before = m.end()
        if joins:
            original[-1] += " " + w
            continue
        original.append(w)
        if kind:
            out.append(kind)
        elif w in UNITS and out and out[-1] == NUM:
            out.append(UNIT)
        else:
            out.append(w)
    return out, original


# texts of these signs only are cut and coded as bytes: every sign beyond ASCII among them is a letter
PLAIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-įĲ-ſ]*")
BASE, WHOLE = 0x9E3779B97F4A7C15, (1 << 64) - 1
BACK = pow(BASE, -1, 1 << 64)
MIX = np.uint64(BASE)
LETTER, DIGIT, MARK = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[list(b"abcdefghijklmnopqrstuvwxyz")] = LETTER
KINDS[128:] = LETTER
KINDS[list(b"0123456789")] = DIGIT
KINDS[2] = MARK
JOINS = np.zeros(256, bool)
JOINS[list(b".,:/")] = True


def _code(token: str) -> int:
    """Signed 64-bit code of a template token: its bytes as digits to the base BASE, mixed."""
    h = 0
    for b in reversed(token.encode("utf-8", "surrogatepass")):
        h = (h * BASE + b) & WHOLE
    h = (h ^ len(token.encode("utf-8", "surrogatepass"))) * BASE & WHOLE
    h ^= h >> 29
    return h - (1 << 64) if h >> 63 else h


UNIT_CODES, NUMBER_CODES = [np.array(sorted(_code(u) for u in words), np.int64) for words in (UNITS, NUMBERS)]
NUM_CODE, NAME_CODE, UNIT_CODE = _code(NUM), _code(NAME), _code(UNIT)


def marked(text: str, common: frozenset[str] | None = None) -> str:
    """``text`` with one sign in place of each name word."""
    if "\x02" in text:
        text = text.replace("\x02", " ")
    made = NAME_AT.sub("\x02", text) if NAME_AT.search(text) else text
    if common is not None:
        made = START_AT.sub(lambda m: m[0] if m[0].lower() in common else "\x02", made)
    return made


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0 to n - 1, and of its inverse."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, BACK, np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def coded(texts: list[str], common: frozenset[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the tokens of all texts, where each text's end); units are not told from words yet."""
    codes, counts = [], np.zeros(len(texts), np.int64)
    lines, place = [], []
    order = np.zeros(0, np.int64)
    for k, whole in enumerate(texts):
        text = marked(whole, common)
        if PLAIN.fullmatch(text):
            lines.append(text.lower().encode())
            place.append(k)
        else:
            own = [_code(t) for t in template(whole.replace("\x02", " "), common)[0]]
            codes.append(np.array(own, np.int64))
            counts[k] = len(own)
            order = np.concatenate([order, np.full(len(own), k)])
    if lines:
        raw = np.frombuffer(b"\n".join(lines), np.uint8)
        kind = KINDS[raw]
        if len(raw) > 2:      # a sign between two digits belongs to the number
            inner = JOINS[raw[1:-1]] & (kind[:-2] == DIGIT) & (kind[2:] == DIGIT)
            kind[1:-1][inner] = DIGIT
        change = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == MARK), [True]])
        start = np.flatnonzero(change[:-1] & (kind != 0))
        end = np.flatnonzero(change[1:] & (kind != 0)) + 1
        n = 1 << max(16, int(len(raw) - 1).bit_length())
        up, down = _powers(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * up[:len(raw)], dtype=np.uint64)])
        h = ((sums[end] - sums[start]) * down[start] ^ (end - start).astype(np.uint64)) * MIX
        h = (h ^ h >> np.uint64(29)).view(np.int64)
        word, mark = np.isin(h, NUMBER_CODES), kind[start] == MARK
        h[(kind[start] == DIGIT) | word] = NUM_CODE
        h[mark] = NAME_CODE
        # a number word after a number, or a name after a name, with one blank or hyphen between, goes on with it
        beside = (start[1:] - end[:-1] == 1) & np.isin(raw[end[:-1]], (32, 45))
        first = np.ones(len(h), bool)
        first[1:] = ~(beside & (mark[1:] & mark[:-1] | word[1:] & (h[:-1] == NUM_CODE)))
        h, start = h[first], start[first]
        edges = np.cumsum([len(x) + 1 for x in lines])
        of = np.searchsorted(edges, start, side="right")
        counts[place] = np.bincount(of, minlength=len(lines))
        codes.append(h)
        order = np.concatenate([order, np.array(place)[of]])
    flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    if len(lines) not in (0, len(texts)):
        flat = flat[np.argsort(order, kind="stable")]
    return flat, np.cumsum(counts)


def _hashes(codes: np.ndarray, window: int, ends: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every window of ``window`` codes; ``ends``: where each of several texts ends.

    A unit is one that follows a number of its own text.
    """
    after = np.flatnonzero(codes[:-1] == NUM_CODE) + 1
    if ends is not None:
        after = after[~np.isin(after, ends)]
    if len(after):
        codes = codes.copy()
        codes[after[np.isin(codes[after], UNIT_CODES)]] = UNIT_CODE
    a = codes.view(np.uint64)
    n = max(0, len(a) - window + 1)
    out = np.zeros(n, np.uint64)
    for k in range(window):
        out = (out ^ a[k:k + n]) * MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _bare(tokens: list[str]) -> bool:
    return all(t[0] == "\x01" for t in tokens)


def _beside(tokens: list[str], i: int, n: int, reach: tuple[int, int]):
    """Distances from the window at ``i`` to those of placeholders alone that it borders on, at most ``reach`` back and on."""
    back, on = reach
    if not _bare(tokens[i:i + 1]) and _bare(tokens[i + 1:i + n]):
        for k in range(1, min(on, len(tokens) - n - i) + 1):
            if not _bare(tokens[i + k + n - 1:i + k + n]):
                break
            yield k
    if not _bare(tokens[i + n - 1:i + n]) and _bare(tokens[i:i + n - 1]):
        for k in range(1, min(back, i) + 1):
            if not _bare(tokens[i - k:i - k + 1]):
                break
            yield -k


def _anchored(h: int, k: int) -> int:
    """Hash of the window of placeholders ``k`` places from a window of hash ``h``."""
    x = ((h ^ k) & WHOLE) * BASE & WHOLE
    x ^= x >> 29
    return x - (1 << 64) if x >> 63 else x


def _own(original: list[str], n: int) -> list[int]:
    """Hashes of the windows of the original tokens."""
    return _hashes(np.array([_code(t) for t in original], np.int64), n).tolist()


def benchmark_windows(items: DataFrame, window: int = WINDOW, common: frozenset[str] | None = None) -> DataFrame:
    """(item_id, pos, hash, look, far, bare, tokens, slots, windows) of each item; windows: how many the item has.

    look: hash of the template; hash differs for windows of placeholders alone: they have a row with
    the hash of their original tokens (bare) and one per neighbour at a distance ``far``.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens, original = template((text or "").replace("\x02", " "), common)
                if not tokens:
                    continue
                n = min(window, len(tokens))
                hashes = _hashes(np.array([_code(t) for t in tokens], np.int64), n).tolist()
                for i, h in enumerate(hashes):
                    bare = _bare(tokens[i:i + n])
                    own = _own(original[i:i + n], n)[0] if bare else h
                    made = [(i, own, 0, bare)] + [(i + k, _anchored(h, k), k, False)
                                                  for k in _beside(tokens, i, n, (len(tokens), len(tokens)))]
                    rows += [(item, j, x, hashes[j], k, b, tokens[j:j + n], original[j:j + n], len(hashes))
                             for j, x, k, b in made]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 9,
                 (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.string()),
                  pa.list_(pa.string()), pa.int32()))],
                names=["item_id", "pos", "hash", "look", "far", "bare", "tokens", "slots", "windows"])
    return items.select("item_id", "text").mapInArrow(
        run, "item_id long, pos int, hash long, look long, far int, bare boolean, tokens array<string>, "
             "slots array<string>, windows int")


def _bitmap(windows: DataFrame) -> bytes:
    """2**BITMAP_BITS bits, set at the low bits of the benchmark's hashes; made of words summed up in Spark."""
    bit = F.col("hash").bitwiseAND((1 << BITMAP_BITS) - 1)
    hashes = windows.select(F.explode(F.array("hash", "look")).alias("hash"))
    words = (hashes.select(F.shiftright(bit, 5).alias("w"), F.expr(f"shiftleft(1L, cast(hash & 31 as int))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())      # at most 2**19 rows of 12 bytes
    out = np.zeros(1 << BITMAP_BITS - 5, np.uint32)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.uint32)
    return out.tobytes()


def possible_hits(docs: DataFrame, bitmap: bytes, window: int, short: list[int], reach: tuple[int, int],
                  common: frozenset[str] | None = None) -> DataFrame:
    """(doc_id, row, at, hash, tokens, slots): windows of documents whose hash is in the bitmap.

    ``short`` are the lengths of items below a window, looked up at their own length; ``reach`` how far
    windows of placeholders lie from a window with a word. ``row`` tells rows with the same doc_id apart.
    """
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, common))

    def run(batches):
        bitmap, common = shared.value
        bits, low = np.frombuffer(bitmap, np.uint32), np.int64((1 << BITMAP_BITS) - 1)

        def listed(h):
            return bits[(h & int(low)) >> 5] >> np.uint32(h & 31) & 1

        def search(texts):
            """(text number, place, hash, length) of possible hits in some texts put end to end."""
            a, ends = coded(texts, common)
            starts = np.concatenate([[0], ends[:-1]])
            for n in [window, *short]:
                h = _hashes(a, n, ends) if len(a) >= n else np.zeros(0, np.int64)
                slot = h & low
                at = np.flatnonzero(bits[slot >> 5] >> (slot & 31).astype(np.uint32) & 1)
                doc = np.searchsorted(ends, at, side="right")
                inside = at + n <= ends[doc]
                for d, i, x in zip(doc[inside].tolist(), (at - starts[doc])[inside].tolist(), h[at[inside]].tolist()):
                    yield d, i, x, n

        for batch in slices(batches):
            rows, ids, texts = [], batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = held = 0
            for k in range(len(texts)):
                held += len(texts[k] or "")
                if held < CHUNK and k < len(texts) - 1:
                    continue
                made = {}
                for d, i, x, n in search([t or "" for t in texts[first:k + 1]]):
                    if d not in made:
                        text = texts[first + d].replace("\x02", " ")
                        row = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1
                        made = {d: (row, *template(text, common), {})}     # one text at a time is kept
                    row, tokens, original, own = made[d]
                    if _bare(tokens[i:i + n]):
                        if n not in own:
                            own[n] = _own(original, n)
                        hits = [(i, own[n][i])]
                    else:
                        hits = [(i, x)] + [(i + k, _anchored(x, k)) for k in _beside(tokens, i, n, reach)]
                    rows += [(ids[first + d], row, j, h, tokens[j:j + n], original[j:j + n])
                             for j, h in hits if listed(h)]
                first, held = k + 1, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6,
                 (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())))],
                names=["doc_id", "row", "at", "hash", "tokens", "slots"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, row long, at int, hash long, tokens array<string>, slots array<string>")


def agreeing(pos: list[int], n: int, slots: dict[int, tuple[str, str]]) -> tuple[int, int]:
    """(windows that count, replacements in them); ``slots``: (benchmark value, document value) by place."""
    votes = Counter(slots.values())
    total = Counter(was for was, _ in slots.values())
    equal = {at for at, (was, now) in slots.items() if was == now}
    good = {at for at, pair in slots.items() if 2 * votes[pair] > total[pair[0]]}
    kept = [p for p in pos if all(at in equal for at in range(p, p + n)) or all(at in good for at in range(p, p + n))]
    return len(kept), len({slots[at] for p in kept for at in range(p, p + n) if at not in equal})


def _agreeing(batches):
    for batch in slices(batches, 50):
        rows = []
        for doc, item, windows, n, pos, found in zip(*[batch.column(k).to_pylist() for k in range(6)]):
            rows.append((doc, item, windows, *agreeing(pos, n, {s["at"]: (s["was"], s["now"]) for s in found})))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5,
             (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
            names=["doc_id", "item_id", "windows", "matched", "changed"])


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, matched, windows, changed) per document and item it holds.

    matched: windows of the item that count on the best alignment; changed: slots with other values in them.
    """
    common = common_words(docs.select("text").unionByName(items.select("text")))
    bench = stored(benchmark_windows(items, window, common), "benchmark-windows")
    short = [r[0] for r in bench.select(F.size("tokens").alias("n")).distinct().collect() if r[0] < window]
    far = bench.agg(F.min("far").alias("back"), F.max("far").alias("on")).first()
    hits = possible_hits(docs, _bitmap(bench), window, short, (-(far["back"] or 0), far["on"] or 0), common)
    b = bench.select("item_id", "pos", "hash", "bare", F.col("tokens").alias("b_tokens"),
                     F.col("slots").alias("b_slots"), "windows")
    met = hits.join(b, "hash").where((F.col("tokens") == F.col("b_tokens")) & (~F.col("bare") | (F.col("slots") == F.col("b_slots"))))
    # (place in the item, benchmark value, document value) of each slot that a window fills
    slots = F.transform(F.zip_with("b_slots", "slots", lambda x, y: F.struct(x.alias("was"), y.alias("now"))),
                        lambda p, i: F.struct((F.col("pos") + i).alias("at"), p.was.alias("was"), p.now.alias("now")))
    # an item's windows are bounded by its length, and so is what an alignment gathers
    found = (met.groupBy("doc_id", "row", "item_id", (F.col("at") - F.col("pos")).alias("shift"))
             .agg(F.collect_set("pos").alias("places"), F.max("windows").alias("windows"), F.max(F.size("slots")).alias("n"),
                  F.collect_set(slots).alias("filled")))
    enough = (F.col("matched") >= run) | (F.col("matched") >= F.col("windows") * share)
    long_enough = found.withColumn("matched", F.size("places")).where(enough)
    held = (long_enough.select("doc_id", "item_id", "windows", "n", "places", F.flatten("filled").alias("filled"))
            .mapInArrow(_agreeing, "doc_id long, item_id long, windows int, matched int, changed int").where(enough))
    return (held.groupBy("doc_id", "item_id")
            .agg(F.max_by(F.struct("matched", "windows", "changed"), F.struct("matched", -F.col("changed"))).alias("s"))
            .select("doc_id", "item_id", "s.matched", "s.windows", "s.changed"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their columns; rows without an id are kept."""
    name = fresh(docs, "_leaked")
    found = stored(leaks(docs, items).select(F.col("doc_id").alias(name)).distinct(), "leaks")
    return docs.join(found, F.col("doc_id") == F.col(name), "left_anti")
