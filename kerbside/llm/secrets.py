"""Secret scans: fixed shapes, and a battery of randomness tests under false-discovery control.

Base spans follow three shapes (assignments, access keys, long hex runs). The battery looks at
every other run of key-like signs that no plain word explains. Its encoding is inferred (decimal,
hex, base32, base64, letters and digits), each sign becomes its place in that alphabet, and three
tests ask whether the places look drawn evenly: a chi-squared test of uniformity over slices of
the alphabet, a runs test around the middle, and a serial-correlation test of neighbours; a
fourth counts repeated signs. Their p-values, combined by Fisher's sum, say how random it looks.

Plain text looks random now and then, and more often the shorter it is. So the null is measured,
not assumed: the corpus's plain words of the same length class go through the same battery, each
distinct word once. A token's discovery p-value is the share of these words, read in its alphabet,
that look at least as random, mixed with a prior in proportion to the evidence: the prior weighs as
much as ``PRIOR_WORDS`` words, of which the share ``PRIOR`` would pass the battery at ``LEVEL``. The
same rule holds for every size of corpus; the more words, the less the prior says. Benjamini-Hochberg
over the distinct tokens of a class of length and encoding picks the tokens to report.

Letter runs of one case are words as a rule, and may be keys: they are a group of their own, read in
the alphabet of 26 letters, against the words that several rows hold, with a prior by length, as the
battery tells short words from keys badly. Runs of digits are numbers as a rule, and an even draw of
digits is what order numbers look like: their null are the corpus's own numbers, so one is reported
only if it stands out among them. A run that a base span cuts into is judged by its rest. All tables
are counts per (class, score bin).

A null text counts as empty and has no span; repeated rows are scanned alike; very long texts are
read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")        # the longest run from an AKIA on, if it has 20 signs
HEX = re.compile("[0-9a-f]{24,}")               # maximal runs, if they have 24 signs
SHORTEST = 16
TOKENS = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)
BINS = 100          # of the randomness score
CLASSES = (16, 20, 24, 32, 48, 64, 1 << 62)     # lower bounds of the length classes
LENGTHS = len(CLASSES) - 1
NARROW, WIDE, LETTERS, NUMBERS = range(4)       # groups of encodings, each with all length classes
RATE = 0.01         # share of false discoveries allowed among the reported tokens
LEVEL = 0.05        # of the battery's own p-value, that the prior speaks of
PRIOR = 0.005       # share of plain words that pass the battery at LEVEL, before any is seen
PRIOR_WORDS = 200   # distinct words the prior weighs as much as
# fixed values: the same share for letter runs, by lower bound of length
LETTER_PRIOR = {16: 0.5, 20: 0.4, 24: 0.3, 32: 0.005, 48: 0.005, 64: 0.005}
# alphabets in their natural order (fixed values)
DIGITS, LOW = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"decimal": DIGITS, "hex": DIGITS + "abcdef", "base32": LOW.upper() + "234567",
             "alnum": DIGITS + LOW, "letters": LOW, "base64": LOW.upper() + LOW + DIGITS + "+/-_"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed shapes, ordered by start, then kind."""
    out = []
    if ("=" in text or ":" in text) and any(w in (low := text.lower()) for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def encoding(token: str) -> str:
    """The smallest alphabet that holds the token, upper and lower case hex alike."""
    signs = set(token.rstrip("="))
    for name in ("decimal", "hex", "base32", "alnum"):
        if signs <= set(ALPHABETS[name]) or name in ("hex", "alnum") and signs <= set(ALPHABETS[name].upper()):
            return name
    return "base64"


def _chi2_tail(x: float, k: int) -> float:
    """P(chi-squared with k degrees of freedom > x), by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(token: str, name: str | None = None) -> float:
    """The battery's p-values combined by Fisher's sum: near 0 for ordered tokens, larger for random ones."""
    name = name or encoding(token)
    alphabet = ALPHABETS[name]
    body = token.rstrip("=")
    if name in ("hex", "alnum", "letters") and not set(body) <= set(alphabet):
        body = body.lower()
    x = np.array([alphabet.index(c) for c in body])
    n, size = len(x), min(len(alphabet), 64)
    x = np.minimum(x, size - 1)
    slices = max(2, min(8, n // 4))
    seen = np.bincount(x * slices // size, minlength=slices)
    share = np.bincount(np.arange(size) * slices // size, minlength=slices) / size
    p1 = _chi2_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), slices - 1)
    above = x >= size // 2
    a, b = int(above.sum()), int((~above).sum())
    if a and b:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        p2 = math.erfc(abs(runs - mean) / math.sqrt(2 * var))
    else:
        p2 = 0.0
    d = x - x.mean()
    total = float((d * d).sum())
    p3 = math.erfc(abs(float((d[1:] * d[:-1]).sum()) / total + 1 / n) * math.sqrt(n / 2)) if total else 0.0
    # letters of words: their places repeat, while random signs seldom do
    same = n - len(set(body))
    expected = n - size * (1 - (1 - 1 / size) ** n)
    p4 = 0.5 * math.erfc((same - expected) / math.sqrt(2 * max(1.0, expected)))
    s = -sum(math.log(max(p, 1e-12)) for p in (p1, p2, p3, p4))
    return math.exp(-s) * (1 + s + s * s / 2 + s ** 3 / 6)      # chi-squared tail of Fisher's sum


def length_class(n: int) -> int:
    return max(i for i, low in enumerate(CLASSES[:-1]) if n >= low)


def _bin(score: float) -> int:
    """Bin of a score on a scale of logarithms, 0 the least random."""
    return int(np.clip((math.log10(max(score, 1e-10)) + 10) * BINS / 10, 0, BINS - 1))


@lru_cache(50_000)
def looks(token: str, name: str) -> tuple[int, int]:
    """(class of encoding and length, bin of the score)."""
    group = {"base64": WIDE, "letters": LETTERS, "decimal": NUMBERS}.get(name, NARROW)
    return length_class(len(token)) + LENGTHS * group, _bin(randomness(token, name))


def _key(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode()) >> 1


def plain(token: str) -> bool:
    return token.isalpha() and (token.islower() or token.isupper() or token.istitle())


def candidates(text: str, taken: list[tuple[int, int, int]]):
    """(start, end, whether it is a plain word) of key-like runs, without what base spans take of them."""
    for m in TOKENS.finditer(text):
        at, end = m.span()
        for s, _, e in taken:
            if s < end and at < e:
                if s - at >= SHORTEST:
                    yield at, s, plain(text[at:s])
                at = max(at, e)
        if end - at >= SHORTEST:
            yield at, end, plain(text[at:end])


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base (kind, start, end), found (start, end, class, bin, key), plain (class, bin, key).

    ``plain`` holds the row's distinct plain words: together they are the null of the whole corpus.
    ``key`` tells distinct tokens and words.
    """
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    run_ = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("class", pa.int32()), ("bin", pa.int32()),
                      ("key", pa.int64())])
    cell = pa.struct([("class", pa.int32()), ("bin", pa.int32()), ("key", pa.int64())])

    def run(batches):
        for batch in slices(batches):
            base, found, null = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                tokens, words = [], set()
                for s, e, word in candidates(text, spans):
                    token = text[s:e]
                    name = encoding(token)
                    if word:
                        # a plain word is natural text in its own alphabet and in the widest one
                        key = _key(token)
                        words.update((*looks(token, n), key) for n in (name, "base64", "letters"))
                        name = "letters"
                    c, b = looks(token, name)
                    if name == "decimal":
                        words.add((c, b, _key(token)))       # numbers are each other's null
                    tokens.append({"start": s, "end": e, "class": c, "bin": b, "key": _key(token)})
                found.append(tokens)
                null.append([{"class": c, "bin": b, "key": k} for c, b, k in words])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(run_)),
                 pa.array(null, pa.list_(cell))], names=["doc_id", "base", "found", "plain"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, base array<struct<start long, kind int, end long>>, "
             "found array<struct<start long, end long, class int, bin int, key long>>, "
             "plain array<struct<class int, bin int, key long>>")


def prior(c: int, b: int) -> float:
    """Share of plain words of class ``c`` taken to look as random as bin ``b``, before any is seen."""
    if b < _bin(LEVEL):
        return 1.0
    group, length = divmod(c, LENGTHS)
    return LETTER_PRIOR[CLASSES[length]] if group == LETTERS else PRIOR


def _cut(c: int, tokens: dict[tuple[int, int], int], plain: dict[tuple[int, int], int], rate: float) -> int:
    """The lowest bin of class ``c`` that is reported (BINS if none)."""
    n_plain = sum(n for (k, _), n in plain.items() if k == c)
    n_tokens = sum(n for (k, _), n in tokens.items() if k == c)
    best, above, null = BINS, 0, 0
    for b in range(BINS - 1, -1, -1):
        above += tokens.get((c, b), 0)
        null += plain.get((c, b), 0)
        p = (null + PRIOR_WORDS * prior(c, b)) / (n_plain + PRIOR_WORDS)
        if above and p <= rate * above / n_tokens:
            best = b
    return best


def cut_points(tokens: dict[tuple[int, int], int], plain: dict[tuple[int, int], int], rate: float = RATE) -> list[int]:
    """Per class the lowest bin reported, Benjamini-Hochberg over its distinct tokens.

    Classes are the lengths of the narrow encodings, then those of base64.
    """
    return [_cut(c, tokens, plain, rate) for c in range(2 * LENGTHS)]


def other_cuts(tokens: dict[tuple[int, int], int], plain: dict[tuple[int, int], int], rate: float = RATE) -> list[int]:
    """The same for letter runs of one case, then numbers, whose classes follow those of ``cut_points``."""
    return [_cut(c, tokens, plain, rate) for c in range(2 * LENGTHS, 4 * LENGTHS)]


def find(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per row of ``docs``: doc_id, spans (start, kind, end), kind one of assign, access, hex, random."""
    seen = stored(scan(docs), "secret-scan")

    def counts(column):
        """Distinct tokens or words per (class, bin); of letter runs only words that several rows hold are a null."""
        cells = (seen.select(F.explode(column).alias("c")).groupBy("c.class", "c.bin", "c.key").agg(F.count("*").alias("rows")))
        if column == "plain":
            cells = cells.where((F.floor(F.col("class") / LENGTHS) != LETTERS) | (F.col("rows") > 1))
        return {(r["class"], r["bin"]): r["n"] for r in
                cells.groupBy("class", "bin").agg(F.count("*").alias("n")).collect()}     # classes x bins at most

    tokens, words = counts("found"), counts("plain")
    cuts = F.array(*[F.lit(c) for c in cut_points(tokens, words, rate) + other_cuts(tokens, words, rate)])
    random = F.transform(F.filter("found", lambda t: t.bin >= F.element_at(cuts, t["class"] + 1)),
                         lambda t: F.struct(t.start.alias("start"), F.lit(len(KINDS)).alias("kind"), t.end.alias("end")))
    return seen.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def joined(spans):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "random")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")
