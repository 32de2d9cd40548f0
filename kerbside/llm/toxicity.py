"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored over context windows.

1. The lexicon is learned from labelled training rows: whole words, and stems (shared beginnings
   of inflected words), that toxic documents hold and clean ones do not. Words that clean rows
   hold are known to be clean: they are no term's inflection and no misspelling.
2. Its trie is intersected with Levenshtein automata (with swaps of neighbours) of a distance that
   grows with the term's length. The product is made deterministic state by state, as words ask
   for it, so most words die after three or four transitions.
3. Each match is weighed in a window of words around it: quoted or reported speech, a second
   person, other matches near. Sums of the windows go into a logistic model fitted to the
   training rows with a prior, so that features the labels never show keep their prior sign.

Nulls and empty texts have no match and get the model's lowest score. Repeated rows are scored
alike; long texts are read whole; extra columns pass through (a column named like an output is
replaced). Without any toxic label the lexicon is empty and every score is below one half.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import fresh, labelled, slices, with_columns_from

SAMPLE_ROWS = 20_000      # labelled rows the model is fitted to, at most
THRESHOLD = 0.7
MEMO = 200_000            # words whose match is remembered
WINDOW = 8                # words on either side of a match
STEM = (4, 12)            # shortest and longest beginning that may become a stem
PRECISION = 0.9           # of a term: its share of toxic rows over that plus its share of clean rows
SUPPORT = 4               # toxic training rows that a term occurs in, at least
ALPHA = 0.01              # chance of any wrong term in the lexicon
SHORTEST = 2              # letters of a whole word that may become a term
END = "$"                 # end of a word in the trie
# a word, also with signs in place of letters inside
WORD = re.compile(r"[^\W_]+(?:[*@$!|]+[^\W_]+)*")
# fixed values: marks of quotation, of reported speech and of the second person
QUOTES = re.compile("[\"“”„«»‘’]|\n\\s*\n")     # or the end of a paragraph
CLOSED_BY = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’", "”": "”", "’": "’"}
REPORTED = frozenset("said says say saying called calls call word words term quote quoted quotes wrote writes "
                     "told slur insult insults sagte sagt wort nannte dit mot appelé dijo dice palabra".split())
PERSON = frozenset("you your you're u du dich dir ihr tu te toi vous tú usted ustedes".split())
FEATURES = ["one", "exact", "near", "quoted", "terms", "density", "person", "cluster"]
PRIOR = np.array([-3.0, 1.5, 0.5, -1.0, 0.5, 0.2, 0.3, 0.3])
PRIOR_STRENGTH = np.array([0.1, 0.3, 1, 3, 3, 1, 3, 3])


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...]          # ``idiot$`` is a word, ``idiot`` a stem
    known: frozenset[str]           # words of clean documents
    weights: tuple[float, ...]


def allowance(term: str) -> int:
    """Edits allowed for a term: longer ones bear more, stems less than words."""
    n = len(term.removesuffix(END))
    if term.endswith(END):
        return 2 if n >= 8 else 1 if n >= 5 else 0
    return 1 if n >= 7 else 0


class Automaton:
    """Trie of the lexicon times Levenshtein automata, made deterministic on demand."""

    LIMIT = 200_000     # transitions kept; beyond it they are built anew

    def __init__(self, terms):
        self.terms, self.kids, self.bound, self.final = list(terms), [{}], [0], [None]
        for t, term in enumerate(self.terms):
            node, whole = 0, term.endswith(END)
            k = allowance(term)
            self.bound[0] = max(self.bound[0], k)
            for ch in term.removesuffix(END):
                if ch not in self.kids[node]:
                    self.kids[node][ch] = len(self.kids)
                    self.kids.append({})
                    self.bound.append(0)
                    self.final.append(None)
                node = self.kids[node][ch]
                self.bound[node] = max(self.bound[node], k)
            self.final[node] = (*(self.final[node] or ()), (t, whole, k))
        self.clear()

    def clear(self):
        start = self._close({(0, 0, ""): 0} if self.terms else {})
        self.states, self.next, self.made = {start: 0}, [{}], 0
        self.sets, self.outcome = [start], [self._outcome(start)]

    def _close(self, found):
        """Deletions of lexicon letters; (node, edits, letter owed by a swap)."""
        todo, out = [s for s in found], set()
        while todo:
            node, e, owed = s = todo.pop()
            if s in out:
                continue
            out.add(s)
            if not owed:
                todo.extend((kid, e + 1, "") for kid in self.kids[node].values() if e < self.bound[kid])
        return frozenset(out)

    def _outcome(self, states):
        """(matches if the word ends here, stems that matched already)."""
        ends, stems = [], []
        for node, e, owed in states:
            for t, whole, k in (self.final[node] or ()) if not owed else ():
                if e <= k:
                    (ends if whole else stems).append((e, t))
        return min(ends, default=None), min(stems, default=None)

    def _step(self, s, ch):
        if self.made > self.LIMIT:
            return None
        found = set()
        for node, e, owed in self.sets[s]:
            kids = self.kids[node]
            if owed:
                if ch == owed:
                    found.add((node, e, ""))
                continue
            if ch in kids:
                found.add((kids[ch], e, ""))
            if e < self.bound[node]:
                found.add((node, e + 1, ""))
                for a, kid in kids.items():
                    if a != ch and e < self.bound[kid]:
                        found.add((kid, e + 1, ""))
                    grand = self.kids[kid].get(ch)
                    if grand is not None and a != ch and e < self.bound[grand]:
                        found.add((grand, e + 1, a))
        new = self._close(found)
        if new not in self.states:
            self.states[new] = len(self.sets)
            self.sets.append(new)
            self.next.append({})
            self.outcome.append(self._outcome(new))
        self.next[s][ch] = self.states[new]
        self.made += 1
        return self.states[new]

    def match(self, word: str):
        """(edits, term) nearest to ``word``, or None."""
        s, stem, nexts = 0, None, self.next
        for ch in word:
            n = nexts[s].get(ch)
            if n is None:
                n = self._step(s, ch)
                if n is None:
                    self.clear()
                    return self.match(word)
            s = n
            if not self.sets[s]:
                return stem
            found = self.outcome[s][1]
            if found is not None and (stem is None or found < stem):
                stem = found
        end = self.outcome[s][0]
        return end if stem is None or end is not None and end <= stem else stem


def quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of what stands between an opening mark and its own closing one, outermost pairs, in order."""
    spans, marks = [], []       # marks: those open, outermost first
    for m in QUOTES.finditer(text):
        q, i = m[0], m.start()
        if len(q) > 1:
            marks.clear()
            continue
        before, after = text[i - 1:i], text[i + 1:i + 2]
        if q == "’" and before.isalnum() and after.isalnum():
            continue            # an apostrophe
        begins = (not before or before.isspace() or before in "([{-–—") and bool(after) and not after.isspace()
        same = q in "\"”’"      # marks that may open or close
        at = next((k for k in range(len(marks) - 1, -1, -1) if q in CLOSED_BY[marks[k][0]]), None)
        if at is not None and not (same and begins):
            start = marks[at][1]
            del marks[at:]
            while spans and spans[-1][0] > start:
                spans.pop()
            spans.append((start, i))
        elif not same or begins or q == '"' and after and not after.isspace():
            marks = [x for x in marks if x[0] != q] + [(q, i)]
    return spans


def features(text: str, automaton: Automaton, known: frozenset[str], memo: dict) -> list[float]:
    """Sums over the windows of one text, in the order of FEATURES without the first."""
    low = text.lower()
    words = WORD.findall(low)
    found = {}
    for w in set(words):
        m = memo.get(w, 0)
        if m == 0:
            m = None if w in known else automaton.match(w)
            if len(memo) > MEMO:
                memo.clear()
            memo[w] = m
        if m is not None:
            found[w] = m
    if not found:
        return [0.0] * (len(FEATURES) - 1)
    quotes = quotations(low)
    spots = [(i, m) for i, m in enumerate(WORD.finditer(low)) if m[0] in found]
    exact = near = quoted = person = cluster = 0.0
    last = None
    for i, m in spots:
        edits, _ = found[m[0]]
        around = words[max(0, i - WINDOW):i + WINDOW + 1]
        k = bisect_right(quotes, (m.start(), len(low))) - 1
        inside = k >= 0 and m.end() <= quotes[k][1]
        told = inside or not REPORTED.isdisjoint(words[max(0, i - 4):i])
        # a window that quotes counts as quotation, not as abuse
        if told:
            quoted += 1
        elif edits == 0:
            exact += 1
        else:
            near += 1 / edits
        person += not told and not PERSON.isdisjoint(around)
        cluster += last is not None and i - last <= 2 * WINDOW
        last = i
    return [math.log1p(exact), math.log1p(near), math.log1p(quoted), math.log1p(len({found[m[0]][1] for _, m in spots})),
            math.log1p(100 * (exact + near) / len(words)), math.log1p(person), math.log1p(cluster)]


def beginnings(word: str):
    """The word with its end, and its beginnings that may be stems."""
    if len(word) >= SHORTEST:
        yield word + END
        for k in range(STEM[0], min(len(word), STEM[1]) + 1):
            yield word[:k]


def _counts(sample: DataFrame, terms_of) -> DataFrame:
    """(term, n): how many documents of ``sample`` (text) have each term; summed per batch first."""
    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for part in slices([batch]):
                for text in part.column(0).to_pylist():
                    counts.update(terms_of(set(WORD.findall((text or "").lower()))))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["term", "n"])
    return sample.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def precise(p: int, c: int, n_toxic: int, n_clean: int) -> bool:
    """Whether ``p`` toxic and ``c`` clean rows make PRECISION, toxic and clean rows weighing the same."""
    return p * max(1, n_clean) >= PRECISION * (p * max(1, n_clean) + c * max(1, n_toxic))


def chance(p: int, c: int, share: float) -> float:
    """P(at least ``p`` of ``p + c`` rows are toxic), if each is with probability ``share`` (Chernoff's bound)."""
    x = p / (p + c)
    if x <= share:
        return 1.0
    d = x * math.log(x / share) + ((1 - x) * math.log((1 - x) / (1 - share)) if c else 0.0)
    return math.exp(-(p + c) * d)


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[str]:
    """Significant terms of high precision; of beginnings with the same documents the longest, of nested ones the shortest."""
    share = n_toxic / max(1, n_toxic + n_clean)
    good = {t: p for t, p in toxic.items() if precise(p, clean.get(t, 0), n_toxic, n_clean)
            and chance(p, clean.get(t, 0), share) * len(toxic) <= ALPHA}
    further = {}
    for t, p in good.items():
        if len(t) > STEM[0]:
            further[t[:-1]] = max(further.get(t[:-1], 0), p)
    closed = {t for t, p in good.items() if further.get(t) != p}
    return sorted(t for t in closed
                  if not any(t[:k] in closed for k in range(STEM[0], len(t))))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1,
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and window weights from at most ``sample_rows`` labelled rows outside the held-out fold."""
    picked = labelled(labels, "toxic", modulus, held, sample_rows)
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
              .repartition(docs.sparkSession.sparkContext.defaultParallelism).persist())
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")

    def pairs(counts: DataFrame) -> dict[str, int]:
        return {r["term"]: r["n"] for r in counts.collect()}     # bounded by the sample's words

    try:
        n = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["n"] for r in
                                        sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        in_toxic = pairs(_counts(toxic, lambda words: words))
        in_clean = pairs(_counts(clean, lambda words: words).where(F.col("n") >= 2))
        known = frozenset(w for w, k in in_clean.items() if not precise(in_toxic.get(w, 0), k, n[1], n[0]))
        # in fewer rows no term is significant, whatever clean rows hold
        share = n[1] / max(1, n[0] + n[1])
        least = max(SUPPORT, math.ceil(math.log(ALPHA) / math.log(share)) if 0 < share < 1 else SUPPORT)
        stems = pairs(_counts(toxic, lambda words: {b for w in words - known for b in beginnings(w)})
                      .where(F.col("n") >= least))
        wanted = frozenset(stems)
        terms = tuple(choose_terms(stems, pairs(_counts(
            clean, lambda words: {b for w in words - known for b in beginnings(w)} & wanted)), n[1], n[0]))
        known = frozenset(w for w in known if len(w) >= SHORTEST)
        rows = _with_features(sample, terms, known).select("toxic", "_features").toArrow()
    finally:
        sample.unpersist()
    x = np.array(rows.column("_features").to_pylist(), float).reshape(rows.num_rows, len(FEATURES) - 1)
    x = np.column_stack([np.ones(len(x)), x])
    return Model(terms, known, tuple(_logistic(x, np.array(rows.column("toxic").to_pylist(), float)).tolist()))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps for the weights with a normal prior around PRIOR."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + PRIOR_STRENGTH * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_STRENGTH)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _with_features(df: DataFrame, terms, known) -> DataFrame:
    def make():
        automaton, memo = Automaton(terms), {}
        return lambda batch: [pa.array([features(t or "", automaton, known, memo)
                                        for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))]
    return with_columns_from(df, [T.StructField("_features", T.ArrayType(T.DoubleType()))], make)


def score(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """``docs`` with toxicity (0 to 1) in the column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.known, model.weights))

    def make():
        terms, known, weights = shared.value
        automaton, memo, w = Automaton(terms), {}, np.array(weights)

        def compute(batch):
            f = np.array([[1.0, *features(t or "", automaton, known, memo)]
                          for t in batch.column("text").to_pylist()])
            z = f.reshape(-1, len(FEATURES)) @ w
            return [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())]
        return compute

    return with_columns_from(docs, [T.StructField(into, T.DoubleType())], make)


def clean_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, with their columns."""
    name = fresh(docs, "_toxicity")
    return score(docs, model, name).where(F.col(name) < threshold).select(*docs.columns)
