"""Spelling variants against a brute-force search by deletions, and the parts of the search."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside.llm import queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(rows, least=7, times=2, slips=31):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slips and h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= times}


def plain(rows, least=7, times=2, ratio=10, slips=31):
    """(word, n, n_near, form, form_n, root) by words that share a form with one sign left out."""
    counts = plain_words(rows, least, times, slips)
    shared, nears = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            shared[k, len(w), w[:k] + w[k + 1:]].add(w)
            if w[:k] + w[k + 1:] in counts:
                nears[w].add(w[:k] + w[k + 1:])
                nears[w[:k] + w[k + 1:]].add(w)
    for group in shared.values():
        for w in group:
            nears[w] |= group - {w}
    form = {}
    for w, n in counts.items():
        best = min(nears[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n, len(nears[w]), form.get(w) or "", counts.get(form.get(w)) or 0, root(w)) for w, n in counts.items())


def collected(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert collected(queries.op11_spelling(spark, SF)) == plain([(d["doc_id"], d["text"]) for d in docs])


def clouds():
    """Words that are edits of a few stems, so that blocks are dense; hard texts."""
    rng = random.Random(3)
    stems = ["aabbccdd", "orantion", "straßenbahn", "ÉCOLEÉCOLE", "x" * 70, "ab" * 50]
    rows = []
    for d in range(300):
        out = []
        for _ in range(30):
            w = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at:at + rng.choice([0, 1])] = rng.choice(["", "a", "b", "é", "ß", "÷"])
            out.append("".join(w))
        rows.append((d, " ".join(out)))
    rows += [(400, None), (401, ""), (None, "orantion orantion, ORANTION"), (402, "y" * 3000 + " " + "y" * 3000 + " " + "y" * 2999 + " " + "y" * 2999)]
    rows += rows[:5]                                                        # repeated rows
    return rows


@pytest.mark.parametrize("tile", [spelling.TILE, 5])                        # 5: blocks cut into tiles that meet in pairs
@pytest.mark.parametrize("ratio", [10, 2])
def test_dense_words(spark, tile, ratio):
    rows = clouds()
    df = (spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
          .withColumns({"word": F.lit("clash"), "n": F.lit(1), "key": F.lit(2), "root": F.lit("r")}))
    assert collected(spelling.variants(df, ratio=ratio, slips=31, tile=tile)) == plain(rows, ratio=ratio)


def test_long_chain(spark):
    """Counts that double along a chain: roots need several rounds."""
    chain = [f"abcdefg{'h' * k}" for k in range(12)]
    rows = [(k, " ".join([w] * 2 ** (k + 1))) for k, w in enumerate(chain)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = collected(spelling.variants(df, ratio=2))
    assert out == plain(rows, ratio=2, slips=None) and {r[5] for r in out} == {chain[-1]}


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "short words only")], "doc_id long, text string")).count() == 0


def test_near_words_share_two_parts_and_are_close():
    rng = random.Random(4)
    for _ in range(2000):
        w = "".join(rng.choice(spelling.LETTERS) for _ in range(rng.randint(7, 20)))
        at = rng.randrange(len(w))
        x = w[:at] + rng.choice(["", rng.choice(spelling.LETTERS)]) + w[at + rng.choice([0, 1]):]
        v = spelling.Vectors([w, x])
        if spelling.one_edit(w, x):
            assert ((v.counts[0] - v.counts[1]) ** 2).sum() <= 2
            assert (v.keys()[0] == v.keys()[1]).any()


def test_one_edit():
    assert spelling.one_edit("abc", "ab") and spelling.one_edit("abc", "xabc") and spelling.one_edit("abc", "axc")
    assert not any(spelling.one_edit(a, b) for a, b in [("abc", "abc"), ("abc", "acb"), ("abc", "a"), ("abcd", "bcda")])
    assert np.isin(np.arange(spelling.PARTS), spelling.PART_OF).all()
