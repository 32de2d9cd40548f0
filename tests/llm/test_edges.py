"""Clashing columns, rows beside each other in a batch, and packing against exact solutions."""

import random
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import common, decontaminate, packing, simhash, toxicity

ITEM = "Slowly the minutes pass at night while old clocks tick in quiet rooms near the river"


def test_fresh(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, A_ int, b int")
    assert [common.fresh(df, n) for n in ("a", "b", "c")] == ["a__", "b_", "c"]


def test_names_of_own_columns_pass_through(spark):
    docs = spark.createDataFrame(
        [(1, f"w{'x ' * 30}", "p", 1.5, "q"), (2, f"w{'x ' * 30}", "p", 2.5, "q"), (3, ITEM, "p", 3.5, "q")],
        "doc_id long, text string, _dropped string, toxicity double, _leaked string").withColumn("_stays", F.lit(7))
    kept = simhash.one_per_group(docs, words=4, bits=4)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2]
    model = toxicity.Model(*[getattr(toxicity_model(spark), f) for f in toxicity.Model.__dataclass_fields__])
    left = toxicity.clean_documents(docs, model)
    assert left.columns == docs.columns and {r.doc_id: r.toxicity for r in left.collect()} == {1: 1.5, 2: 2.5, 3: 3.5}


def toxicity_model(spark):
    docs = spark.createDataFrame([(i, "you vile snarg" if i % 2 else "a calm day") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


@pytest.mark.parametrize("before", ["we paid 5", "twelve", "3"])
def test_units_belong_to_their_own_text(spark, before):
    """A text that starts with a word of measure is the same whatever stands in the row before it."""
    text = "minutes pass slowly at night while clocks tick in quiet rooms near the old river"
    items = spark.createDataFrame([(9, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, before), (2, text), (3, before)], "doc_id long, text string").coalesce(1)
    assert [r.doc_id for r in decontaminate.leaks(docs, items).collect()] == [2]


def test_unit_marking_stops_at_ends():
    a, ends = decontaminate.coded(["paid 5", "minutes pass", "5 minutes"])
    h = decontaminate._hashes(a, 1, ends)
    alone = [decontaminate._hashes(*decontaminate.coded([t])[:1], 1).tolist() for t in ("paid 5", "minutes pass", "5 minutes")]
    assert h.tolist() == sum(alone, [])


def sequences(patterns):
    return sum(t for _, t in patterns)


def test_three_beside_the_largest():
    assert sequences(packing.plan({1064: 100, 670: 300, 328: 300})) == 200
    assert sequences(packing.plan({1064: 1, 670: 3, 328: 3})) == 2


def least(items, size):
    """Fewest bins, over all subsets."""
    n = len(items)
    sums = [sum(items[i] for i in range(n) if m >> i & 1) for m in range(1 << n)]

    @lru_cache(None)
    def bins(m):
        if not m:
            return 0
        first = m & -m
        rest, best, part = m ^ first, n, m ^ first
        while True:
            if sums[part | first] <= size:
                best = min(best, 1 + bins(rest ^ part))
            if not part:
                return best
            part = (part - 1) & rest

    return bins((1 << n) - 1)


def test_reduction_keeps_the_optimum_of_long_sequences():
    """Few lengths, some of them hot: fixed sets and the exact rest are as few as the exact whole."""
    rng = random.Random(8)
    close = 0
    for _ in range(60):
        lengths = rng.sample(range(150, 2049), rng.randint(2, 5))
        items = [rng.choice(lengths) for _ in range(9)]
        counts = {w: items.count(w) for w in items}
        fixed, left = packing.reduce_instance(counts, 2048)
        rest = [w for w, n in left.items() for _ in range(n)]
        best = least(tuple(items), 2048)
        assert sequences(fixed) + least(tuple(rest), 2048) == best
        found = packing.plan(counts)
        assert all(sum(p) <= 2048 for p, _ in found)
        assert sorted(w for p, t in found for w in p * t) == sorted(items)
        close += sequences(found) == best
    assert close >= 57


def test_hot_length_is_dealt_out(spark):
    cut = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(2048 - 0).cast("long").alias("length"),
                                   F.lit(7).cast("long").alias("ids_crc32"))
    out = packing.pack(cut)
    rows = out.collect()
    assert len(rows) == 3000 == len({r.sequence_id for r in rows}) and {r.offset for r in rows} == {0}
    assert np.isin([c for c in cut.columns], out.columns).all()


# ---- secrets ------------------------------------------------------------------------------------
def random_spans(spark, rows):
    from kerbside.llm import secrets
    out = secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 3] for r in out}


def long_words(n):
    rng = random.Random(21)
    parts = ["inter", "counter", "trans", "ation", "ability", "ment", "graph", "ology", "ical", "ness", "over", "under", "stand"]
    found = set()
    while len(found) < n:
        found.add("".join(rng.choice(parts) for _ in range(rng.randint(4, 6)))[:30])
    return sorted(w for w in found if len(w) >= 16)


@pytest.mark.parametrize("n", [0, 990, 1200])
def test_secrets_do_not_depend_on_the_number_of_words(spark, n):
    """Order numbers are left alone and keys found, whatever else the table holds."""
    rng = random.Random(22)
    wide = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(wide) for _ in range(rng.choice([24, 32, 40]))) for _ in range(40)]
    rows = [(i, f"order {rng.randrange(10 ** 15, 10 ** 16)} came") for i in range(300)]
    rows += [(1000 + i, f"it was {k} then") for i, k in enumerate(keys)]
    rows += [(2000 + i, f"the {w} of it") for i, w in enumerate(long_words(n) if n else [])]
    found = random_spans(spark, rows)
    assert sum(bool(found[i]) for i in range(300)) <= 3
    assert sum(found[1000 + i] == [(7, 7 + len(k))] for i, k in enumerate(keys)) >= 36
    assert not any(v for d, v in found.items() if d >= 2000)


def test_secrets_beside_base_spans(spark):
    """What a base span leaves of a run is judged too."""
    rng = random.Random(23)
    wide = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rest = ["".join(rng.choice(wide) for _ in range(35)) + "Z" for _ in range(30)]      # the hex run starts after it
    rows = [(i, f"see {r}{'0a1b2c3d4e5f' * 2} ok") for i, r in enumerate(rest)]
    found = random_spans(spark, rows)
    assert sum(found[i] == [(4, 40)] for i in range(30)) >= 27


def test_discovery_control_by_hand():
    """The rule spelled out again over all bins, for random counts of every group."""
    from kerbside.llm import secrets
    rng = random.Random(24)
    for _ in range(200):
        c = rng.randrange(4 * secrets.LENGTHS)
        tokens = {(c, rng.randrange(100)): rng.randrange(1, 50) for _ in range(rng.randrange(6))}
        plain = {(c, min(99, int(rng.expovariate(0.1)))): rng.randrange(1, 400) for _ in range(rng.randrange(12))}
        total, words = sum(tokens.values()), sum(plain.values())
        good = [b for b in range(100) if sum(n for (_, x), n in tokens.items() if x >= b) and
                (sum(n for (_, x), n in plain.items() if x >= b) + 200 * secrets.prior(c, b)) / (words + 200)
                <= 0.01 * sum(n for (_, x), n in tokens.items() if x >= b) / total]
        cuts = secrets.cut_points(tokens, plain) + secrets.other_cuts(tokens, plain)
        assert cuts[c] == min(good, default=secrets.BINS)


# ---- decontamination: other names, numbers and units ---------------------------------------------
NAMES = ["Tom", "Ben", "Ann", "Eve", "Max", "Kim", "Sue", "Zoe", "Lena", "Omar", "New York", "San Marino", "Paris", "Oslo", "Lake Como"]
COUNTS = ["5", "12", "twenty one", "seven", "thirty-two", "3,400", "2.5", "five hundred", "nine"]
MEASURES = ["km", "miles", "hours", "kg", "dollars", "days"]
STORIES = [
    "{n0} has {c0} apples in the basket. {n1} gives {c1} of them to {n2} before lunch. How many apples does {n0} keep then?",
    "A train leaves {n0} and travels {c0} {m0} towards {n1} while a bus covers {c1} {m0} on the same road. Which one is faster?",
    "{n0} paid {c0} {m0} for the ticket to {n1}. {n2} paid {c1} {m0} less for the way back from {n1}. What did both pay?",
    "When {n0} reads {c0} pages every evening the book lasts {c1} {m0}. {n1} reads twice as much. How long does it last for {n1}?",
    "There are {c0} students in the school of {n0}. {n1} counts {c1} of them on the playground. How many are inside with {n2}?",
]


def told(story, rng):
    names, counts = rng.sample(NAMES, 3), rng.sample(COUNTS, 2)
    return story.format(**{f"n{i}": x for i, x in enumerate(names)}, **{f"c{i}": x for i, x in enumerate(counts)}, m0=rng.choice(MEASURES))


def test_other_parameters_are_found(spark):
    """Recall on rewrites with other names (at the beginning of sentences too), numbers of several words and units."""
    rng = random.Random(31)
    items = [(k, told(s, rng)) for k, s in enumerate(STORIES)]
    filler = ["they walk along the quiet river and talk about the weather of the week", "how many people does it take to build a house there",
              "what a train does when a bus is late", "which way is best when there are two"]
    docs = [(100 * k + i, f"Once more. {told(s, rng)} That was it.") for k, s in enumerate(STORIES) for i in range(20)]
    docs += [(1000 + i, f"{rng.choice(filler)}. {rng.choice(NAMES)} counts {rng.choice(COUNTS)} {rng.choice(MEASURES)}. {rng.choice(filler)}") for i in range(100)]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum((100 * k + i, k) in found for k in range(len(STORIES)) for i in range(20)) >= 90
    assert all(d < 1000 and d // 100 == k for d, k in found)


@pytest.mark.parametrize("ours,theirs", [
    ("Tom has 5 apples. Ben gives 3 of them to Ann. Eve eats 2.", "Max has 7 apples. Kim gives 4 of them to Sue. Zoe eats 1."),
    ("She buys twenty apples and then sells nine of them to a friend in Paris for a good price", "She buys twenty one apples and then sells nine of them to a friend in New York for a good price")])
def test_named_misses_are_found(spark, ours, theirs):
    docs = spark.createDataFrame([(1, theirs), (2, "nothing of the kind is here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, ours)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()] == [(1, 7)]


def test_template_and_codes_agree_with_common_words():
    rng = random.Random(32)
    parts = ["Anna ", "Lena-Marie ", "New York ", "twenty one ", "Five ", "hundred ", "12 ", "kg ", ". ", "\n", "The ", "the ", "é", "Ça va ", "中", "\x02", "Σ ", "? Who ", ": "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(c for c in t if c.isascii() or c in "éÇ") for t in texts]
    common = frozenset(["the", "who", "va", "five"])
    codes, ends = decontaminate.coded(texts, common)
    h = decontaminate._hashes(codes, 1, ends)
    start = 0
    for text, end in zip(texts, ends):
        tokens, original = decontaminate.template(text.replace("\x02", " "), common)
        assert len(tokens) == len(original) == end - start
        want = np.array([decontaminate._code(t) for t in tokens], np.int64)
        assert h[start:end].tolist() == decontaminate._hashes(want, 1).tolist(), text
        start = end


def test_common_words(spark):
    df = spark.createDataFrame([("the The the Tom tom",), (None,), ("a a a é é b",)], "text string")
    assert decontaminate.common_words(df) == {"the", "tom", "a", "é", "b"}
    assert decontaminate.common_words(df, 1) == {"a"} and decontaminate.common_words(df.limit(0)) == frozenset()
