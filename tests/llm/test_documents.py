"""Document operators against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kerbside.llm import common, decontaminate, exact_dedup, packing, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"
TEXT = "doc_id long, text string"
CLASH = ["_loc_file", "digest", "keep_id", "fp", "component_id", "score", "toxicity", "piece", "offset", "n", "best"]


def rows_of(spark, rows, clash=False):
    df = spark.createDataFrame(rows, TEXT)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH]) if clash else df


def odd_rows(seed=1):
    """Nulls, empty texts, repeated rows, near and exact copies, a very long text."""
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.replace(" ", "\n")) for i, t in enumerate(base[:6])]
    rows += [(200 + i, t + " end") for i, t in enumerate(base[:8])]
    rows += [(300, None), (301, ""), (302, " \t\r\n"), (303, "one"), (303, "one"), (None, "one"), (304, "ONE two"),
             (305, " ".join(rng.choice(words) for _ in range(30_000))), (306, "é É\x0b ß"), (306, "éÉß")]
    rng.shuffle(rows)
    return rows


def best_copy(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\f\r"), []).append((i, t or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), hashlib.sha256(key.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("weak,max_files", [(False, None), (True, None), (False, 1)])
def test_exact_dedup(spark, weak, max_files):
    rows = odd_rows()
    digest = (lambda c: F.substring(exact_dedup.sha256(c), 1, 1).cast("binary")) if weak else exact_dedup.sha256
    docs = rows_of(spark, rows, clash=True).repartition(5)
    found = exact_dedup.assign(docs, digest=digest, max_files=max_files).collect()
    wanted, groups = best_copy(rows)
    got = sorted([(r.doc_id, r.keep_id, r.group_size) for r in found], key=str)
    assert got == sorted([w[:3] for w in wanted], key=str)
    assert sum(r.kept for r in found) == groups
    if not weak:
        assert sorted(bytes(r.digest).hex() for r in found) == sorted(w[3] for w in wanted)


def test_unique_documents(spark):
    rows = odd_rows()
    docs = rows_of(spark, rows, clash=True)
    left = exact_dedup.unique_documents(docs)
    assert left.columns == docs.columns
    assert left.count() == best_copy(rows)[1]


def fingerprint(text, words):
    tokens = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "")
              .replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not tokens:
        return 0
    parts = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(prints, bits):
    ids = sorted({f for _, f in prints})
    parent = {f: f for f in ids}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a, b in combinations(ids, 2):
        if bin(a ^ b).count("1") <= bits:
            parent[root(a)] = root(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return {f: least.get(root(f)) for f in ids}


@pytest.mark.parametrize("words,bits", [(4, 4), (2, 9), (5, 0)])
def test_simhash(spark, words, bits):
    rows = odd_rows()
    prints = [(i, fingerprint(t, words)) for i, t in rows]
    wanted = components_of(prints, bits)
    got = simhash.groups(rows_of(spark, rows, clash=True), words, bits).collect()
    assert sorted([(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got], key=str) == sorted(
        [(i, f, wanted[f]) for i, f in prints], key=str)


def test_one_per_group(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "z y x w v u t s"), (3, "z y x w v u t s"), (4, None), (None, "")]
    docs = rows_of(spark, rows, clash=True)
    left = simhash.one_per_group(docs, 4, 4)
    assert left.columns == docs.columns
    # 2 names the group of its second text, so it stays
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 2, 4]
    assert simhash.one_per_group(docs.limit(0), 4, 4).count() == 0


def test_simhash_dense_segments(spark, monkeypatch):
    """Near fingerprints by the hundred under one segment value: blocks connect what pairs would."""
    monkeypatch.setattr(simhash, "HOT", 8)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "PROBES", 32)
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(120)})
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = simhash.links(nodes, 4).collect()
    whole = (1 << 64) - 1
    assert all(bin((r.a & whole) ^ (r.b & whole)).count("1") <= 4 for r in links)
    roots = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = components_of(list(enumerate(prints)), 4)
    groups = {}
    for k, p in enumerate(prints):
        signed = p - (1 << 64) if p >> 63 else p
        groups.setdefault(wanted[p], set()).add(roots.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("n", [1, 300, 40_000, 10 ** 6, 10 ** 10])
@pytest.mark.parametrize("bits", [0, 3, 4, 9])
def test_segments_are_exact(n, bits):
    segments = simhash.plan(n, bits)
    radii = [t for _, _, t in segments]
    # differing in t + 1 bits in every segment must already pass the limit
    assert sum(t + 1 for t in radii) > bits
    assert all(0 <= s and s + w <= 64 for s, w, _ in segments)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 201), (5, 5), (3, 1)], "a long, b long")
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert got == {**{i: 0 for i in range(71)}, 200: 200, 201: 200}
    assert common.components(edges.limit(0)).count() == 0


ITEMS = [(1, "If Anna buys 3 kg of apples for 12 euros and sells 3 boxes to Tom then how many euros remain for 12 people"),
         (2, "the river bends twice before it meets the old mill where nobody has lived for years now"), (3, None), (4, "!"),
         (5, "six short words are here only")]
LEAKED = [(1, ("Xx yy. " + ITEMS[0][1] + " now"), [1]),
          (2, "if Berta buys 5 kg of apples for 20 euros and sells 5 boxes to Jim then how many euros remain for 20 people", [1]),
          (3, "if Berta buys 5 kg of apples for 20 euros and sells 6 boxes to Jim then how many euros remain for 21 people", []),
          (4, "THE RIVER bends, twice: before it meets -- the old mill; where nobody has lived for years now!", [2]),
          (5, "the river bends and the old mill is far", []), (6, None, []), (7, "", []), (8, "so six short words are here only", [5]),
          (9, "filler word " * 40_000 + ITEMS[1][1], [2])]


def test_decontamination(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = rows_of(spark, [(i, t) for i, t, _ in LEAKED] + [(None, ITEMS[1][1]), (1, LEAKED[0][1])], clash=True)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert got == {(i, k) for i, _, found in LEAKED for k in found} | {(None, 2)}
    left = decontaminate.clean_documents(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [3, 5, 6, 7]
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_decontamination_of_items_with_few_words(spark):
    """Windows of placeholders: word for word, or at their place beside a window with a word."""
    numbers = " ".join(str(n) for n in range(31, 51))
    items = [(1, "Compute 12 + 45 * 78 - 3"), (2, "7 8 9 10"), (3, f"Add up the numbers {numbers} and halve"),
             (4, "Tell Anna 3 or Berta 4 of Carla 5 and Dora 6")]
    others = " ".join(str(n) for n in range(131, 151))
    docs = [(1, "so compute 12 + 45 * 78 - 3 now", [1]), (2, "Compute 1 + 2 * 3 - 4", [1]), (3, "it is 7 8 9 10 again", [2]),
            (4, "it is 7 8 9 11 again", []), (5, items[2][1], [3]), (6, f"add up the numbers {others} and halve", [3]),
            (7, others + " " + others, []), (8, "list " + " ".join(numbers.split()[2:17]), [3]), (9, items[3][1], [4]),
            (10, "tell Emil 7 or Frank 8 of Gerd 9 and Hans 10", [4])]
    got = {(r.doc_id, r.item_id): (r.matched, r.windows) for r in decontaminate.leaks(
        spark.createDataFrame([d[:2] for d in docs], TEXT), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(i, k) for i, _, found in docs for k in found}
    assert got[5, 3] == got[6, 3] == (19, 19)


def test_one_altered_slot_frees_no_passage(spark):
    rng = random.Random(6)
    tail = " ".join("".join(rng.choice("aeioubdgklmnrst") for _ in range(6)) for _ in range(40))
    items = [(1, f"they sold 12 boxes before noon and then another 12 boxes {tail}"),
             (2, f"then Anna met Tom and Anna saw Tom and Anna left while 5 more came {tail[::-1]}")]
    docs = [(1, items[0][1].replace("another 12", "another 13"), 1), (2, items[0][1].replace("12", "13"), 1),
            (3, items[1][1].replace("Anna", "Berta").replace("Berta left", "Dora left").replace(" 5 ", " 6 "), 2)]
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.leaks(
        spark.createDataFrame([d[:2] for d in docs], TEXT), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(i, k) for i, _, k in docs}
    assert all(got[i, k] >= 30 for i, _, k in docs)


def test_slots_by_majority():
    slots = {0: ("a", "b"), 1: ("x", "x"), 2: ("a", "b"), 3: ("y", "y"), 4: ("a", "c"), 5: ("z", "z"), 6: ("u", "u"), 7: ("v", "v")}
    assert decontaminate.agreeing([0, 1, 2, 3, 4, 5, 6], 2, slots) == (5, 1)
    tie = {0: ("a", "b"), 1: ("x", "x"), 2: ("a", "a"), 3: ("y", "y")}
    assert decontaminate.agreeing([0, 1, 2], 2, tie) == (2, 0)


def test_template_and_codes_agree():
    rng = random.Random(5)
    signs = list("aB é\x02ÀßΣ中 1.,:/\n") + ["Anna ", "kg ", "12 ", "two ", " Tom", "İ", "3,4:5"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(c for c in t if c.isascii() or c in "éÀß") for t in texts]
    for some in (texts[:7], texts[7:2500], texts[2500:], texts[:1], ["", ""]):
        codes, ends = decontaminate.coded(some)
        start = 0
        for text, end in zip(some, ends):
            tokens, _ = decontaminate.template(text.replace("\x02", " "))
            want = np.array([decontaminate._code(t) for t in tokens], np.int64)
            assert end - start == len(want)
            for n in (1, 3):
                assert decontaminate._hashes(codes[start:end], n).tolist() == decontaminate._hashes(want, n).tolist(), text
            start = end


def test_word_encoder_is_the_tokenizer():
    path = queries.tokenizer_path()
    encoder, whole = packing.Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(2)
    signs = list("ab cdé ÉÀßſ'S'tT 12_!?-\n\t\r$%&*#.,’“”ñΣσİ中\x0b\x1ć") + ["<|endoftext|>", "'ll", "\x00"]
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes()


def test_words_that_end_in_a_sign():
    """A word's letters go through the model once, whatever sign follows them; ids are the tokenizer's."""
    path = queries.tokenizer_path()
    encoder, whole, asked = packing.Encoder(path), Tokenizer.from_file(path), []

    class Model:
        def tokenize(self, part, model=encoder.model):
            asked.append(part)
            return model.tokenize(part)

    encoder.model = Model()
    encoder.encode("quixotry quixotry, quixotry. quixotry! quixotry,")
    assert asked == ["quixotry", ",", ".", "!"]
    words = ["a.", "b..", "c?!", "it's,", "l'", "l's.", "don't:", "é,", "ÉTÉ;", "çç", "x1,", "1,", ",", "..", "_a,", "a_", "a-b.", "straße!", "'s,", "ŉ."]
    for text in [*words, " ".join(words), "\n".join(reversed(words))]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes()


def test_packing(spark):
    rows = odd_rows() + [(i, "word " * (i % 90)) for i in range(1000, 1400)]
    docs = rows_of(spark, rows, clash=True)
    size = 128
    got = packing.packed(docs, queries.tokenizer_path(), size).collect()
    whole = Tokenizer.from_file(queries.tokenizer_path())
    wanted = []
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        wanted += [(i, k // size, k, len(ids[k:k + size]), zlib.crc32(np.array(ids[k:k + size], "<u4").tobytes()))
                   for k in range(0, len(ids), size)]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == sorted(wanted, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(bins) <= -(-sum(w[3] for w in wanted) // size) * 1.02 + 1
    assert packing.packed(docs.limit(0), queries.tokenizer_path()).count() == 0
    made = packing.sequences(docs, queries.tokenizer_path(), size).collect()
    assert len(made) == len(bins) and all(len(r.ids) == 4 * r.length <= 4 * size for r in made)


def best_possible(items, size):
    """Fewest bins, by search."""
    items = sorted(items, reverse=True)

    def fits(k, rooms):
        if k == len(items):
            return True
        seen = set()
        for i, room in enumerate(rooms):
            if room >= items[k] and room not in seen:
                seen.add(room)
                if fits(k + 1, rooms[:i] + [room - items[k]] + rooms[i + 1:]):
                    return True
        return False
    n = -(-sum(items) // size)
    while not fits(0, [size] * n):
        n += 1
    return n


def test_dominance_keeps_the_optimum():
    rng = random.Random(4)
    for _ in range(150):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        counts = {w: items.count(w) for w in items}
        fixed, left = packing.reduce_instance(counts, 20)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert sum(t for _, t in fixed) + (best_possible(rest, 20) if rest else 0) == best_possible(items, 20)
        plan = packing.plan(counts, 20)
        packed = [w for p, t in plan for w in p * t]
        assert sorted(packed) == sorted(items) and all(sum(p) <= 20 for p, _ in plan)


def edits(a, b):
    """Edit distance with swaps of neighbours (a letter edited once)."""
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_is_edit_distance():
    terms = ["idiot$", "worthless$", "scum$", "vequa", "loweische"]
    automaton = toxicity.Automaton(terms)
    rng = random.Random(6)
    for _ in range(4000):
        w = list(rng.choice(terms).rstrip("$"))
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(w))
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "e", "s"])
            if len(w) > 2 and rng.random() < 0.3:
                k = rng.randrange(len(w) - 1)
                w[k], w[k + 1] = w[k + 1], w[k]
        word = "".join(w) + rng.choice(["", "", "tail"])
        near = []
        for t, term in enumerate(terms):
            if term.endswith("$"):
                best = edits(term[:-1], word)
            else:
                best = min(edits(term, word[:k]) for k in range(len(word) + 1))
            if best <= toxicity.allowance(term):
                near.append((best, t))
        assert automaton.match(word) == min(near, default=None), word


def test_quotations_are_pairs():
    automaton = toxicity.Automaton(["idiot$"])
    quoted = toxicity.FEATURES.index("quoted") - 1
    for text, inside in [("you’re an idiot, don’t come", 0), ("l’homme est idiot d’accord", 0), ("“fine” you idiot “good”", 0),
                         ("\"fine\" you idiot \"good\"", 0), ("he put “an idiot” there", 1), ("er schrieb „du idiot“ hin", 1),
                         ("il a mis « un idiot » ici", 1), ("»ein idiot« steht da", 1), ("it has ‘the boy’s idiot’ on it", 1),
                         ("x=\"idiot\"", 1), ("the sign “not an ‘idiot’ here” hangs", 1), ("“open\n\nan idiot” here", 0), ("", 0)]:
        got = toxicity.features(text, automaton, frozenset(), {})
        assert (got[quoted] > 0) == bool(inside), text


def test_lexicon_does_not_depend_on_size_or_balance():
    rare = {"grumblug$": 30, "zut$": 200, "common$": 900}
    for n in (1000, 2000, 20_000):
        assert "grumblug$" in toxicity.choose_terms(rare, {"common$": 900}, n, n)
    # one toxic row in a hundred, and clean rows that quote the term
    assert toxicity.choose_terms({"snarfix$": 200, "zut$": 200}, {"snarfix$": 40, "zut$": 19_000}, 200, 19_800) == ["snarfix$"]
    assert toxicity.precise(200, 40, 200, 19_800) and not toxicity.precise(900, 900, 1000, 1000)
    assert toxicity.choose_terms({"chance$": 4}, {}, 1000, 1000) == []
    assert "zut$" in set(toxicity.beginnings("zut"))


def test_toxicity(spark):
    rng = random.Random(7)
    words = ["calm%s" % c for c in "abcdefghijklmnop"]
    bad = ["grumblug", "snarfix"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(3 if toxic else 0):
            text.insert(rng.randint(0, 60), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, None, int(toxic)))
    labels += [(5, 1, 0), (None, 1, 1), (9999, 1, 1), (3, None, None)]
    docs = rows_of(spark, rows + [(1000, None), (1001, ""), (1002, "calma grumbulg calmb snarfxi grumblug snarfix"), (0, rows[0][1])], True)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marked)
    assert {t.rstrip("$") for t in model.terms} >= set(bad)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.toxicity <= 1 for r in got)
    scores = {r.doc_id: r.toxicity for r in got}
    assert all((scores[i] >= 0.7) == (i % 4 == 0) for i in range(400))
    assert scores[1000] == scores[1001] < 0.5 and scores[1002] >= 0.7
    left = toxicity.clean_documents(docs, model)
    assert left.columns == docs.columns and left.count() == 302
    assert toxicity.score(docs, toxicity.fit(docs, marked.limit(0))).where("toxicity >= 0.5").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_pipeline(spark):
    """Stage by stage against what each kept; then the whole run."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = common.stored(stage(spark, docs, SF), f"test-{name}")
        if name == "exact_dedup":
            assert after.count() == best_copy(before)[1]
        elif name == "simhash":
            prints = [(i, fingerprint(t, 4)) for i, t in before]
            wanted = components_of(prints, 4)
            assert {r.doc_id for r in after.collect()} == {i for i, f in prints if wanted[f] == i}
        elif name == "packing":
            assert {r.doc_id for r in after.collect()} == {i for i, _ in before}
            docs = after
            break
        assert after.columns == columns and 0 < after.count() <= len(before)
        docs = after
    ran = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length").collect()
    assert sorted(ran) == sorted(docs.select("doc_id", "piece", "length").collect())
