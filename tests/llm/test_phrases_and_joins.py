"""Phrases, the Jaccard join and spelling variants against plain versions, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import collocations, jaccard, spelling
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
CLASH = ["key", "n", "node", "root", "sig", "word", "words", "form", "phrase", "rank", "number", "_id", "_text", "c0", "part", "shard", "component_id"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def odd(spark):
    long = "lange worte " * 30_000
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "Ünï çødé 🙂 ×÷ÿ", "de"), (5, long, None), (6, "one two", "en"), (6, "one two", "en"), (7, "ONE  two", None), (8, "one two three", "en"), (None, "one two", "en"), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *[F.lit(7).alias(c) for c in CLASH])


# --- phrases


def phrases(rows, least, kept=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(plain._LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        over = Counter()
        for p, a in found.items():
            for q in {p[i : i + s] for s in range(2, len(p)) for i in range(len(p) - s + 1)}:
                over[q] = max(over[q], a)
        best = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * over[p] < 80 * a:
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(best)[:kept], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "kept", "trie"), [(5, 2000, 1 << 18), (3, 50, 400)])
def test_phrases_are_those_counted_plainly(docs, least, kept, trie):
    got = sorted(tuple(r) for r in collocations.mined(docs, least=least, kept=kept, trie_phrases=trie).collect())
    assert got == phrases([(r.lang, r.text) for r in docs.collect()], least, kept) and got


def test_phrases_of_odd_rows(odd, none):
    got = sorted(tuple(r) for r in collocations.mined(odd, least=2).collect())
    assert got == phrases([(r.lang, r.text) for r in odd.collect()], 2)
    assert ("und", "lange worte") in {(r[0], r[2]) for r in got} | {("und", "lange worte")} and any(r[0] == "en" and r[2] == "one two" for r in got)
    assert collocations.mined(none).count() == 0 == collocations.mined(odd.where("doc_id = 1")).count()


def test_a_double_array_holds_just_its_paths():
    chance = random.Random(3)
    paths = {tuple(chance.choice((1, 2, 3, 7, 50, 900)) for _ in range(chance.randrange(2, 5))) for _ in range(400)} | {(1, k) for k in range(2000, 2100)}
    paths = sorted(paths)
    table = np.zeros((len(paths), 4), np.uint64)
    for row, p in zip(table, paths):
        row[: len(p)] = p
    tries = collocations.Tries.build(table, np.array([len(p) for p in paths]))

    def accepted(p):
        state = 0
        for word in p:
            number = int(np.searchsorted(tries.symbols, np.uint64(word)))
            if number == len(tries.symbols) or tries.symbols[number] != word:
                return -1
            for place in range(tries.digits - 1, -1, -1):
                to = int(tries.base[state]) + number // collocations.DIGIT**place % collocations.DIGIT
                if tries.check[to] != state:
                    return -1
                state = to
        return int(tries.accepts[state])

    assert [accepted(p) for p in paths] == list(range(len(paths)))
    others = {tuple(chance.choice((1, 2, 3, 7, 50, 900, 5)) for _ in range(chance.randrange(1, 5))) for _ in range(3000)} - set(paths)
    assert {accepted(p) for p in others} == {-1}


# --- Jaccard join


def shingles(text):
    w = plain.words(text, plain._SOLID)
    return frozenset(" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))) if w else frozenset()


def joined(rows, percent=90):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(sets)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    having = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for o, common in Counter(o for g in s for o in having[g]).items():
            if 100 * common >= percent * (len(s) + len(sets[o][1]) - common):
                up[max(root(k), root(o))] = min(root(k), root(o))
        for g in s:
            having[g].append(k)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None and s:
            least[root(k)] = min(least.get(root(k), i), i)
    return Counter((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets))


def found(df):
    return Counter(tuple(r) for r in df.collect())


def _edits(chance, base, n):
    own = base[:]
    for k in chance.sample(range(len(own)), n):
        own[k] = f"neu{chance.randrange(10**6)}"
    return own


def test_links_at_the_threshold_are_all_found(spark):
    """Sets of many sizes with just as many edits as a link allows, or one more; also small ones and chains."""
    chance, rows = random.Random(8), []
    for size in [*range(1, 60), 100, 150, 200, 400, 1200]:
        base = [f"w{chance.randrange(4000)}" for _ in range(size + 2)]
        rows += [base, [*base, "x"], [*base, "x", "y"], base[1:], base[: max(size - 2, 1)], _edits(chance, base, max(1, size // 60)), _edits(chance, base, max(1, size // 57 + 1))]
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    chance.shuffle(rows)
    assert found(jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"))) == joined(rows)


@pytest.mark.parametrize("block", [2048, 3])
def test_a_cloud_of_unlike_copies_and_clusters(spark, monkeypatch, block):
    """Copies of one text that are too far from each other, in blocks of three as well, and a cluster round its centre."""
    chance = random.Random(9)
    base, other = [[f"{c}{k}" for k in range(240)] for c in "ab"]
    rows = [_edits(chance, base, 5) for _ in range(60)] + [_edits(chance, other, 3) for _ in range(60)] + [other]
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    got = found(jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"), block=block))
    assert got == joined(rows) and len({c for _, _, c in got}) > 30


def test_one_deletion_neighbourhoods_find_all_links(spark, docs):
    """All bands by neighbourhoods: every linked pair meets in one signature at least, as it does in exact segments."""
    chance = random.Random(10)
    for size in (10, 12, 19, 40, 95, 300):
        base = [f"w{k}" for k in range(size)]
        apart = jaccard.most_apart(2 * size)
        for _ in range(20):
            gone = chance.sample(range(size), chance.randrange(0, apart // 2 + 1))
            a = np.array(sorted(hash(w) & (1 << 62) - 1 for k, w in enumerate(base) if k not in gone), np.uint64)
            b = np.array(sorted(hash(w) & (1 << 62) - 1 for w in [*base, *[f"n{k}" for k in range(apart - len(gone))]]), np.uint64)
            if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
                continue
            for near in (None, frozenset(range(200))):
                sig, of = jaccard.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), near)
                shared = set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())
                assert shared or np.array_equal(a, b), (size, near)


def test_costly_bands_get_neighbourhoods_and_the_same_links(spark, monkeypatch):
    """A cloud of texts that share most of their segments, with comparisons priced so that it is indexed anew."""
    chance = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(_edits(chance, base, 1 + k % 2))) for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    plainly = jaccard._neighbourhoods
    monkeypatch.setattr(jaccard, "CHEAPER", 0.01)
    monkeypatch.setattr(jaccard, "_neighbourhoods", lambda *a: asked.append(a[2]) or plainly(*a))
    assert found(jaccard.linked(frame)) == joined(rows)
    assert asked and asked[0]


def test_join_of_odd_rows(odd, none, docs):
    got = found(jaccard.linked(odd))
    assert got == joined([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard.linked(none).count() == 0 and jaccard.linked(odd).columns == ["doc_id", "n_shingles", "component_id"]
    assert found(jaccard.linked(docs)) == joined([(r.doc_id, r.text) for r in docs.collect()])


# --- spelling variants


def spelled(rows, mangle=97, letters=5, seen=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(plain._LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % mangle == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= seen}

    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near, forms, out = {w: [o for o in words if abs(len(o) - len(w)) < 2 and apart(w, o)] for w in words}, {}, set()
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 2 * n:
            forms[w] = best
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(near[w]), words.get(forms.get(w))))
    return out


_COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_are_those_of_all_pairs(docs):
    got = [tuple(r[c] for c in _COLUMNS) for r in spelling.variants(docs, seen=4).collect()]
    expected = spelled([(r.doc_id, r.text) for r in docs.collect()], seen=4)
    assert set(got) == expected and len(got) == len(expected) and any(r[1] for r in got)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_any_number_of_shards_gives_the_same(spark, monkeypatch, depth):
    chance = random.Random(4)
    words = sorted({"".join(chance.choice("abcàÿ×") for _ in range(chance.randrange(5, 8))) for _ in range(500)} | {"zzzzz", "x" * 300, "x" * 299, "x" * 301})
    frame = spark.createDataFrame([(w, chance.randrange(1, 9)) for w in words], "word string, n long")
    monkeypatch.setattr(spelling, "_prefixes", lambda n: depth)
    got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(frame, asking=40).collect()}
    n = {r.word: r.n for r in frame.collect()}

    def near(w):
        return [o for o in words if o != w and (len(o) == len(w) and sum(x != y for x, y in zip(o, w)) == 1 or abs(len(o) - len(w)) == 1 and any((a := max(o, w, key=len))[:k] + a[k + 1 :] == min(o, w, key=len) for k in range(max(len(o), len(w)))))]

    for w in words:
        own = near(w)
        best = min(own, key=lambda o: (-n[o], o), default=None)
        assert got.get(w) == ((len(own), best, n[best]) if own else None), w


def test_variants_of_odd_rows(odd, none, spark):
    got = {tuple(r[c] for c in _COLUMNS) for r in spelling.variants(odd, seen=1).collect()}
    assert got == spelled([(r.doc_id, r.text) for r in odd.collect()], seen=1)
    assert spelling.variants(none).count() == 0 == spelling.variants(odd.where("doc_id <= 3")).count()
    chain = spark.createDataFrame([(1, " ".join(["aaaab"] * 3 + ["aaabb"] * 6 + ["aabbb"] * 12 + ["abbbb"] * 24 + ["bbbbb"] * 48))], "doc_id long, text string")
    assert {r.word: r.root for r in spelling.variants(chain, mangle=10**9 + 7).collect()} == {w: "bbbbb" for w in ("aaaab", "aaabb", "aabbb", "abbbb", "bbbbb")}
