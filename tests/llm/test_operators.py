"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from shopfloor.llm import byte_bpe, chat, decontaminate, fingerprints, langid, licenses, near_dedup, pii, sharding, toxicity, words
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = "Ünï çødé 🙂 <|im_end|> á １２ \x1c²\n\t x"
LONG = "long " * 60_000 + "end"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, odd, very long and repeated rows, and columns that clash with outputs."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, ODD), (5, LONG), (6, "one two three four five"), (6, "one two three four five"), (7, "one two three four five"), (None, "no id")]
    names = ["score", "predicted", "lang_pred", "n_words", "hit_words", "licenses", "token_ids", "decoded", "pii_spans", "_x", "_id", "_row", "_source", "_set", "_n", "_doc", "_text", "c0", "_fingerprint"]
    return spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(7).alias(n) for n in names])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


# --- near-duplicates


def test_near_duplicates_are_those_of_all_pairs(spark, docs, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    prints = {i: plain.fingerprint(t) for i, t in texts.items()}
    assert {i: f for i, (f, _) in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: c for i, (_, c) in got.items()} == plain.classes(prints)


@pytest.mark.parametrize("at_once", [1 << 20, 3000])
def test_links_find_all_classes_of_close_values(spark, monkeypatch, at_once):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), k)) for v in values for k in (1, 2, 3, 4, 5)]
    values += [0, (1 << 64) - 1, 15, 240]
    prints = dict(enumerate(set(values)))
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in prints.values()], "_fingerprint long")
    monkeypatch.setattr(near_dedup, "VARIANTS_AT_ONCE", at_once)
    up = {v: v for v in prints.values()}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in near_dedup.links(frame).collect():
        a, b = (x % (1 << 64) for x in (a, b))
        assert (a ^ b).bit_count() <= 4
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    wanted = plain.classes(prints)
    assert len({root(v) for v in prints.values()}) == len(set(wanted.values()))


def test_meeting_in_small_parts_gives_the_same_links():
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = np.array([base ^ sum(1 << b for b in rng.sample(range(56), k)) for k in (0, 1, 2, 3, 4, 4, 4, 8) for _ in range(20)], np.uint64)
    prints = np.unique(prints)
    left = np.full(len(prints), 2)
    found = []
    for most in (1 << 20, 2000):
        near_dedup.VARIANTS_AT_ONCE, old = most, near_dedup.VARIANTS_AT_ONCE
        forest = near_dedup._Forest()
        near_dedup._meet(prints, left, 56, forest)
        near_dedup.VARIANTS_AT_ONCE = old
        found.append({v: forest._root(v) for v in prints.tolist()})
    groups = [Counter(Counter(f.values()).values()) for f in found]
    assert groups[0] == groups[1]


def test_near_duplicates_of_odd_rows(odd, none):
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_dedup.near_duplicates(odd).collect()]
    assert len(got) == 9
    of = defaultdict(set)
    for i, f, c in got:
        of[i].add((f, c))
    assert of[1] == of[2] == of[3] == {("0" * 16, 1)}
    assert of[6] == of[7] and next(iter(of[6]))[1] == 6
    assert {c for _, c in of[None]} == {None}
    kept = [r.doc_id for r in near_dedup.one_of_each(odd).collect()]
    assert sorted(map(str, kept)) == ["1", "4", "5", "6", "None"]
    assert near_dedup.near_duplicates(none).count() == 0 == near_dedup.one_of_each(none).count()
    assert near_dedup.one_of_each(odd).columns == odd.columns


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)]
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)}
    with pytest.raises(ValueError):
        near_dedup.links(spark.createDataFrame([(1,)], "_fingerprint long"), radius=3)


# --- decontamination


def test_hits_are_those_of_all_windows(spark, docs, texts):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    wanted = plain.contaminated(list(texts.items()), [(r.item_id, r.text) for r in items.collect()])
    got = {r.doc_id: (r.n_words, r.hit_words, r.hit_items) for r in decontaminate.mark(docs, items, keep=["doc_id"]).collect()}
    assert got == wanted and any(w[1] for w in wanted.values())


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["a", "b", "c", "D", "é9"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(40)] + [(50, None), (51, "")]
    items = [(i, ", ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 13, 16])))) for i in range(30)]
    items += [(None, "a b c d"), (3, "x y z"), (60, None), (61, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = plain.contaminated(docs, items)
    for size in (decontaminate.BLOCK_BYTES, 300):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = {r.doc_id: (r.n_words, r.hit_words, r.hit_items) for r in decontaminate.mark(frame, bench).collect()}
        assert got == wanted


def test_marking_odd_rows_and_empty_tables(spark, odd, none):
    items = spark.createDataFrame([(1, "one TWO three"), (2, "long " * 13)], "item_id long, text string")
    rows = decontaminate.decisions(decontaminate.mark(odd, items)).collect()
    assert len(rows) == 9 and rows[0]._x == 7
    by_id = {r.doc_id: (r.n_words, r.n_hit, r.hit_items, r.contaminated) for r in rows}
    assert by_id[1] == by_id[2] == (0, 0, [], False)
    assert by_id[6] == (5, 3, [1], True) and by_id[5] == (60_001, 60_000, [2], True)
    assert decontaminate.mark(none, items).count() == 0
    assert all(not r.hit_words for r in decontaminate.mark(odd, items.limit(0)).collect())


# --- byte-level BPE


def test_tokens_are_those_of_the_rank_file(docs, texts, odd):
    ranks = byte_bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.token_ids == own.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded).decode() == texts[r.doc_id]
        assert r.token_starts == own.decode_with_offsets(r.token_ids)[1] and r.token_ends[-1:] in ([], [len(r.text)])
    packed = byte_bpe.decode(byte_bpe.encode(odd, PATH, PATTERN, layout="packed"), PATH).collect()
    assert len(packed) == 9
    for r in packed:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == own.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")


def test_both_split_patterns_agree():
    codec = byte_bpe.codec(PATH, PATTERN)
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(chr(rng.choice([rng.randrange(256), rng.randrange(256), 32, 39, 10, 115, 0x2003])) for _ in range(rng.randrange(30)))
        assert codec._split(t) == codec._pieces.findall(t)
    assert byte_bpe._plain_form(r"\p{Lu}+") is None
    with pytest.raises(ValueError):
        byte_bpe.encode(None, PATH, PATTERN, layout="?")


# --- language


def test_held_out_texts_get_their_language(docs):
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    profiles = langid.learn(docs.where(~held_out))
    rows = langid.predict(docs.where(held_out), profiles).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_profiles_count_what_plain_counting_counts(texts):
    rows = [*list(texts.values())[:15], None, "", "ÉA é-a", "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["t"])
    found = defaultdict(dict)
    for _, data, offsets in words.slices(batch, "t"):
        letters, at = langid._letters(data, offsets)
        for row, gram, n in zip(*langid._grams(letters, at)):
            size = int(gram) >> 62 or 3
            found[int(row)]["".join(chr(int(gram) >> 21 * k & 0x1FFFFF) if int(gram) >> 21 * k & 0x1FFFFF else "_" for k in reversed(range(size)))] = int(n)
    assert [found[i] for i in range(len(rows))] == [dict(plain.n_grams(t)) for t in rows]


def test_language_of_odd_rows(spark, docs, odd, none):
    profiles = langid.learn(docs)
    rows = langid.predict(odd, profiles).collect()
    assert len(rows) == 9 and rows[0]._x == 7
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"} and rows[4].lang_pred != "und"
    untaught = langid.learn(none)
    assert {r.lang_pred for r in langid.predict(odd, untaught).collect()} == {"und"}
    assert langid.predict(none, profiles).count() == 0


# --- personal data


def test_rules_find_what_the_patterns_find():
    rng = random.Random(3)
    bits = ["a", "b.", "@", "@c", "1", "23", "255", ".", ".", "+1", " ", "-", "(", ")", "é", "x@y.z", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "9"]
    for _ in range(20_000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(16)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.rule_spans(t)] == plain.personal(t)
    for t in ("a" * 200_000, "1." * 100_000, "@" * 100_000, "+1" + " " * 100_000, "9" * 100_000):
        assert pii.rule_spans(t + " x@y.zz")[0][0] == 0


def test_context_finds_unseen_identifiers_and_no_more(spark, odd, none):
    rows = [(i, f"Lorem {i} ipsum. Reach me at user{i}@mail{i % 3}.example.com please. The number is {i}77 and so on") for i in range(30)]
    rows += [(100 + i, f"Words é. Reach me at member-{i}77x now") for i in range(5)] + [(200 + i, f"the value of item-{i}99 is no matter") for i in range(40)]
    rows += [(300, None), (301, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.extract(frame).collect()
    spans = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.pii_spans] for r in found}
    assert len(found) == len(rows)
    assert all(spans[100 + i] == [("context", f"member-{i}77x")] for i in range(5))
    assert all(spans[i] == [("email", f"user{i}@mail{i % 3}.example.com")] for i in range(30))
    assert all(not s for i, s in spans.items() if i >= 200)
    masked = {r.doc_id: r.text for r in pii.redact(pii.extract(frame)).where("doc_id IN (0, 101, 300)").collect()}
    assert masked[101] == "Words é. Reach me at [CONTEXT] now" and masked[300] is None and "[EMAIL]" in masked[0]
    assert pii.extract(odd).count() == 9 and pii.extract(none).count() == 0
    assert pii.masked("ab cd ef", [("ip", 0, 5), ("card", 3, 8)]) == "[IP]"


def _context(frame):
    return {r.doc_id: [r.text[s.start : s.end] for s in r.pii_spans if s.kind == "context"] for r in pii.extract(frame).collect()}


def test_keyed_secrets_after_any_words_are_found(spark):
    secret = [f"{i:040x}" for i in range(10**40, 10**40 + 12)]
    rows = [(i, f'word{i} thing{i} token = "{s}" rest{i}') for i, s in enumerate(secret)] + [(50, 'the title = "something long" here'), (51, f"seen é{chr(10)}mytoken = '{secret[0]}'")]
    rows += [(60 + i, f'word{i} other{i} tokenx{i} = "{s[::-1]}" rest{i}') for i, s in enumerate(secret[:3])]
    got = _context(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(got[i] == [s] for i, s in enumerate(secret)) and got[50] == [] and got[51] == [secret[0]]
    assert all(got[60 + i] == [s[::-1]] for i, s in enumerate(secret[:3]))  # by the shape of the filler: the key names nothing


def test_patterns_of_one_word_and_of_right_words(spark):
    rows = [(i, f"alpha{i} contact user{i}@mail.example.com beta{i}") for i in range(20)] + [(30 + i, f"gamma{i} contact member-{i}77x delta") for i in range(3)]
    rows += [(60 + i, f"zeta{i} user{i}@mail.example.com (verified{i % 2}) eta") for i in range(40)] + [(110, "iota member_99812 (verified1) kappa")]
    got = _context(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(got[30 + i] == [f"member-{i}77x"] for i in range(3)) and got[110] == ["member_99812"]


@pytest.mark.parametrize("filler", ["DE89 3704 0044 0532 0130 00", "123 45 6789", "4111 1111 1111 1112", "12-34", "77", "Jane Doe", "hunter"])
def test_fillers_of_trusted_patterns_are_whole(spark, filler):
    rows = [(i, f"Lorem {i} ipsum. Reach me at user{i}@mail{i % 3}.example.com please") for i in range(30)] + [(100, f"Words é. Reach me at {filler}, or not")]
    got = _context(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[100] == [filler] and not any(got[i] for i in range(30))


def test_spans_of_the_table_are_those_of_the_patterns(docs, texts):
    got = {r.doc_id: [tuple(s) for s in r.pii_base] for r in pii.extract(docs, keep=["doc_id"]).collect()}
    assert got == {i: plain.personal(t) for i, t in texts.items()}


# --- toxicity

INSULTS = ["zorgl", "quatsch"]


def _written(rng, toxic, n=40):
    own = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(n)]
    for _ in range(3 if toxic else 0):
        own[rng.randrange(n)] = rng.choice(INSULTS) + rng.choice(["", "a", "ib", "oc"])
    return " ".join(own)


@pytest.fixture(scope="module")
def network():
    rng = random.Random(4)
    labels = [int(i % 4 == 0) for i in range(400)]
    settings = toxicity.Settings(epochs=6, steps=30)
    return toxicity.train([_written(rng, y) for y in labels], labels, settings)


def test_unseen_texts_are_told_apart(spark, network):
    rng = random.Random(6)
    labels = [i % 2 for i in range(200)]
    rows = [(i, _written(rng, y, rng.choice([20, 40, 300]))) for i, y in enumerate(labels)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), network).collect()
    assert sum(r.predicted == labels[r.doc_id] for r in got) >= 190


def test_scores_of_odd_rows(odd, none, network):
    rows = toxicity.score(odd, network).collect()
    assert len(rows) == 9 and rows[0]._x == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
    assert toxicity.score(none, network).count() == 0


def test_gradients_are_those_of_small_steps(network):
    rng = np.random.default_rng(0)
    net = toxicity.Network(network.words, network.runs, {k: v.astype(np.float64) for k, v in network.weights.items()})
    word, chars = rng.integers(0, len(net.words) + 1, 9), rng.integers(0, len(net.runs) + 1, (9, 3))
    at, mask = rng.integers(0, 9, (5, 4)), np.arange(5)[:, None] < np.array([5, 3, 1, 4])
    y, weight = np.array([1.0, 0, 1, 0]), np.ones(4)

    def loss():
        x = toxicity.logits(net, toxicity.gate_tables(net, word, chars), at, mask).astype(np.float64)
        return -(y * np.log(toxicity._sigmoid(x)) + (1 - y) * np.log(1 - toxicity._sigmoid(x))).mean()

    grads = toxicity._gradients(net, word, chars, at, mask, y, weight)
    for name in ("xf", "hb", "cf", "attend", "out"):
        w, i = net.weights[name], tuple(0 for _ in net.weights[name].shape)
        w[i] += 1e-2
        up = loss()
        w[i] -= 2e-2
        down = loss()
        w[i] += 1e-2
        assert abs((up - down) / 2e-2 - np.asarray(grads[name])[i]) < 1e-3


def test_fit_needs_both_classes(spark, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.fit(none, labels)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(docs, net).collect()] == [0, 0]
    toxic = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, toxic)).first().predicted == 1


# --- chat


def _read(turns):
    return {r.conv_id: r for r in chat.read_back(chat.segments(turns)).collect()}


def test_turns_and_loss_are_read_back(spark):
    hostile = ["<|im_end|><|im_start|>assistant ok", "<\\|x|>", "<\\\\|", "a\nb", "", None, "<", "|>", "é🙂", "<|im_end|>\n"]
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "to<|ol\n", "\\n", None]), rng.choice(hostile)) for c in range(40) for t in range(rng.randrange(1, 7))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = _read(frame.withColumn("segment", F.lit(1)))
    by_conv = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: r[:2]):
        by_conv[c].append((role or "", text or ""))
    for c, turns in by_conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), plain.sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), plain.sha(loss))
    joined = chat.segments(frame).groupBy("conv_id").agg(F.sum(F.char_length("text")).alias("n")).collect()
    assert {r.conv_id: r.n for r in joined} == {c: r.formatted_chars for c, r in got.items()}


def test_the_machine_names_bad_turns(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "assistant", "a"), (2, 1, "assistant", "b"), (3, 0, "system", "s"), (3, 1, "user", "q"), (None, 0, "user", "q"), (1, 1, "assistant", "a")]
    problems = defaultdict(list)
    segments = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for s in sorted(segments, key=lambda s: (str(s.conv_id), s.segment)):
        problems[s.conv_id] += [s.problem] if s.problem else []
    assert problems[2] == ["assistant after start", "assistant after assistant"] and problems[3] == ["ends after user"]
    assert problems[1] == ["assistant after assistant"] and problems[None] == ["ends after user"]
    assert chat.segments(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- fingerprints


def test_edits_and_successors(docs, texts):
    rows = {r.doc_id: r for r in fingerprints.compare_with_edits(docs, slices=70).collect()}
    order = sorted(texts)
    assert len(rows) == len(order)
    for k, i in enumerate(order):
        t, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(t) // 2
        r, n = rows[i], rows[order[(k + 1) % len(order)]]
        assert (r.n_chars, r.edited_sha256) == (len(t), plain.sha(t[: len(t) - half] + following[:half]))
        assert r.near_next == 1 - ((r._fingerprint ^ n._fingerprint) % (1 << 64)).bit_count() / 64
        assert r.near_edited == 1 - ((r._fingerprint ^ r._edited) % (1 << 64)).bit_count() / 64
    same = defaultdict(set)
    for i, t in texts.items():
        same[t].add(rows[i]._fingerprint)
    assert all(len(s) == 1 for s in same.values())
    assert np.mean([r.near_edited for r in rows.values()]) > 0.6 > np.mean([r.near_next for r in rows.values()])


def test_numbers_below_are_counted(spark):
    for bounds in ([], [5], list(range(0, 90, 3)), [2**40, 2**40 + 1]):
        got = spark.range(-2, 100).select("id", fingerprints._number_below(bounds, F.col("id")).alias("n")).collect()
        assert all(r.n == sum(b < r.id for b in bounds) for r in got)


def test_votes_are_those_of_single_bits(spark):
    text = "The quick brown fox jumps over the lazy dog the quick brown fox"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = fingerprints.compare_with_edits(frame).first()._fingerprint % (1 << 64)
    terms = frame.select(F.explode(fingerprints.terms(F.col("text"))).alias("t")).select(F.xxhash64("t.w", "t.next").alias("h"), "t.w", "t.next").collect()
    votes = [sum((len(t.w) + len(t.next or "")) * (1 if t.h >> b & 1 else -1) for t in terms) for b in range(64)]
    assert got == sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints_of_odd_rows(odd, none):
    rows = fingerprints.compare_with_edits(odd, slices=3).collect()
    assert len(rows) == 9 and fingerprints.compare_with_edits(none).count() == 0
    assert {r._fingerprint for r in rows if r.doc_id in (1, 2)} == {0}
    single = fingerprints.compare_with_edits(odd.where("doc_id = 4")).collect()
    assert [r.near_next for r in single] == [1.0]


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(7)
    values = [rng.getrandbits(64) for _ in range(60)]
    values = sorted({*values, *[v ^ sum(1 << b for b in rng.sample(range(64), k)) for v in values for k in (1, 2, 3, 4)]})
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed] + [(None,)], "_fingerprint long")
    some = frame.where("pmod(_fingerprint, 3) = 0")
    got = [tuple(r) for r in fingerprints.within(some, frame).collect()]
    wanted = {(a, b) for a in signed for b in signed if a % 3 == 0 and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert set(got) == wanted and len(got) == len(wanted)


def test_rows_within_the_radius_are_counted(docs):
    rows = fingerprints.compare_with_edits(docs)
    got = {r.doc_id: (r._fingerprint, r.n_within) for r in fingerprints.count_within(rows, F.col("doc_id") % 20 == 0).collect()}
    prints = [f for f, _ in got.values()]
    assert len(got) == rows.count()
    for i, (f, n) in got.items():
        assert n == (sum(((f ^ g) % (1 << 64)).bit_count() <= 3 for g in prints) if i % 20 == 0 else None)


# --- sharding


@pytest.mark.parametrize("blocks", [12, sharding.SUMMARY_BLOCKS])
def test_shards_have_the_least_capacity(spark, monkeypatch, blocks):
    monkeypatch.setattr(sharding.GroupEnds.__init__, "__defaults__", (blocks,))
    rng = random.Random(blocks)
    for n_rows, n in ((0, 8), (1, 8), (3, 2), (60, 8), (300, 8)):
        rows = [(i, rng.choice([None, "", "a", "é" * rng.randrange(200), str(rng.random()) * rng.randrange(30)])) for i in range(n_rows)]
        got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), n).collect()
        sizes = defaultdict(int)
        for _, t in rows:
            sizes[(t is not None, plain.sha(t or ""))] += len((t or "").encode()) + 1
        load, slots = Counter(), defaultdict(list)
        for r in got:
            load[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
        assert len(got) == n_rows and all(sorted(s) == list(range(len(s))) for s in slots.values())
        ordered = [s for _, s in sorted(sizes.items())]
        assert not rows or max(load.values()) == plain.least_capacity(ordered, n)
        assert set(load) <= set(range(n))


def test_equal_texts_share_a_shard(docs, odd):
    rows = docs.select("doc_id", "text").unionByName(docs.selectExpr("doc_id + 100000 AS doc_id", "text"))
    got = {r.doc_id: r.shard for r in sharding.shards(rows).collect()}
    assert all(got[i] == got[i + 100_000] for i in got if i < 100_000)
    assert sharding.shards(odd).count() == 9


def test_fingerprints_of_text_and_day_ids(spark, docs):
    """Ids that sort alike give the same, whatever their type; a quote and a backslash in an id do no harm."""
    own = {r.doc_id: (r.edited_sha256, r._fingerprint, r.near_next) for r in fingerprints.compare_with_edits(docs.where("doc_id < 150"), slices=9).collect()}
    for named, back in ((F.concat(F.lit("o'n\\\\e-"), F.lpad(F.col("doc_id").cast("string"), 6, "0")), lambda i: int(i[-6:])), (F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")), lambda i: i.toordinal() - 737425)):
        rows = fingerprints.compare_with_edits(docs.where("doc_id < 150").withColumn("doc_id", named), slices=9).collect()
        assert {back(r.doc_id): (r.edited_sha256, r._fingerprint, r.near_next) for r in rows} == own


# --- licences


def test_licences_by_lines_paragraphs_and_whole(spark, odd, none):
    mit = licenses.TEMPLATES[2][1]
    rows = [
        (1, "intro\nReleased under the MIT license!\nmore"),
        (2, "Text before.\n\n" + mit.replace(", ", ",\n") + "\n\nText after."),
        (3, mit),
        (4, "licensed under the apache license version 2.0 \nAll Rights Reserved"),
        (5, "released under the moon"),
        (6, None),
    ]
    got = {r.doc_id: [x.license for x in r.licenses] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["MIT"], 2: ["MIT"], 3: ["MIT"], 4: ["Apache-2.0", "reserved"], 5: [], 6: []}
    assert licenses.scan(odd).count() == 9 and licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(odd, templates=[("x", "one")])


def _plain_licences(text):
    """All windows by hand: lines, sentences, paragraphs and runs of them, the whole."""

    def normal(t):
        return re.sub(r"[\W_]+", " ", t.lower()).strip()

    lines = (text or "").split("\n")
    parts = [p for p in (normal(p) for p in re.split(r"\n[^\w\n]*(?:\n[^\w\n]*)+", text or "")) if p]
    found, grams = {}, [(name, licenses.bigrams_of(body)) for name, body in licenses.TEMPLATES]
    whole = [" ".join(parts[i:k]) for i in range(len(parts)) for k in range(i + 1, len(parts) + 1)]
    for unit in {normal(u) for u in [*lines, *re.split(r"[.!?](?=[ \t\n\f\r])", text or ""), *whole]}:
        w = unit.split()
        own = Counter(f"{a} {b}" for a, b in zip(w, w[1:]))
        for name, g in grams:
            dice = 2 * sum((own & g).values()) / (sum(own.values()) + sum(g.values()))
            if dice >= 0.8:
                found[name] = max(found.get(name, 0), dice)
    return found


def test_licences_are_those_of_all_windows(spark):
    """Licences in pieces among other text: cut into paragraphs, with words lost, behind a copyright line."""
    chance, rows = random.Random(6), []
    code = [f"int f{k}(int x) {{ return x * {k}; }}" for k in range(40)]
    for k, (_, body) in enumerate(licenses.TEMPLATES):
        w = body.split()
        third = len(w) // 3 if len(w) > 20 else len(w)
        pieces = "\n\n".join(" ".join(p) for p in (w[:third], w[third : 2 * third], w[2 * third :]) if p)
        rows += [
            (4 * k, "MIT or not\n\n(c) 2020 Jane\n\n" + pieces + "\n\n" + "\n".join(code)),
            (4 * k + 1, f"// Copyright 2020 Jane Doe. {body} More of it! And more."),
            (4 * k + 2, "\n".join(code[:9]) + "\n \n" + " ".join(x for x in w if chance.random() > 0.06) + "\n\n\n" + "\n\n".join(code)),
            (4 * k + 3, "\n\n".join([*code[:3], pieces, pieces, *code[:2]])),
        ]
    got = {r.doc_id: {x.license: round(x.dice, 9) for x in r.licenses} for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        # A run that begins with a paragraph like no template is not looked at, and never the best one.
        assert got[i] == {name: round(d, 9) for name, d in _plain_licences(text).items()}, (i, text[:80])
    assert all(got[4 * k][name] == 1.0 for k, (name, _) in enumerate(licenses.TEMPLATES))
    assert got[1] == {"MIT": 1.0}


def test_telling_words_lose_no_match():
    rng = random.Random(3)
    for _, body in licenses.TEMPLATES:
        grams = licenses.bigrams_of(body)
        telling = licenses.telling_words(grams, 0.8)
        own = body.lower().replace(".", "").split()
        for _ in range(200):
            kept = [w for w in own if rng.random() > 0.1]
            n = Counter(zip(kept, kept[1:]))
            common = sum((n & Counter(zip(own, own[1:]))).values())
            if kept and 2 * common >= 0.8 * (sum(n.values()) + len(own) - 1):
                assert set(licenses.bigrams_of(" ".join(kept))) and telling & {w for g in licenses.bigrams_of(" ".join(kept)) for w in g.split()}


def test_telling_bigrams_lose_no_match():
    rng = random.Random(4)
    for _, body in licenses.TEMPLATES:
        grams = licenses.bigrams_of(body)
        telling = licenses.telling_bigrams(grams, 0.8)
        own = re.sub(r"[\W_]+", " ", body.lower()).split()
        for _ in range(200):
            kept = [w for w in own if rng.random() > 0.1]
            n = Counter(f"{a} {b}" for a, b in zip(kept, kept[1:]))
            if 2 * sum((n & grams).values()) >= 0.8 * (sum(n.values()) + sum(grams.values())) > 0:
                assert telling & set(n)


def test_licences_of_repeated_bigrams_and_short_paragraphs(spark):
    """Units as the rules have them, by hand: templates that repeat bigrams, paragraphs of few words, runs over many of them."""
    templates = [("A", "u v u v u v w"), ("B", "x y z x y"), ("C", "u v w q e f g h i j u v w q"), ("D", "x y")]
    known = [(name, licenses.bigrams_of(body)) for name, body in templates]
    every = {g for _, grams in known for g in grams}
    rng, rows = random.Random(7), []
    for k in range(300):
        w = " ".join(body for _, body in rng.choices(templates, k=rng.randint(1, 3))).split()
        w = [x if rng.random() > 0.08 else rng.choice("uvwxyzk") for x in w]
        rows.append((k, "".join(x + rng.choice([" ", " ", " ", ", ", "\n", ". ", "\n\n", "\n \n\n"]) for x in w)))

    def grams_of(unit):
        return Counter(f"{a} {b}" for a, b in zip(unit.split(), unit.split()[1:]))

    def found(text):
        flat = lambda t: " ".join(re.findall(r"[a-z]+", t))
        parts = [p for p in map(flat, re.split(r"\n ?(?:\n ?)+", text)) if p]
        starts = [i for i, p in enumerate(parts) if set(grams_of(p)) & every]
        cut = {flat(u) for u in [*text.split("\n"), *re.split(r"[.!?](?=\s)", text), *parts, text]}
        out = {}
        for unit in cut | {" ".join(parts[i:k]) for i in starts for k in range(i + 2, len(parts) + 1)}:
            own = grams_of(unit)
            for name, grams in known:
                dice = 2 * sum((own & grams).values()) / (sum(own.values()) + sum(grams.values()))
                if dice >= 0.8:
                    out[name] = max(out.get(name, 0), round(dice, 9))
        return out

    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: {x.license: round(x.dice, 9) for x in r.licenses} for r in licenses.scan(frame, templates=templates).collect()}
    assert got == {k: found(text) for k, text in rows}
    assert len({n for x in got.values() for n in x}) == 4


def test_a_long_paragraph_takes_no_longer_than_its_words_in_short_ones(spark):
    words = "released under the mit license and other words of the text without a line end ".split() * 1500

    def seconds(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        started = time.perf_counter()
        found = licenses.scan(frame).collect()
        return time.perf_counter() - started, found

    short = [(k, " ".join(words[k : k + 75])) for k in range(0, len(words), 75)]
    seconds(short)
    least, _ = seconds(short)
    most, found = seconds([(1, " ".join(words))])
    assert not found[0].licenses
    assert most < 5 * max(least, 1)


def test_size_bounds_lose_no_match():
    for n in range(1, 60):
        low, high = licenses.bounds(n, 0.8)
        like = [m for m in range(1, 200) if 2 * min(n, m) / (n + m) >= 0.8 - 1e-12]
        assert (like[0], like[-1]) == (low, high)
