"""The toxicity network's forward pass, the language distance and bootstrapped identifiers against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import langid, pii, toxicity, words
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")


# --- toxicity: one window after the other, one word after the other


def _hash(part: bytes) -> int:
    data = np.frombuffer(part, np.uint8)
    return int(words.Hasher.of_bytes(data)(np.array([0]), np.array([len(part)]))[0])


def _plain_logit(net, text):
    own = plain.words(text)
    w = {k: v.astype(np.float64) for k, v in net.weights.items()}
    known = {int(h): k + 1 for k, h in enumerate(net.words)}
    runs = {int(h): k + 1 for k, h in enumerate(net.runs)}

    def vector(word):
        b = word.encode()
        found = [runs.get(_hash(b[:n]), 0) if len(b) >= n else 0 for n in toxicity.BEGINNINGS]
        last = int(words.mix(np.array([_hash(b[-toxicity.ENDING :])], np.uint64))[0]) if len(b) >= toxicity.ENDING else 0
        found = [k for k in [*found, runs.get(last, 0)] if k]
        return w["word"][known.get(_hash(b), 0)] + sum((w["chars"][k] for k in found), np.zeros(w["word"].shape[1])) / max(len(found), 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def read(vectors, d):
        size, state, out = w["hf"].shape[0], np.zeros(w["hf"].shape[0]), []
        for v in vectors:
            x, u = v @ w[f"x{d}"] + w[f"c{d}"], state @ w[f"h{d}"]
            z, r = sigmoid(x[:size] + u[:size]), sigmoid(x[size : 2 * size] + u[size : 2 * size])
            state = z * state + (1 - z) * np.tanh(x[2 * size :] + r * u[2 * size :])
            out.append(state)
        return out

    if not own:
        return float(w["bias"][0])
    starts = [0]
    while starts[-1] + toxicity.WINDOW < len(own):
        starts.append(min(starts[-1] + toxicity.STRIDE, len(own) - toxicity.WINDOW))
    best = -math.inf
    for start in starts:
        vectors = [vector(x) for x in own[start : start + toxicity.WINDOW]]
        states = [np.concatenate(p) for p in zip(read(vectors, "f"), read(vectors[::-1], "b")[::-1])]
        weight = np.exp([s @ w["attend"] for s in states])
        best = max(best, float(sum(a * s for a, s in zip(weight / weight.sum(), states)) @ w["out"] + w["bias"][0]))
    return best


def test_scores_are_those_of_a_plain_forward_pass(spark, docs):
    rows = docs.limit(60).collect()
    chance = random.Random(2)
    texts = [" ".join(plain.words(r.text)[:200]) + (" awful rubbish idiot" if chance.random() < 0.4 else "") for r in rows]
    net = toxicity.train(texts, [int("idiot" in t) for t in texts], toxicity.Settings(epochs=4, steps=8))
    asked = [(k, t) for k, t in enumerate([*texts[:25], "", None, "idiot", "Ünïcode, ONE two!", " ".join(f"w{k % 7}" for k in range(33))])]
    got = {r.k: r.score for r in toxicity.score(spark.createDataFrame(asked, "k int, text string"), net).collect()}
    for k, text in asked:
        assert got[k] == pytest.approx(1 / (1 + math.exp(-_plain_logit(net, text))), abs=2e-4), k


# --- language: out-of-place distance over ranked n-grams


def _key(gram: str) -> int:
    """Ties go by code points, a word's edge first; shorter n-grams apart."""
    value = 0
    for c in gram:
        value = value << 21 | (0 if c == "_" else ord(c))
    value |= len(gram) << 62 if len(gram) < 3 else 0
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def _ranked(counts, size=langid.PROFILE_GRAMS):
    return {g: k for k, g in enumerate(sorted(counts, key=lambda g: (-counts[g], _key(g)))[:size])}


def test_languages_are_those_of_the_plain_distance(spark, docs):
    rows = docs.collect()
    teaching = [r for r in rows if r.doc_id % 3]
    counts = {}
    for r in teaching:
        if r.lang is not None:
            counts.setdefault(r.lang, plain.n_grams(None)).update(plain.n_grams(r.text))
    profiles = {lang: _ranked(c) for lang, c in counts.items() if c}
    learnt = langid.learn(docs.where("doc_id % 3 <> 0"))
    # Short texts have many ties; equal letters in other orders too.
    more = spark.createDataFrame([(10_000 + k, t, None) for k, t in enumerate(["a", "ab ba", "der the les", "zz", "é", "The THE the", "1 2 3", None])], docs.schema)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.unionByName(more), learnt, keep=["doc_id"]).collect()}
    size = langid.PROFILE_GRAMS
    for r in [*rows, *more.collect()]:
        own = _ranked(plain.n_grams(r.text))
        if not own:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        apart = {lang: sum(abs(p[g] - k) if g in p else size for g, k in own.items()) for lang, p in profiles.items()}
        best = min(sorted(apart), key=apart.get)
        assert got[r.doc_id][0] == best and got[r.doc_id][1] == pytest.approx(1 - apart[best] / (len(own) * size)), r.doc_id


# --- personal data: identifiers of no rule, told by their context alone


def test_bootstrapped_patterns_find_identifiers_that_no_rule_knows(spark, docs):
    """Planted among real texts: twelve addresses and four staff numbers stand after the same words; the latter are found by these alone."""
    texts = {r.doc_id: r.text for r in docs.where("text IS NOT NULL").collect()}
    ids = sorted(texts)[:40]
    hidden = {ids[30]: "ZX-88-410", ids[31]: "kt4471", ids[32]: "9931 4410 22", ids[33]: "emp_0071"}
    for k, i in enumerate(ids[:12]):
        texts[i] += f"\nPlease forward replies towards mailbox person{k}@host{k}.example today."
    for i, name in hidden.items():
        texts[i] += f"\nPlease forward replies towards mailbox {name} today."
    texts[ids[34]] += "\nThe mailbox was 77123 letters full."  # like one, but elsewhere
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.pii_spans] for r in pii.extract(frame).collect()}
    for i, name in hidden.items():
        assert not any(name in texts[i][a:b] for _, a, b in pii.rule_spans(texts[i])) and not any(name in texts[i][a:b] for a, b in pii.keyed_secrets(texts[i]))
        assert ("context", name) in got[i]
    assert not any("77123" in t for _, t in got[ids[34]])
    # Without the addresses there is nothing to learn from, and nothing is found.
    alone = frame.where(~F.col("doc_id").isin(ids[:12]))
    untaught = {r.doc_id: r.pii_spans for r in pii.extract(alone).collect()}
    assert all(not any(texts[i][s.start : s.end] == name for s in untaught[i]) for i, name in hidden.items())
