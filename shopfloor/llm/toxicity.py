"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters the network as the sum of two looked-up vectors: one for the whole word and the mean of
those of its character runs: its beginnings of several lengths and its end, which also cover words never
met in training. Words and runs found in few training texts have no vector, since it would only learn
those texts by heart; they are told apart by 64-bit hashes. Windows of ``WINDOW`` words that overlap by half cover the whole
text; each is read in both directions, its states are pooled by attention, and the text's score is that
of its most toxic window.

The network is small and is fitted on the driver on a bounded sample of labelled rows (``Settings``);
tasks then score all texts with it. What does not depend on the place in the text is worked out once
for each different word of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.ship import beside, mapped, renamed

WINDOW, STRIDE = 32, 16
#: Character runs of a word: its first so many bytes, and its last three.
BEGINNINGS, ENDING = (2, 3, 4, 5, 6, 8), 3
_SLICE_BYTES = 1 << 19


@dataclass(frozen=True)
class Settings:
    """Sizes of the network and of its training."""

    #: Labelled rows of each class used for fitting, at most, and the length of texts among them in bytes.
    rows_per_class: int = 1500
    longest_text: int = 6000
    #: Training texts that a word, or a character run, must occur in to get a vector.
    texts_of_word: int = 6
    embedding: int = 8
    hidden: int = 8
    #: Epochs, the steps of each, and the windows of a step: a quarter toxic, a quarter hard, half of any clean texts.
    epochs: int = 12
    steps: int = 60
    #: Of the training texts, one in so many is kept to choose the epoch and the threshold by.
    kept_apart: int = 5
    #: Share of the words left out at random while training.
    left_out: float = 0.2
    decay: float = 0.02
    batch: int = 64
    rate: float = 0.015
    seed: int = 7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Hashes of the words and runs that have a vector (sorted), and the weights: both tables (row 0: none), each direction's gates, attention and output."""

    words: np.ndarray
    runs: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, s: Settings, word_hashes: np.ndarray, run_hashes: np.ndarray, word_leaning: np.ndarray, run_leaning: np.ndarray) -> Network:
        """Random small weights; the first value of a word's vector and the second of a run's say which way it leans."""
        r = np.random.default_rng(s.seed)
        e, h = s.embedding, s.hidden

        def normal(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        w = {"word": normal(len(word_hashes) + 1, e, scale=0.1), "chars": normal(len(run_hashes) + 1, e, scale=0.1)}
        w["word"][1:, 0], w["chars"][1:, 1] = word_leaning, run_leaning
        w["word"][0] = w["chars"][0] = 0
        for d in ("f", "b"):
            w |= {f"x{d}": normal(e, 3 * h, scale=e**-0.5), f"h{d}": normal(h, 3 * h, scale=h**-0.5), f"c{d}": np.zeros(3 * h, np.float32)}
        return cls(word_hashes, run_hashes, w | {"attend": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.3), "bias": np.full(1, -1, np.float32)})


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts of a slice: the number of each word among the different ones, the first word of each row, and for each different word its hash and those of its character runs (0: none)."""
    data = words.LOWER[data]
    starts, ends, firsts = words.find(data, offsets, words.ALNUM)
    hasher = words.Hasher.of_bytes(data)
    hashes, first, number = np.unique(hasher(starts, ends), return_index=True, return_inverse=True)
    a, b = starts[first], ends[first]
    runs = [np.where(b - a >= n, hasher(a, np.minimum(a + n, b)), 0) for n in BEGINNINGS]
    runs.append(np.where(b - a >= ENDING, words.mix(hasher(np.maximum(b - ENDING, a), b)), 0))
    return number.astype(np.int32), firsts, hashes, np.stack(runs, 1).astype(np.uint64)


def _rows(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows of a table: 1 + the place among the known hashes, or 0."""
    if not len(known):
        return np.zeros(hashes.shape, np.int32)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0).astype(np.int32)


def _frequent(row: np.ndarray, hashes: np.ndarray, toxic: np.ndarray, teaching: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes that occur in ``least`` rows or more, and how surely each leans to toxic rows: its log-odds in standard errors, within -1 and 1."""
    order = np.lexsort((row, hashes))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    row, hashes = row[new], hashes[new]
    found, number = np.unique(hashes, return_inverse=True)
    n = np.bincount(number, minlength=len(found))
    n_toxic = np.bincount(number, weights=toxic[row], minlength=len(found))
    a, b = n_toxic + 0.5, n - n_toxic + 0.5
    odds = np.log(a / ((toxic & teaching).sum() + 1)) - np.log(b / ((~toxic & teaching).sum() + 1))
    keep = (n >= least) & (found != 0)
    return found[keep], (np.clip(odds / np.sqrt(1 / a + 1 / b) / 5, -1, 1)[keep]).astype(np.float32)


def windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and length of every window; the last one of a text ends with it."""
    n = np.diff(firsts)
    each = np.where(n == 0, 0, 1 + np.maximum(-(-(n - WINDOW) // STRIDE), 0))
    row = np.repeat(np.arange(len(n)), each)
    k = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    start = firsts[:-1][row] + np.minimum(k * STRIDE, np.maximum(n[row] - WINDOW, 0))
    return row, start, np.minimum(n[row], WINDOW)


def _embed(w: dict[str, np.ndarray], word: np.ndarray, chars: np.ndarray) -> np.ndarray:
    share = (1 / np.maximum((chars > 0).sum(axis=1, keepdims=True), 1)).astype(np.float32)
    out = w["word"][word]
    for k in range(chars.shape[1]):
        out = out + w["chars"][chars[:, k]] * share
    return out


def _read(inputs: np.ndarray, mask: np.ndarray | None, w_h: np.ndarray, hidden: int, tape: list | None = None) -> np.ndarray:
    """States after each step; ``inputs`` are (steps, windows, gates), ``mask`` (steps, windows) or None for all."""
    h = np.zeros((inputs.shape[1], hidden), np.float32)
    out = np.empty((*inputs.shape[:2], hidden), np.float32)
    for t in range(len(inputs)):
        x, u = inputs[t], h @ w_h
        zr = _sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        c = np.tanh(x[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        new = z * h + (1 - z) * c
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if tape is not None:
            tape.append((h, z, r, c, u[:, 2 * hidden :]))
        out[t] = h = new
    return out


def _unread(grad: np.ndarray, tape: list, mask: np.ndarray, w_h: np.ndarray, hidden: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of ``w_h`` from those of the states."""
    d_inputs = np.zeros((*grad.shape[:2], 3 * hidden), np.float32)
    d_w, d_h = np.zeros_like(w_h), np.zeros(grad.shape[1:], np.float32)
    for t in range(len(grad) - 1, -1, -1):
        h, z, r, c, u = tape[t]
        total = d_h + grad[t]
        on = mask[t][:, None]
        d_new = np.where(on, total, 0)
        d_c = d_new * (1 - z) * (1 - c * c)
        d_z = d_new * (h - c) * z * (1 - z)
        d_r = d_c * u * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
        d_inputs[t] = np.concatenate([d_z, d_r, d_c], axis=1)
        d_w += h.T @ d_u
        d_h = np.where(on, d_new * z, total) + d_u @ w_h.T
    return d_inputs, d_w


def _pool(w: dict[str, np.ndarray], states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the windows, the attention and the pooled states."""
    e = states @ w["attend"]
    if mask is not None:
        e = np.where(mask, e, -np.inf)
    e = np.exp(e - e.max(axis=0))
    a = e / e.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", a, states)
    return pooled @ w["out"] + w["bias"][0], a, pooled


def logits(net: Network, tables: dict[str, np.ndarray], at: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """Logits of windows of different words ``at`` (steps, windows); ``tables`` are the gates' inputs of the different words."""
    w = net.weights
    hidden = w["hf"].shape[0]
    forward = _read(tables["f"][at], mask, w["hf"], hidden)
    backward = _read(tables["b"][at[::-1]], None if mask is None else mask[::-1], w["hb"], hidden)[::-1]
    return _pool(w, np.concatenate([forward, backward], axis=2), mask)[0]


def gate_tables(net: Network, word: np.ndarray, chars: np.ndarray) -> dict[str, np.ndarray]:
    w = net.weights
    embedded = _embed(w, word, chars)
    return {d: embedded @ w[f"x{d}"] + w[f"c{d}"] for d in ("f", "b")}


def text_logits(net: Network, data: np.ndarray, offsets: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """The largest window logit of each text; the output's bias alone for a text without words."""
    number, firsts, hashes, run_hashes = word_hashes(data, offsets)
    word, chars = _rows(net.words, hashes), _rows(net.runs, run_hashes)
    out = np.full(len(offsets) - 1, -np.inf)
    if len(number):
        tables = gate_tables(net, word, chars)
        row, start, length = windows(firsts)
        steps = np.arange(WINDOW)[:, None]
        for full in (True, False):
            chosen = np.flatnonzero((length == WINDOW) == full)
            for k in range(0, len(chosen), at_once):
                c = chosen[k : k + at_once]
                mask = None if full else steps < length[c]
                at = number[np.minimum(start[c] + steps, len(number) - 1)]
                np.maximum.at(out, row[c], logits(net, tables, at, mask))
    return np.where(np.isinf(out), net.weights["bias"][0], out)


def _gradients(net: Network, word: np.ndarray, chars: np.ndarray, at: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted cross-entropy. Table gradients come as (rows, values)."""
    w = net.weights
    hidden = w["hf"].shape[0]
    used, number = np.unique(at, return_inverse=True)
    number = number.reshape(at.shape)
    word, chars = word[used], chars[used]
    embedded = _embed(w, word, chars)
    tapes = {"f": [], "b": []}
    states = {}
    for d, turn in (("f", 1), ("b", -1)):
        table = embedded @ w[f"x{d}"] + w[f"c{d}"]
        states[d] = _read(table[number[::turn]], mask[::turn], w[f"h{d}"], hidden, tapes[d])[::turn]
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logit, a, pooled = _pool(w, both, mask)
    d_logit = ((_sigmoid(logit) - label) * weight / weight.sum()).astype(np.float32)
    g = {"bias": np.array([d_logit.sum()]), "out": pooled.T @ d_logit}
    d_pooled = d_logit[:, None] * w["out"]
    d_a = np.einsum("tbh,bh->tb", both, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    g["attend"] = np.einsum("tb,tbh->h", d_e, both)
    d_both = a[:, :, None] * d_pooled + d_e[:, :, None] * w["attend"]
    d_embedded = np.zeros_like(embedded)
    for d, turn, part in (("f", 1, d_both[:, :, :hidden]), ("b", -1, d_both[:, :, hidden:])):
        d_in, g[f"h{d}"] = _unread(part[::turn], tapes[d], mask[::turn], w[f"h{d}"], hidden)
        flat = np.zeros((len(used), 3 * hidden), np.float32)
        np.add.at(flat, number[::turn].ravel(), d_in.reshape(-1, 3 * hidden))
        g[f"x{d}"], g[f"c{d}"] = embedded.T @ flat, flat.sum(axis=0)
        d_embedded += flat @ w[f"x{d}"].T
    some = chars > 0
    share = 1 / np.maximum(some.sum(axis=1), 1)
    met = word > 0
    g["word"] = (word[met], d_embedded[met])
    g["chars"] = (chars[some], np.broadcast_to((d_embedded * share[:, None])[:, None, :], (*chars.shape, d_embedded.shape[1]))[some])
    return g


def train(texts: list[str], labels: list[int], settings: Settings = Settings(), share: float | None = None) -> Network:
    """Fit a network. ``share`` is that of toxic rows where it will be used (as in ``labels`` by default). A toxic text teaches by its most toxic window so far, a clean one by its worst and some other windows.

    With one class only, or no texts, the network has no words and says that class (clean, if none).
    """
    y = np.array(labels, np.float32)
    none = np.zeros(0, np.uint64)
    if not len(y) or y.min() == y.max():
        net = Network.start(settings, none, none, none, none)
        net.weights["out"][:] = 0
        net.weights["bias"][:] = 4 if len(y) and y[0] == 1 else -4
        return net
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    parts = [word_hashes(data, offsets) for _, data, offsets in words.slices(batch, "t", _SLICE_BYTES)]
    hashes, place = np.unique(np.concatenate([h for _, _, h, _ in parts]), return_index=True)
    run_hashes = np.concatenate([runs for _, _, _, runs in parts])[place]
    number = np.searchsorted(hashes, np.concatenate([h[n] for n, _, h, _ in parts])).astype(np.int32)
    firsts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f, _, _ in parts]))])
    r = np.random.default_rng(settings.seed)
    apart = np.zeros(len(y), bool)
    for value in (0, 1):
        own = r.permutation(np.flatnonzero(y == value))
        apart[own[: len(own) // settings.kept_apart]] = True
    of_word = np.repeat(np.arange(len(y)), np.diff(firsts))
    teach = ~apart[of_word]
    row_of, number_of = of_word[teach], number[teach]
    runs_of = run_hashes[number_of]
    known, leaning = _frequent(row_of, hashes[number_of], y == 1, ~apart, settings.texts_of_word)
    known_runs, run_leaning = _frequent(np.repeat(row_of, runs_of.shape[1]), runs_of.ravel(), y == 1, ~apart, settings.texts_of_word)
    net = Network.start(settings, known, known_runs, leaning, run_leaning)
    word, chars = _rows(net.words, hashes), _rows(net.runs, run_hashes)
    row, start, length = windows(firsts)
    steps = np.arange(WINDOW)[:, None]
    at = number[np.minimum(start + steps, max(len(number) - 1, 0))]
    mask = steps < length

    def all_logits() -> np.ndarray:
        tables = gate_tables(net, word, chars)
        return np.concatenate([logits(net, tables, at[:, k : k + 4096], mask[:, k : k + 4096]) for k in range(0, len(row), 4096)])

    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    n_steps, kept = 0, (np.inf, None)
    few_windows = np.bincount(row, minlength=len(y))[row] <= 4
    toxic, learn = y[row] == 1, ~apart[row]
    own = all_logits()
    for epoch in range(settings.epochs):
        if epoch < 3:  # windows of short toxic texts are most surely the toxic ones
            picked = np.flatnonzero(toxic & learn & few_windows)
            picked = picked if len(picked) else np.flatnonzero(toxic & learn)
        else:
            order = np.lexsort((-own, row))
            best = order[np.unique(row[order], return_index=True)[1]]
            picked = best[toxic[best] & learn[best]]
        clean = np.flatnonzero(~toxic & learn)
        hard = clean[np.argsort(-own[clean])[: max(2 * len(picked), 200)]]
        for _ in range(settings.steps):
            s = np.concatenate([r.choice(of, settings.batch // k) for of, k in ((picked, 4), (hard, 4), (clean, 2))])
            weight = np.where(toxic[s], 1.0, 0.5).astype(np.float32)
            seen = np.where(r.random(len(word)) < settings.left_out, 0, 1).astype(np.int32)
            grads = _gradients(net, word * seen, chars * seen[:, None], at[:, s], mask[:, s], y[row[s]], weight)
            n_steps += 1
            _adam(net.weights, grads, moments, n_steps, settings.rate * (0.3 if epoch >= settings.epochs * 2 // 3 else 1), settings.decay)
        own = all_logits()
        found = np.full(len(y), net.weights["bias"][0], np.float32)
        found[np.unique(row)] = -np.inf
        np.maximum.at(found, row, own)
        judged = apart if len(set(y[apart])) == 2 else ~apart
        threshold, errors = _best_threshold(found[judged], y[judged], float(y.mean()) if share is None else share)
        if epoch >= 3 and errors <= kept[0]:
            kept = (errors, {k: v.copy() for k, v in net.weights.items()} | {"bias": net.weights["bias"] - threshold})
    net.weights = kept[1] or net.weights
    return net


def _best_threshold(logit: np.ndarray, y: np.ndarray, share: float) -> tuple[np.float32, float]:
    """The logit that errs least if ``share`` of all rows are toxic, in the middle of its gap, and its error rate."""
    order = np.argsort(logit)
    x, y = logit[order], y[order]
    missed = np.concatenate([[0], np.cumsum(y == 1) / max((y == 1).sum(), 1)])
    alarms = np.concatenate([np.cumsum((y == 0)[::-1])[::-1] / max((y == 0).sum(), 1), [0]])
    errors = share * missed + (1 - share) * alarms
    k = int(np.median(np.flatnonzero(errors <= errors.min() + 1e-12)))
    if k == len(x):
        return np.float32(x[-1] + 1), float(errors.min())
    return np.float32((x[max(k - 1, 0)] + x[k]) / 2), float(errors.min())


def _adam(weights: dict, grads: dict, moments: dict, step: int, rate: float, decay: float) -> None:
    for name, g in grads.items():
        if isinstance(g, tuple):
            at, inverse = np.unique(g[0], return_inverse=True)
            summed = np.zeros((len(at), g[1].shape[1]), np.float32)
            np.add.at(summed, inverse, g[1])
            g = summed
        else:
            at = slice(None)
        m, v = moments[name]
        m[at] = 0.9 * m[at] + 0.1 * g
        v[at] = 0.999 * v[at] + 0.001 * g * g
        if name in ("word", "chars"):
            weights[name][at] *= 1 - rate * decay
        weights[name][at] -= (rate * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """Fit on at most ``rows_per_class`` labelled rows of each class, chosen by a hash of the id among those with texts of at most ``longest_text`` bytes.

    Rows without id, text or label are no examples. Repeated rows may be drawn again; of an id with several texts
    the one with the least hash is read. The share of toxic texts is that of the examples, so labels of rows
    that are not in ``docs`` have no effect.
    """
    known = labels.where(F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_y"))
    sized = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.octet_length(F.col(f"`{text}`")).alias("_n")).where(F.col("_n").between(1, settings.longest_text))
    examples = known.join(sized.drop("_n"), "_id")
    n = {row["_y"]: row["count"] for row in examples.groupBy("_y").count().collect()}
    share = n.get(1, 0) / max(sum(n.values()), 1)
    chosen = {}
    for y in (0, 1):
        rows = examples.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(settings.rows_per_class).collect()
        chosen |= {row["_id"]: y for row in rows}
    if not chosen:
        return train([], [], settings)
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], f"_id {docs.schema[doc_id].dataType.simpleString()}")
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")).where("_text IS NOT NULL").join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text")).orderBy("_id").collect()
    return train([row["_text"] for row in texts], [chosen[row["_id"]] for row in texts], settings, share)


def score(docs: DataFrame, net: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more); columns of these names are replaced.

    Null and empty texts, and those without words, get the score of no evidence.
    """
    made = ["score", "predicted"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    source = beside(docs, kept, _source=F.col(f"`{text}`"))
    schema = T.StructType([*renamed(source.schema.fields, kept), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    sent = docs.sparkSession.sparkContext.broadcast(net)  # its size is fixed by the settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "_source", _SLICE_BYTES):
                found = _sigmoid(text_logits(sent.value, data, offsets).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))], [*kept, *made])

    return mapped(source, run, schema)
