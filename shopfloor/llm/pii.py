"""Personal data in texts: rules for four kinds, and identifiers that only their context gives away.

The rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers. What they find are the
seeds, and so are quoted values of keys that name a secret (``token = "..."``); the latter are spans found
by context, as the rules have no kind for them. Four forms of pattern are induced for each seed: the two
words before it; the word before it with all that stands between; what stands after it with the next
word; and what stands before it with the shape of its first word, if that is long and of letters and
digits. Other strings that look like identifiers and stand at the same patterns are candidates. Patterns
and instances form a graph that is scored in rounds, as Spark jobs: a pattern's confidence is the weight of
its reliable instances among all places in the corpus that it fits; a candidate's reliability is that of
having one good pattern at least. What stands at patterns of high confidence is added to the spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.decontaminate import Words
from shopfloor.llm.ship import beside, mapped, named
from shopfloor.operators.joins import small
from shopfloor.session import stage

#: Kinds of the rules, in the order of their spans; then that of spans found by context.
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
#: Bits of the filter that lets most places of no pattern go unsent; the rest are joined exactly.
FILTER_BITS = 22
#: Bytes between a word and its neighbour, at most, that make up a pattern; and bytes of a word whose shape is one, at least.
MOST_BETWEEN, LEAST_SHAPED = 16, 12
#: Sums that a task holds before it joins equal ones.
HELD_SUMS = 1 << 20


@dataclass(frozen=True)
class Bootstrap:
    """How patterns are judged: different seeds they need, confidence they need, rounds."""

    seeds: int = 3
    confidence: float = 0.8
    rounds: int = 3


_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CHUNK = re.compile(r"[^\s\"'<>()\[\]{},;|]+")
_TRIM = ".,:;!?*#%&$=`~-"
_VALUE = re.compile(r"""[=:][ \t]{0,3}(["'])([^"'\s]{8,})\1""")
_SECRET_KEY = re.compile(r"""(?i)(?:token|secret|passw(?:or)?d|passphrase|pwd|credentials?|(?:api|access|private|secret|auth)[_-]?key|key)["']?[ \t]{0,3}$""")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of an address, left to right. Each @ is looked at once, so time is linear."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        start = at - (len(local) - len(local.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Four numbers joined by dots, each at most 255; longer chains are cut by fours from the left."""
    found = []
    for run in _DOTTED.finditer(text):
        at, chain = run.start(), []
        for part in run[0].split("."):
            chain = [*chain, (at, part)] if part else []
            if len(chain) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for _, p in chain):
                    found.append((chain[0][0], at + len(part)))
                chain = []
            at += len(part) + 1
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(number of the kind, start, end) of all that the rules find."""
    return [(k, a, b) for k, find in enumerate((emails, addresses, cards, phones)) for a, b in find(text)]


def keyed_secrets(text: str) -> list[tuple[int, int]]:
    """Quoted values of eight characters or more whose key names a secret."""
    return [m.span(2) for m in _VALUE.finditer(text) if _SECRET_KEY.search(text, max(0, m.start() - 24), m.start())]


def _chunk(text: str, m: re.Match) -> tuple[int, int]:
    return m.start() + len(m[0]) - len(m[0].lstrip(_TRIM)), m.start() + len(m[0].rstrip(_TRIM))


def _grouped(text: str) -> Iterator[tuple[int, int]]:
    """Chunks of a text; those with digits that follow each other after one space count as one."""
    start = end = -1
    for m in _CHUNK.finditer(text):
        a, b = _chunk(text, m)
        if a >= b:
            continue
        digits = any(c.isdigit() for c in text[a:b])
        if end >= 0 and digits and a == end + 1 and text[end] == " ":
            end = b
            continue
        if end >= 0:
            yield start, end
        start, end = a, b
        if not digits:
            yield a, b
            start = end = -1
    if end >= 0:
        yield start, end


def _free(spans: Iterator[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans, in order, that don't overlap those taken."""
    busy, k = sorted(taken), 0
    for start, end in spans:
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        if k == len(busy) or busy[k][0] >= end:
            yield start, end


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Strings of five characters or more that have a digit, an @ or a _ and don't overlap what the rules found; groups with digits count as one."""
    like = ((a, b) for a, b in _grouped(text) if b - a >= 5 and any(c in "@_0123456789" for c in text[a:b]))
    return list(_free(like, [(a, b) for _, a, b in taken]))


def filler(text: str, at: int) -> tuple[int, int] | None:
    """What stands at a place that a trusted pattern names, of any length: groups with digits, capitalised words, or one word."""
    m = _CHUNK.match(text, at)
    if not m:
        return None
    start, end = _chunk(text, m)
    if start >= end:
        return None
    same = (lambda t: any(c.isdigit() for c in t)) if any(c.isdigit() for c in text[start:end]) else (lambda t: t[:1].isupper() and t.isalpha())
    while same(text[start:end].rpartition(" ")[2]) and end < len(text) and text[end] in " -":
        m = _CHUNK.match(text, end + 1)
        more = _chunk(text, m) if m else (0, 0)
        if not m or more[0] != end + 1 or more[1] <= more[0] or not same(text[more[0] : more[1]]):
            break
        end = more[1]
    return start, end


def _maybe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a digit, an @, a _, a = or a colon; no other row has a seed or a candidate."""
    hit = np.flatnonzero(((data >= 48) & (data <= 58)) | (data == 61) | (data == 64) | (data == 95))
    return np.unique(np.searchsorted(offsets, hit, "right") - 1)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_SLOT = T.StructType([T.StructField("pattern", T.LongType()), T.StructField("instance", T.LongType()), T.StructField("seed", T.BooleanType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_SLOT_ARROW = pa.list_(pa.struct([("pattern", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()), ("start", pa.int32()), ("end", pa.int32())]))


class Places:
    """Pattern hashes at every word of the texts of a slice, by form; zero where a form has none."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = own = Words(data, offsets)
        n = len(own.starts)
        at = np.arange(n)
        first = np.repeat(own.firsts[:-1], own.counts)
        self.forms = np.zeros((4, n), np.uint64)
        if not n:
            return
        pair = at[at - 2 >= first]
        self.forms[0, pair] = own.hashes(pair - 2, np.full(len(pair), 2))
        after = at[at - 1 >= first]
        after = after[own.starts[after] - own.ends[after - 1] <= MOST_BETWEEN]
        between = words.Hasher.of_bytes(own.data)(own.ends[after - 1], own.starts[after])
        alone = own.hashes(at, np.ones(n, np.int64))
        odd = np.uint64(0x9E3779B97F4A7C15)
        self.forms[1, after] = words.mix(alone[after - 1] * odd + between + np.uint64(1))
        self.forms[2, after - 1] = words.mix(alone[after] * odd + between + np.uint64(2))
        digits, upper, hexes = (np.concatenate([[0], np.cumsum(x)]) for x in ((data >= 48) & (data <= 57), (data >= 65) & (data <= 90), (own.data >= 97) & (own.data <= 102)))
        size = own.ends - own.starts
        has = lambda x: x[own.ends] - x[own.starts]
        kind = size * 4 + 2 * (has(upper) > 0) + (has(digits) + has(hexes) == size)
        shaped = (size[after] >= LEAST_SHAPED) & (has(digits)[after] > 0) & (has(digits)[after] < size[after])
        self.forms[3, after[shaped]] = words.mix(kind[after[shaped]].astype(np.uint64) * odd + between[shaped] + np.uint64(3))


def _slots(texts: list[str], spans: list[list[tuple[bool, int, int]]]) -> list[list[dict]]:
    """For each span (seed?, start, end): the hashes of the patterns it stands at and of its text."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    _, data, offsets = next(words.slices(batch, "t", 1 << 40))
    places, exact = Places(data, offsets), words.Hasher.of_bytes(data)
    own, out = places.words, []
    for row, (text, found) in enumerate(zip(texts, spans)):
        made, at, before = [], 0, int(offsets[row])
        for seed, start, end in sorted(found, key=lambda s: s[1:]):
            before, at = before + len(text[at:start].encode()), start
            after = before + len(text[start:end].encode())
            k, m = int(np.searchsorted(own.starts, before)), int(np.searchsorted(own.starts, after)) - 1
            if k > m or k > own.firsts[row] and own.ends[k - 1] > before:
                continue
            instance = int(exact(np.array([before]), np.array([after])).view(np.int64)[0])
            for form in range(4):
                pattern = int(places.forms[form].view(np.int64)[m if form == 2 else k])
                if pattern:
                    made.append({"pattern": pattern, "instance": instance, "seed": seed, "start": start, "end": end})
        out.append(made)
    return out


def _detect(source: DataFrame, shown: str) -> DataFrame:
    """Rule spans (``pii_base``), keyed secrets (``_keyed``) and pattern slots (``_slots``) of the texts in ``shown``."""
    schema = T.StructType([*source.schema.fields, T.StructField("pii_base", T.ArrayType(SPAN)), T.StructField("_keyed", T.ArrayType(SPAN)), T.StructField("_slots", T.ArrayType(_SLOT))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, shown):
                base, keyed, slots = [[[] for _ in range(part.num_rows)] for _ in range(3)]
                rows = _maybe(data, offsets).tolist()
                texts = part.column(shown).take(pa.array(rows, pa.int64())).to_pylist()
                used, found = [], []
                for row, text in zip(rows, texts):
                    own = rule_spans(text)
                    base[row] = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own]
                    secret = list(_free(iter(keyed_secrets(text)), [(a, b) for _, a, b in own]))
                    keyed[row] = [{"kind": CONTEXT, "start": a, "end": b} for a, b in secret]
                    seeds = [*own, *((len(KINDS), a, b) for a, b in secret)]
                    more = candidates(text, seeds)
                    if seeds or more:
                        used.append((row, text))
                        found.append([(True, a, b) for _, a, b in seeds] + [(False, a, b) for a, b in more])
                if used:
                    for (row, _), made in zip(used, _slots([t for _, t in used], found)):
                        slots[row] = made
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base, _SPAN_ARROW), pa.array(keyed, _SPAN_ARROW), pa.array(slots, _SLOT_ARROW)], schema.names)

    return mapped(source, run, schema)


def _filter_of(patterns: DataFrame) -> np.ndarray:
    """A filter of fixed size that holds for all ``pattern`` of the frame: each task makes a part, the driver joins them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[batch.column(0).to_numpy().view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["part"])

    packed = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in mapped(patterns.select("pattern"), run, "part binary").toLocalIterator():
        packed |= np.frombuffer(zlib.decompress(r.part), np.uint8)
    return packed


def _fits(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes & np.uint64((1 << FILTER_BITS) - 1)
    return (packed[low >> np.uint64(3)] >> (np.uint64(7) - (low & np.uint64(7))).astype(np.uint8)) & 1 != 0


def place_counts(docs: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """``total``, the number of places that each ``pattern`` fits.

    Tasks send one sum for each pattern they have seen; what only passes the filter is joined away after all
    sums are made, so the join meets each pattern once.
    """
    packed = _filter_of(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return found, np.bincount(at, np.concatenate([n for _, n in held]), len(found)).astype(np.int64)

        for batch in batches:
            for _, data, offsets in words.slices(batch, "_source"):
                forms = Places(data, offsets).forms.ravel()
                held.append(np.unique(forms[(forms != 0) & _fits(packed, forms)], return_counts=True))
                if sum(len(h) for h, _ in held) > HELD_SUMS:
                    held = [summed()]
                    if len(held[0][0]) > HELD_SUMS // 2:  # too many to hold: sent as they are, and summed after
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["pattern", "n"])
                        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        found, n = summed()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["pattern", "n"])

    sent = mapped(docs.select(F.col(f"`{text}`").alias("_source")), run, "pattern long, n long")
    # Staged, or Spark would push the join below the sum.
    totals = stage(sent.groupBy("pattern").agg(F.sum("n").alias("total")), "pii-places")
    return totals.join(patterns, "pattern", "left_semi")


def fillers_of(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """(``_row``, ``start``, ``end``) of what stands at the trusted patterns in ``_source`` and is not in ``pii_base``."""
    packed = _filter_of(trusted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "_source"):
                places = Places(data, offsets)
                own, out, last = places.words, [], -1
                form, word = np.nonzero((places.forms != 0) & _fits(packed, places.forms))
                order = np.argsort(word, kind="stable")
                rows = np.searchsorted(own.firsts, word[order], "right") - 1
                for row, form_k, k in zip(rows.tolist(), form[order].tolist(), word[order].tolist()):
                    if row != last:
                        last, text = row, part.column("_source")[row].as_py()
                        busy = [(x["start"], x["end"]) for x in part.column("pii_base")[row].as_py()]
                        near, at, to, where = None, 0, int(offsets[row]), part.column("_row")[row].as_py()
                    at += len(data[to : own.starts[k]].tobytes().decode())
                    to = int(own.starts[k])
                    if form_k == 2:
                        near = list(_grouped(text)) if near is None else near
                        end = at + len(data[own.starts[k] : own.ends[k]].tobytes().decode())
                        span = next(((a, b) for a, b in near if a <= at < b and not any(c.isalnum() for c in text[end:b])), None)
                        span = span if span and any(c in "@_0123456789" for c in text[span[0] : span[1]]) else None
                    else:
                        span = filler(text, at)
                    if span and next(_free(iter([span]), busy), None):
                        out.append((where, int(places.forms[form_k].view(np.int64)[k]), *span))
                columns = list(zip(*out)) or [()] * 4
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["_row", "pattern", "start", "end"])

    sent = mapped(found.select("_row", "_source", "pii_base"), run, "_row long, pattern long, start int, end int")
    return sent.join(trusted, "pattern", "left_semi").select("_row", "start", "end").distinct()


def _merged(spans: Column) -> Column:
    """Sorted spans (``kind``, ``start``, ``end``), overlapping ones as one."""
    kind = "array<struct<kind:string,start:int,end:int>>"

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["kind"].alias("kind"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(F.size(done) == 0, F.array(s)).when(last["end"] <= s["start"], F.concat(done, F.array(s))).otherwise(F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).cast(kind)

    return F.aggregate(spans.cast(kind), F.array().cast(kind), step)


def trusted_patterns(edges: DataFrame, fillers: DataFrame, rules: Bootstrap) -> DataFrame:
    """Patterns with enough confidence.

    ``edges`` are (``pattern``, ``instance``, ``seed``, ``n``); ``fillers`` (``pattern``, ``total``): how
    many places of the corpus the pattern fits at all.
    """
    reliable = edges.where("seed").select("instance").distinct().withColumn("r", F.lit(1.0))
    scored = None
    for _ in range(rules.rounds):
        weights = edges.join(reliable, "instance", "left").groupBy("pattern").agg(F.sum(F.col("n") * F.coalesce("r", F.lit(0.0))).alias("w"))
        scored = stage(weights.join(fillers, "pattern").select("pattern", F.least(F.col("w") / F.col("total"), F.lit(1.0)).alias("confidence")), "pii-patterns")
        # 1 - product of (1 - confidence), a seed stays at 1
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        again = edges.join(scored, "pattern").groupBy("instance").agg(F.when(F.bool_or("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("r"))
        reliable = stage(again, "pii-instances")
    return scored.where(F.col("confidence") >= rules.confidence)


def extract(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: Bootstrap = Bootstrap()) -> DataFrame:
    """The columns ``keep`` (all by default) with ``pii_base`` and ``pii_spans``, arrays of (``kind``, ``start``, ``end``) in code points.

    ``pii_base`` has what the rules find, by kind, then by start; ``pii_spans`` has the same and after that
    the spans found by context. Columns of these names are replaced. A null text counts as empty and has no
    spans. Repeated rows stay apart and have the same spans; as seeds, equal strings count once.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("pii_base", "pii_spans")]
    # A later pass finds places by row and by place in the text, so both are staged together, once.
    shown = f"c{kept.index(text)}" if text in kept else "_text"
    extra = {} if text in kept else {"_text": F.col(f"`{text}`")}
    source = beside(docs, kept, _row=F.monotonically_increasing_id(), **extra)
    found = stage(_detect(source, shown), "pii")
    slots = found.where(F.size("_slots") > 0).select("_row", F.inline("_slots"))
    edges = slots.groupBy("pattern", "instance", "seed").agg(F.count("*").alias("n"))
    enough = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"))
    patterns = stage(enough.where(F.col("seeds") >= rules.seeds).select("pattern"), "pii-candidates")
    more = found.select("_row", F.inline("_keyed")).select("_row", "start", "end")
    if not patterns.isEmpty():
        totals = stage(place_counts(docs, text, patterns), "pii-totals")
        edges = stage(edges.join(patterns, "pattern"), "pii-edges")
        trusted = stage(trusted_patterns(edges, totals, rules).select("pattern"), "pii-trusted")
        if not trusted.isEmpty():
            texts = found.select("_row", F.col(shown).alias("_source"), "pii_base")
            more = more.unionByName(stage(fillers_of(texts, trusted), "pii-fillers"))
    spans = F.struct(F.lit(CONTEXT).alias("kind"), "start", "end")
    # Few texts have such spans: the texts then stay where they are.
    more = small(stage(more.groupBy("_row").agg(F.array_sort(F.collect_set(spans)).alias("_more")), "pii-more"))
    spans = F.concat("pii_base", F.coalesce(_merged(F.col("_more")), F.array().cast(T.ArrayType(SPAN))))
    return named(found.join(more, "_row", "left").withColumn("pii_spans", spans), kept, "pii_base", "pii_spans")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with ``[KIND]`` in place of each span; overlapping spans become one, named after the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(found: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``found`` with its spans masked in the text. Null texts stay null."""
    schema = found.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in words.slices(batch, text):
                pairs = zip(part.column(text).to_pylist(), part.column(spans).to_pylist())
                new = [masked(t, [(s["kind"], s["start"], s["end"]) for s in own]) if t and own else t for t, own in pairs]
                yield part.set_column(part.schema.get_field_index(text), text, pa.array(new, part.schema.field(text).type))

    return mapped(found, run, schema)
