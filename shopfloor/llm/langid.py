"""Language identification by rank-order profiles of letter n-grams.

A profile lists a language's most frequent n-grams of one to three letters by rank. A text gets the
language whose profile is nearest by out-of-place distance: for each of the text's most frequent
n-grams, how far its rank lies from its rank in the profile, or a full profile's length if it is not
in there.

Texts are lower-cased letter by letter; whatever is no letter ends a word, and word ends count as one
more letter. Everything is counted in whole arrays, a few megabytes of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.ship import beside, mapped, renamed

PROFILE_GRAMS = 300
UNKNOWN = "und"
_SLICE_BYTES = 1 << 19
#: (language, n-gram) counts a task holds before it sums them up.
_HELD_COUNTS = 1 << 21


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (letter := chr(c)).isalpha():
            low = letter.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters with one 0 before and after every word, and the row of each."""
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    n = np.diff(begun)
    # a row's letters stand after a 0 of its own
    rows = np.repeat(np.arange(len(n)), n + 1)
    folded = np.zeros(len(rows) + 1, np.uint32)
    folded[np.arange(len(points)) + 1 + np.repeat(np.arange(len(n)), n)] = _folding()[points]
    rows = np.concatenate([rows, [max(len(n) - 1, 0)]])
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0)
    return folded[keep], rows[keep]


def _grams(letters: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count) of all n-grams, sorted by group and n-gram.

    ``groups`` is the group of each letter, in order or not. An n-gram is up to three code points of 21
    bits; its length is in the highest bits.
    """
    alphabet = np.flatnonzero(np.bincount(letters, minlength=1)).astype(np.uint64)
    base = np.int64(len(alphabet))
    code = np.zeros(int(letters.max(initial=0)) + 1, np.int64)
    code[alphabet.astype(np.int64)] = np.arange(base)
    x = code[letters]
    solid = letters != 0
    found = []
    for n in (1, 2, 3):
        size = max(len(x) - n + 1, 0)
        own = np.zeros(size, np.int64)
        for k in range(n):
            own = own * base + x[k : k + size]
        middle = solid[n // 2 : n // 2 + size] if n != 2 else solid[:size] | solid[1 : 1 + size]
        at = groups[n // 2 if n != 2 else 0 :][:size]
        if n == 2:  # a word end and the next row's first letter belong to that row
            at = np.where(solid[:size], at, groups[1 : 1 + size])
        keys = np.sort((at * base**n + own)[middle])
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        group, gram = np.divmod(keys[first], base**n)
        wide = np.zeros(len(gram), np.uint64)
        rest = gram
        for k in range(n):
            rest, digit = np.divmod(rest, base)
            wide |= alphabet[digit] << np.uint64(21 * k)
        wide |= np.uint64(n) << np.uint64(62) if n < 3 else np.uint64(0)
        found.append((group, wide, np.diff(np.concatenate([first, [len(keys)]]))))
    return tuple(np.concatenate(c) for c in zip(*found))


@dataclass(frozen=True)
class Profiles:
    """Languages, and for each n-gram known to any its rank in each (the length of a profile if absent)."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from all rows with a language. Counts are summed in each task, then by language and n-gram.

    Ranks go by count, then by n-gram. Null and empty texts add nothing; a language without letters has
    an empty profile and is left out.
    """
    rows = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []

        def summed():
            group, gram, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((gram, group))
            group, gram, n = group[order], gram[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (gram[1:] != gram[:-1])]))
            return group[first], gram[first], np.add.reduceat(n, first)

        for batch in batches:
            for part, data, offsets in words.slices(batch, "t", _SLICE_BYTES):
                of_row = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)
                letters, rows = _letters(data, offsets)
                held.append(_grams(letters, of_row[rows]))
                if sum(len(h[0]) for h in held) > _HELD_COUNTS:
                    held = [summed()]
        if held and sum(len(h[0]) for h in held):
            group, gram, n = summed()
            known = pa.array(list(names))
            for at in range(0, len(n), 50_000):
                s = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([known.take(pa.array(group[s])), pa.array(gram[s].view(np.int64)), pa.array(n[s].astype(np.int64))], ["lang", "gram", "n"])

    counts = mapped(rows, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", "place").collect()
    languages = sorted({r.lang for r in top})
    grams, at = np.unique(np.array([r.gram for r in top], np.int64).view(np.uint64), return_inverse=True)
    ranks = np.full((len(grams) + 1, len(languages)), -1, np.int64)
    ranks[at, [languages.index(r.lang) for r in top]] = [r.place - 1 for r in top]
    return Profiles(languages, grams, ranks, size)


def _nearest(profiles: Profiles, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest language of each text (-1: none), and the score."""
    n_rows, size = len(offsets) - 1, profiles.size
    letters, rows = _letters(data, offsets)
    row, gram, n = _grams(letters, rows)
    best, score = np.full(n_rows, -1), np.zeros(n_rows)
    if not len(row) or not profiles.languages:
        return best, score
    order = np.lexsort((gram.view(np.int64), -n, row))
    row, gram = row[order], gram[order]
    begin = np.searchsorted(row, np.arange(n_rows))
    rank = np.arange(len(row)) - begin[row]
    top = rank < size
    row, gram, rank = row[top], gram[top], rank[top]
    at = np.minimum(np.searchsorted(profiles.grams, gram), len(profiles.grams) - 1)
    at = np.where(profiles.grams[at] == gram, at, len(profiles.grams))
    place = profiles.ranks[at]
    apart = np.where(place < 0, size, np.abs(place - rank[:, None]))
    full, first = np.unique(row, return_index=True)
    distance = np.add.reduceat(apart, first, axis=0)
    used = np.diff(np.concatenate([first, [len(row)]]))
    best[full] = distance.argmin(axis=1)
    score[full] = 1 - distance.min(axis=1) / (used * size)
    return best, score


def predict(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred`` and ``score``; columns of these names are replaced.

    Null texts and texts without a letter get ``und`` and score 0, as all texts do if nothing was learned.
    Of equally near languages the first by name wins. The score is 1 less the distance as a share of the largest possible.
    """
    made = ["lang_pred", "score"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    source = beside(docs, kept, _source=F.col(f"`{text}`"))
    schema = T.StructType([*renamed(source.schema.fields, kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(profiles)  # a fixed number of n-grams for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = [*known.languages, UNKNOWN]
        for batch in batches:
            for part, data, offsets in words.slices(batch, "_source", _SLICE_BYTES):
                best, score = _nearest(known, data, offsets)
                columns = [pa.array([names[b] for b in best.tolist()], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*kept, *made])

    return mapped(source, run, schema)
