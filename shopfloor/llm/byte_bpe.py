"""Byte-level BPE over Arrow batches, with the ``tokenizers`` library.

Each match of the split pattern is a piece of its own. A piece's UTF-8 bytes are written as one
printable character each (the vocabulary's byte table) and merged by the library's BPE model, whose
merges come from the rank file. Pieces repeat, so a task keeps the ids of pieces it has met, up to a
bounded number. Decoding writes every id as its printable characters and turns these back into bytes by the
reversed byte table; a character whose bytes lie in several tokens is whole again in the joined bytes.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.ship import beside, mapped, renamed

#: Pieces a task remembers, and the longest of them in characters.
KNOWN_PIECES, LONGEST_KNOWN = 50_000, 64


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each longer token is merged from, by rank: its split by the merges of lower rank."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank) if ranks.get(parts[i] + parts[i + 1], rank) < rank else rank)
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        merges.append((parts[0], parts[1]))
    return merges


#: Characters up to U+00FF that the two pattern libraries class differently.
_CLASSED_APART = "\x1c\x1d\x1e\x1f²³¹¼½¾".encode("latin-1")


def _plain_form(pattern: str) -> str | None:
    """The pattern for Python's own library, twice as fast; the same for texts up to U+00FF without ``_CLASSED_APART``."""
    for classes, plain in ((r"[^\s\p{L}\p{N}]", r"(?:[^\w\s]|_)"), (r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d")):
        pattern = pattern.replace(classes, plain)
    return None if r"\p" in pattern or r"\P" in pattern else pattern


class Codec:
    """Encoder by one rank file."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers.models import BPE

        ranks = read_ranks(path)
        table = byte_characters()
        written = {token: "".join(table[b] for b in token) for token in ranks}
        self._model = BPE({written[t]: r for t, r in ranks.items()}, [(written[a], written[b]) for a, b in merges_of(ranks)])
        self._to_characters = {b: c for b, c in enumerate(table)}
        self._pieces = regex.compile(pattern)
        self._plain_pieces = re.compile(plain) if (plain := _plain_form(pattern)) else None
        self._known: dict[str, bytes] = {}
        self.lengths = np.array([len(t) for t in token_bytes(path)], np.int64)

    def _split(self, text: str) -> list[str]:
        if self._plain_pieces:
            try:
                narrow = text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                if len(narrow.translate(None, _CLASSED_APART)) == len(narrow):
                    return self._plain_pieces.findall(text)
        return self._pieces.findall(text)

    def _encode_piece(self, piece: str) -> bytes:
        characters = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._to_characters)
        ids = np.array([t.id for t in self._model.tokenize(characters)], "<u4").tobytes()
        if len(piece) <= LONGEST_KNOWN:
            if len(self._known) >= KNOWN_PIECES:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known = self._known.get
        return b"".join([known(p) or self._encode_piece(p) for p in self._split(text)])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; tokens that share a split character all cover it."""
        ends = np.cumsum(self.lengths[ids])
        first = (np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(first)])  # characters begun before each byte
        starts = ends - self.lengths[ids]
        return before[starts + 1] - 1, before[ends]


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token, by rank."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@lru_cache(maxsize=2)
def token_characters(path: str) -> list[str]:
    """The printable characters of each token, by rank."""
    table = byte_characters()
    return ["".join(table[b] for b in token) for token in token_bytes(path)]


#: The byte table reversed: what each printable character stands for.
_BYTE_OF = {ord(c): b for b, c in enumerate(byte_characters())}


def decode_ids(ids: bytes, path: str) -> bytes:
    """What little-endian unsigned 32-bit ids stand for."""
    table = token_characters(path)
    return "".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).translate(_BYTE_OF).encode("latin-1")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _with(docs: DataFrame, column: str, fields: list[T.StructField], make) -> DataFrame:
    """``docs`` without columns named as ``fields``, and ``fields`` made from ``column`` in slices of bounded size."""
    names = {f.name for f in fields}
    kept = [c for c in docs.columns if c not in names]
    source = beside(docs, kept, _source=F.col(f"`{column}`"))
    schema = T.StructType([*renamed(source.schema.fields, kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in words.slices(batch, "_source"):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *make(part.column("_source").to_pylist())], [*kept, *[f.name for f in fields]])

    return mapped(source, run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", layout: str = "arrays") -> DataFrame:
    """Add the tokens of every whole text; columns of the same names are replaced.

    ``layout`` "arrays" adds ``token_ids``, ``token_starts`` and ``token_ends`` (code points, end
    exclusive); "packed" adds ``token_ids`` alone as binary, little-endian unsigned 32-bit integers, and
    "packed with offsets" also ``token_offsets``, start and end of each token in turn, likewise. A null text counts as empty and has no tokens. ``path`` must be readable on every executor.
    """
    if layout not in ("arrays", "packed", "packed with offsets"):
        raise ValueError(f"unknown layout {layout}")

    def packed(texts):
        own = codec(path, pattern)
        return [pa.array([own.encode(t or "") for t in texts], pa.binary())]

    def packed_with_offsets(texts):
        own = codec(path, pattern)
        ids = [own.encode(t or "") for t in texts]
        places = [own.offsets(t or "", np.frombuffer(i, "<u4")) for t, i in zip(texts, ids)]
        return [pa.array(ids, pa.binary()), pa.array([np.stack(p, 1).astype("<u4").tobytes() for p in places], pa.binary())]

    def arrays(texts):
        own = codec(path, pattern)
        ids = [np.frombuffer(own.encode(t or ""), "<u4").astype(np.int32) for t in texts]
        places = [own.offsets(t or "", i) for t, i in zip(texts, ids)]
        ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        lists = [ids, [a for a, _ in places], [b for _, b in places]]
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(np.int32))) for x in lists]

    ints = T.ArrayType(T.IntegerType())
    if layout == "packed":
        return _with(docs, text, [T.StructField("token_ids", T.BinaryType())], packed)
    if layout == "packed with offsets":
        return _with(docs, text, [T.StructField(c, T.BinaryType()) for c in ("token_ids", "token_offsets")], packed_with_offsets)
    return _with(docs, text, [T.StructField(c, ints) for c in ("token_ids", "token_starts", "token_ends")], arrays)


def decode(docs: DataFrame, path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that the ids (either layout of ``encode``) stand for, as binary ``into``. Null ids give no bytes."""

    def make(rows):
        rows = [r if isinstance(r, bytes | None) else np.array(r, "<u4").tobytes() for r in rows]
        return [pa.array([decode_ids(r or b"", path) for r in rows], pa.binary())]

    fields = [T.StructField(into, T.BinaryType())]
    names = [c for c in docs.columns if c != into]
    source = beside(docs, names, _source=F.col(f"`{ids}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *make(part.column("_source").to_pylist())], [*names, into])

    return mapped(source, run, T.StructType([*renamed(source.schema.fields, names), *fields]))
