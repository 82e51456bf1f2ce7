"""SimHash fingerprints of texts in DataFrame functions, and search within a Hamming radius.

The terms of a text are its pairs of neighbouring words. Every occurrence votes on each of 64 bits, for
the bit if it is set in the term's hash and against it if not, with the term's length as its weight; the
fingerprint has the bits that won. Sums for two bits share one 64-bit number, so a term costs 32
additions.

Texts are compared with their successors by id. Rows are dealt once, by slices of the id range; each
slice also gets a copy of the next slice's first row. All that follows (windows, votes, comparison)
stays within the slices, so no other exchange of texts is needed.
"""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from functools import reduce
from itertools import combinations
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BITS = 64
RADIUS, BLOCKS = 3, 6
#: Rows that a slice should have, and slices at most.
ROWS_A_SLICE, MOST_SLICES = 1000, 20_000
#: Weights of one text sum up to less than this, as a text has at most 2^31 bytes.
_LANE = 1 << 32


def terms(text: Column) -> Column:
    """Pairs of neighbouring lower-cased words (``w``) as an array of structs; the last word stands alone."""
    words = F.split(F.lower(text), r"\s+")
    return F.arrays_zip(words.alias("w"), F.slice(words, F.lit(2), F.size(words)).alias("next"))


def votes(first: Column, second: Column) -> list[Column]:
    """Sums over the terms: 32 of votes, for bits j and j + 32 each, and the sum of all weights."""
    h = F.xxhash64(first, second)
    weight = (F.length(first) + F.coalesce(F.length(second), F.lit(0))).cast("long")
    lanes = [F.sum(F.shiftright(h, j).bitwiseAND(F.lit(_LANE + 1)) * weight).alias(f"_v{j}") for j in range(32)]
    return [*lanes, F.sum(weight).alias("_weight")]


def winning_bits() -> Column:
    """The fingerprint, from the columns that ``votes`` made."""
    weight, bits = F.col("_weight"), []
    for j in range(32):
        low, high = F.col(f"_v{j}").bitwiseAND(F.lit(_LANE - 1)), F.shiftrightunsigned(f"_v{j}", 32)
        bits += [F.shiftleft((2 * low > weight).cast("long"), j), F.shiftleft((2 * high > weight).cast("long"), j + 32)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _literal(value) -> str:
    """A number, a text or a day as SQL."""
    if isinstance(value, str):
        return f"cast(X'{value.encode().hex()}' AS string)"
    if isinstance(value, int | float | Decimal):
        return str(value)
    return f"cast('{value}' AS {'timestamp' if isinstance(value, datetime) else 'date'})"


def _number_below(bounds: list, value: Column) -> Column:
    """How many of the sorted values lie below ``value``: first among every k-th of them, then among the k that follow."""
    if not bounds:
        return F.lit(0)
    k = math.isqrt(len(bounds)) + 1
    runs = [bounds[i : i + k] for i in range(0, len(bounds), k)]

    def below(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda b: b < value))

    run = below(F.expr(f"array({', '.join(_literal(r[0]) for r in runs)})"))
    listed = F.expr("array(" + ", ".join(f"array({', '.join(map(_literal, r))})" for r in runs) + ")")
    return F.when(run == 0, 0).otherwise((run - 1) * k + below(F.get(listed, run - 1)))


def with_successors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """Rows ``_slice``, ``_pos``, ``_ghost``, ``_id``, ``_text`` and ``_next`` (the next row's text; after the last the first), dealt by slices.

    ``_pos`` is unique in a slice. A ghost is a copy of the next slice's first row, after all rows of its
    slice. Rows are ordered by id, nulls first, and rows of one id by a hash of the text. A null text
    counts as empty. ``slices`` follows the number of rows unless it is given; it changes nothing but the
    size of tasks. Ids may be numbers, days or texts, which are ordered by their bytes.
    """
    n_rows = docs.count()
    slices = slices or min(max(n_rows // ROWS_A_SLICE, 16), MOST_SLICES)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    steps = [k / slices for k in range(1, slices)]
    if isinstance(docs.schema[doc_id].dataType, StringType):
        # Texts have no percentiles in SQL: some ids, chosen by their hash, are cut evenly. About 16 for each slice at any size.
        some = docs.select(F.col(f"`{doc_id}`").alias("_id")).where("_id IS NOT NULL").where(F.pmod(F.xxhash64("_id"), F.lit(max(n_rows // (16 * slices), 1))) == 0)
        ids = [r["_id"] for r in some.distinct().orderBy("_id").collect()]
        bounds = [ids[int(len(ids) * step)] for step in steps] if ids else []
    else:
        bounds = docs.select(F.percentile_approx(F.col(f"`{doc_id}`"), steps, 5 * MOST_SLICES)).first()[0] or []
    bounds = sorted(set(bounds))
    rows = rows.withColumn("_slice", F.when(F.col("_id").isNull(), 0).otherwise(_number_below(bounds, F.col("_id"))))
    # One row for each slice.
    heads = rows.groupBy("_slice").agg(F.min(F.struct(F.col("_id").isNotNull().alias("known"), "_id", "_hash")).alias("head")).orderBy("_slice").collect()
    numbers = [h["_slice"] for h in heads]
    firsts = docs.sparkSession.createDataFrame(
        [(n, h["head"]["_id"], h["head"]["_hash"], numbers[k - 1]) for k, (n, h) in enumerate(zip(numbers, heads))],
        f"_slice int, _first_id {rows.schema['_id'].dataType.simpleString()}, _first_hash long, _before int",
    )
    own = F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("ghost"))
    copy = F.struct(F.col("_before").alias("slice"), F.lit(True).alias("ghost"))
    is_first = F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("_hash") == F.col("_first_hash"))
    dealt = rows.join(F.broadcast(firsts), "_slice").select("_id", "_text", "_hash", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))).alias("at"))
    dealt = dealt.select("_id", "_text", "_hash", F.col("at.slice").alias("_slice"), F.col("at.ghost").alias("_ghost"))
    order = Window.partitionBy("_slice").orderBy("_ghost", F.asc_nulls_first("_id"), "_hash")
    return dealt.withColumns({"_pos": F.row_number().over(order), "_next": F.lead("_text").over(order)}).drop("_hash")


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_chars``, ``edited_sha256``, ``_fingerprint``, ``_edited`` (longs), ``near_edited``, ``near_next``.

    The edited text has its last half (rounded down) replaced by as much of the beginning of the next
    text, or all of that. A text without words has fingerprint 0. A single row is its own successor.
    Repeated rows stay apart.
    """
    rows = with_successors(docs, doc_id, text, slices)
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    rows = rows.withColumns({"_n": n.cast("long"), "_edit": edited}).withColumn("_sha", F.sha2("_edit", 256))
    keys = ["_slice", "_pos", "_ghost", "_id", "_n", "_sha"]
    both = rows.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("_edit").alias("t")))).alias("x"))
    both = both.select(*keys, F.col("x.which").alias("_which"), F.explode(terms(F.col("x.t"))).alias("term"))
    voted = both.groupBy(*keys, "_which").agg(*votes(F.col("term.w"), F.col("term.next")))
    voted = voted.select(*keys, "_which", winning_bits().alias("_bits"))
    pairs = voted.groupBy(*keys).agg(*[F.max(F.when(F.col("_which") == k, F.col("_bits"))).alias(c) for k, c in ((0, "_fingerprint"), (1, "_edited"))])
    following = F.lead("_fingerprint").over(Window.partitionBy("_slice").orderBy("_pos"))
    return pairs.withColumn("_following", following).where("NOT _ghost").select(
        F.col("_id").alias(doc_id),
        F.col("_n").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        "_fingerprint",
        "_edited",
        likeness(F.col("_fingerprint"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_fingerprint"), F.col("_following")).alias("near_next"),
    )


def _blocks(n: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each of n blocks."""
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, column: str = "_fingerprint") -> DataFrame:
    """All pairs (``query``, ``found``) of fingerprints that differ in at most ``radius`` bits, each pair once, itself included.

    Both frames hold each fingerprint once; null fingerprints find nothing. Differing bits lie in at most
    ``radius`` blocks, so some ``blocks - radius`` blocks agree: there is one permuted table for each choice
    of so many blocks, keyed by their bits. A pair counts in the table of its first agreeing blocks alone.
    """
    cut = _blocks(blocks)
    masks = [((1 << n) - 1) << a for a, n in cut]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        own = F.col(f"`{column}`")
        keys = [F.struct(F.lit(t).alias("t"), own.bitwiseAND(F.lit(reduce(or_, [signed[i] for i in chosen]))).alias("k")) for t, chosen in enumerate(tables)]
        return rows.where(own.isNotNull()).select(own.alias(name), F.explode(F.array(*keys)).alias("x")).select(name, F.col("x.t").alias("t"), F.col("x.k").alias("k"))

    apart = F.col("query").bitwiseXOR(F.col("found"))
    agree = [apart.bitwiseAND(F.lit(m)) == 0 for m in signed]
    canonical = F.lit(False)
    for t, chosen in enumerate(tables):
        skipped = [~agree[i] for i in range(max(chosen)) if i not in chosen]
        canonical = canonical | reduce(and_, skipped, F.col("t") == t)
    found = keyed(queries, "query").join(keyed(prints, "found"), ["t", "k"])
    return found.where((F.bit_count(apart) <= radius) & canonical).select("query", "found")


def count_within(rows: DataFrame, asking: Column, radius: int = RADIUS, blocks: int = BLOCKS, column: str = "_fingerprint") -> DataFrame:
    """Add ``n_within``: for rows for which ``asking`` holds, how many rows lie within the radius of theirs, itself included; else null.

    ``rows`` is read more than once. Rows of one fingerprint are counted first, so copies make no pairs.
    More blocks give longer keys, and so fewer chance meetings in larger tables, for more tables.
    """
    counts = rows.groupBy(column).agg(F.count("*").alias("_rows"))
    queries = rows.where(asking).select(column).distinct()
    pairs = within(queries, counts.select(column), radius, blocks, column)
    near = pairs.join(counts, pairs["found"] == counts[column]).groupBy("query").agg(F.sum("_rows").alias("n_within"))
    return rows.join(near, asking & (F.col(column) == F.col("query")), "left").drop("query")
