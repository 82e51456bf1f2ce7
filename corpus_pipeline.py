"""A corpus made ready for training: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``. The caller writes
a stage's result before it calls the next stage: that one begins by deleting what earlier stages have
staged, except what its own ``docs`` read.

Defined results: a null text counts as empty. It is not toxic unless the network says so of an empty text,
near-duplicates of it are all texts without words, it has no benchmark words, no personal data and no tokens.
Repeated rows pass the first stage alike, and one of each class passes the second. Further columns pass all
stages but the last under their own names, whatever these are; an empty table stays empty.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import byte_bpe, decontaminate, near_dedup, pii, toxicity
from shopfloor.session import Staging, drop_staged, staged_of
from shopfloor.session import stage as written

#: No SQL: the network of the first stage can't be said in SQL. Tests hold each stage against a plain version.
ORACLE_SQL = None


#: What stages have staged and no later stage has deleted yet, by application.
_left: dict[str, list[str]] = {}


def _stage(function):
    """``function``, which first deletes what earlier stages have staged and ``docs`` don't read."""

    @wraps(function)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = _left.setdefault(spark.sparkContext.applicationId, [])
        read = staged_of(docs) if left else set()
        drop_staged(spark, [p for p in left if p not in read])
        before = Staging(spark)
        result = function(spark, docs, sf_dir)
        left[:] = [*(p for p in left if p in read), *before.paths]
        return result

    return begin


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the network calls toxic. Rows with crc32 of the id divisible by 5 teach nothing."""
    teaching = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    net = toxicity.fit(docs.where(teaching), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(_columns(docs))])
    kept = toxicity.score(plain, net, text=f"c{docs.columns.index('text')}").where("predicted = 0")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that SimHash joins (shingles of four words, four bits at most): that of the smallest id."""
    return near_dedup.one_of_each(docs, shingle_words=4, radius=4)


@_stage
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which one word in 20 or more lies in benchmark windows."""
    marked = decontaminate.mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.decisions(marked).where("NOT contaminated").select(*_columns(docs))


@_stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; ``n_chars`` follows the new text."""
    found = pii.redact(pii.extract(docs))
    changed = F.when(F.size("pii_spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*_columns(docs))


@_stage
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit integers), with digests of the ids and of the decoded bytes."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    # Written between the two, so that a task needs one Python worker at a time.
    encoded = written(byte_bpe.encode(docs.select("doc_id", "text"), path, pattern, layout="packed").select("doc_id", "token_ids"), "encoded")
    return byte_bpe.decode(encoded, path).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "token_ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("pii", mask_personal_data),
    ("byte_bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again; only the last one stays."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES:
        scope = Staging(spark)
        docs = scope.result(function(spark, docs, sf_dir), f"pipeline-{name}")
        drop_staged(spark, last)
        scope.end()
        last = scope.paths
    return docs
