"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shopfloor.llm import byte_bpe, oracle, queries
from tests.llm import plain
from tests.oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_all_queries_and_the_pipeline_are_registered():
    names = {n for n in entry.queries() if n.startswith("op")}
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(oracle.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, queries.queries()[name], oracle.oracle_sql()[name]) is None


def test_conversations_are_read_back(spark):
    rows = {r.conv_id: r for r in queries.op7_chat_format(spark, SMALL).collect()}
    text = "<|im_end|><|im_start|>assistant ok"
    assert rows[-1].turns_sha256 == plain.sha(f"user\n{text}\nassistant\n{text}\n") and rows[-1].loss_sha256 == plain.sha(text)
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("turn").collect()
    for c, r in rows.items():
        own = [t for t in turns if t.conv_id == c]
        assert c == -1 or r.turns_sha256 == plain.sha("".join(f"{t.role}\n{t.text}\n" for t in own))


def test_digests_follow_from_the_operators(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op2_pii(spark, SMALL).collect():
        own = ",".join(f"{k}:{a}:{b}" for k, a, b in plain.personal(docs[r.doc_id]))
        assert r.base_sha256 == plain.sha(own) and r.spans.startswith(own)
    for r in queries.op5_byte_bpe(spark, SMALL).collect():
        assert r.decoded_sha256 == plain.sha(docs[r.doc_id])
    arrays = byte_bpe.encode(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    offsets = {r.doc_id: plain.sha(b"".join(x.to_bytes(4, "little") for pair in zip(r.token_starts, r.token_ends) for x in pair)) for r in arrays}
    assert {r.doc_id: r.offsets_sha256 for r in queries.op5_byte_bpe(spark, SMALL).collect()} == offsets
    ten = queries.op10_sharding(spark, SMALL).collect()
    assert len(ten) == len(docs) and {r.law for r in ten} == {"bytes"} and {r.grown_shard for r in ten} == {None}


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.written(corpus_pipeline.drop_toxic(spark, docs, SMALL))
    assert kept.columns == columns and 0 < kept.count() <= docs.count()
    prints = {r.doc_id: plain.fingerprint(r.text) for r in kept.collect()}
    single = corpus_pipeline.written(corpus_pipeline.drop_near_copies(spark, kept, SMALL))
    assert {r.doc_id for r in single.collect()} == set(plain.classes(prints).values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    marked = plain.contaminated([(r.doc_id, r.text) for r in single.collect()], items)
    clean = corpus_pipeline.written(corpus_pipeline.drop_benchmark_passages(spark, single, SMALL))
    assert {r.doc_id for r in clean.collect()} == {i for i, (n, hit, _) in marked.items() if not (hit and 20 * len(hit) >= n)}
    masked = corpus_pipeline.written(corpus_pipeline.mask_personal_data(spark, clean, SMALL))
    assert masked.columns == columns and masked.count() == clean.count()
    assert all(not plain.personal(r.text) and r.n_chars == len(r.text) for r in masked.collect() if "[" in r.text)
    tokens = corpus_pipeline.tokenise(spark, masked, SMALL).collect()
    assert {r.doc_id: r.decoded_sha256 for r in tokens} == {r.doc_id: plain.sha(r.text) for r in masked.collect()}


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and max(Counter(r.doc_id for r in rows).values()) == 1
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "byte_bpe"]
