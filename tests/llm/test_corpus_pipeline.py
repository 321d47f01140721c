"""The pipeline's stages on odd rows, and the whole of it against plain versions."""

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from tallyfield.llm import bigru, linededup

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_take_odd_rows(spark, table, nothing, stage):
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, table, BASE)
    assert out.dtypes == table.dtypes
    assert 0 < out.count() <= table.count()
    assert run(spark, nothing, BASE).count() == 0


def test_packing_takes_odd_rows(spark, table, docs, nothing):
    out = corpus_pipeline.best_fit_packing(spark, table, BASE).collect()
    assert sorted(brute.key(r["doc_id"]) for r in out if r["piece"] == 0) == sorted(brute.key(d) for d, _ in docs)
    ends = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert corpus_pipeline.best_fit_packing(spark, nothing, BASE).count() == 0


def test_near_dedup_keeps_one_of_each_class(spark, table, docs):
    out = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, table, BASE).collect()]
    want = sorted({brute.key(d) for d, t in docs if not brute.words(t)} | {brute.key(c) for _, c, _ in brute.near_classes(docs)})
    assert sorted(map(brute.key, out)) == want


def test_line_dedup_changes_texts_and_drops_emptied_documents(spark, table, docs):
    out = {(r["doc_id"], r["text"]) for r in corpus_pipeline.line_dedup(spark, table, BASE).collect()}
    plain = brute.lines(docs, linededup.LEAST_WORDS)
    want = {(d, kept if gone else text) for (d, n, gone, kept), (_, text) in zip(plain, docs) if not gone or len(gone) < n}
    assert out == want


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    packed = corpus_pipeline.run(spark, BASE).collect()
    network = bigru.train(docs.where(~bigru.held_out()))
    languages = {r["_id"]: r for r in bigru.identify(docs, network).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r in rows if languages[r[0]]["lang_pred"] != "und" and languages[r[0]]["score"] >= corpus_pipeline.LEAST_SCORE]
    rows = [(d, kept) for d, n, gone, kept in brute.lines(rows, linededup.LEAST_WORDS) if not gone or len(gone) < n]
    heads = {c for _, c, _ in brute.near_classes(rows)}
    rows = [r for r in rows if r[0] in heads]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
    clean = {d for d, _, _, _, dirty in brute.contamination(rows, items) if not dirty}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows if d in clean}
    found: dict[int, int] = {}
    for r in packed:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == lengths
