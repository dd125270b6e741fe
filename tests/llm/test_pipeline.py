"""Stages keep the columns of documents and act on all that is left."""

import importlib

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "packing"]
    kept = docs
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, kept, SMALL)
        assert out.columns == docs.columns
        ids = {r[0] for r in out.select("doc_id").collect()}
        assert ids <= {r[0] for r in kept.select("doc_id").collect()}
        kept = spark.createDataFrame(out.collect(), docs.schema)
    last = pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert {r[0] for r in last.select("doc_id").distinct().collect()} == ids
    assert 0 < len(ids) < docs.count()


def test_all_queries_are_registered():
    names = entry.queries()
    assert {f"op{k}" for k in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names


def test_stages_ask_for_small_batches(spark):
    """Neither side holds a batch of 10,000 texts."""
    pipeline = importlib.import_module("corpus_pipeline")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    try:
        for rows, want in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            for _, stage in pipeline.STAGES:
                spark.conf.set(key, rows)
                stage(spark, spark.read.parquet(f"{SMALL}/documents.parquet").limit(0), SMALL)
                assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, held)


def test_tokenizers_go_with_their_memo():
    """A worker that goes on to words holds no tokenizer any more."""
    from logflow.llm import _common, _tokens

    first = _tokens.encoder(_tokens.tokenizer_path("byte_bpe_50k.json"))
    ids = first.encode(["Some words."])
    assert first.memo and _tokens._ENCODERS
    _common.WORD_HASHES.of([b"a"])
    assert not _tokens._ENCODERS
    assert _tokens.encoder(_tokens.tokenizer_path("byte_bpe_50k.json")).encode(["Some words."]) == ids
