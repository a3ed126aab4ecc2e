"""Empty tables, repeated rows and clashing column names of the earlier operators and the pipeline."""

import pytest

from gradeloom.llm import license_scan, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_token_counts_of_an_empty_table(spark, documents):
    assert token_counts.count_tokens(documents([]), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_license_scan_of_empty_tables_and_repeated_rows(spark, documents):
    assert license_scan.scan(documents([])).count() == 0
    rows = license_scan.scan(documents([(1, "Released under the MIT License.", "a")] * 3)).collect()
    assert [r["licenses"] for r in rows] == ["MIT"] * 3


def test_toxicity_of_an_empty_table(spark, documents):
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(documents([]), labels)
    assert toxicity.score(documents([]), model).count() == 0


def test_pipeline_over_empty_tables(spark, documents, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
