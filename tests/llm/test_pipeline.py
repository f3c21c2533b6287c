"""The pipeline's stages on small documents."""

from __future__ import annotations

import corpus_pipeline
import pytest


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    words = [" ".join(f"{a}{b}" for b in ("ta", "no", "ri", "ke", "lo", "mu", "pi", "sa") for a in "abcdefghij"[k:]) for k in range(8)]
    rows = [(i, t) for i, t in enumerate([*texts, *words, *(f"{w} end" for w in words), "w5 w6 w7 w8 secret test item of ten words here now"])]
    spark.createDataFrame([(i, t, ("en", "fr")[i % 2], "s", len(t or ""), True) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, extra boolean").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, "secret test item of ten words here now w8 w9")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            assert out.count() <= before
            before, docs = out.count(), out
        else:
            assert out.count() == before
    assert docs.where("text is null").count() == 0


def test_run_and_empty(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
