"""The pipeline's stages against what they are to do, one after the other."""

from __future__ import annotations

import random

from test_llm_ops import frame, labelled

import corpus_pipeline


def test_stages(spark, tmp_path):
    docs, labels, _ = labelled(spark, random.Random(7), "grobiankram", n=400)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    clean = next(t for i, t in texts if t and "grobiankram" not in t)
    near = clean.split()
    near[3] = "changed"
    extra = [(9000, clean), (9001, " ".join(near)), (9002, 'Keep this. token = "0123456789abcdef0123456789abcdef"')]
    frame(spark, [*texts, *extra]).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = [r.text or "" for r in docs.collect()]
    assert not any("grobiankram" in t for t in left)
    assert len([t for t in left if t[:40] == clean[:40]]) == 1
    assert any("[SECRET]" in t for t in left) and not any("0123456789abcdef" in t for t in left)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()
