"""The pipeline's stages on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_stages_keep_columns_and_clean_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
        assert after <= before and after
        if name == "mixing":
            assert after == before
        else:
            assert out.count() == len(after)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and last.filter(F.length("ids") / 4 != F.col("n_tokens")).count() == 0
