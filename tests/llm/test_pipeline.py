import corpus_pipeline
from pyspark.sql import functions as F

from layerspark.llm import mixing, packing, pii, quality, simhash
from layerspark.session import materialize


def test_stages_in_order(spark, sf, docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "PII", "mixing sources to target weights", "packing"]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, at, sf), "stage")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "quality rules":
            assert out.count() == quality.judge(at).filter("kept").count()
        elif name == "SimHash near-dedup":
            groups = simhash.near_duplicates(at).select("component_id").distinct().count()
            assert out.count() == groups == out.select("doc_id").distinct().count()
        elif name == "PII":
            assert out.count() == at.count()
            left = pii.find(out).agg(*[F.sum(f"n_{k}") for k in pii.BASE]).first()
            assert sum(left) == 0
        else:
            assert out.count() == mixing.draw(at).count()
        at = out
    packed = corpus_pipeline.STAGES[-1][1](spark, at, sf)
    assert packed.agg(F.sum("length")).first()[0] == packing.pieces(at).agg(F.sum("length")).first()[0]


def test_run_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for name, table in (("odd", odd_docs), ("none", no_docs)):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert (packed.count() > 0) == (name == "odd")
