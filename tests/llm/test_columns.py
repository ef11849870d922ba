"""Further columns of any name pass through every pipeline stage with their values."""

from pyspark.sql import functions as F

from panelith.llm import common


def test_columns_of_any_name_pass_all_stages(spark, odd_docs):
    import corpus_pipeline

    names = {"size": "a.b", "sid": "mix_shard", "rest": "jaccard_h", "shards": "mix_order", "token": "c0", "n": "further_1", "grp": "text_hash", "block": "row`s"}
    docs = odd_docs.withColumnsRenamed({k: v for k, v in names.items() if v != "row`s"})
    docs = docs.withColumn("mix_shard", F.lit(98) + F.coalesce("doc_id", F.lit(0)))
    want = docs.schema
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.durable(stage(spark, docs, "/root/testdata/sf0.001"), "test")
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in want]
    rows = docs.collect()
    assert rows and all(r["mix_shard"] == 98 + (r["doc_id"] or 0) and r["a.b"] == 7 and r["jaccard_h"] == "x" for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == len(rows)
