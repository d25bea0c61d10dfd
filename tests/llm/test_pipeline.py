import corpus_pipeline
from tests.llm.test_operators import SF


def test_stages_in_order_and_their_effects(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] == seen[2] and seen[5] > 0
