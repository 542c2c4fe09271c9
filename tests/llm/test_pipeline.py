"""The pipeline's stages against brute force, and what they do with odd rows."""

import corpus_pipeline
from tests.llm.test_operators import BASE, ODD_ROWS, brute_contamination, brute_jaccard, brute_secrets, check_packing, write_tables


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = stage(spark, docs, sf_dir)
        if name != "packing":
            assert after.columns == columns
            after = corpus_pipeline.written(after, name)
            texts = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "language_id":
            assert all(i in texts for i, t in before.items() if t.strip())
        elif name == "near_duplicates":
            groups = brute_jaccard(before)
            assert set(texts) == {i for i, (group, _) in groups.items() if i == group}
        elif name == "decontamination":
            assert set(texts) == {i for i, t in before.items() if not brute_contamination(t, items)[-1]}
        elif name == "secrets":
            assert set(texts) == set(before) and len(BASE) == 3
            assert all(texts[i] == t for i, t in before.items() if not brute_secrets(t) and "[secret]" not in texts[i])
            assert not any(brute_secrets(t) for t in texts.values())
        elif name == "packing":
            check_packing(after.toPandas(), docs.toPandas())
        docs = after


def test_odd_and_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write_tables(spark, tmp_path / "odd", ODD_ROWS)).count() > 0
    assert corpus_pipeline.run(spark, write_tables(spark, tmp_path / "empty", [])).count() == 0
