"""The pipeline's stages on a small table."""

import random

import corpus_pipeline
from veinstone.llm.common import staged


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}x" for _ in range(n))
    passage = text(80)
    rows = [(i, text(120), "en", f"s{i % 4}", 0) for i in range(40)] + [(50, "too short", "en", "s1", 0), (51, f"{text(60)} {passage} {text(50)}", "en", "s1", 0), (52, f"{text(70)} {passage} {text(40)}", "en", "s2", 0), (53, None, None, None, None), (53, "x y", "en", "s1", 0)]
    rows += [(60, rows[3][1], "en", "s0", 0), (61, rows[4][1], "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, ""), f"test-{k}")
        seen.append({r.doc_id for r in docs.collect()})
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        if k == 2:
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert passage in texts[51] and len(texts[52].split()) == 110
    assert not seen[0] & {50, 53} and set(range(40)) <= seen[0]
    assert seen[0] - seen[1] == {60, 61} and seen[1] == seen[2] and seen[3] <= seen[2] and seen[4] == seen[3]


def test_run_reads_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
