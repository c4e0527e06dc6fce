import random

import corpus_pipeline
from socialtext.llm import similar
from tests.conftest import SF


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.count()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == columns
        if name == "near_copies":
            assert similar.grouped(docs, 5, 80).where("component_id <> doc_id").count() == 0
        if name in ("language", "exact_copies", "near_copies"):
            assert docs.count() <= first
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() == docs.count() > first / 2


def test_language_stage_drops_what_no_language_explains(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pick = random.Random(4)
    rows = [(-1 - i, "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=pick.choice([40, 100, 500])))) for i in range(20)]
    rows += [(-50, "To jest bardzo piękny dzień i idziemy na plażę popływać z przyjaciółmi."), (-51, "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQ="), (-52, None), (-53, "12 34")]
    more = spark.createDataFrame([(i, t, None, "new", 0) for i, t in rows], docs.schema)
    got = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.union(more), SF).select("doc_id").collect()}
    assert got == {r["doc_id"] for r in docs.where("text rlike '[a-zA-Z]'").select("doc_id").collect()}
