"""Steps that must keep disk and memory bounded while a query runs: what they leave behind, move at once or hold."""

import json
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from socialtext.catalog import selecting
from socialtext.operators import blocks, classify, embeddings, features, tokenizer
from socialtext.session import discarded, ensure_checkpoint_dir, folder_of, stored


@pytest.fixture(scope="module")
def docs(spark):
    r = np.random.default_rng(5)
    rows = [(i, "xy"[i % 2], i // 60, [f"{'xy'[i % 2]}{r.integers(12)}" for _ in range(r.integers(4, 25))] + ["the", None][: 1 + i % 2]) for i in range(240)]
    return spark.createDataFrame(rows, "doc_id int, label string, slice int, tokens array<string>").cache()


def shuffles(spark):
    """Shuffles whose files are there."""
    return set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet().mkString(",").split(",")) - {""}


def folders(spark, part=""):
    return {f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if part in f}


def test_stored_tables_leave_no_shuffle_and_can_go(spark):
    before = shuffles(spark)
    df = stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "test-table")
    assert not shuffles(spark) - before  # before, they stayed until the driver collected its garbage
    assert df.agg(F.sum("count")).first()[0] == 100 and folder_of(df.where("k > 1")) is None
    discarded(df, spark.range(3))
    assert not folders(spark, "test-table")


def test_waves_give_the_same_sums(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 5, i, [f"t{(i * j) % 11}" for j in range(4)]) for i in range(60)], f"{blocks.BLOCK} int, id int, {blocks.TERMS} array<string>")
    table = spark.createDataFrame([(f"t{j}", [float(j), 1.0]) for j in range(11)], "term string, weights array<double>")
    monkeypatch.setattr(blocks, "PART_TERMS", 4)
    packed = blocks.pack(rows, table, 2)

    def lines(rows, w, entries, terms):
        place, _, row = entries
        names, size = rows.column(blocks.TERMS).combine_chunks().flatten(), np.bincount(row, minlength=rows.num_rows)
        return pa.table({"term": terms.take(names), "n": pa.array(np.repeat(size, size)), "s": pa.array(w[place, 0])})

    def run():
        found, own = blocks.passed(packed, lambda r, w, e: (w * np.bincount(e[0], minlength=len(w))[:, None], np.array([1.0, r.num_rows])), 2,
                                   lambda w, sums, held, more: np.column_stack([w + sums, held, more]), "test-sums", packed.weights)
        kept = blocks.per_block(packed, lines, "term string, n long, s double", with_terms=True, fold=lambda x: x.groupBy("term").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
        return ({r["term"]: r["weights"] for r in blocks._long(packed.names, found, 5).collect()}, own.tolist(),
                sorted(map(tuple, kept.groupBy("term").agg(F.sum("n"), F.sum("s")).collect())))

    whole = run()
    assert len(packed.waves(5)) == 1 and len(whole[0]) == 11 and whole[1] == [5.0, 60.0]
    for j in range(11):
        assert [r[2] for r in whole[2] if r[0] == f"t{j}"] == [j * r[1] / 4 for r in whole[2] if r[0] == f"t{j}"]
    monkeypatch.setattr(blocks, "WAVE_BYTES", 1)
    monkeypatch.setattr(blocks.Packed, "waves", lambda p, n: [p.where(lambda block, i=i: F.pmod(F.col(block), F.lit(3)) == i) for i in range(3)])
    assert run() == whole  # before, a pass moved the weights of all blocks at once


def test_waves_are_bounded(spark):
    def waves(pairs, terms, width):
        df = spark.range(1).select(F.lit(0).alias(blocks.BLOCK), F.lit(0).alias("_of"))
        return len(blocks.Packed(df, df, df, df, width, df, pairs, terms).waves(width))

    assert [waves(10 ** 6, 10 ** 5, 20), waves(10 ** 8, 10 ** 6, 20), waves(10 ** 8, 10 ** 8, 20)] == [1, 15, 1]


def test_a_model_leaves_its_table_only(spark, docs):
    before = folders(spark)
    model = embeddings.fit_embeddings(docs, dim=4, epoch=2, wordNgrams=2, minCount=2, n_blocks=3)
    left = sorted(f.rsplit("-", 1)[0] for f in folders(spark) - before)
    assert left == ["blocks-parts", "embeddings-terms"]  # before, also rows, blocks, needs and the tables of every epoch
    assert model.terms.count() > 20


def test_terms_of_no_use_are_not_written(spark):
    rows = spark.createDataFrame([(i % 2, [f"r{i}", "a", None, f"q{i}", "b"], [1.0, 2.0, 3.0, 4.0, None]) for i in range(50)],
                                 f"{blocks.BLOCK} int, {blocks.TERMS} array<string>, {blocks.VALUES} array<double>")
    table = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", [3.0])], "term string, weights array<double>")

    def sums(packed):
        found, _ = blocks.passed(packed, lambda r, w, e: (np.bincount(e[0], weights=e[1], minlength=len(w))[:, None], np.zeros(0)), 1, lambda w, s, h: s, "test-sums")
        return {r["term"]: r["weights"][0] for r in blocks._long(packed.names, found, 1).collect()}

    thin, whole = blocks.pack(rows, table, 1, thin=True), blocks.pack(rows, table, 1)
    assert sums(thin) == sums(whole) == {"a": 100.0, "b": 0.0, "c": 0.0}
    assert whole.rows.agg(F.sum(F.size(blocks.TERMS))).first()[0] == 250
    assert thin.rows.agg(F.sum(F.size(blocks.TERMS))).first()[0] < 110
    assert thin.rows.where(F.size(blocks.TERMS) != F.size(blocks.VALUES)).count() == 0


def test_glued_words_share_by_share(spark, monkeypatch):
    names = ["the", "a", "big", "save", "city", "ocean", "oceans", "étés"]
    words = spark.createDataFrame([(w, i) for i, w in enumerate(names)], "word string, rank long")
    df = spark.createDataFrame([(i, f"#{names[i % 8]}{names[i % 5]} plain{i % 3} #oceansave x") for i in range(60)], "id int, text string")
    monkeypatch.setattr(tokenizer, "HELD_WORDS", 3)
    monkeypatch.setattr(tokenizer, "WHOLE_BYTES", 1 << 63)

    def counts():
        return sorted(map(tuple, tokenizer.split_term_counts(df, "text", words, hashtags="split", normalize=False).collect()))

    whole = counts()
    assert len(whole) == 16
    monkeypatch.setattr(tokenizer, "estimated_bytes", lambda _: 4)
    monkeypatch.setattr(tokenizer, "WHOLE_BYTES", 3)
    monkeypatch.setattr(tokenizer, "SHARE_BYTES", 1)
    asked = folders(spark)
    assert counts() == whole
    assert {f.rsplit("-", 1)[0] for f in folders(spark) - asked} == {"cut-words", "token-parts"}  # before, all tokens were counted and cut at once


def test_lines_hold_a_bounded_number_of_posts(monkeypatch):
    monkeypatch.setattr(selecting, "LINE_POSTS", 4)
    rows = [("p", 1, f'{{"é\n": {i}}}') for i in range(10)] + [("p", None, "x")] + [(None, None, "y")] * 5
    batches = [pa.RecordBatch.from_pylist([dict(zip(("part", "line", "p"), r)) for r in rows[a:a + 7]],
                                          pa.schema([("part", pa.string()), ("line", pa.int64()), ("p", pa.string())])) for a in (0, 7, 14)]
    got = [(b.column(0)[0].as_py(), json.loads(b.column(1)[0].as_py())) for b in selecting._lines(batches)]
    assert [(p, len(t)) for p, t in got] == [("p", 4), ("p", 4), ("p", 2), ("p", 1), (None, 4), (None, 1)]  # before, a line held every post of its number
    assert [t for _, line in got for t in line] == [t for *_, t in rows]


def test_words_beyond_the_driver_are_learned_as_a_table(spark, monkeypatch):
    monkeypatch.setattr(features, "DRIVER_WORDS", 10)
    r = np.random.default_rng(2)
    rows = [(i, "xy"[i % 2], [f"{'xy'[i % 2]}{r.integers(10)}" for _ in range(30)] + [f"once{i}"]) for i in range(300)] + [(300, "x", []), (301, "y", None)]
    df = spark.createDataFrame(rows, "doc_id int, lang string, tokens array<string>")
    model, vectors = features.word_vectors(df, dims=4, min_count=3, epochs=5)
    assert isinstance(model, features.TableWordVectors)  # before, the driver held every word with its code and its vectors
    of = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert sorted(of) == sorted(f"{c}{i}" for c in "xy" for i in range(10))
    got = {r["doc_id"]: r for r in vectors.collect()}
    assert len(got) == 302 and vectors.columns == ["doc_id", "lang", "tokens", "vector"]
    for i, _, tokens in rows:
        assert np.allclose(got[i]["vector"].toArray(), sum(of.get(t, 0.0) for t in tokens or []) / max(len(tokens or []), 1), atol=1e-12)

    def alike(a, b):
        return np.mean([of[f"{a}{i}"] @ of[f"{b}{j}"] / np.linalg.norm(of[f"{a}{i}"]) / np.linalg.norm(of[f"{b}{j}"]) for i in range(10) for j in range(10) if (a, i) != (b, j)])

    assert min(alike("x", "x"), alike("y", "y")) > alike("x", "y") + 0.5
    stage = classify.dense_pipeline(2, dims=4, max_iter=30)
    fitted = classify.TextClassifier(stage, "lang").fit(df.where("doc_id < 300"))
    assert fitted.predict(df.where("doc_id < 300")).where("predicted = lang").count() > 290
