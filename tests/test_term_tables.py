"""Topic models and decompositions whose numbers per term stay in tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from socialtext.operators import blocks, svd, topics


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, [f"a{i % 7}", f"a{i % 3}", "both"] if i % 2 else [f"b{i % 5}", f"b{i % 4}", "both", "both"], i // 20) for i in range(60)]
    return spark.createDataFrame([*rows, (100, [], 0), (101, None, 1), (102, [None, "never met again"], 2)], "doc_id int, tokens array<string>, slice int").cache()


@pytest.mark.parametrize("binary", [True, False])
def test_perplexity_falls_in_every_pass(spark, docs, binary, monkeypatch):
    monkeypatch.setattr(blocks, "CHUNK_ENTRIES", 7)
    model = topics.fit_topics(docs, k=3, passes=6, learn_alpha=False, binary=binary, min_df=2)
    assert len(model.log_perplexities) == 6 and all(b < a for a, b in zip(model.log_perplexities, model.log_perplexities[1:]))
    assert model.n_terms == 13 and abs(sum(model.totals) - docs.select(F.sum(F.size(F.filter(F.array_distinct("tokens") if binary else F.col("tokens"), lambda t: t.rlike("^(a|b)")))).alias("n")).first()["n"]) < 1e-6
    sums = topics.probabilities(model).groupBy("topic").agg(F.sum("weight").alias("s")).collect()
    assert len(sums) == 3 and all(abs(r["s"] - 1) < 1e-9 for r in sums)
    shares = {r["doc_id"]: r["shares"] for r in topics.topic_shares(model, docs, "doc_id", "slice").collect()}
    assert len(shares) == 63 and all(abs(sum(s) - 1) < 1e-9 for s in shares.values())
    assert shares[100] == shares[101] == shares[102] == pytest.approx([1 / 3] * 3)
    assert topics.log_perplexity(model, docs) < model.log_perplexities[0]


def test_learned_pseudo_counts(docs):
    fixed = topics.fit_topics(docs, k=2, passes=8, learn_alpha=False)
    learned = topics.fit_topics(docs, k=2, passes=8)
    assert fixed.alpha == (0.5, 0.5) and learned.alpha != fixed.alpha and min(learned.alpha) > 0


def test_digamma():
    assert topics._digamma(np.array([1.0, 0.5, 10.0])) == pytest.approx([-0.5772156649015329, -1.9635100260214235, 2.2517525890667211])


def test_chained_slices(docs):
    fit = {"k": 2, "passes": 2, "learn_alpha": False}
    chain = topics.chained_slices(docs, "slice", decay=0.5, **fit)
    assert list(chain) == [0, 1, 2]
    turned = topics.chained_slices(docs.withColumn("slice", 2 - F.col("slice")), "slice", decay=0.5, **fit)
    assert chain[2].totals != pytest.approx(turned[2].totals)
    # The prior keeps the words of earlier slices; without decay a slice holds its own documents alone.
    assert sum(chain[1].totals) > sum(topics.chained_slices(docs, "slice", decay=0.0, **fit)[1].totals)
    alone = topics.fit_topics(docs.where("slice = 0"), **fit)
    assert chain[0].totals == pytest.approx(alone.totals)
    one = docs.withColumn("slice", F.lit(1))
    assert topics.chained_slices(one, "slice", decay=0.0, **fit)[1].totals == pytest.approx(topics.fit_topics(docs, **fit).totals)
    words = topics.chained_words(chain)
    assert all(abs(r["s"] - 1) < 1e-9 for r in words.groupBy("slice", "topic").agg(F.sum("weight").alias("s")).collect())
    assert topics.slice_drift(words, "slice").count() == 4


def test_slice_words_are_summed_once(spark):
    rows = [(0, ["a", "b", "b", None]), (0, ["a", "c"]), (1, ["a", "b"]), (1, None), (None, ["a"]), (3, ["a"])]
    docs = spark.createDataFrame(rows, "slice int, tokens array<string>")
    words = topics.slice_topic_words(topics.fit_topics(docs, k=1), docs, "slice")
    got = {(r["slice"], r["word"]): r["weight"] for r in words.collect()}
    assert got == pytest.approx({(0, "a"): 0.4, (0, "b"): 0.4, (0, "c"): 0.2, (1, "a"): 0.5, (1, "b"): 0.5, (3, "a"): 1.0})
    drift = topics.slice_drift(words, "slice")
    assert [(r["slice"], r["similarity"]) for r in drift.collect()] == [(1, pytest.approx(0.4 / (0.36 * 0.5) ** 0.5))]
    # Shares are not estimated again, and no join deals the words by slice and topic.
    plan = words._jdf.queryExecution().toString()
    assert "CoGroups" not in plan and "SortMergeJoin" not in plan
    assert "FullOuter" not in drift._jdf.queryExecution().toString()


def test_empty_tables(spark, docs):
    nothing = docs.limit(0)
    model = topics.fit_topics(nothing, k=2)
    assert model.n_terms == 0 and topics.top_words(model, 3).count() == 0
    assert topics.topic_shares(model, docs, "doc_id").where("abs(shares[0] - 0.5) > 1e-9").count() == 0
    assert svd.truncated_svd(nothing, F.col("tokens"), k=2).values == ()
    with pytest.raises(ValueError):
        topics.fit_topics(docs, k=0)


def test_svd_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(blocks, "CHUNK_ENTRIES", 11)
    random = np.random.default_rng(3)
    a = random.normal(size=(60, 12)) * (random.random((60, 12)) < 0.4) @ np.diag(2.0 ** -np.arange(12))
    rows = [(i, [f"t{j}" for j in np.flatnonzero(r)], [float(x) for x in r[r != 0]]) for i, r in enumerate(a)]
    rows += [(60, [], []), (61, None, None), (62, ["t0"], [None])]
    df = spark.createDataFrame(rows, "id int, terms array<string>, n array<double>").repartition(3)
    want = np.linalg.svd(a, compute_uv=False)
    model = svd.truncated_svd(df, F.col("terms"), F.col("n"), k=5, steps=6)
    assert model.values == pytest.approx(want[:5], rel=1e-6)
    reduced = {r["id"]: r["reduced"] for r in svd.project(model, df, "id", F.col("terms"), F.col("n")).collect()}
    assert len(reduced) == 63 and reduced[60] == reduced[61] == reduced[62] == [0.0] * 5
    y = np.array([reduced[i] for i in range(60)])
    assert np.sqrt((y ** 2).sum(axis=0)) == pytest.approx(want[:5], rel=1e-6)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(y) == pytest.approx(np.abs(a @ vt[:5].T), abs=1e-5)
    whole = svd.truncated_svd(df, F.col("terms"), F.col("n"), k=30)
    assert len(whole.values) == 12 and whole.values == pytest.approx(want, rel=1e-4)


def test_svd_of_one_direction(spark):
    df = spark.range(20).select("id", F.array(F.lit("x"), F.lit("y")).alias("terms"))
    model = svd.truncated_svd(df, F.col("terms"), k=3)
    assert model.values == pytest.approx([40 ** 0.5])
    unknown = spark.createDataFrame([(1, ["z"]), (2, ["x"])], "id int, terms array<string>")
    got = {r["id"]: r["reduced"] for r in svd.project(model, unknown, "id", F.col("terms")).collect()}
    assert got[1] == [0.0] and abs(abs(got[2][0]) - 0.5 ** 0.5) < 1e-9
