"""Steps whose rows, files and held lists must not grow faster than the input."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from socialtext.functions import arrays, segment
from socialtext.operators import features, tokenizer
from socialtext.plans import store as store_module
from socialtext.plans.store import BUCKET, KeyedStore


@pytest.mark.parametrize("held", [0, 2, 5, 100])
def test_few_parts_of_glued_words_move(spark, monkeypatch, held):
    # Before, every place of every token was a row: the step had no list of held words and no table of bits.
    monkeypatch.setattr(tokenizer, "HELD_WORDS", held)
    names = ["the", "a", "big", "save", "city", "ocean", "citybig", "he", "oceans", "sav", "été", "𠀀"]
    words = spark.createDataFrame([(w, i) for i, w in enumerate(names)], "word string, rank long")
    texts = ["#savetheocean", "#bigcity", "#xyzbig", "#a", "#Étébig", "#𠀀big", "#", "#oceansav" * 3]
    tokens = spark.createDataFrame([("" + t[1:], i) for i, t in enumerate(texts)], "token string, n int")
    costs = segment.word_costs(names)
    got = {r["n"]: r["parts"] for r in tokenizer.cut_table(tokens, words).collect()}
    assert got == {i: segment.cut_words(t[1:], costs, sorted(set(map(len, names)))) for i, t in enumerate(texts)}


def test_hits_hold_every_word():
    r = np.random.default_rng(3)
    names = sorted({"".join(r.choice(list("abcé𠀀"), r.integers(1, 6))) for _ in range(60)})
    texts = ["".join(r.choice(list("abcé𠀀x"), r.integers(0, 30))) for _ in range(200)]
    bits = np.zeros(segment.TABLE_BITS // 8, np.uint8)
    for place in segment.word_places(names):
        bits[place >> 3] |= 1 << (place & 7)
    costs, lengths = segment.word_costs(names), sorted(set(map(len, names)))
    for text, hits in zip(texts, segment.part_hits(texts, bits, set(lengths))):
        assert hits == sorted(hits)
        assert {(e, n) for e in range(len(text) + 1) for n in lengths if n <= e and text[e - n:e] in costs} <= set(hits)
        assert segment.cut_at(text, costs, {}, hits) == segment.cut_words(text, costs, lengths)


def test_a_bucket_of_a_span_is_one_file(spark, tmp_path, monkeypatch):
    # Before, a bucket had a file per task, and every bucket of a batch was named in the filter.
    monkeypatch.setattr(store_module, "LISTED", 5)
    store = KeyedStore(str(tmp_path / "t"), "id", span=10)
    rows = spark.range(400).repartition(8).select("id", F.lit(1).alias("version"))
    store.append(store.new_rows(rows, [F.col("version")]))
    folders = [f for f in os.listdir(tmp_path / "t") if f.startswith(BUCKET)]
    assert len(folders) == 40
    assert all(len([f for f in os.listdir(tmp_path / "t" / d) if f.endswith(".parquet")]) == 1 for d in folders)
    store.replace_newest(rows.where("id % 20 = 3").withColumn("version", F.lit(2)), "version")
    assert {r["id"] for r in store.read(spark).where("version = 2").collect()} == set(range(3, 400, 20))
    assert store.read(spark).count() == 400
    assert store.new_rows(spark.range(395, 405).withColumn("version", F.lit(1)), [F.col("version")]).count() == 5


def test_relative_weights_move_documents_not_terms(spark, monkeypatch):
    rows = [(1, ["a", "b", "a"]), (2, ["c"]), (2, ["a", "c", "d"]), (None, ["d"]), (None, ["b", "b"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")

    def weights():
        return sorted((str(r["id"]), r["term"], round(r["weight"], 12)) for r in features.tfidf(df, "id", weighting="relative").collect())

    whole = weights()
    assert len(whole) == 8 and ("2", "d", round(np.log(7 / 2) / 4, 12)) in whole
    plan = features.tfidf(df, "id", weighting="relative")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window [")  # the window is below: it sees documents, not their terms
    monkeypatch.setattr(features, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(features, "FREQUENT_TERMS", 3)
    assert weights() == whole


def test_grams_entry_by_entry(spark):
    lists = [["a", "b", "c", "d"], ["a"], [], None, ["a", None, "c"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "id int, tokens array<string>")
    got = {r["id"]: r["g"] for r in df.select("id", arrays.with_ngrams(F.col("tokens"), 3, "_").alias("g")).collect()}
    assert got[0] == ["a", "b", "c", "d", "a_b", "b_c", "c_d", "a_b_c", "b_c_d"] and got[1] == ["a"] and got[2] == [] and got[3] is None
    assert got[4] == ["a", None, "c", "a", "c", "a_c"]
