"""Nothing is lost: rows without a group, other days of a table, rare words."""

from collections import Counter

from pyspark.sql import functions as F

from socialtext.operators import tokenizer
from socialtext.operators.evaluate import stratified_folds
from socialtext.operators.sampling import random_per_group
from socialtext.operators.vocab import corpus_words
from socialtext.sources.writers import write_by_date


def test_rows_without_a_group_are_a_group(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, None)], "id long, g string")
    assert sorted(r["id"] for r in random_per_group(df, ["g"], 5, ["id"]).collect()) == [1, 2, 3, 4, 5]
    assert random_per_group(df, ["g"], 1, ["id"]).count() == 2


def test_a_second_day_leaves_the_first(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.sql("SELECT id, timestamp'2020-01-01' + make_dt_interval(CAST(id AS INT)) AS created FROM range(2)")
    for day in (0, 1):
        write_by_date(days.where(f"id = {day}"), path, mode="overwrite")
    write_by_date(days.where("id = 1"), path, mode="overwrite")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 1]


def test_every_word_gets_a_rank(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c", "b", "a", "7"],)], "tokens array<string>")
    ranks = {r["word"]: r["rank"] for r in corpus_words(df).collect()}
    assert ranks == {"a": 0, "b": 1, "c": 2}


def test_hashtags_are_cut_with_a_word_list_of_any_size(spark, monkeypatch):
    texts = ["#savetheocean now", "#savetheocean #bigcity", "#xyzbig #a1b #", "plain the", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = spark.createDataFrame([(w, i) for i, w in enumerate("the a big save city ocean citybig he oceans sav".split())], "word string, rank long")
    whole = tokenizer.tokenize(df, "text", words=words, hashtags="split", normalize=False).collect()
    monkeypatch.setattr(tokenizer, "MAX_WORDS", 3)
    got = tokenizer.split_term_counts(df, "text", words, hashtags="split", normalize=False).collect()
    assert {r["term"]: r["n"] for r in got} == Counter(t for r in whole for t in r["tokens"]) and len(got) == len({r["term"] for r in got})
    assert {"save", "the", "ocean", "city"} <= {r["term"] for r in got}
    by_id = tokenizer.tokenize(df.withColumn("n", F.monotonically_increasing_id()), "text", id_col="n", words=words, hashtags="split", normalize=False)
    assert sorted(r["tokens"] for r in by_id.collect()) == sorted(r["tokens"] for r in whole)


def test_a_very_long_glued_word(spark):
    words = spark.createDataFrame([("ab", 0), ("abc", 1), ("c", 2), ("longerword", 3)], "word string, rank long")
    df = spark.createDataFrame([(1, "#" + "abc" * 3000 + "longerword")], "id int, text string")
    tokens = tokenizer.tokenize(df, "text", id_col="id", words=words, hashtags="split", normalize=False).first()["tokens"]
    assert tokens == ["abc"] * 3000 + ["longerword"]
