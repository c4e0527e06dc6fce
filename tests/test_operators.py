import datetime as dt
import math

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from socialtext.functions import arrays, dates, text
from socialtext.operators import (
    classify, coherence, counts, evaluate, features, filters, hierarchy, joins, language, merge, normalize, phrases,
    sampling, topics, vocab)
from socialtext.plans.comments import sample_comments
from socialtext.plans.topic_model import fit_topic_model


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_root_sample_hot_path(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 5 != 4, F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 7 + 2)).alias("o"))
    plain = sampling.root_n_sample(df, "o", ["id"])
    hot = sampling.root_n_sample(df, "o", ["id"], hot_rows=100, salts=4)
    assert plain.count() == hot.count() and plain.exceptAll(hot).count() == 0
    sizes = {r["o"]: r["count"] for r in df.groupBy("o").count().collect()}
    for r in hot.groupBy("o").count().collect():
        assert r["count"] == (sizes[None] if r["o"] is None else math.ceil(math.sqrt(sizes[r["o"]])))


def test_samples_are_exact(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "big").otherwise("small").alias("g"), (F.col("id") % 10).alias("s"))
    first = sampling.random_per_group(df, ["g"], 700, ["id"])
    assert {r["g"]: r["count"] for r in first.groupBy("g").count().collect()} == {"big": 700, "small": 500}
    assert first.exceptAll(sampling.random_per_group(df.repartition(7), ["g"], 700, ["id"])).count() == 0
    assert {r["count"] for r in sampling.balanced_downsample(df, "g", ["id"]).groupBy("g").count().collect()} == {500}
    top = sampling.top_per_group(df, ["g"], [F.desc("s"), F.asc("id")], 3, ["id"])
    assert sorted(r["id"] for r in top.filter("g = 'big'").collect()) == [9, 19, 29]
    places = sampling.hash_place(df, ["g"], ["id"])
    assert sorted(r[0] for r in places.filter("g = 'small'").select("place").collect()) == list(range(1, 501))
    assert [r[0] for r in sampling.shuffled(df, ["id"]).select("id").take(5)] == [
        r[0] for r in sampling.shuffled(df.repartition(3), ["id"]).select("id").take(5)]


def test_merges(spark):
    target = frame(spark, [(1, "a", 5), (2, "b", 5)], "k int, v string, t int")
    batch = frame(spark, [(2, "c", 6), (3, "d", 1), (3, "e", 2), (None, "x", 1), (1, "z", 5)], "k int, v string, t int")
    assert [(r["k"], r["v"]) for r in merge.insert_ignore(target, batch, ["k"], [F.asc("t")]).collect()] == [(3, "d")]
    got = {r["k"]: r["v"] for r in merge.newest_wins(target, batch.filter("k is not null"), ["k"], "t").collect()}
    assert got == {1: "a", 2: "c", 3: "e"}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = merge.keep_first(df, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_slices(spark):
    start, end = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 5)
    rows = [(start + dt.timedelta(hours=12 * i),) for i in range(9)] + [(dt.datetime(2019, 1, 1),)]
    df = frame(spark, rows, "created timestamp")
    half = {r["slice"]: r["n"] for r in counts.time_slice_counts(df, start, end, 4).collect()}
    assert half == {0: 2, 1: 2, 2: 2, 3: 3} and sum(half.values()) == 9
    both = {r["slice"]: r["n"] for r in counts.time_slice_counts(df, start, end, 4, edges="inclusive").collect()}
    assert both == {0: 3, 1: 3, 2: 3, 3: 3}
    empty = counts.time_slice_counts(df.filter("created < '2019-06-01'"), start, end, 3).collect()
    assert [r["n"] for r in empty] == [0, 0, 0]
    for bad in (dict(k=0), dict(k=2, edges="x")):
        with pytest.raises(ValueError):
            counts.time_slice_counts(df, start, end, **bad)
    long = counts.time_slice_counts(frame(spark, [(end,)], "created timestamp"), start, end, 7)
    assert [r["n"] for r in long.orderBy("slice").collect()] == [0] * 6 + [1]


def test_filters(spark):
    df = frame(spark, [(1, "ok", "g", "me", 5), (2, "[deleted]", "g", "me", 5), (3, "I am a bot", "g", "me", 5),
                       (4, "", "g", "me", 5), (5, "i am a bot", "h", "you", 1)], "id int, body string, subreddit string, author string, score int")
    assert [r["id"] for r in filters.comment_filter(df, ["g", "h"]).collect()] == [1, 5]
    assert [r["id"] for r in filters.comment_filter(df, ["g", "h"], ["you"]).collect()] == [5]
    assert [r["id"] for r in filters.comment_filter(df, ["g", "h"], score_limit=2).collect()] == [1]
    with pytest.raises(ValueError):
        filters.comment_filter(df)
    with pytest.raises(ValueError):
        filters.comment_filter(df, "g")
    zero = frame(spark, [(0,), (5,), (6,)], "n int")
    assert filters.sigma_filter(zero, ["n"]).count() == 2 and filters.sigma_filter(zero, ["n"], symmetric=True).count() == 3
    rule, context = filters.keyword_context(F.col("t"))
    texts = frame(spark, [("the Coronavirus is",), ("Covid19 cases up",), ("sarscov2 is here",), ("none",)], "t string")
    assert [(r[0], r[1]) for r in texts.select(rule, context).collect()] == [
        ("cor", "coronavirus"), ("cov", "covid19 cases"), ("sars", "sarscov2 is"), (None, None)]
    assert texts.filter(filters.matches_topic(F.col("t"))).count() == 3


def test_comment_samples(spark):
    rows = [(f"c{i}", "text", "g" if i % 3 else "h", "me", 1577836800 + i * 86400 * 10, "l", "p", i % 5) for i in range(20)]
    df = frame(spark, rows, "id string, body string, subreddit string, author string, created_utc long, link_id string, parent_id string, score int")
    assert sample_comments(df, ("2020_01", "2020_12"), ["g", "h"]).count() == 20
    top = sample_comments(df, ("2020_01", "2020_03"), ["g"], comments_per_month=1, top_scores=True)
    assert top.groupBy("month").count().filter("count <> 1").count() == 0 and top.count() == 3
    assert sample_comments(df, ("2020_01", "2020_01"), ["g", "h"], comments_per_month=1).count() == 2
    for bad in (dict(timerange=("2020_01",)), dict(timerange=("2020_01", "2020_02"), comments_per_month=1.5)):
        with pytest.raises(ValueError):
            sample_comments(df, subreddits=["g"], **bad)


def test_arrays_and_dates(spark):
    df = frame(spark, [(["a", "b", "c"], [1, 2, 3, 4], [1.0, 0.0], [1.0, 1.0])], "t array<string>, i array<int>, u array<double>, v array<double>")
    row = df.select(arrays.with_ngrams(F.col("t"), 3, "_").alias("g"), arrays.pad_left(F.col("i"), 3).alias("cut"),
                    arrays.pad_left(F.col("i"), 6).alias("pad"), arrays.cosine_similarity(F.col("u"), F.col("v")).alias("c"),
                    arrays.argmax(F.col("u")).alias("m")).first()
    assert row["g"] == ["a", "b", "c", "a_b", "b_c", "a_b_c"]
    assert row["cut"] == [2, 3, 4] and row["pad"] == [0, 0, 1, 2, 3, 4]
    assert abs(row["c"] - 2 ** -0.5) < 1e-12 and row["m"] == 0
    assert arrays.union_words(["b", "a"], ["b"]) == ["a", "b"]
    days = spark.range(1).select(
        dates.parse_created_at(F.lit("Wed Oct 10 20:19:24 +0100 2018")).alias("a"), dates.parse_created_at(F.lit("bad")).alias("b"),
        dates.shift_months(F.lit("2020-01-31").cast("date"), 1).alias("c"),
        dates.month_difference(F.lit("2021-02-01").cast("date"), F.lit("2019-12-31").cast("date")).alias("d")).first()
    assert days["a"] == dt.datetime(2018, 10, 10, 19, 19, 24) and days["b"] is None
    assert days["c"] == dt.date(2020, 2, 29) and days["d"] == 14


def test_domains(spark):
    urls = ["http://cnn.com/x", "https://user@www.bbc.co.uk:80/a?b", "http://127.0.0.1/x", "http://localhost/", "t.co/abc"]
    got = [r[0] for r in frame(spark, [(u,) for u in urls], "u string").select(text.url_domain(F.col("u"))).collect()]
    assert got == ["cnn", "bbc", "127.0.0.1", "localhost", "t"]


DOCS = [(1, ["new", "york", "is", "big"]), (2, ["new", "york", "new", "york"]), (3, ["big", "is", "good"]), (4, [])]


def test_tfidf_by_hand(spark):
    df = frame(spark, DOCS, "id int, tokens array<string>")
    w = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(df, "id", weighting="log2").collect()}
    assert abs(w[(2, "new")] - 2 ** -0.5) < 1e-9
    raw = {"big": math.log2(2), "is": math.log2(2), "good": math.log2(4)}
    assert abs(w[(3, "good")] - raw["good"] / math.sqrt(sum(x * x for x in raw.values()))) < 1e-9
    r = {(x["id"], x["term"]): x["weight"] for x in features.tfidf(df, "id", weighting="relative").collect()}
    assert abs(r[(2, "new")] - 2 / 4 * math.log(4 / 2)) < 1e-9
    with pytest.raises(ValueError):
        features.tfidf(df, "id", weighting="other")
    assert features.bag_of_words(df, "id", min_df=2).filter("term = 'good'").count() == 0
    assert features.one_hot(df, "id").filter("id = 2").count() == 2


def test_phrases(spark):
    df = frame(spark, DOCS + [(5, ["new", "york"] * 4 + ["x"])], "id int, tokens array<string>")
    scores = phrases.pair_scores(df, min_count=5).collect()
    assert [(s["a"], s["b"], s["n"]) for s in scores] == [("new", "york", 7)]
    total, n = 20, 7
    expected = math.log((n / total) / ((7 / total) ** 2)) / -math.log(n / total)
    assert abs(scores[0]["npmi"] - expected) < 1e-9
    merged = {r["id"]: r["tokens"] for r in phrases.merge_phrases(df, "id", phrases.learn_phrases(df)).collect()}
    assert merged[1] == ["new_york", "is", "big"] and merged[5] == ["new_york"] * 4 + ["x"] and merged[4] == []
    chain = frame(spark, [("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    row = phrases.merge_phrases(frame(spark, [(1, ["a", "b", "c", "d", "e"])], "id int, tokens array<string>"), "id", chain).first()
    assert row["tokens"] == ["a_b", "c_d", "e"]


def test_normalize(spark):
    tokens = ["http://a.b", "😂", "!", "The", "12", "½", "word", "中文"]
    df = frame(spark, [(1, tokens)], "id int, tokens array<string>")
    assert normalize.normalize(df).first()["tokens"] == ["word"]
    assert normalize.normalize(df, strict_emoji_ranges=True).first()["tokens"] == ["word", "中文"]
    assert normalize.normalize_links_emojis(df).first()["tokens"] == ["!", "The", "12", "½", "word"]
    lemmas = frame(spark, [("word", "Lemma")], "form string, lemma string")
    assert normalize.normalize_words(df, "id", lemmas=lemmas).first()["tokens"][-2] == "lemma"


def test_language(spark, table):
    docs = table("documents").select("doc_id", "lang", "text")
    profiles = language.fit_profiles(docs.filter("doc_id % 2 = 0"), "text", "lang")
    guessed = language.guess_language(docs.filter("doc_id % 2 = 1"), "doc_id", "text", profiles)
    assert guessed.filter("language = lang").count() / guessed.count() > 0.9
    odd = frame(spark, [(1, "12 34"), (2, None)], "doc_id int, text string")
    assert {r["language"] for r in language.guess_language(odd, "doc_id", "text", profiles).collect()} == {"00"}


def test_coherence_by_hand(spark):
    df = frame(spark, [(1, ["a", "b"]), (2, ["a", "b", "c"]), (3, ["a"]), (4, ["c"])], "id int, tokens array<string>")
    top = frame(spark, [(0, 0, "a"), (0, 1, "b"), (0, 2, "c")], "topic int, rank int, word string")
    value = {m: coherence.coherence(df, top, m, window=2 if m != "u_mass" else None).first()["value"] for m in coherence.MEASURES}
    e = 1e-12
    u = [math.log((2 / 4 + e) / (3 / 4)), math.log((1 / 4 + e) / (3 / 4)), math.log((1 / 4 + e) / (2 / 4))]
    assert abs(value["u_mass"] - sum(u) / 3) < 1e-9
    # windows of 2: {a,b} {a,b} {b,c} {a} {c}
    p = {"a": 3 / 5, "b": 3 / 5, "c": 2 / 5}
    j = {("a", "b"): 2 / 5, ("a", "c"): 0.0, ("b", "c"): 1 / 5}
    pmi = {k: math.log((v + e) / (p[k[0]] * p[k[1]])) for k, v in j.items()}
    assert abs(value["c_uci"] - sum(pmi.values()) / 3) < 1e-9
    npmi = {k: pmi[k] / -math.log(j[k] + e) for k in j}
    assert abs(value["c_npmi"] - sum(npmi.values()) / 3) < 1e-9

    def n(x, y):
        return 1.0 if x == y else npmi[tuple(sorted((x, y)))]
    words = "abc"
    whole = [sum(n(w, v) for w in words) for v in words]
    cos = []
    for w in words:
        vec = [n(w, v) for v in words]
        cos.append(sum(x * y for x, y in zip(vec, whole)) / math.sqrt(sum(x * x for x in vec) * sum(y * y for y in whole)))
    assert abs(value["c_v"] - sum(cos) / 3) < 1e-6
    with pytest.raises(ValueError):
        coherence.coherence(df, top, "mass_u")


@pytest.fixture(scope="module")
def two_topics(spark):
    rows = [(i, (["sun", "sea", "sand"] if i % 2 else ["vote", "law", "tax"]) * 4, i // 20, "ab"[i % 2]) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id int, tokens array<string>, slice int, label string").cache()


def test_topics(spark, two_topics, tmp_path):
    model, docs = fit_topic_model(two_topics, "doc_id", k=2, passes=20, subsample=0.5, language=None)
    topics.save(model, str(tmp_path / "lda"))
    shares = topics.topic_shares(topics.load(spark, str(tmp_path / "lda")), docs, "doc_id")
    row = shares.first()
    assert abs(sum(row["shares"]) - 1) < 1e-6
    assert topics.top_words(model, 3).count() == 6
    assert abs(topics.slice_topics(model, docs, "slice").groupBy("slice").agg(F.sum("share").alias("s")).first()["s"] - 1) < 1e-6
    words = topics.slice_topic_words(model, docs, "slice")
    assert all(abs(r["s"] - 1) < 1e-6 for r in words.groupBy("slice", "topic").agg(F.sum("weight").alias("s")).collect())
    assert topics.slice_drift(words, "slice").count() == 2
    table = topics.sweep(two_topics, [2], measures=("u_mass",), passes=1, subsample=0.5)
    assert {r["metric"] for r in table.collect()} == {"log_perplexity", "u_mass"}
    folds = evaluate.stratified_folds(two_topics, "label", ["doc_id"], 2)
    assert topics.grid_search(folds, {"k": [2]}, "fold").count() == 2


def test_classifiers(spark, two_topics, tmp_path):
    for name in ("multinomial", "logistic", "svc"):
        model = classify.TextClassifier(classify.bow_pipeline(classify.make_classifier(name, max_iter=5))).fit(two_topics)
        assert model.predict(two_topics).filter("predicted = label").count() == 40 or name == "svc"
    model.save(str(tmp_path / "svc"))
    nb = classify.TextClassifier(classify.bow_pipeline(classify.make_classifier("multinomial"), ngrams=2)).fit(two_topics)
    nb.save(str(tmp_path / "nb"))
    again = classify.TextClassifier.load(str(tmp_path / "nb"))
    assert again.classes == ["a", "b"]
    p = again.probabilities(two_topics, "doc_id")
    assert p.count() == 80 and abs(p.groupBy("doc_id").agg(F.sum("p").alias("s")).first()["s"] - 1) < 1e-9
    with pytest.raises(classify.NotFittedError):
        classify.TextClassifier(classify.hashed_pipeline()).predict(two_topics)
    with pytest.raises(classify.NotFittedError):
        classify.SimilarityClassifier().predict(two_topics, "doc_id")
    with pytest.raises(ValueError):
        classify.make_classifier("oracle")
    many = frame(spark, [(1, ["x", "y"], ["t"])], "doc_id int, labels array<string>, tokens array<string>")
    assert sorted(r["label"] for r in classify.one_label_per_row(many, "labels").collect()) == ["x", "y"]
    sim = classify.SimilarityClassifier(dims=4, min_count=1).fit(two_topics, "doc_id")
    assert sim.predict(two_topics.drop("label"), "doc_id").filter("predicted is not null").count() == 40


def test_tree_and_hierarchy(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector
    classes = frame(spark, [("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0])], "label string, vector array<double>")
    nodes = hierarchy.build_tree(classes)
    assert nodes[3].classes == ("a", "b") and set(nodes[-1].classes) == {"a", "b", "c"}
    clusters = {r["label"]: r["cluster"] for r in hierarchy.flat_clusters(spark, nodes, 0.75).collect()}
    assert clusters == {"a": 0, "b": 0, "c": 1}
    rows = [(i, "abc"[i % 3], [[1.0, 0.0], [0.7, 0.6], [0.0, 1.0]][i % 3]) for i in range(30)]
    df = frame(spark, rows, "id int, label string, v array<double>").select("id", "label", array_to_vector("v").alias("features"))
    model = hierarchy.HierarchicalClassifier(nodes, LogisticRegression(), models_dir=str(tmp_path)).fit(df, "id")
    assert model.predict(df, "id").join(df, "id").filter("prediction = label").count() == 30
    loaded = hierarchy.HierarchicalClassifier(nodes, None, models_dir=str(tmp_path)).load_models()
    p = loaded.probabilities(df, "id").groupBy("id").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert abs(p["s"] - 1) < 1e-9 and p["n"] == 3
    assert hierarchy.HierarchicalClassifier(nodes, LogisticRegression(), downsample=True).fit(df, "id").predict(df, "id").count() == 30
    with pytest.raises(classify.NotFittedError):
        hierarchy.HierarchicalClassifier(nodes, None).predict(df, "id")


def test_class_similarity_in_chunks(spark):
    classes = frame(spark, [(f"c{i}", [float(i), 1.0]) for i in range(7)], "label string, vector array<double>")
    docs = frame(spark, [(i, [1.0, float(i)]) for i in range(5)], "id int, v array<double>")
    one = joins.class_similarity(docs, "id", "v", classes)
    many = joins.class_similarity(docs, "id", "v", classes, chunk=3)
    assert one.count() == many.count() == 35
    both = one.join(many.withColumnRenamed("similarity", "s2"), ["id", "label"]).filter("abs(similarity - s2) < 1e-12")
    assert both.count() == 35
    assert joins.similarity_summary(one, "id").count() == 5


def test_evaluation(spark, two_topics):
    df = frame(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    s = evaluate.weighted_scores(df).first()
    assert s["accuracy"] == 0.5 and abs(s["precision"] - (2 * 0.5 + 0.5) / 4) < 1e-12 and abs(s["recall"] - 0.5) < 1e-12
    folds = evaluate.stratified_folds(two_topics, "label", ["doc_id"], 4)
    assert {r["count"] for r in folds.groupBy("label", "fold").count().collect()} == {5}
    assert evaluate.holdout(two_topics, 0.2, ["doc_id"]).filter("fold = 0").count() == 8
    assert evaluate.group_folds(two_topics, "slice", 3).groupBy("slice").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    with pytest.raises(ValueError):
        evaluate.holdout(two_topics, 1.5, ["doc_id"])
    with pytest.raises(KeyError):
        evaluate.grid_steps({"step0": {"a": [1]}, "step2": {"a": [1]}})
    with pytest.raises(ValueError):
        evaluate.tune(two_topics, None, "unknown")
    ready = two_topics.select("doc_id", "tokens", F.when(F.col("label") == "b", 1.0).otherwise(0.0).alias("label"))
    held = evaluate.holdout(ready, 0.25, ["doc_id"])
    make = lambda alpha=1.0, ngrams=1: classify.bow_pipeline(classify.make_classifier("multinomial", alpha=alpha), ngrams=ngrams)
    best, value, trials = evaluate.tune(held, make, {"step0": {"alpha": [0.1, 1.0]}, "step1": [{"ngrams": [1]}, {"ngrams": [2]}]})
    assert best == {"alpha": 0.1, "ngrams": 1} and value == 1.0 and trials.count() == 4
    for scoring in ("f1", "neg_log_loss", "top_k_accuracy", evaluate.TopKAccuracy(1)):
        assert len(evaluate.cross_validate(held, make(), scoring=scoring, k=1)) == 1
    assert evaluate.compare_models(held, {"nb": make()}).first()["accuracy"] == 1.0
    long = frame(spark, [(1, "x", 0.5, "y"), (1, "y", 0.4, "y"), (1, "z", 0.1, "y")], "id int, label string, p double, truth string")
    assert evaluate.top_k_accuracy(long, "id", "label", "p", "truth", 1).first()[0] == 0.0
    assert evaluate.top_k_accuracy(long, "id", "label", "p", "truth", 2).first()[0] == 1.0
    assert evaluate.best_label(long, "id", "label", "p").first()["prediction"] == "x"


def test_features_and_vocab(spark, two_topics, tmp_path):
    path = str(tmp_path / "cv")
    model, out = features.count_vectors(two_topics, path=path)
    again, _ = features.count_vectors(two_topics.limit(1), path=path)
    assert again.vocabulary == model.vocabulary
    assert features.dense_array(out).select(F.size("dense")).first()[0] == 6
    assert features.reduce_dimensions(out, "doc_id", k=2).select(F.size("reduced")).first()[0] == 2
    custom = features.AnalyzedTokens(lambda t: F.transform(t, F.upper)).transform(two_topics).first()["terms"]
    assert custom[0] in ("SUN", "VOTE")
    ids = vocab.term_dictionary(two_topics)
    assert sorted(r["term_id"] for r in ids.collect()) == list(range(1, 7))
    assert vocab.token_ids(two_topics, "doc_id", ids).filter(F.size("ids") == 12).count() == 40
    assert vocab.corpus_words(two_topics, size=3).count() == 3
    assert vocab.stem_table(two_topics).count() == 6
    assert counts.vocabulary_size(two_topics).first().asDict() == {"vocabulary": 6, "words": 480}


def test_locate(spark):
    users = frame(spark, [(1, " New-York, NY "), (2, "nowhere"), (3, None)], "user_id int, located string")
    places = frame(spark, [("new york ny", "New York", -74.0, 40.7)], "address_text string, address string, longitude double, latitude double")
    assert [(r["user_id"], r["address"]) for r in joins.locate(users, places).collect()] == [(1, "New York")]
