"""Topics, coherence, classifiers, scores, class vectors: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialtext.catalog.registry import query, table
from socialtext.catalog.texts import WORDS_SQL, words
from socialtext.functions.arrays import counted
from socialtext.functions.tokens import lower_words
from socialtext.operators import (
    classify, coherence, counts, embeddings, evaluate, features, hierarchy, joins, linear, reshape, svd, topics, vocab)
from socialtext.session import in_tasks, spread, stored

DIMS = 64
_LIST = ", ".join(f"avg(embedding[{i + 1}]::DOUBLE)" for i in range(DIMS))
_CLASS_SQL = f"""
    WITH k AS (SELECT label, [{_LIST}] AS v FROM embeddings GROUP BY label),
    s AS (SELECT vec_id, embeddings.label AS truth, k.label, list_cosine_similarity(embedding::DOUBLE[], v) AS sim
          FROM embeddings, k)"""


def _similarities(spark, sf):
    docs = spread(table(spark, sf, "embeddings"))
    classes = joins.mean_vectors(docs, "label", "embedding", DIMS)
    return docs, joins.class_similarity(docs, "vec_id", "embedding", classes)


@query("class_similarity", _CLASS_SQL + " SELECT vec_id, label, round(sim, 6) AS similarity FROM s")
def class_similarity(spark, sf):
    return _similarities(spark, sf)[1].withColumn("similarity", F.round("similarity", 6))


@query("similarity_summary", _CLASS_SQL + """
    SELECT vec_id, round(avg(sim), 6) AS avg_similarity, round(max(sim), 6) AS max_similarity FROM s GROUP BY vec_id""")
def similarity_summary(spark, sf):
    out = joins.similarity_summary(_similarities(spark, sf)[1], "vec_id")
    return out.select("vec_id", F.round("avg_similarity", 6).alias("avg_similarity"),
                      F.round("max_similarity", 6).alias("max_similarity"))


@query("best_label", _CLASS_SQL + """
    SELECT vec_id, label AS prediction FROM (SELECT *, row_number() OVER (
      PARTITION BY vec_id ORDER BY round(sim, 9) DESC, label DESC) AS rn FROM s) WHERE rn = 1""")
def best_label(spark, sf):
    sims = _similarities(spark, sf)[1].withColumn("similarity", F.round("similarity", 9))
    return evaluate.best_label(sims, "vec_id", "label", "similarity")


@query("topk_accuracy", _CLASS_SQL + """
    SELECT round(avg(CASE WHEN rn <= 3 AND label = truth THEN 1.0 ELSE 0.0 END) * (SELECT count(*) FROM k), 6) AS top_k_accuracy
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, label DESC) AS rn FROM s)""")
def topk_accuracy(spark, sf):
    docs, sims = _similarities(spark, sf)
    long = sims.withColumn("similarity", F.round("similarity", 9)).join(
        docs.select("vec_id", F.col("label").alias("truth")), "vec_id")
    out = evaluate.top_k_accuracy(long, "vec_id", "label", "similarity", "truth", 3)
    return out.select(F.round("top_k_accuracy", 6).alias("top_k_accuracy"))


@query("weighted_scores", _CLASS_SQL + """,
    p AS (SELECT truth AS t, label AS p FROM (SELECT *, row_number() OVER (
            PARTITION BY vec_id ORDER BY round(sim, 9) DESC, label DESC) AS rn FROM s) WHERE rn = 1),
    l AS (SELECT t, count(*) AS n, sum(CASE WHEN t = p THEN 1 ELSE 0 END) AS hit FROM p GROUP BY t),
    g AS (SELECT p AS t, count(*) AS guessed FROM p GROUP BY p),
    r AS (SELECT n, hit, coalesce(hit / guessed, 0) AS pr, hit / n AS re FROM l LEFT JOIN g USING (t))
    SELECT round(sum(hit) / sum(n), 6) AS accuracy, round(sum(pr * n) / sum(n), 6) AS precision,
           round(sum(re * n) / sum(n), 6) AS recall,
           round(sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * n) / sum(n), 6) AS f1 FROM r""")
def weighted_scores(spark, sf):
    docs, sims = _similarities(spark, sf)
    best = evaluate.best_label(sims.withColumn("similarity", F.round("similarity", 9)), "vec_id", "label", "similarity")
    scored = evaluate.weighted_scores(joins.join_predictions(best, docs.select("vec_id", "label"), "vec_id"))
    return scored.select(*[F.round(c, 6).alias(c) for c in scored.columns])


@query("log_loss", _CLASS_SQL + """,
    e AS (SELECT vec_id, truth, label, exp(sim) / sum(exp(sim)) OVER (PARTITION BY vec_id) AS p FROM s)
    SELECT round(-avg(ln(p)), 6) AS log_loss FROM e WHERE label = truth""")
def log_loss(spark, sf):
    docs, sims = _similarities(spark, sf)
    totals = sims.groupBy("vec_id").agg(F.sum(F.exp("similarity")).alias("total"))
    own = sims.join(docs.select("vec_id", "label"), ["vec_id", "label"]).join(totals, "vec_id")
    out = evaluate.log_loss(own.withColumn("p", F.exp("similarity") / F.col("total")), "p")
    return out.select(F.round("log_loss", 6).alias("log_loss"))


@query("wide_probabilities", """
    SELECT user_id, coalesce(sum(n) FILTER (event_type = 'click') / sum(n), 1e-10) AS click,
           coalesce(sum(n) FILTER (event_type = 'error') / sum(n), 1e-10) AS error,
           coalesce(sum(n) FILTER (event_type = 'view') / sum(n), 1e-10) AS "view"
    FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY user_id""")
def wide_probabilities(spark, sf):
    events = table(spark, sf, "events")
    shares = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).join(
        events.groupBy("user_id").agg(F.count(F.lit(1)).alias("total")), "user_id")
    return reshape.wide_probabilities(shares.withColumn("p", F.col("n") / F.col("total")), "user_id", "event_type", "p",
                                      ["click", "error", "view"])


@query("fold_assign", """
    SELECT doc_id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5('24|' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold
    FROM labels""")
def fold_assign(spark, sf):
    return evaluate.stratified_folds(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", ["doc_id"], 5)


@query("holdout_split", """
    SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('24|' || doc_id), doc_id) <=
           (SELECT ceil(count(*) * 0.2::DOUBLE) FROM labels) THEN 0 ELSE -1 END AS fold FROM labels""")
def holdout_split(spark, sf):
    return evaluate.holdout(table(spark, sf, "labels").select("doc_id"), 0.2, ["doc_id"])


@query("group_folds", """
    SELECT doc_id, CAST(('0x' || substr(md5('24|' || source), 1, 8))::BIGINT % 12 AS INTEGER) AS fold FROM documents""")
def group_folds(spark, sf):
    return evaluate.group_folds(table(spark, sf, "documents").select("doc_id", "source"), "source", 12).select("doc_id", "fold")


@query("mean_fold_scores", """
    SELECT event_type, 'value' AS metric, round(avg(value), 6) AS value FROM events GROUP BY event_type""")
def mean_fold_scores(spark, sf):
    scores = table(spark, sf, "events").select("event_type", F.lit("value").alias("metric"), "value")
    return counts.mean_scores(scores, ["event_type"]).withColumn("value", F.round("value", 6))


_TOPIC_SQL = f"""
    WITH d AS (SELECT doc_id, lang, {WORDS_SQL} AS ws FROM documents),
    f AS (SELECT lang, w, count(*) AS df FROM (SELECT DISTINCT doc_id, lang, unnest(ws) AS w FROM d) GROUP BY 1, 2),
    tw AS (SELECT lang AS topic, w AS word, rank FROM (
             SELECT *, row_number() OVER (PARTITION BY lang ORDER BY df DESC, w) - 1 AS rank FROM f) WHERE rank < 6)"""


def _topic_words(spark, sf):
    """The most widespread words of each language, as if they were topics."""
    docs = words(spark, sf, "lang")
    top = vocab.top_terms(docs, "lang", 6).select(
        F.col("lang").alias("topic"), (F.col("rank") - 1).alias("rank"), F.col("term").alias("word"))
    return docs.select("doc_id", "tokens"), top


@query("u_mass", _TOPIC_SQL + """,
    h AS (SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(ws) AS word FROM d) WHERE word IN (SELECT word FROM tw)),
    n AS (SELECT count(*)::DOUBLE AS t FROM d),
    pr AS (SELECT a.topic, a.word AS w, b.word AS v FROM tw a JOIN tw b ON a.topic = b.topic AND b.rank < a.rank),
    c2 AS (SELECT x.word AS w, y.word AS v, count(*) AS c FROM h x JOIN h y ON x.doc_id = y.doc_id GROUP BY 1, 2),
    c1 AS (SELECT word AS v, count(*) AS c FROM h GROUP BY 1)
    SELECT topic, round(avg(ln((coalesce(c2.c, 0) / t + 1e-12) / (c1.c / t))), 6) AS value
    FROM pr LEFT JOIN c2 USING (w, v) JOIN c1 USING (v), n GROUP BY topic""")
def u_mass(spark, sf):
    docs, top = _topic_words(spark, sf)
    return coherence.coherence(docs, top, "u_mass").withColumn("value", F.round("value", 6))


def _window_sql(size: int) -> str:
    return _TOPIC_SQL + f""",
    win AS (SELECT doc_id, s, list_distinct([x FOR x IN ws[s:s + {size - 1}] IF list_contains(tws, x)]) AS ws
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {size} + 1, 1) + 1)) AS s, tws
                  FROM d, (SELECT list(DISTINCT word) AS tws FROM tw))),
    h AS (SELECT doc_id, s, unnest(ws) AS word FROM win),
    n AS (SELECT count(*)::DOUBLE AS t FROM win),
    c1 AS (SELECT word, count(*) / t AS p FROM h, n GROUP BY word, t),
    c2 AS (SELECT x.word AS w, y.word AS v, count(*) / t AS p FROM h x JOIN h y ON x.doc_id = y.doc_id AND x.s = y.s, n GROUP BY 1, 2, t),
    every AS (SELECT a.topic, a.word AS w, b.word AS v, pw.p AS p_w, pv.p AS p_v, coalesce(c2.p, 0) + 1e-12 AS p
           FROM tw a JOIN tw b ON a.topic = b.topic JOIN c1 pw ON pw.word = a.word
           JOIN c1 pv ON pv.word = b.word LEFT JOIN c2 ON c2.w = a.word AND c2.v = b.word),
    pr AS (SELECT * FROM every WHERE w <> v)"""


@query("c_npmi", _window_sql(10) + " SELECT topic, round(avg(ln(p / (p_w * p_v)) / -ln(p)), 6) AS value FROM pr GROUP BY topic")
def c_npmi(spark, sf):
    docs, top = _topic_words(spark, sf)
    return coherence.coherence(docs, top, "c_npmi").withColumn("value", F.round("value", 6))


@query("c_uci", _window_sql(10) + " SELECT topic, round(avg(ln(p / (p_w * p_v))), 6) AS value FROM pr GROUP BY topic")
def c_uci(spark, sf):
    docs, top = _topic_words(spark, sf)
    return coherence.coherence(docs, top, "c_uci").withColumn("value", F.round("value", 6))


@query("c_v", _window_sql(110) + """,
    x AS (SELECT topic, w, v, ln(p / (p_w * p_v)) / -ln(p) AS x FROM every),
    whole AS (SELECT topic, v, sum(x) AS s FROM x GROUP BY 1, 2),
    cos AS (SELECT topic, w, sum(x * s) / sqrt(sum(x * x) * sum(s * s)) AS c FROM x JOIN whole USING (topic, v) GROUP BY 1, 2)
    SELECT topic, round(avg(c), 6) AS value FROM cos GROUP BY topic""")
def c_v(spark, sf):
    docs, top = _topic_words(spark, sf)
    return coherence.coherence(docs, top, "c_v").withColumn("value", F.round("value", 6))


TOPICS, PASSES, INNER, ETA = 5, 5, 5, 1 / 5
_NOISE = "-ln((('0x' || substr(md5('{j}|24|' || w), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296) * df AS w{j}"


def _each(pattern: str, sep: str = ", ") -> str:
    """``pattern`` once per topic, with its number for ``{j}``."""
    return sep.join(pattern.replace("{j}", str(j)) for j in range(TOPICS))


def _shares_sql(out: str, entries: str, phi: str, inner: int) -> str:
    """CTEs of the topic shares ``{out}_1 …`` of each document, and the split of each entry in the last step."""
    parts, start = [], f"(SELECT DISTINCT doc_id, {_each(f'{1 / TOPICS}::DOUBLE AS t{{j}}')} FROM {entries})"
    for i in range(1, inner + 1):
        before = start if i == 1 else f"{out}_{i - 1}"
        parts.append(f"""{out}_{i}s AS MATERIALIZED (SELECT doc_id, w, {_each('t{j} * p{j} / (' + _each('t{j} * p{j}', ' + ') + ') AS g{j}')}
            FROM {entries} JOIN {phi} USING (w) JOIN {before} USING (doc_id)),
          {out}_{i} AS MATERIALIZED (SELECT doc_id, {_each(f'(sum(g{{j}}) + {1 / TOPICS}) / (count(*) + 1.0::DOUBLE) AS t{{j}}')} FROM {out}_{i}s GROUP BY doc_id)""")
    return ",\n".join(parts)


def _phi_sql(out: str, weights: str) -> str:
    each = _each(f"(w{{j}} + {ETA}) / (sum(w{{j}}) OVER () + count(*) OVER () * {ETA}) AS p{{j}}")
    return f"{out} AS MATERIALIZED (SELECT w, {each} FROM {weights})"


def _lda_sql(passes: int = PASSES, inner: int = INNER, least: int = 3) -> str:
    """CTEs of the same passes in SQL: entries ``x``, word probabilities ``phi``, topic shares ``shares`` (t0, t1, …)."""
    parts = [f"d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents)", "e AS (SELECT DISTINCT doc_id, unnest(ws) AS w FROM d)",
             f"f AS (SELECT w, count(*) AS df FROM e GROUP BY w HAVING count(*) >= {least})", "x AS MATERIALIZED (SELECT doc_id, w FROM e JOIN f USING (w))",
             f"w0 AS MATERIALIZED (SELECT w, {_each(_NOISE)} FROM f)"]
    for p in range(passes):
        parts += [_phi_sql(f"p{p}", f"w{p}"), _shares_sql(f"q{p}", "x", f"p{p}", inner),
                  f"w{p + 1} AS MATERIALIZED (SELECT w, {_each('sum(g{j}) AS w{j}')} FROM q{p}_{inner}s GROUP BY w)"]
    parts += [_phi_sql("phi", f"w{passes}"), _shares_sql("r", "x", "phi", inner),
              f"shares AS (SELECT d.doc_id, ws, {_each(f'coalesce(t{{j}}, {1 / TOPICS}) AS t{{j}}')} FROM d LEFT JOIN r_{inner} USING (doc_id))"]
    return "WITH " + ",\n".join(parts)


def _fit_small(spark, sf):
    """The words of all documents and a model of them. They are written once, as every pass reads them."""
    docs = stored(words(spark, sf), "topic-words")
    return docs, topics.fit_topics(docs, k=TOPICS, passes=PASSES, inner=INNER, min_df=3, learn_alpha=False)


def _slices(docs):
    """Five slices of the document numbers."""
    total = docs.agg(F.max("doc_id") + 1).scalar()
    return docs.withColumn("slice", F.floor(F.col("doc_id") * 5 / total).cast("int"))


_SLICE_SQL = "CAST(floor(doc_id * 5 / (SELECT max(doc_id) + 1 FROM documents)) AS INTEGER) AS slice"


@query("lda_topics", f"""{_lda_sql()}
    SELECT doc_id, CAST(list_position([{_each('t{j}')}], greatest({_each('t{j}')})) - 1 AS INTEGER) AS topic,
           round(greatest({_each('t{j}')}), 6) AS share FROM shares""")
def lda_topics(spark, sf):
    docs, model = _fit_small(spark, sf)
    return topics.topic_shares(model, docs, "doc_id").select("doc_id", "topic", F.round(F.array_max("shares"), 6).alias("share"))


@query("lda_top_words", f"""{_lda_sql()},
    long AS ({_each("SELECT {j} AS topic, w AS word, p{j} AS p FROM phi", " UNION ALL ")}),
    best AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY p DESC, word) - 1 AS rank FROM long)
    SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, word, round(p, 6) AS weight FROM best WHERE rank < 10""")
def lda_top_words(spark, sf):
    return topics.top_words(_fit_small(spark, sf)[1], 10).withColumn("weight", F.round("weight", 6))


@query("slice_topics", f"""{_lda_sql()},
    m AS (SELECT {_SLICE_SQL}, {_each('avg(t{j}) AS t{j}')} FROM shares GROUP BY slice)
    {_each("SELECT slice, CAST({j} AS INTEGER) AS topic, round(t{j}, 6) AS share FROM m", " UNION ALL ")}""")
def slice_topics(spark, sf):
    """Mean topic shares in five slices of the document numbers."""
    docs, model = _fit_small(spark, sf)
    return topics.slice_topics(model, _slices(docs), "slice").withColumn("share", F.round("share", 6))


@query("slice_drift", f"""{_lda_sql()},
    m AS (SELECT slice, w, {_each('sum(t{j}) AS m{j}')} FROM (SELECT {_SLICE_SQL}, {_each('t{j}')}, unnest(ws) AS w FROM shares) GROUP BY slice, w),
    long AS ({_each("SELECT slice, {j} AS topic, w, m{j} AS m FROM m", " UNION ALL ")}),
    v AS (SELECT slice, topic, w, m / sum(m) OVER (PARTITION BY slice, topic) AS v FROM long),
    n AS (SELECT slice, topic, sum(v * v) AS n FROM v GROUP BY slice, topic),
    dots AS (SELECT a.slice, a.topic, sum(a.v * b.v) AS s FROM v a JOIN v b ON a.slice = b.slice + 1 AND a.topic = b.topic AND a.w = b.w GROUP BY a.slice, a.topic)
    SELECT a.slice, CAST(a.topic AS INTEGER) AS topic, round(coalesce(s, 0) / sqrt(a.n * b.n), 6) AS similarity
    FROM n a JOIN n b ON a.slice = b.slice + 1 AND a.topic = b.topic LEFT JOIN dots ON dots.slice = a.slice AND dots.topic = a.topic""")
def slice_drift(spark, sf):
    docs, model = _fit_small(spark, sf)
    words_of = topics.slice_topic_words(model, _slices(docs), "slice")
    return topics.slice_drift(words_of, "slice").withColumn("similarity", F.round("similarity", 6))


def _chain_sql(passes: int = 2, inner: int = 3, least: int = 2, decay: float = 0.5) -> str:
    """Slice by slice: the weights of a slice start the next one and stay in it with half their size."""
    parts = [f"d AS (SELECT {_SLICE_SQL}, doc_id, {WORDS_SQL} AS ws FROM documents)", "e AS (SELECT DISTINCT slice, doc_id, unnest(ws) AS w FROM d)"]
    for c in range(5):
        parts += [f"f{c} AS (SELECT w, count(*) AS df FROM e WHERE slice = {c} GROUP BY w HAVING count(*) >= {least})",
                  f"n{c} AS (SELECT w, {_each(_NOISE)} FROM f{c})"]
        if c:
            parts.append(f"w{c}_0 AS MATERIALIZED (SELECT w, {_each('coalesce(o.w{j}, n.w{j}) AS w{j}')} FROM n{c} n FULL JOIN w{c - 1}_{passes} o USING (w))")
        else:
            parts.append("w0_0 AS MATERIALIZED (SELECT * FROM n0)")
        parts.append(f"x{c} AS MATERIALIZED (SELECT doc_id, w FROM e JOIN w{c}_0 USING (w) WHERE slice = {c})")
        for p in range(passes):
            sums = f"(SELECT w, {_each('sum(g{j}) AS s{j}')} FROM q{c}_{p}_{inner}s GROUP BY w)"
            prior = f"LEFT JOIN (SELECT w, {_each('w{j} AS o{j}')} FROM w{c - 1}_{passes}) o USING (w)" if c else ""
            old = f" + {decay} * coalesce(o{{j}}, 0)" if c else ""
            parts += [_phi_sql(f"p{c}_{p}", f"w{c}_{p}"), _shares_sql(f"q{c}_{p}", f"x{c}", f"p{c}_{p}", inner),
                      f"w{c}_{p + 1} AS MATERIALIZED (SELECT w, {_each(f'coalesce(s{{j}}, 0){old} AS w{{j}}')} FROM w{c}_{p} LEFT JOIN {sums} s USING (w) {prior})"]
        parts += [_phi_sql(f"phi{c}", f"w{c}_{passes}")]
    return "WITH " + ",\n".join(parts)


@query("chained_topics", _chain_sql() + ", long AS (" + " UNION ALL ".join(
    _each(f"SELECT {c} AS slice, {{j}} AS topic, w AS word, p{{j}} AS p FROM phi{c}", " UNION ALL ") for c in range(5)) + """),
    n AS (SELECT slice, topic, sum(p * p) AS n FROM long GROUP BY slice, topic),
    dots AS (SELECT a.slice, a.topic, sum(a.p * b.p) AS s FROM long a JOIN long b ON a.slice = b.slice + 1 AND a.topic = b.topic AND a.word = b.word GROUP BY a.slice, a.topic)
    SELECT CAST(a.slice AS INTEGER) AS slice, CAST(a.topic AS INTEGER) AS topic, round(s / sqrt(a.n * b.n), 6) AS similarity
    FROM n a JOIN n b ON a.slice = b.slice + 1 AND a.topic = b.topic JOIN dots ON dots.slice = a.slice AND dots.topic = a.topic""")
def chained_topics(spark, sf):
    """How far the words of each topic move from slice to slice, when every slice starts from the one before."""
    docs = _slices(stored(words(spark, sf), "topic-words"))
    models = topics.chained_slices(docs, "slice", k=TOPICS, passes=2, inner=3, min_df=2, learn_alpha=False)
    return topics.slice_drift(topics.chained_words(models), "slice").withColumn("similarity", F.round("similarity", 6))


def _labelled(spark, sf):
    docs = in_tasks(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    return docs.select("doc_id", F.col("lang").alias("label"), lower_words(F.col("text")).alias("tokens")).persist()


def _predictions(spark, sf, pipeline):
    docs = _labelled(spark, sf)
    return classify.TextClassifier(pipeline).fit(docs).predict(docs).select("doc_id", "predicted")


def _held_out(spark, sf):
    """Words of all documents, with those of every fifth document number held out from learning."""
    docs = stored(words(spark, sf, "lang").withColumnRenamed("lang", "label"), "labelled-words")
    return docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")


@query("nb_classifier", f"""
    WITH d AS (SELECT doc_id, lang, {WORDS_SQL} AS ws FROM documents),
    t AS (SELECT doc_id, lang, w, count(*) AS tf FROM (SELECT doc_id, lang, unnest(ws) AS w FROM d) GROUP BY ALL),
    v AS (SELECT w, ln((1 + (SELECT count(*) FROM d)) / (1.0::DOUBLE + count(*))) + 1 AS idf FROM t GROUP BY w HAVING count(*) >= 2),
    x AS (SELECT doc_id, lang, w, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS x FROM t JOIN v USING (w)),
    s AS (SELECT lang AS label, w, sum(x) AS s FROM x GROUP BY lang, w),
    c AS (SELECT lang AS label, ln(count(*) + 1) AS prior FROM d GROUP BY lang),
    m AS (SELECT label, ln(sum(s) + (SELECT count(*) FROM v)) AS mass FROM s GROUP BY label),
    p AS (SELECT doc_id, label, sum(x * (ln(coalesce(s, 0) + 1) - mass)) AS p
          FROM x CROSS JOIN c JOIN m USING (label) LEFT JOIN s USING (label, w) GROUP BY doc_id, label)
    SELECT doc_id, label AS predicted FROM (SELECT d.doc_id, c.label,
      row_number() OVER (PARTITION BY d.doc_id ORDER BY prior + coalesce(p, 0) DESC, c.label) AS r
      FROM d CROSS JOIN c LEFT JOIN p ON p.doc_id = d.doc_id AND p.label = c.label) WHERE r = 1""")
def nb_classifier(spark, sf):
    return _predictions(spark, sf, classify.bow_pipeline(classify.make_classifier("multinomial"), min_df=2))


@query("linear_classifier")
def linear_classifier(spark, sf):
    return _predictions(spark, sf, classify.bow_pipeline(classify.make_classifier("logistic", max_iter=10), min_df=5))


@query("hashed_classifier")
def hashed_classifier(spark, sf):
    return _predictions(spark, sf, classify.hashed_pipeline(ngrams=2, buckets=1 << 14, max_iter=10))


@query("stochastic_linear")
def stochastic_linear(spark, sf):
    """Hinge loss with a mixed penalty, learned on four fifths of the documents and applied to the rest."""
    train, test = _held_out(spark, sf)
    terms = F.array_distinct("tokens")
    model = linear.fit_linear(train, F.col("label"), terms, penalty="elasticnet", alpha=1e-3, epochs=5)
    return linear.predict(model, test, "doc_id", terms).select("doc_id", "predicted")


@query("embedding_classifier")
def embedding_classifier(spark, sf):
    """Averaged embeddings of words and pairs with a label tree, on held-out documents."""
    train, test = _held_out(spark, sf)
    model = embeddings.fit_embeddings(train, dim=16, lr=0.3, epoch=3, loss="hs", wordNgrams=2, minCount=5)
    return embeddings.predict(model, test, "doc_id").select("doc_id", "predicted")


@query("label_code_lengths", """
    WITH RECURSIVE n AS (SELECT source AS label, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
    tree AS (SELECT 0 AS step, list_sort(list({'n': n, 'labels': [label]})) AS nodes, CAST([] AS VARCHAR[]) AS merged FROM n
      UNION ALL
      SELECT step + 1, list_sort(list_append(nodes[3:], {'n': nodes[1].n + nodes[2].n, 'labels': list_sort(list_concat(nodes[1].labels, nodes[2].labels))})),
             list_concat(nodes[1].labels, nodes[2].labels) FROM tree WHERE len(nodes) > 1)
    SELECT label, n, (SELECT count(*) FROM tree WHERE list_contains(merged, label)) AS bits FROM n""")
def label_code_lengths(spark, sf):
    """Code length of each source in the label tree of the classifier, from the counts of the sources."""
    counts_of = {r["source"]: r["count"] for r in table(spark, sf, "documents").where("source is not null").groupBy("source").count().collect()}
    paths = embeddings.huffman(counts_of)
    return spark.createDataFrame([(c, n, len(paths[c])) for c, n in counts_of.items()], "label string, n long, bits long")


@query("similarity_classifier")
def similarity_classifier(spark, sf):
    train, test = _held_out(spark, sf)
    model = classify.SimilarityClassifier(dims=16, min_count=5, epochs=3).fit(train, "doc_id")
    return model.predict(test, "doc_id").select("doc_id", "predicted")


@query("dense_classifier")
def dense_classifier(spark, sf):
    return _predictions(spark, sf, classify.dense_pipeline(4, dims=16, hidden=(8,), max_iter=20))


@query("class_tree")
def class_tree(spark, sf):
    """Flat clusters of the vector classes at cosine distance 0.75."""
    classes = joins.mean_vectors(table(spark, sf, "embeddings"), "label", "embedding", DIMS)
    return hierarchy.flat_clusters(spark, hierarchy.build_tree(classes), 0.75)


@query("hierarchical")
def hierarchical(spark, sf):
    from pyspark.ml.functions import array_to_vector
    docs = spread(table(spark, sf, "embeddings"))
    nodes = hierarchy.build_tree(joins.mean_vectors(docs, "label", "embedding", DIMS))
    rows = docs.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = hierarchy.HierarchicalClassifier(nodes, classify.make_classifier("logistic", max_iter=10)).fit(rows, "vec_id")
    return model.predict(rows.drop("label"), "vec_id")


@query("document_vectors")
def document_vectors(spark, sf):
    docs = words(spark, sf, "lang")
    _, vectors = features.word_vectors(docs, dims=16, min_count=5)
    return features.class_vectors(vectors, "lang").select(
        "lang", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("length"))


def _squared(values):
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)


@query("svd_reduction")
def svd_reduction(spark, sf):
    """Share of the squared length of the term counts of each document that ten dimensions keep."""
    docs = stored(words(spark, sf).select("doc_id", counted(F.col("tokens")).alias("terms")), "svd-words")
    terms, values = F.col("terms.term"), F.col("terms.tf").cast("array<double>")
    reduced = svd.project(svd.truncated_svd(docs, terms, values, k=10), docs, "doc_id", terms, values)
    whole = docs.select("doc_id", _squared(values).alias("whole"))
    return (whole.join(reduced.select("doc_id", _squared(F.col("reduced")).alias("kept")), "doc_id")
            .select("doc_id", F.round(F.try_divide("kept", "whole"), 6).alias("kept_share")))


@query("svd_moments", f"""
    WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    g AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS g FROM e a JOIN e b USING (vec_id) GROUP BY a.i, b.i),
    p AS (SELECT sum(g) FILTER (i = j) AS p1, sum(g * g) AS p2 FROM g),
    c AS (SELECT sum(a.g * b.g * c.g) AS p3 FROM g a JOIN g b ON a.j = b.i JOIN g c ON b.j = c.i AND c.j = a.i)
    SELECT round(p1, 6) AS squares, round(p2 / p1 ** 2, 9) AS fourth_powers, round(p3 / p1 ** 3, 9) AS sixth_powers FROM p, c""")
def svd_moments(spark, sf):
    """Power sums of all singular values of the vectors: they fix the values, and SQL has them without a decomposition."""
    rows = spread(table(spark, sf, "embeddings"))
    places = F.sequence(F.lit(1), F.lit(DIMS))
    found = svd.truncated_svd(rows, F.when(F.size("embedding") == DIMS, places), F.col("embedding"), k=DIMS)
    p1, p2, p3 = (sum(v ** n for v in found.values) for n in (2, 4, 6))
    return spark.createDataFrame([(round(p1, 6), round(p2 / p1 ** 2, 9), round(p3 / p1 ** 3, 9))],
                                 "squares double, fourth_powers double, sixth_powers double")
