"""Tokens, terms, languages, features: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialtext.catalog.registry import query, table
from socialtext.functions import arrays, text as tx, tokens as tk
from socialtext.operators import counts, features, filters, language, normalize, phrases, tokenizer, vocab
from socialtext.session import in_tasks, spread

STOPS = ["the", "of", "and", "in", "de", "la", "der", "die", "und", "el", "les", "to"]
STOPS_SQL = ", ".join(f"'{w}'" for w in STOPS)
WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def documents(spark, sf, *columns):
    return spread(table(spark, sf, "documents").select(*columns))


def words(spark, sf, *extra):
    """Lower-cased words of every document."""
    docs = documents(spark, sf, "doc_id", "text", *extra)
    return docs.select("doc_id", *extra, tk.lower_words(F.col("text")).alias("tokens"))


def dealt_words(spark, sf):
    """The same in tasks of bounded size, for counts of pairs and grams: nearly all are distinct, so a task keeps as many rows as it has words."""
    docs = in_tasks(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", tk.lower_words(F.col("text")).alias("tokens"))


# The full split in RE2 terms. RE2 has no look-around, so inner hyphens are set apart by blanks first,
# twice, as neighbouring matches may share a letter. The texts hold no links, tags or contractions.
_SPLIT_SQL = r"""
    SELECT doc_id, lang, text, regexp_extract_all(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        trim(regexp_replace(regexp_replace(replace(text, '.@', '. @'), '([*;,!?()\[\]])', ' \1', 'g'), '\s{2,}', ' ', 'g')),
        '([\p{L}\p{M}_])-([\p{L}\p{M}_])', '\1 - \2', 'g'), '([\p{L}\p{M}_])-([\p{L}\p{M}_])', '\1 - \2', 'g'),
        '(\p{N})-(\p{N})', '\1 - \2', 'g'), '(\p{N})-(\p{N})', '\1 - \2', 'g'),
      '[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}'
      || '|@[\p{L}\p{M}\p{N}_]+|#[\p{L}\p{M}\p{N}_]+|[\p{L}\p{M}\p{N}_]+(?:[-.:/][\p{L}\p{M}\p{N}_]+)*|\.{2,}|-{2,}|\S') AS raw
    FROM documents"""
# ASCII letters are cut to three by one rule each: RE2 has no back-references.
def _cut_sql(value: str, keep: int) -> str:
    for letter in "abcdefghijklmnopqrstuvwxyz":
        value = f"regexp_replace({value}, '{letter}{{3,}}', '{letter * keep}', 'g')"
    return value


# Three equal letters in the token as it was written.
_RUN = "|".join(f"{x}{{3}}" for x in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@query("top_terms_by_lang", f"""
    WITH t AS (SELECT DISTINCT doc_id, lang, CASE WHEN regexp_matches(tok, '{_RUN}') THEN {_cut_sql('lower(tok)', 3)} ELSE lower(tok) END AS term
               FROM (SELECT doc_id, lang, unnest(raw) AS tok FROM ({_SPLIT_SQL}))
               WHERE NOT regexp_matches(tok, '^\\p{{P}}+$') AND lower(tok) NOT IN ({STOPS_SQL})),
    n AS (SELECT lang, term, count(*) AS df FROM t GROUP BY lang, term)
    SELECT lang, term, df, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY df DESC, term) AS rank FROM n) WHERE rank <= 20""")
def top_terms_by_lang(spark, sf):
    tokens = tokenizer.tokenize(documents(spark, sf, "doc_id", "lang", "text"), "text", ignore_stopwords=STOPS)
    return vocab.top_terms(tokens.select("lang", "tokens"), "lang", 20)


@query("split_tokens", f"SELECT doc_id, array_to_string(raw, ' ') AS joined FROM ({_SPLIT_SQL})")
def split_tokens(spark, sf):
    raw = tokenizer.raw_tokens(F.col("text"), tk.TokenizerOptions())
    return documents(spark, sf, "doc_id", "text").select("doc_id", arrays.join_tokens(raw).alias("joined"))


@query("clean_text", r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(replace(
      replace(replace(replace(replace(text, '’', ''''), 'won''t', 'will not'), 'n''t', ' not'), '''s', ' is'),
      '.@', '. @'), '([*;,!?()\[\]])', ' \1', 'g'), '\s{2,}', ' ', 'g')) AS cleaned FROM documents""")
def clean_text(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", tx.clean_text(F.col("text"), decontract=True).alias("cleaned"))


@query("printable_ascii", r"SELECT doc_id, trim(regexp_replace(text, '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g')) AS cleaned FROM documents")
def printable_ascii(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", tx.keep_printable_ascii(F.col("text")).alias("cleaned"))


@query("repeat_cut", f"SELECT doc_id, {_cut_sql('lower(text)', 2)} AS cut FROM documents")
def repeat_cut(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", tx.cut_repeats(F.lower("text"), 2).alias("cut"))


@query("contractions", r"""
    SELECT doc_id, 'we are ' || text || ' can not will not do not she is I will' AS cleaned FROM documents""")
def contractions(spark, sf):
    noisy = F.concat(F.lit("we're "), "text", F.lit(" can't won't don't she's I'll"))
    return documents(spark, sf, "doc_id", "text").select("doc_id", tx.expand_contractions(noisy).alias("cleaned"))


@query("html_and_escapes", r"""
    SELECT doc_id, '<b>' || text || ' & é A ’ ''' || ' 😢 😁' AS cleaned FROM documents""")
def html_and_escapes(spark, sf):
    noisy = F.concat(F.lit("&lt;b&gt;"), "text", F.lit(r" &amp; &eacute; &#65; &#x2019; \xe2\x80\x99 \xF0\x9F\x98\xA2 U+1F601"))
    fixed = tx.repair_escapes(tx.unescape_html(noisy))
    return documents(spark, sf, "doc_id", "text").select("doc_id", F.regexp_replace(fixed, r" +", " ").alias("cleaned"))


@query("comment_quotes", r"""
    SELECT doc_id, ' ' || regexp_replace(text, '"[^"]*"', ' ', 'g') AS cleaned FROM documents""")
def comment_quotes(spark, sf):
    noisy = F.concat(F.lit("&gt; an older line\n"), "text")
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id", tx.drop_double_quoted(tx.drop_comment_quotes(noisy)).alias("cleaned"))


@query("special_tokens", """
    SELECT doc_id, 'HANDLE says TAG URL MAIL USER SUB NUM POS_EMOJI NEG_EMOJI CLUB bye' AS joined, lang FROM documents""")
def special_tokens(spark, sf):
    noisy = F.concat_ws(" ", F.concat(F.lit("@user"), F.col("doc_id").cast("string")), F.lit("says"),
                        F.concat(F.lit("#tag_"), "lang"), F.concat(F.lit("https://x.example/"), "lang"),
                        F.concat("lang", F.lit("@mail.com")), F.concat(F.lit("u/"), "lang"), F.concat(F.lit("/r/"), "lang"),
                        F.col("doc_id").cast("string"), F.lit("😍😭 Dynamo bye!"))
    docs = documents(spark, sf, "doc_id", "lang").withColumn("noisy", noisy)
    out = tokenizer.tokenize(docs, "noisy", twitter_handles="HANDLE", hashtags="TAG", urls="URL", emails="MAIL",
                             reddit_usernames="USER", subreddits="SUB", numbers="NUM", pos_emojis=True, neg_emojis=True,
                             extra_patterns=[("club", "[Dd]ynamo", "CLUB")])
    return out.select("doc_id", arrays.join_tokens(F.col("tokens")).alias("joined"), "lang")


@query("glued_tokens", """
    SELECT doc_id, 'b|@' || lang || '|@bob|#' || lang || '|#go|a_b' AS joined FROM documents""")
def glued_tokens(spark, sf):
    noisy = F.concat(F.lit("b@"), "lang", F.lit("@bob #"), "lang", F.lit("#go A B"))
    docs = documents(spark, sf, "doc_id", "lang").withColumn("noisy", noisy)
    out = tokenizer.tokenize(docs, "noisy", keep_untokenized=["a b"])
    return out.select("doc_id", F.array_join("tokens", "|").alias("joined"))


@query("url_domain", r"""
    SELECT page_id, CASE WHEN d = '' THEN host ELSE d END AS domain FROM (
      SELECT page_id, host, regexp_extract(host, '([^.]+)\.(?:(?:ac|co|com|edu|gob|gov|ltd|me|mil|net|nom|or|org|plc|sch)\.[a-z]{2}|[^.]+)$', 1) AS d
      FROM (SELECT page_id, lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]+)', 1)) AS host FROM pages))""")
def url_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.url_domain(F.col("url")).alias("domain"))


@query("url_lookup", r"""
    SELECT page_id, 'see|' || regexp_extract(html, '<title>([^<]*)</title>', 1) AS joined FROM pages""")
def url_lookup(spark, sf):
    """Every page address, replaced by the title of the page from a lookup table."""
    pages = spread(table(spark, sf, "pages"))
    link = F.concat(F.lit("http://p.example/"), F.col("page_id").cast("string"))
    titles = pages.select(link.alias("url"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("value"))
    posts = pages.select("page_id", F.concat(F.lit("see "), link).alias("text"))
    out = tokenizer.tokenize(posts, "text", id_col="page_id", urls="map", url_map=titles, whitespaces_to_underscores=False)
    return out.select("page_id", F.array_join("tokens", "|").alias("joined"))


@query("segment_terms")
def segment_terms(spark, sf):
    """Neighbouring words glued to hashtags and cut again with the word ranks of the corpus."""
    docs = words(spark, sf)
    glued = docs.withColumn("glued", F.array_join(F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size("tokens"), F.lit(1))), lambda i: (i % 2 == 1) & (i <= F.size("tokens"))),
        lambda i: F.concat(F.lit("#"), F.element_at("tokens", i), F.coalesce(F.get("tokens", i), F.lit("")))), " "))
    ranks = vocab.corpus_words(docs)
    return tokenizer.split_term_counts(glued, "glued", ranks, hashtags="split", normalize=False)


@query("stem_vocab")
def stem_vocab(spark, sf):
    return vocab.stem_table(words(spark, sf))


@query("simple_tokens", r"""
    SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+')) AS n,
           array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+'), ' ') AS joined FROM documents""")
def simple_tokens(spark, sf):
    out = tokenizer.simple_tokens(documents(spark, sf, "doc_id", "text"), "text")
    return out.select("doc_id", F.size("tokens").cast("long").alias("n"), arrays.join_tokens(F.col("tokens")).alias("joined"))


@query("normalized_tokens", rf"""
    SELECT doc_id, array_to_string([t FOR t IN regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]+')
      IF NOT regexp_matches(t, '^\p{{P}}+$') AND NOT regexp_matches(t, '^\p{{N}}+$') AND lower(t) NOT IN ({STOPS_SQL})], ' ') AS joined
    FROM documents""")
def normalized_tokens(spark, sf):
    out = tokenizer.simple_tokens(documents(spark, sf, "doc_id", "text"), "text")
    out = normalize.normalize(out, language=None, stop_words=STOPS)
    return out.select("doc_id", arrays.join_tokens(F.col("tokens")).alias("joined"))


_CONTEXT_RULES = [("the", r"(?:^|[^\p{L}\p{N}_])(the [\p{L}\p{N}_]+)"), ("de", r"(?:^|[^\p{L}\p{N}_])(de [\p{L}\p{N}_]+)"),
                  ("und", r"(?:^|[^\p{L}\p{N}_])(und [\p{L}\p{N}_]+)")]
_CONTEXT_SQL = "SELECT doc_id, CASE " + " ".join(
    f"WHEN regexp_matches(lower(text), '{p}') THEN '{n}'" for n, p in _CONTEXT_RULES) + " END AS rule, CASE " + " ".join(
    f"WHEN regexp_matches(lower(text), '{p}') THEN regexp_extract(lower(text), '{p}', 1)" for n, p in _CONTEXT_RULES) + (
    " END AS context FROM documents")


@query("keyword_context", f"SELECT * FROM ({_CONTEXT_SQL}) WHERE rule IS NOT NULL")
def keyword_context(spark, sf):
    rule, context = filters.keyword_context(F.col("text"), _CONTEXT_RULES)
    return documents(spark, sf, "doc_id", "text").select("doc_id", rule.alias("rule"), context.alias("context")).filter(
        "rule is not null")


@query("rule_counts", f"SELECT rule, count(*) AS n FROM ({_CONTEXT_SQL}) WHERE rule IS NOT NULL GROUP BY rule")
def rule_counts(spark, sf):
    rule, _ = filters.keyword_context(F.col("text"), _CONTEXT_RULES)
    return counts.rule_counts(documents(spark, sf, "text"), rule)


@query("topic_filter", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)licensed under|api[_-]?key|copyright|token =')")
def topic_filter(spark, sf):
    return documents(spark, sf, "doc_id", "text").filter(
        filters.matches_topic(F.col("text"), "(?:licensed under|api[_-]?key|copyright|token =)")).select("doc_id")


@query("vocabulary_size", f"""
    SELECT count(DISTINCT w) AS vocabulary, count(*) AS words FROM (SELECT unnest({WORDS_SQL}) AS w FROM documents)""")
def vocabulary_size(spark, sf):
    return counts.vocabulary_size(words(spark, sf))


@query("term_dictionary", f"""
    SELECT term, df, row_number() OVER (ORDER BY md5('ids|' || term), term) AS term_id FROM (
      SELECT w AS term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({WORDS_SQL}) AS w FROM documents)
      GROUP BY w HAVING count(*) >= 2)""")
def term_dictionary(spark, sf):
    return vocab.term_dictionary(words(spark, sf), min_df=2)


@query("padded_ids", f"""
    WITH d AS (SELECT w AS term, row_number() OVER (ORDER BY md5('ids|' || w), w) AS id
               FROM (SELECT DISTINCT w FROM (SELECT unnest({WORDS_SQL}) AS w FROM documents))),
    x AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS term, len(ws) AS n FROM (
            SELECT doc_id, {WORDS_SQL} AS ws FROM documents)),
    k AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids, count(*) AS n
          FROM x JOIN d USING (term) WHERE pos > n - 8 GROUP BY doc_id)
    SELECT documents.doc_id, repeat('0 ', CAST(8 - coalesce(n, 0) AS INTEGER)) || coalesce(ids, '') AS ids FROM documents LEFT JOIN k ON k.doc_id = documents.doc_id""")
def padded_ids(spark, sf):
    docs = words(spark, sf)
    ids = vocab.token_ids(docs, "doc_id", vocab.term_dictionary(docs))
    padded = arrays.pad_left(F.transform("ids", lambda i: i.cast("int")), 8)
    return ids.select("doc_id", F.array_join(F.transform(padded, lambda i: i.cast("string")), " ").alias("ids"))


@query("ngrams", f"""
    WITH t AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
    x AS (SELECT doc_id, unnest(ws) AS a, unnest(list_concat(ws[2:], [NULL])) AS b,
                 unnest(list_concat(ws[3:], [NULL, NULL])) AS c FROM t WHERE len(ws) > 0)
    SELECT gram, count(*) AS n FROM (
      SELECT a AS gram FROM x UNION ALL SELECT a || '_' || b FROM x WHERE b IS NOT NULL
      UNION ALL SELECT a || '_' || b || '_' || c FROM x WHERE c IS NOT NULL) WHERE gram IS NOT NULL GROUP BY gram""")
def ngrams(spark, sf):
    grams = arrays.exploded(dealt_words(spark, sf), arrays.with_ngrams(F.col("tokens"), 3, "_"), "gram")
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query("bow", f"""
    SELECT doc_id, w AS term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents) GROUP BY 1, 2""")
def bow(spark, sf):
    return features.bag_of_words(words(spark, sf), "doc_id")


@query("bow_min_df", f"""
    WITH t AS (SELECT doc_id, w AS term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents) GROUP BY 1, 2)
    SELECT * FROM t WHERE term IN (SELECT term FROM t GROUP BY term HAVING count(*) >= 5)""")
def bow_min_df(spark, sf):
    return features.bag_of_words(words(spark, sf), "doc_id", min_df=5)


@query("one_hot", f"""
    SELECT DISTINCT doc_id, w AS term, 1 AS tf FROM (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents)""")
def one_hot(spark, sf):
    return features.one_hot(words(spark, sf), "doc_id")


@query("full_vectors", f"""
    WITH t AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents) GROUP BY 1, 2),
    k AS (SELECT w FROM t GROUP BY w HAVING count(*) >= 0.2 * (SELECT count(*) FROM documents))
    SELECT d.doc_id, CAST(coalesce(sum(tf), 0) AS DOUBLE) AS total, (SELECT count(*) FROM k) AS width
    FROM documents d LEFT JOIN (SELECT * FROM t WHERE w IN (SELECT w FROM k)) s ON s.doc_id = d.doc_id GROUP BY d.doc_id""")
def full_vectors(spark, sf):
    _, vectors = features.count_vectors(words(spark, sf), min_df=0.2)
    dense = features.dense_array(vectors)
    total = F.aggregate("dense", F.lit(0.0), lambda a, x: a + x)
    return dense.select("doc_id", total.alias("total"), F.size("dense").cast("long").alias("width"))


_TF_SQL = f"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
    c AS (SELECT count(*) AS n FROM documents),
    t AS (SELECT doc_id, w AS term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY 1, 2),
    f AS (SELECT term, count(*) AS df FROM t GROUP BY term)"""


@query("tfidf_log2", _TF_SQL + """,
    w AS (SELECT doc_id, term, tf * log2(n::DOUBLE / df) AS w FROM t JOIN f USING (term), c),
    l AS (SELECT doc_id, term, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0) AS weight FROM w)
    SELECT doc_id, term, round(weight, 6) AS weight FROM l WHERE abs(weight) > 1e-12""")
def tfidf_log2(spark, sf):
    out = features.tfidf(words(spark, sf), "doc_id", weighting="log2")
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_smooth", _TF_SQL + """,
    w AS (SELECT doc_id, term, tf * (ln((1.0 + n) / (1 + df)) + 1) AS w FROM t JOIN f USING (term), c)
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf_smooth(spark, sf):
    out = features.tfidf(words(spark, sf), "doc_id", weighting="smooth")
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_relative", _TF_SQL + """
    SELECT doc_id, term, round(tf * ln(n::DOUBLE / df) / sum(tf) OVER (PARTITION BY doc_id), 6) AS weight
    FROM t JOIN f USING (term), c""")
def tfidf_relative(spark, sf):
    out = features.tfidf(words(spark, sf), "doc_id", weighting="relative")
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


_PAIRS_SQL = f"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
    u AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM d) GROUP BY w),
    tot AS (SELECT sum(n)::DOUBLE AS t FROM u),
    p AS (SELECT a, b, count(*) AS n FROM (SELECT unnest(ws[:-2]) AS a, unnest(ws[2:]) AS b FROM d WHERE len(ws) > 1)
          GROUP BY a, b HAVING count(*) >= 5),
    s AS (SELECT p.a, p.b, p.n, ln((p.n / t) / ((ua.n / t) * (ub.n / t))) / nullif(-ln(p.n / t), 0) AS npmi
          FROM p JOIN u ua ON ua.w = p.a JOIN u ub ON ub.w = p.b, tot)"""


@query("npmi_pairs", _PAIRS_SQL + " SELECT a, b, n, round(npmi, 6) AS npmi FROM s")
def npmi_pairs(spark, sf):
    return phrases.pair_scores(dealt_words(spark, sf)).withColumn("npmi", F.round("npmi", 6))


@query("phrase_list", _PAIRS_SQL + " SELECT a, b FROM s WHERE npmi > 0.3")
def phrase_list(spark, sf):
    return phrases.learn_phrases(dealt_words(spark, sf)).select("a", "b")


@query("phrase_merge", _PAIRS_SQL + """,
    x AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS a, unnest(list_concat(ws[2:], [NULL])) AS b FROM d WHERE len(ws) > 0),
    hit AS (SELECT x.*, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island
            FROM x JOIN (SELECT a, b FROM s WHERE npmi > 0.3) k USING (a, b)),
    chosen AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS k FROM hit) WHERE k % 2 = 1),
    kept AS (SELECT x.doc_id, x.pos, CASE WHEN c.pos IS NULL THEN a ELSE a || '_' || b END AS t
             FROM x LEFT JOIN chosen c ON c.doc_id = x.doc_id AND c.pos = x.pos
             LEFT JOIN chosen p ON p.doc_id = x.doc_id AND p.pos = x.pos - 1 WHERE p.pos IS NULL)
    SELECT d.doc_id, CAST(count(t) AS INTEGER) AS n, coalesce(string_agg(t, ' ' ORDER BY pos), '') AS joined
    FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id""")
def phrase_merge(spark, sf):
    docs = dealt_words(spark, sf)
    merged = phrases.merge_phrases(docs, "doc_id", phrases.learn_phrases(docs))
    return merged.select("doc_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("joined"))


GRAM_SQL = r"""
    WITH c AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS x FROM documents),
    g AS (SELECT doc_id, lang, substr(x, i, 3) AS gram FROM (
            SELECT doc_id, lang, x, unnest(range(1, length(x) - 1)) AS i FROM c WHERE length(x) >= 3)),
    p AS (SELECT lang AS language, gram, count(*) AS c FROM g GROUP BY 1, 2),
    pen AS (SELECT language, ln(sum(c) + (SELECT count(DISTINCT gram) FROM p)) AS penalty FROM p GROUP BY language),
    tf AS (SELECT doc_id, gram, count(*) AS tf FROM g GROUP BY 1, 2),
    s AS (SELECT doc_id, language, sum(tf * ln(c + 1)) AS s FROM tf JOIN p USING (gram) GROUP BY 1, 2),
    k AS (SELECT doc_id, sum(tf) AS known FROM tf GROUP BY doc_id),
    sc AS (SELECT k.doc_id, pen.language, coalesce(s.s, 0) - known * penalty AS score
           FROM k CROSS JOIN pen LEFT JOIN s ON s.doc_id = k.doc_id AND s.language = pen.language)"""


@query("language_scores", GRAM_SQL + " SELECT doc_id, language, round(score, 4) AS score FROM sc")
def language_scores(spark, sf):
    docs = documents(spark, sf, "doc_id", "lang", "text")
    scores = language.language_scores(docs, "doc_id", "text", language.fit_profiles(docs, "text", "lang"))
    return scores.withColumn("score", F.round("score", 4))


@query("language_guess", GRAM_SQL + """
    SELECT d.doc_id, coalesce(b.language, '00') AS language FROM documents d LEFT JOIN (
      SELECT doc_id, language FROM (SELECT *, row_number() OVER (
        PARTITION BY doc_id ORDER BY round(score, 9) DESC, language DESC) AS rn FROM sc) WHERE rn = 1) b ON b.doc_id = d.doc_id""")
def language_guess(spark, sf):
    docs = documents(spark, sf, "doc_id", "lang", "text")
    guessed = language.guess_language(docs, "doc_id", "text", language.fit_profiles(docs, "text", "lang"))
    return guessed.select("doc_id", "language")
