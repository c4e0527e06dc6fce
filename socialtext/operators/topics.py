"""Topic models whose term table stays on the executors: topics, shares, chained time slices, sweeps.

The model is a table ``term, weights`` (expected counts of the term per topic); documents lie in blocks (see ``blocks``). In a pass
every block gets the weights of the terms that it holds, estimates the topic shares of its documents and sends one row per term
back; the sums of these rows are the next table. Only numbers per topic reach the driver, so
the vocabulary has no bound. Estimates are expectation-maximization with pseudo-counts ``alpha`` (topics in a document) and ``eta``
(terms in a topic).
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from socialtext.functions.arrays import argmax, counted, exploded
from socialtext.operators import blocks
from socialtext.operators.coherence import coherence
from socialtext.session import discarded, stored

#: Entries (document, term) of a block, and of the part of a block that is worked on at once.
BLOCK_ENTRIES, CHUNK_ENTRIES = 1 << 19, 1 << 15
_RESERVED = ("_terms", "_values", "_block")


@dataclass(frozen=True)
class TopicModel:
    """``terms`` is the table; the rest are numbers per topic or settings. ``log_perplexities`` has one value per pass."""

    terms: DataFrame
    alpha: tuple[float, ...]
    eta: float
    n_terms: int
    totals: tuple[float, ...]
    inner: int
    binary: bool
    log_perplexities: tuple[float, ...] = ()

    @property
    def k(self) -> int:
        return len(self.alpha)


def _digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 6, then the asymptotic series."""
    x, out = np.array(x, float), np.zeros(np.shape(x))
    for _ in range(6):
        small = x < 6
        out -= np.where(small, 1 / x, 0.0)
        x = np.where(small, x + 1, x)
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def _shares(p: np.ndarray, n: np.ndarray, starts: np.ndarray, doc: np.ndarray, alpha: np.ndarray, inner: int):
    """Topic shares of each document by ``inner`` steps from equal shares; the last step also gives the split of each entry."""
    size = np.add.reduceat(n, starts)[:, None]
    theta = np.full((len(starts), len(alpha)), 1 / len(alpha))
    for _ in range(inner):
        split = p * theta[doc]
        likely = split.sum(axis=1)
        split *= (n / likely)[:, None]
        held = np.add.reduceat(split, starts)
        theta = (held + alpha) / (size + alpha.sum())
    return theta, split, likely, held


def _phi(weights: np.ndarray, model: dict) -> np.ndarray:
    """Probability of each term of the block under each topic."""
    return (weights + model["eta"]) / (np.array(model["totals"]) + model["n_terms"] * model["eta"])


def _estimate(model: dict):
    """Of one block: sums per term, and a list of the log-likelihood and the sums that belong to no term."""
    alpha, k = np.array(model["alpha"]), len(model["alpha"])

    def run(rows: pa.Table, weights: np.ndarray, entries) -> tuple[np.ndarray, np.ndarray]:
        phi = _phi(weights, model)
        place, n, doc = entries
        sums, stats = np.zeros((len(phi), k)), np.zeros(2 * k + 3)
        for at, _, local, starts in blocks.chunks(doc):
            _, split, likely, held = _shares(phi[place[at]], n[at], starts, local, alpha, model["inner"])
            for j in range(k):
                sums[:, j] += np.bincount(place[at], weights=split[:, j], minlength=len(phi))
            stats[0] += float(n[at] @ np.log(likely))
            stats[1] += n[at].sum()
            stats[2] += (_digamma(held.sum(axis=1) + alpha.sum()) - _digamma(alpha.sum())).sum()
            stats[3: 3 + k] += (_digamma(held + alpha) - _digamma(alpha)).sum(axis=0)
        stats[3 + k:] = sums.sum(axis=0)
        return sums, stats

    return run


def _settings(model: TopicModel) -> dict:
    return {c: getattr(model, c) for c in ("alpha", "eta", "n_terms", "totals", "inner")}


def _documents(df: DataFrame, tokens_col: str, binary: bool, keep: list[str], seed: int) -> DataFrame:
    """``_terms`` (distinct, per document), ``_values`` unless binary, a stored random number, and the columns to keep."""
    found = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    at = F.rand(seed).alias("_u")
    if binary:
        return df.select(*keep, F.array_distinct(F.array_compact(found)).alias("_terms"), at)
    pairs = df.select(*keep, F.coalesce(counted(F.array_compact(found)), F.array().cast("array<struct<term:string,tf:bigint>>")).alias("_c"), at)
    return pairs.select(*keep, F.col("_c.term").alias("_terms"), F.col("_c.tf").alias("_values"), "_u")


def _blocked(docs: DataFrame) -> DataFrame:
    return docs.select(*[c for c in docs.columns if c in (blocks.TERMS, blocks.VALUES, blocks.BLOCK)])


def _start(df_terms: DataFrame, k: int, seed: int) -> DataFrame:
    """Document frequency times exponential noise from a hash of topic, seed and term: the same start in every run."""
    def noise(topic: int) -> Column:
        h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{topic}|{seed}|"), F.col("term"))), 1, 8), 16, 10).cast("double")
        return -F.ln((h + 0.5) / F.lit(4294967296.0)) * F.col("df")

    return df_terms.select("term", F.array(*[noise(j) for j in range(k)]).alias("weights"))


def _totals(parts: DataFrame, k: int) -> tuple[float, ...]:
    """Sums per topic: ``k`` numbers. A row may hold the weights of one term or of many."""
    def run(batches):
        total = np.zeros(k)
        for batch in batches:
            total += np.asarray(batch.column(0).flatten(), float).reshape(-1, k).sum(axis=0)
        yield pa.RecordBatch.from_arrays([blocks.lists_of(total[None, :])], names=["weights"])

    row = parts.select("weights").mapInArrow(run, "weights array<double>").agg(
        *[F.coalesce(F.sum(F.get("weights", F.lit(i))), F.lit(0.0)) for i in range(k)]).first()
    return tuple(float(x) for x in row)


def _learned(alpha: tuple[float, ...], stats: list[float], k: int) -> tuple[float, ...]:
    """One fixed-point step of the Dirichlet pseudo-counts."""
    return tuple(max(a * s / stats[2], 1e-6) if stats[2] > 0 else a for a, s in zip(alpha, stats[3: 3 + k]))


def fit_topics(df: DataFrame, tokens_col: str = "tokens", *, k: int = 100, passes: int = 1, subsample: float = 1.0,
               learn_alpha: bool = True, binary: bool = True, min_df: float = 1.0, alpha: float | None = None,
               eta: float | None = None, inner: int = 5, seed: int = 24, start: TopicModel | None = None,
               decay: float = 0.0) -> TopicModel:
    """A model of ``k`` topics. Every pass reads every document.

    With ``subsample`` below 1 a pass is ``1 / subsample`` steps, each over its own share of the blocks, whose sums are mixed into
    the table with weight ``(1 + step) ** -0.5``. ``min_df`` is a number of documents, or a share of them below 1. ``alpha`` and
    ``eta`` are 1 / k if not given. With ``start``, its word weights, times ``decay``, stay in the table as a prior and its topics
    are the first estimate. Documents without tokens count as nothing; an empty table gives a model without terms.
    """
    if k < 1 or passes < 1 or inner < 1 or not 0 < subsample <= 1 or not 0 <= decay <= 1:
        raise ValueError("k, passes and inner are at least 1, subsample lies in (0, 1], decay in [0, 1]")
    docs = stored(_documents(df, tokens_col, binary, [], seed), "topics-documents")
    counts = stored(exploded(docs, "_terms", "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")), "topics-terms")
    size = counts.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    least = min_df if min_df >= 1 else min_df * docs.count()
    known = counts.where(F.col("df") >= least)
    if start is not None:
        if start.k != k:
            raise ValueError("the earlier model must have as many topics")
        prior = start.terms.select("term", F.transform("weights", lambda w: w * decay).alias("_prior"))
        fresh = _start(known, k, seed).join(start.terms.select("term", F.col("weights").alias("_old")), "term", "full")
        terms = stored(fresh.select("term", F.coalesce("_old", "weights").alias("weights")), "topics-start")
        if decay == 0:
            terms = terms.join(known.select("term"), "term", "left_semi")
    else:
        prior, terms = None, _start(known, k, seed)
    terms = stored(terms, "topics-start")
    discarded(counts)
    model = TopicModel(terms, (alpha or 1 / k,) * k, eta or 1 / k, terms.count(), _totals(terms, k), inner, binary)
    packed = blocks.pack(_blocked(blocks.dealt(docs, size)), terms, k, thin=True).kept()
    discarded(docs)
    if prior is not None and decay > 0:
        prior = _part_prior(packed, prior, k)
    batches = max(1, round(1 / subsample))
    for step in range(passes * batches):
        rate = 1.0 if batches == 1 else (1 + step) ** -0.5
        now = packed if batches == 1 else packed.where(lambda block: F.pmod(F.col(block), F.lit(batches)) == step % batches)
        weights, stats = blocks.passed(now, _estimate(_settings(model)), k, _mixed(rate, batches, k), "topics-sums", prior if decay > 0 else None)
        if stats is None:  # nothing to learn from in this share
            continue
        packed = packed.moved_on(weights)
        exact = rate == 1.0 and batches == 1 and (prior is None or decay == 0)
        totals = tuple(float(x) for x in stats[3 + k: 3 + 2 * k]) if exact else _totals(weights, k)
        model = replace(model, totals=totals, alpha=_learned(model.alpha, list(stats), k) if learn_alpha else model.alpha,
                        log_perplexities=(*model.log_perplexities, float(-stats[0] / stats[1])))
    return replace(model, terms=packed.without_rows().terms())


def _part_prior(packed: blocks.Packed, prior: DataFrame, k: int) -> DataFrame:
    """The weights of the prior in the order of the parts; zeros for terms that it lacks."""
    places = packed.names.select("_part", F.posexplode("_names").alias("_at", "term"))
    weight = F.coalesce("_prior", F.array_repeat(F.lit(0.0), k))
    lists = places.join(prior, "term", "left").groupBy("_part").agg(F.sort_array(F.collect_list(F.struct("_at", weight.alias("w")))).alias("_p"))
    return stored(lists.select("_part", F.flatten("_p.w").alias("weights")), "topics-prior")


def _mixed(rate: float, batches: int, k: int):
    """The weights after a step: ``(1 - rate) · old + rate · (batches · sums + prior)``."""
    def new(weights: np.ndarray, sums: np.ndarray, held: np.ndarray, prior: np.ndarray | float = 0.0) -> np.ndarray:
        return weights * (1 - rate) + (sums * batches + prior) * rate

    return new


def probabilities(model: TopicModel) -> DataFrame:
    """``topic, word, weight``: the probability of every word in every topic."""
    totals = F.array(*[F.lit(t + model.n_terms * model.eta) for t in model.totals])
    rows = model.terms.select(F.col("term").alias("word"), F.posexplode("weights").alias("topic", "_w"))
    return rows.select("topic", "word", ((F.col("_w") + model.eta) / F.get(totals, F.col("topic"))).alias("weight"))


def top_words(model: TopicModel, n: int = 20) -> DataFrame:
    """``topic, rank, word, weight``: ranks are cut in every task before the ``n`` best per topic meet."""
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
    return (probabilities(model).withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < n)
            .select("topic", "rank", "word", "weight"))


def _share_rows(model: dict, schema: T.StructType):
    alpha = np.array(model["alpha"])

    def run(rows: pa.Table, weights: np.ndarray, entries) -> pa.Table:
        theta = np.tile(alpha / alpha.sum(), (rows.num_rows, 1))
        phi = _phi(weights, model)
        place, n, doc = entries
        for at, here, local, starts in blocks.chunks(doc):
            theta[here] = _shares(phi[place[at]], n[at], starts, local, alpha, model["inner"])[0]
        return pa.table([*[rows.column(c) for c in schema.names[:-1]], blocks.lists_of(theta)], names=schema.names)

    return run


def topic_shares(model: TopicModel, df: DataFrame, id_col: str, *extra: str, tokens_col: str = "tokens") -> DataFrame:
    """``id, shares, topic``: share of every topic and the strongest one. Without a known term: the shares of ``alpha``."""
    keep = list(dict.fromkeys((id_col, *extra)))
    docs = stored(_documents(df, tokens_col, model.binary, keep, 0), "topics-new")
    packed = blocks.pack(blocks.dealt(docs, blocks.entry_count(docs)), model.terms, model.k, thin=True)
    discarded(docs)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("shares", T.ArrayType(T.DoubleType()))])
    out = blocks.per_block(packed, _share_rows(_settings(model), schema), schema)
    return out.select(*keep, "shares", argmax(F.col("shares")).alias("topic"))


def log_perplexity(model: TopicModel, df: DataFrame, tokens_col: str = "tokens") -> float:
    """Minus the mean log-likelihood of the known tokens, from shares estimated on the same tokens."""
    docs = stored(_documents(df, tokens_col, model.binary, [], 0), "topics-new")
    packed = blocks.pack(_blocked(blocks.dealt(docs, blocks.entry_count(docs))), model.terms, model.k, thin=True)
    discarded(docs)
    _, stats = blocks.passed(packed, _estimate(_settings(model)), model.k, lambda weights, *_: weights, "topics-sums")
    packed.without_rows()
    return math.nan if stats is None else float(-stats[0] / stats[1])


# ---- time slices ---------------------------------------------------------------------------

def slice_topics(model: TopicModel, df: DataFrame, slice_col: str, tokens_col: str = "tokens") -> DataFrame:
    """``slice, topic, share``: mean topic share per time slice under one model of all slices."""
    shares = topic_shares(model, df, slice_col, tokens_col=tokens_col)
    means = shares.groupBy(slice_col).agg(F.array(*[F.avg(F.col("shares")[i]) for i in range(model.k)]).alias("_m"))
    return means.select(slice_col, F.posexplode("_m").alias("topic", "share"))


def _word_sums(model: dict, slice_col: str, schema: T.StructType):
    """Of one block: the topic shares of its documents summed over the tokens, a row per slice and word."""
    shares = _share_rows(model, T.StructType([T.StructField("shares", T.ArrayType(T.DoubleType()))]))
    k = len(model["alpha"])

    def run(rows: pa.Table, weights: np.ndarray, entries, terms: pa.Array) -> pa.Table:
        theta = np.asarray(shares(rows, weights, entries).column("shares").combine_chunks().flatten(), float).reshape(-1, k)
        lists, slices = (rows.column(c).combine_chunks() for c in (blocks.TERMS, slice_col))
        word, n = (np.asarray(x.flatten()) for x in (lists, rows.column("_times").combine_chunks()))
        slices = slices.dictionary_encode()
        row = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
        of = np.asarray(pc.fill_null(slices.indices, len(slices.dictionary)), np.int64)  # the last number is null
        width = max(1, len(terms))
        held, at = np.unique(of[row] * width + word, return_inverse=True)
        sums = np.stack([np.bincount(at, weights=theta[row, j] * n, minlength=len(held)) for j in range(k)], axis=1)
        slice_of = held // width
        keys = [slices.dictionary.take(pa.array(slice_of, mask=slice_of == len(slices.dictionary))), terms.take(pa.array(held % width))]
        return pa.table([*keys, blocks.lists_of(sums)], names=schema.names)

    return run


def slice_topic_words(model: TopicModel, df: DataFrame, slice_col: str, tokens_col: str = "tokens") -> DataFrame:
    """``slice, topic, word, weight``: topic words estimated anew in every slice from ``Σ p(topic | doc) · tf``.

    A block sends one row per slice and word that it holds, not one per token. Their sums are stored: shares are estimated once,
    however often the result is read.
    """
    k = model.k
    pairs = F.coalesce(counted(F.array_compact(F.coalesce(F.col(tokens_col), F.array().cast("array<string>")))), F.array().cast("array<struct<term:string,tf:bigint>>"))
    docs = df.select(slice_col, pairs.alias("_c"), F.rand(0).alias("_u")).select(slice_col, F.col("_c.term").alias(blocks.TERMS), F.col("_c.tf").alias("_times"), "_u")
    docs = stored(docs if model.binary else docs.withColumn(blocks.VALUES, F.col("_times")), "topics-new")
    packed = blocks.pack(blocks.dealt(docs, blocks.entry_count(docs)), model.terms, k)
    discarded(docs)
    schema = T.StructType([df.schema[slice_col], T.StructField("word", T.StringType()), T.StructField("_sums", T.ArrayType(T.DoubleType()))])

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.array(*[F.sum(F.get("_sums", F.lit(i))) for i in range(k)]).alias("_sums"))

    found = blocks.per_block(packed, _word_sums(_settings(model), slice_col, schema), schema, with_terms=True, fold=lambda rows: summed(rows, slice_col, "word"))
    sums = stored(summed(found, slice_col, "word"), "topics-slice-words")
    packed.without_rows()
    totals = stored(summed(sums, slice_col), "topics-slice-totals").withColumnRenamed("_sums", "_totals")
    return (sums.join(F.broadcast(totals), slice_col)  # a row per slice
            .select(slice_col, "word", "_totals", F.posexplode("_sums").alias("topic", "_mass"))
            .select(slice_col, "topic", "word", (F.col("_mass") / F.get("_totals", F.col("topic"))).alias("weight")))


def chained_slices(df: DataFrame, slice_col: str, tokens_col: str = "tokens", *, decay: float = 0.5, **fit) -> dict:
    """A model per slice, in the order of the slices.

    The word weights of a slice, times ``decay``, are the prior of the next one, so a topic keeps its number and its words move as
    far as the new documents carry them. With ``decay`` 0 only the first estimate is handed on. The slices (days, months) are
    counted ones; one job after the other fits them, each over all its documents.
    """
    models, last = {}, None
    for value in [r[0] for r in df.select(slice_col).where(F.col(slice_col).isNotNull()).distinct().orderBy(slice_col).collect()]:
        last = fit_topics(df.where(F.col(slice_col) == value), tokens_col, start=last, decay=decay if last else 0.0, **fit)
        models[value] = last
    return models


def chained_words(models: dict, slice_col: str = "slice") -> DataFrame:
    """``slice, topic, word, weight`` of chained models; the slice is its number in order."""
    parts = [probabilities(m).select(F.lit(i).alias(slice_col), "topic", "word", "weight") for i, m in enumerate(models.values())]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def slice_drift(slice_words: DataFrame, slice_col: str) -> DataFrame:
    """``slice, topic, similarity``: cosine of a topic's word weights with those one slice earlier.

    A topic has a word once in a slice. The slices of a word meet in one shuffle; squares are summed apart, a number per slice and topic.
    """
    rows = slice_words.select(F.col(slice_col).alias("slice"), "topic", "word", F.col("weight").alias("w"))
    slices = Window.partitionBy("topic", "word").orderBy("slice")
    earlier = F.when(F.lag("slice").over(slices) + 1 == F.col("slice"), F.lag("w").over(slices))
    sums = (rows.withColumn("_w0", F.when(F.col("word").isNotNull(), earlier)).groupBy("slice", "topic")
            .agg(F.sum(F.col("w") * F.col("_w0")).alias("dot"), F.sum(F.col("w") * F.col("w")).alias("a")))
    sums = stored(sums.where("a is not null"), "topics-drift")
    before = sums.select((F.col("slice") + 1).alias("_slice"), F.col("topic").alias("_topic"), F.col("a").alias("b"))
    return (sums.join(F.broadcast(before), F.col("slice").eqNullSafe(F.col("_slice")) & F.col("topic").eqNullSafe(F.col("_topic")))
            .select("slice", "topic", (F.coalesce("dot", F.lit(0.0)) / F.sqrt(F.col("a") * F.col("b"))).alias("similarity")))


# ---- choice of settings --------------------------------------------------------------------

def sweep(df: DataFrame, ks: list[int], tokens_col: str = "tokens", id_col: str = "doc_id",
          measures: tuple[str, ...] = ("u_mass", "c_v", "c_uci", "c_npmi"), n_words: int = 10, **fit) -> DataFrame:
    """``k, metric, value`` for every number of topics. The token lists are kept between the fits."""
    kept = df.select(id_col, tokens_col).persist()
    spark = df.sparkSession
    rows = []
    try:
        for k in ks:
            model = fit_topics(kept, tokens_col, k=k, **fit)
            rows.append((k, "log_perplexity", log_perplexity(model, kept, tokens_col)))
            words = top_words(model, n_words)
            for name in measures:
                value = coherence(kept, words, name, tokens_col).agg(F.avg("value")).first()[0]
                rows.append((k, name, None if value is None else float(value)))
    finally:
        kept.unpersist()
    return spark.createDataFrame(rows, "k int, metric string, value double")


def grid_search(df: DataFrame, grid: dict[str, list], fold_col: str, tokens_col: str = "tokens") -> DataFrame:
    """``params, fold, value``: held-out log likelihood per word over the folds of ``fold_col``."""
    from itertools import product
    names = sorted(grid)
    folds = [r[0] for r in df.select(fold_col).distinct().orderBy(fold_col).collect()]
    kept = df.persist()
    rows = []
    try:
        for values in product(*(grid[n] for n in names)):
            params = dict(zip(names, values))
            for fold in folds:
                model = fit_topics(kept.filter(F.col(fold_col) != fold), tokens_col, **params)
                rows.append((str(params), int(fold), -log_perplexity(model, kept.filter(F.col(fold_col) == fold), tokens_col)))
    finally:
        kept.unpersist()
    return df.sparkSession.createDataFrame(rows, "params string, fold int, value double")


def save(model: TopicModel, path: str) -> None:
    """The table as Parquet and the numbers as one JSON row beside it."""
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    numbers = {c: v for c, v in vars(model).items() if c != "terms"}
    model.terms.sparkSession.createDataFrame([(json.dumps(numbers),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/numbers")


def load(spark: SparkSession, path: str) -> TopicModel:
    numbers = json.loads(spark.read.text(f"{path}/numbers").first()[0])
    lists = {c: tuple(v) if isinstance(v, list) else v for c, v in numbers.items()}
    return TopicModel(spark.read.parquet(f"{path}/terms"), **lists)
