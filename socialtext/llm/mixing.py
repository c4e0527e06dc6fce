"""Soft-membership mixing to target weights. DataFrame and ``pyspark.ml`` functions only.

A classifier learned from the label table gives every document a posterior over the domains. Non-negative rates are fitted
by projected-gradient least squares, so that the expected tokens per domain (rate x tokens x posterior, summed over all
documents) meet the targets. A rate becomes whole copies: its integer part, and one more if a hash of the id falls below
the rest.

Null and empty texts have no tokens, the prior as posterior and rate 1. Labels with neither column set are not used;
several labels of a document count one each. Without any usable label all domains are equally likely. Repeated rows get the
same rate. Only ``doc_id`` and ``text`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.tables import stored

DOMAINS = ("high", "low", "toxic")
#: Target shares of the tokens. The total is chosen so that no clean domain has to shrink: clean text is repeated, toxic text is cut.
WEIGHTS = {"high": 0.70, "low": 0.29, "toxic": 0.01}
CLEAN = ("high", "low")
#: The classifier is fitted on at most so many labelled rows, the first in the order of a hash of their id.
TRAIN_ROWS = 4000
#: A text counts as at most so many independent words, which keeps the memberships of long texts soft.
EVIDENCE = 64.0


def _with_tokens(rows: DataFrame) -> DataFrame:
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    return rows.withColumn("tokens", words).withColumn("n_tokens", F.size("tokens").cast("long"))


def fit_memberships(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, features: int = 1 << 15) -> Callable[[DataFrame], DataFrame]:
    """Learns the domains; the result adds ``n_tokens, posterior`` (in the order of ``DOMAINS``) to rows with ``doc_id, text``."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    train = (labels.select(F.col("doc_id").alias("_id"), domain.alias("domain")).where("domain is not null and _id is not null")
             .orderBy(F.xxhash64("_id"), "domain").limit(train_rows))
    tf = HashingTF(inputCol="tokens", outputCol="features", numFeatures=features)
    known = docs.select("doc_id", "text").join(F.broadcast(train), F.col("doc_id") == F.col("_id")).select("text", "domain")
    sample = stored(tf.transform(_with_tokens(known)).select("features", "domain"), "mix-sample")
    seen = sorted(r["domain"] for r in sample.select("domain").distinct().collect())
    if len(seen) < 2:
        even = F.array(*[F.lit(float(d in seen) if seen else 1 / len(DOMAINS)) for d in range(len(DOMAINS))])
        return lambda rows: _with_tokens(rows).drop("tokens").withColumn("posterior", even)
    place = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(seen) for x in (d, float(i))]), F.col("domain"))
    model = NaiveBayes(smoothing=1.0).fit(sample.withColumn("label", place))

    def apply(rows: DataFrame) -> DataFrame:
        scored = model.transform(tf.transform(_with_tokens(rows))).withColumn("raw", vector_to_array("rawPrediction"))
        cool = F.greatest(F.lit(1.0), F.col("n_tokens") / F.lit(EVIDENCE))
        weight = F.transform("raw", lambda x: F.exp((x - F.array_max("raw")) / cool))
        total = scored.withColumn("w", weight).withColumn("all", F.aggregate("w", F.lit(0.0), lambda a, x: a + x))
        posterior = F.array(*[F.col("w")[seen.index(d)] / F.col("all") if d in seen else F.lit(0.0) for d in range(len(DOMAINS))])
        return total.withColumn("posterior", posterior).select(*[c for c in rows.columns], "n_tokens", "posterior")

    return apply


def fit_rates(members: DataFrame, weights: dict[str, float] = WEIGHTS, rounds: int = 60, tolerance: float = 1e-6) -> Column:
    """The rate as an expression of ``n_tokens, posterior``. Every round is one aggregate over all documents; only sums per
    domain reach the driver.

    The squared residual is measured in the scale of the domains: inverse Gram matrix of the expected tokens, taken over the
    rows whose rate is still above zero, for only they can follow the gradient. The step is halved while the residual grows.
    A rate after t rounds is a nested expression of its own row, so nothing is joined or shuffled.
    """
    k = len(DOMAINS)
    part = [F.col("n_tokens") * F.col("posterior")[i] for i in range(k)]

    def totals(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens per domain, and the Gram matrix of the rows with a positive rate."""
        open_part = [F.when(F.col("rate") > 0, p) for p in part]
        row = (members.select("n_tokens", "posterior", rate.alias("rate"))
               .agg(*[F.sum(part[i] * F.col("rate")) for i in range(k)], *[F.sum(open_part[i] * part[j]) for i in range(k) for j in range(k)]).first())
        values = np.array([x or 0.0 for x in row])
        return values[:k], values[k:].reshape(k, k)

    rate, step, worst = F.lit(1.0), 1.0, np.inf
    got, gram = totals(rate)
    if not got.any():
        return rate
    every = gram
    share = np.array([weights[d] for d in DOMAINS])
    target = share * max(got[i] / share[i] for i, d in enumerate(DOMAINS) if d in CLEAN)
    for _ in range(rounds):
        scale = np.linalg.pinv(gram if gram.any() else every, rcond=1e-12, hermitian=True)
        pull = step * (scale @ (got - target))
        move = sum((part[i] * F.lit(float(pull[i])) for i in range(1, k)), part[0] * F.lit(float(pull[0])))
        rate = F.greatest(F.lit(0.0), rate - move)
        got, gram = totals(rate)
        left = np.abs(got - target).max()
        if left <= tolerance * target.sum():
            break
        step = step / 2 if left > worst else min(1.0, 2 * step)
        worst = left
    return rate


def _copies() -> Column:
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """``doc_id, n_tokens, posterior, rate, copies`` of every row."""
    members = stored(fit_memberships(docs, labels)(docs.select("doc_id", "text")).drop("text"), "mix-members")
    return members.withColumn("rate", fit_rates(members, weights)).withColumn("copies", _copies())


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with all their columns. Fitted numbers only: texts are not shuffled."""
    member = fit_memberships(docs, labels)
    rate = fit_rates(stored(member(docs.select("doc_id", "text")).select("n_tokens", "posterior"), "mix-members"), weights)
    rows = member(docs.select(F.struct("*").alias("row"), "doc_id", "text")).withColumn("rate", rate)
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), _copies().cast("int")))).select("row.*")
