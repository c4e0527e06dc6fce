"""How filters interact: for every order of the filters and every step, what the step removes and what it loses.

A document matters only through its *mask*, the set of filters that it fails. Orders are numbered lexicographically (Lehmer
rank). All orders that begin with the same letters form one interval of ranks, and a mask is removed at step ``k`` by exactly the
intervals whose first ``k - 1`` letters it passes and whose ``k``-th letter it fails. So the counts of a mask are added at the start
of each interval and taken off behind its end, and a running sum over the ranks gives all totals: work per part is a fixed number
of rows, whatever the number of documents.

A null text is empty, a null source is the empty part, and an empty table gives no rows. Of equal texts the rows with the smallest
``doc_id`` (null after all others) pass filter E, repeated rows of that id included. Very long texts are only split into words
inside the row. A label row counts once per ``doc_id``; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from socialtext.llm.tables import stored

#: The filters in the order of their bits.
FILTERS = "ABCDE"
_ORDERS = ["".join(p) for p in permutations(FILTERS)]


def words(text: Column) -> Column:
    """Maximal runs without white space ``[\\x20\\x09-\\x0D]``."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def text_mask(text: Column, words: Column) -> Column:
    """Bits of the filters that look at one text alone: A to D."""
    n = F.size(words)
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 2 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(fail, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, fail in enumerate(fails)), F.lit(0))


def labelled_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part, set of failed filters and label.

    Texts are read once and never shuffled; what moves is their SHA-256, the id and the mask. Equal texts have equal masks, so a
    class of copies needs no join: all its rows count as failing E, but for those of the smallest id, which an aggregate finds. Both
    aggregates combine before the shuffle, so a class, an id or a part with a third of all rows is no hot task.
    """
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("_text"))
    read = read.withColumn("_words", words(F.col("_text"))).select(
        "doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"), text_mask(F.col("_text"), F.col("_words")).alias("mask"))
    rows = read.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    flags = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))
    rows = stored(rows, "audit-rows")
    known = rows.where("doc_id is not null").join(flags, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    nameless = rows.where("doc_id is null").select("doc_id", "part", "digest", "mask", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    rows = stored(known.union(nameless), "audit-labelled")
    repeats = 1 << FILTERS.index("E")
    same_id = rows.groupBy("digest", "doc_id").agg(F.collect_list(F.struct("part", "mask", "good", "toxic", "n")).alias("rows"))
    first = same_id.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rows")).alias("first"))
    first = first.select(F.inline("first.rows"))
    count = F.sum("n").alias("n")
    every = rows.groupBy("part", "mask", "good", "toxic").agg(count).withColumn("mask", F.col("mask") + repeats)
    kept = first.groupBy("part", "mask", "good", "toxic").agg(count)
    moved = kept.withColumn("mask", F.col("mask") + repeats).withColumn("n", -F.col("n"))
    both = every.union(moved).union(kept)
    return (both.groupBy("part", "mask").agg(count, F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                             F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def removal_intervals(n_filters: int = len(FILTERS)) -> list[tuple[int, int, int, int]]:
    """``mask, step, first rank, rank behind the last`` of all intervals of orders in which a mask goes at a step."""
    found = []
    for mask in range(1, 1 << n_filters):
        for step in range(1, n_filters + 1):
            for prefix in permutations(range(n_filters), step):
                if mask >> prefix[-1] & 1 and not any(mask >> f & 1 for f in prefix[:-1]):
                    digits = [sum(g < f and g not in prefix[:i] for g in range(n_filters)) for i, f in enumerate(prefix)]
                    rank = sum(d * factorial(n_filters - 1 - i) for i, d in enumerate(digits))
                    found.append((mask, step, rank, rank + factorial(n_filters - step)))
    return found


def audit(masks: DataFrame) -> DataFrame:
    """Totals of every part, order and step from ``part, mask, n, good, toxic``."""
    spark = masks.sparkSession
    masks = stored(masks, "audit-masks")
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, first int, behind int")
    # A fixed table of 485 intervals; a part has at most 32 masks.
    steps = (masks.join(F.broadcast(intervals), "mask")
             .select("part", "step", "n", "good", "toxic", F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("behind").alias("rank"), F.lit(-1).alias("sign")))).alias("_end"))
             .where(F.col("_end.rank") < len(_ORDERS)))
    ends = steps.groupBy("part", F.col("_end.rank").alias("rank"), "step").agg(
        *[F.sum(F.col(c) * F.col("_end.sign")).alias(c) for c in ("n", "good", "toxic")])
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << b) > 0, F.col("n")).otherwise(0)) for b in range(len(FILTERS))]
    alone = [F.sum(F.when(F.col("mask") == 1 << b, F.col("n")).otherwise(0)) for b in range(len(FILTERS))]
    parts = masks.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone"))
    orders = spark.createDataFrame(list(enumerate(_ORDERS)), "rank int, filter_order string")
    grid = (parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(len(_ORDERS) - 1))).alias("rank"))
            .select("part", "rank", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")))
    zeros = grid.select("part", "rank", "step", *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = (ends.union(zeros).groupBy("part", "rank", "step").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
               .select("part", "rank", "step", *[F.sum(c).over(along).alias(c) for c in ("n", "good", "toxic")]))
    rows = (removed.join(F.broadcast(orders), "rank").join(parts, "part")
            .withColumn("_letter", F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1)))))
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("_letter")) - F.col("n")).alias("redundant"), F.element_at("alone", F.col("_letter")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "_letter")).alias("shapley"))


def oracle() -> str:
    """The same rows by following every mask through every order."""
    letters = ", ".join(f"'{f}'" for f in FILTERS)
    return f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
 list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
 [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
  d.doc_id > min(d.doc_id) OVER (PARTITION BY text)] AS fails FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT unnest([{letters}]) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
 WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, instr('{FILTERS}', filter_order[step]) AS letter,
 list_transform(range(1, step), lambda i: instr('{FILTERS}', filter_order[i])) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, letter, n, good, toxic, fails, fails[letter] AS fail,
 len(list_filter(before, lambda b: fails[b])) > 0 AS gone FROM c, s),
t AS (SELECT part, filter_order, step, letter, sum(n) FILTER (NOT gone AND NOT fail) AS kept, sum(n) FILTER (fail AND NOT gone) AS removed,
 sum(n) FILTER (fail AND gone) AS redundant, sum(n) FILTER (fail AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
 sum(good) FILTER (fail AND NOT gone) AS good_lost, sum(toxic) FILTER (fail AND NOT gone) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
 CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
 CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
 CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM t"""
