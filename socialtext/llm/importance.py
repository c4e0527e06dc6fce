"""Importance resampling towards a target: documents whose words look like the target's are drawn first.

Every feature (a run of words) falls into a bucket by its CRC-32. The gain of a bucket is the logarithm of its smoothed share in
the target over its smoothed share in all documents; the weight of a document is the mean gain of its features. A Gumbel number
made from a hash of the id is added, so that the highest scores are a draw without replacement, the same in every run.

A null text or one without a word has no features, weight 0 and is never drawn. A null id hashes as the empty string and comes
after all ids of the same score. Rows with equal id and score are told apart by their number of features, then by nothing: as many
of them are drawn as places are left. Very long texts are split inside their row. An empty table gives no rows; an empty target
gives every bucket its smoothing alone. Other columns of the tables, whatever their names, are not read.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.tables import stored

BUCKETS = 10_000
SEED = "2024"
#: Keys per group whose median a task sends, and the most groups aimed at besides one per task: larger tables get larger groups.
GROUP_KEYS, MOST_GROUPS = 1 << 18, 1 << 14
#: So many remaining keys are looked at directly.
FEW_KEYS = 4096
_KEY = ("_minus", "_none", "_id", "_features")


def words(text: Column) -> Column:
    """Runs of letters beyond ASCII, ``a-z`` and digits, after lower-casing ``A-Z`` alone; may hold empty strings."""
    return F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(word: Column) -> Column:
    """Only words that ``lower`` changes go through the slower letter table."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def runs(found: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` neighbouring words, joined by one space."""
    if longest == 1:
        return found
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.when(F.size(found) >= n, F.array_join(F.slice(found, i, n), " ")))

    long = [of(n) for n in range(2, longest + 1)]
    return F.filter(F.concat(found, *long), lambda f: f.isNotNull())


def features(text: Column, longest: int = 1) -> Column:
    return runs(F.transform(F.filter(words(text), lambda w: w != ""), lowered), longest)


def bucket(feature: Column) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(BUCKETS)).cast("int")


def histogram(docs: DataFrame, longest: int = 1) -> np.ndarray:
    """Features per bucket: an array of fixed length. Counts combine in every task, which sends at most one row per bucket."""
    if longest == 1:  # the letter table then runs once per word in compiled code
        rows = docs.select(F.explode_outer(words(F.col("text"))).alias("w")).where("w <> ''").select(bucket(lowered(F.col("w"))).alias("b"))
    else:
        rows = docs.select(F.explode_outer(features(F.col("text"), longest)).alias("w")).where("w is not null").select(bucket(F.col("w")).alias("b"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in rows.groupBy("b").count().collect():
        counts[row["b"]] = row["count"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))`` of every bucket."""
    s, t, b = source.astype(float), target.astype(float), float(BUCKETS)
    return np.array([math.floor(1000 * math.log(x)) for x in (t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b))], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row, from one look into the array of gains per feature."""
    spark = docs.sparkSession
    table = spark.createDataFrame([([int(g) for g in gain],)], "gains array<int>").scalar()
    one = F.size(features(F.col("text"))) if longest > 1 else F.lit(None).cast("int")
    rows = docs.select("doc_id", features(F.col("text"), longest).alias("_f"), one.alias("n_words"), table.alias("_g"))
    buckets = F.transform("_f", lambda f: F.element_at(F.col("_g"), bucket(f) + 1).cast("long"))
    rows = rows.select("doc_id", F.coalesce("n_words", F.size("_f")).cast("long").alias("n_words"), F.size("_f").cast("long").alias("n_features"),
                       F.aggregate(buckets, F.lit(0).cast("long"), lambda a, g: a + g).alias("_sum"))
    # Whole numbers: the quotient towards zero, less one where a negative sum leaves a remainder.
    n, total = F.col("n_features"), F.col("_sum")
    weight = F.when(n == 0, F.lit(0)).otherwise((total - F.pmod(total, n)) / n).cast("long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    return rows.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + gumbel)


def _key() -> list[Column]:
    """Best first: high score, then small id, nulls last."""
    return [(-F.col("score")).alias("_minus"), F.col("doc_id").isNull().cast("long").alias("_none"),
            F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"), F.col("n_features").alias("_features")]


def _before(key: tuple[int, ...], equal: bool = False) -> Column:
    """Rows whose key comes before ``key`` (or, with ``equal``, is it). The first part alone is a bound the Parquet scan can use."""
    out = F.lit(equal)
    for name, value in reversed(list(zip(_KEY, key))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return (F.col(_KEY[0]) <= key[0]) & out


def _medians(size: int):
    """Of every group of up to ``size`` keys of a partition: the middle key and the number of keys, a row each."""
    def run(batches):
        held, n = [], 0

        def middle():
            keys = np.concatenate(held)
            order = np.lexsort(keys.T[::-1])
            return pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (*keys[order[len(keys) // 2]], len(keys))], names=[*_KEY, "size"])

        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _KEY]).astype(np.int64)
            while len(rows):
                held.append(rows[: size - n])
                n, rows = n + len(held[-1]), rows[size - n:]
                if n == size:
                    yield middle()
                    held, n = [], 0
        if n:
            yield middle()
    return run


def cutoff(keys: DataFrame, k: int, few: int = FEW_KEYS, group_keys: int = GROUP_KEYS) -> tuple[int, ...] | None:
    """The key at place ``k`` (from 1) of ``keys``, exactly, without sorting them.

    Every group of keys sends its median and its size. The median of the medians, each counted as often as its group has keys, has
    at least a quarter of all remaining keys on either side; the keys before it are counted, and the side without the place goes.
    The driver gets one row per group: their number is bounded by the tasks plus ``MOST_GROUPS``, not by the keys. When the keys
    left are half of those last written, they are written anew, so later rounds read less and lineage stays short.
    """
    held = written = keys.count()
    if not 0 < k <= held:
        return None
    while held > few:
        size = max(group_keys, -(-held // MOST_GROUPS))
        schema = ", ".join(f"{c} long" for c in (*_KEY, "size"))
        sent = np.array(keys.mapInArrow(_medians(size), schema).collect(), np.int64)
        sent = sent[np.lexsort(sent[:, :4].T[::-1])]
        pivot = tuple(int(x) for x in sent[np.searchsorted(np.cumsum(sent[:, 4]), sent[:, 4].sum() / 2), :4])
        got = keys.agg(F.count_if(_before(pivot)).alias("before"), F.count_if(_before(pivot, True)).alias("upto")).first()
        if got["before"] < k <= got["upto"]:
            return pivot
        if k <= got["before"]:
            keys, held = keys.where(_before(pivot)), got["before"]
        else:
            keys, held, k = keys.where(~_before(pivot, True)), held - got["upto"], k - got["upto"]
        if 2 * held <= written:
            keys, written = stored(keys, "importance-keys"), held
    return tuple(sorted(tuple(r) for r in keys.select(*_KEY).collect())[k - 1])


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, few: int = FEW_KEYS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null where a row is not drawn.

    Texts are read twice (counts, scores) and never shuffled. Only rows up to the cutoff are sorted, by ranges; the rank is the place
    within a range after the counted rows of the ranges before it.
    """
    gain = gains(histogram(docs, longest), histogram(target, longest))
    rows = stored(scored(docs, gain, longest).select("*", *_key()), "importance-scores")
    able = F.col("n_words") >= least_words
    k = percent * rows.where(able).count() // 100
    last = cutoff(rows.where(able).select(*_KEY), k, few)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    wins = able & _before(last, True)
    # The number that Spark gives to sorted rows is the range, shifted by 33 bits, plus the place in it.
    best = stored(rows.where(wins).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
                  .select(*columns, F.monotonically_increasing_id().alias("_place")), "importance-best")
    ranges = best.groupBy(F.shiftright("_place", 33).alias("_range")).count().collect()
    starts, at = [], 0
    for r in sorted(ranges):
        starts.append((r["_range"], at))
        at += r["count"]
    first = rows.sparkSession.createDataFrame(starts, "_range long, _first long")
    rank = F.col("_first") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    drawn = (best.withColumn("_range", F.shiftright("_place", 33)).join(F.broadcast(first), "_range")
             .select(*columns, F.when(rank <= k, rank).alias("rank")))
    return rows.where(~F.coalesce(wins, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank")).union(drawn)


def oracle() -> str:
    """The same rows; CRC-32 comes from its rule, byte by byte, once per distinct word."""
    return f"""WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
 lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS step),
w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents),
v AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
h AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM w UNION SELECT word FROM v)),
b AS (SELECT word, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(0, len(x), 2), lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT))),
 lambda c, y: xor(c // 256, step[xor(c % 256, y) + 1]))) % {BUCKETS} AS bucket FROM h, crc),
s AS (SELECT bucket, count(*) AS s FROM w JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM v JOIN b USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM w) + {BUCKETS}) / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM v) + {BUCKETS})))) AS BIGINT) AS gain
 FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
 coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
 FROM documents LEFT JOIN m USING (doc_id)),
r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
 count(*) FILTER (n_features >= 20) OVER () AS able FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank FROM r"""
