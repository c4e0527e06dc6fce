"""Exact dedup by progressive refinement: length, then hash of the beginning, then hash of the whole, each step only for
the rows that still share a group. DataFrame functions only.

Texts are equal when they are identical after deleting every white-space character ``[\\x20\\x09-\\x0D]``; null is empty.
Of equal texts the row with the most code points in the original stays, then the smallest ``doc_id`` (null last). Fully
equal rows (same ``doc_id``, text length and class) are counted, and one of them is marked as kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.tables import bucket_of, probable, stored

#: White space that does not count, as fixed by the definition of equal texts.
_SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _SPACES, "")


def refine(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", prefix: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept`` and its keys ``original_chars, _length, _prefix, _whole``.

    Lengths and beginnings are narrow numbers. Whole contents are read again only where both agree with another row: a
    bounded broadcast filter thins the scan before the exact join, so texts outside it are not shuffled. Classes are formed
    by aggregates, which combine before the shuffle, so a class of a third of all rows is no hot task. An empty table gives
    an empty result; other columns are not touched.
    """
    norm = normalised(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("original_chars"),
                       F.char_length(norm).alias("_length"), F.xxhash64(F.substring(norm, 1, prefix)).alias("_prefix"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    keys = stored(rows.drop("_text"), "refine-keys")
    shared = (keys.groupBy("_length").count().where("count > 1").select("_length"))
    shared = (keys.join(shared, "_length", "left_semi").groupBy("_length", "_prefix").count().where("count > 1")
              .select(F.struct("_length", "_prefix").alias("_group")))
    shared = stored(shared, "refine-groups")
    open_rows = probable(rows.withColumn("_group", F.struct("_length", "_prefix")), shared, "_group")
    hashed = (open_rows.withColumn("_whole", F.sha2(normalised(F.col("_text")), 256)).drop("_text")
              .join(shared, "_group", "left_semi"))
    found = stored(hashed.groupBy("_group", "_whole", "doc_id", "original_chars").agg(F.count("*").alias("_copies")), "refine-rows")
    order = F.struct((-F.col("original_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id")
    classes = stored(found.groupBy("_group", "_whole").agg(F.sum("_copies").alias("group_size"), F.min(order).alias("_keep")), "refine-classes")
    # One row again per input row: equal rows are told apart by their number only.
    several = (found.join(classes, ["_group", "_whole"]).withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
               .select("doc_id", F.col("_keep.doc_id").alias("keep_id"), "group_size",
                       ((F.col("_number") == 1) & F.col("doc_id").eqNullSafe(F.col("_keep.doc_id"))
                        & (F.col("original_chars") == -F.col("_keep.n"))).alias("kept"), "original_chars", F.col("_group._length").alias("_length"), F.col("_group._prefix").alias("_prefix"), "_whole"))
    alone = (keys.withColumn("_group", F.struct("_length", "_prefix")).join(shared, "_group", "left_anti")
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept"), "original_chars", "_length", "_prefix", F.lit(None).cast("string").alias("_whole")))
    return alone.union(several)


def _same_row(prefix: int = 64) -> tuple[list[Column], Column]:
    """Keys of a row of the documents, and the test that a verdict belongs to it.

    A verdict without a whole hash is that of a row alone with its length and beginning, so these two tell it from other rows of its id.
    """
    norm = normalised(F.col("text"))
    keys = [F.col("doc_id").alias("_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("_chars"),
            F.char_length(norm).alias("_solid"), F.xxhash64(F.substring(norm, 1, prefix)).alias("_start"), F.sha2(norm, 256).alias("_digest")]
    test = (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("original_chars") == F.col("_chars"))
            & (F.col("_length") == F.col("_solid")) & (F.col("_prefix") == F.col("_start")) & (F.col("_whole").isNull() | (F.col("_whole") == F.col("_digest"))))
    return keys, test


def with_digest(docs: DataFrame) -> DataFrame:
    """The verdict of every row of ``documents`` with the SHA-256 of its normalised text."""
    keys, test = _same_row()
    return (refine(docs).join(docs.select(*keys).dropDuplicates(), test, "left")
            .select("doc_id", "keep_id", "group_size", "kept", F.col("_digest").alias("text_sha256")))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows whose ``doc_id`` shares no filter bucket with a dropped row pass without a shuffle; the rest is compared exactly.
    """
    verdict = stored(refine(docs), "dedup-verdict")
    dropped = verdict.where(~F.col("kept"))
    hit = dropped.select(bucket_of(F.col("doc_id")).alias("_bucket")).distinct()
    keys, test = _same_row()
    rows = docs.select(F.struct("*").alias("row"), bucket_of(F.col("doc_id")).alias("_bucket"), F.col("doc_id"), F.col("text"))
    calm = rows.join(F.broadcast(hit), "_bucket", "left_anti").select("row")
    doubt = rows.join(F.broadcast(hit), "_bucket", "left_semi").select("row", *keys)
    stay = doubt.join(verdict.where("kept"), test, "left_semi").dropDuplicates(["_id", "_chars", "_digest"]).select("row")
    return calm.union(stay).select("row.*")
