"""Sharding by balanced label propagation over links between equal texts. Law ``rows``: counts at most one apart.

A block is the rows of one group of equal texts that start in the same shard. In every round a block looks at the shards
of its neighbours (the rows of its group) and asks to move to the one with most of them; a shard admits blocks, in an order
that a hash fixes, up to its quota of rows. Rows without links fill what is left, so counts end exactly even. A group
larger than a quota stays spread over several shards. Null text is empty with size 1; repeated rows take one slot each;
an empty table gives an empty result; a null ``doc_id`` is a row like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from socialtext.llm.tables import ranked, stored

#: Hash ranges in which a shard admits blocks: bounds the table that the running sums are taken over.
_LANES = 1024


def _round(blocks: DataFrame, quota: int, number: int) -> DataFrame:
    seen = blocks.groupBy("key", "shard").agg(F.sum("rows").alias("near"))
    best = seen.groupBy("key").agg(F.max(F.struct("near", (-F.col("shard")).alias("minus"))).alias("best"))
    # A row's own shard holds itself, so an even number of neighbours elsewhere is reason enough; the least shard decides.
    asks = (blocks.join(best, "key").withColumn("want", F.when(F.col("best.minus") != -F.col("shard"), -F.col("best.minus")))
            .withColumn("lane", F.pmod(F.xxhash64("key", "first", F.lit(number)), F.lit(_LANES))))
    load = asks.groupBy("shard").agg(F.sum("rows").alias("load")).withColumnRenamed("shard", "want")
    sums = asks.where("want is not null").groupBy("shard", "want", "lane").agg(F.sum("rows").alias("asked"))
    # Admitted: what the free room takes, and what two shards exchange. What an uneven exchange leaves over is evened out at the end.
    room = Window.partitionBy("want").orderBy("lane", "shard").rowsBetween(Window.unboundedPreceding, 0)
    swap = Window.partitionBy("shard", "want")
    upto = swap.orderBy("lane").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("taken", F.sum("asked").over(room)).withColumn("out", F.sum("asked").over(upto)).withColumn("both", F.sum("asked").over(swap))
    back = sums.select(F.col("shard").alias("want"), F.col("want").alias("shard"), F.col("both").alias("back")).distinct()
    admitted = (sums.join(load, "want", "left").join(back, ["shard", "want"], "left")
                .where((F.col("taken") + F.coalesce("load", F.lit(0)) <= quota) | (F.col("out") <= F.coalesce(F.least("both", "back"), F.lit(0))))
                .select("shard", "want", "lane", F.lit(True).alias("in")))
    return (asks.join(F.broadcast(admitted), ["shard", "want", "lane"], "left")
            .select("key", "first", "rows", F.when(F.col("in"), F.col("want")).otherwise(F.col("shard")).cast("int").alias("shard")))


def shard(docs: DataFrame, shards: int = 8, rounds: int = 4) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.sha2(text, 256).alias("key"))
    rows = stored(rows.withColumn("first", F.pmod(F.xxhash64("doc_id", "key"), F.lit(shards)).cast("int")), "shard-rows")
    total = rows.count()
    groups = rows.groupBy("key", "first").agg(F.count("*").alias("rows"))
    linked = groups.groupBy("key").agg(F.sum("rows").alias("all")).where("all > 1").select("key")
    blocks = stored(groups.join(linked, "key", "left_semi").withColumn("shard", F.col("first")), "shard-blocks")
    for number in range(rounds):
        blocks = stored(_round(blocks, total // shards, number), "shard-blocks")
    placed = rows.join(blocks.select("key", "first", "shard"), ["key", "first"], "left")
    tied = ranked(placed.where("shard is not null"), ["shard"], F.xxhash64("doc_id", "key"), "slot")
    quota = [total // shards + (b < total % shards) for b in range(shards)]
    room = F.element_at(F.array(*map(F.lit, quota)), F.col("shard") + 1)
    # Rows beyond a quota (many linked rows that start together) fill up like rows without links.
    tied = stored(tied.withColumn("shard", F.when(F.col("slot") < room, F.col("shard"))), "shard-tied")
    held = {r["shard"]: r["n"] for r in tied.where("shard is not null").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    columns = ["doc_id", "size", "text_crc32", "key", "first"]
    free = ranked(placed.where("shard is null").select(*columns).union(tied.where("shard is null").select(*columns)), [],
                  F.xxhash64("doc_id", "key"), "place")
    start, where = 0, F.lit(None).cast("struct<shard:int,slot:long>")
    for b in reversed(range(shards)):
        need = [quota[x] - held.get(x, 0) for x in range(shards)]
        start = sum(need[:b])
        where = F.when((F.col("place") >= start) & (F.col("place") < start + need[b]),
                       F.struct(F.lit(b).alias("shard"), (F.col("place") - start + held.get(b, 0)).cast("long").alias("slot"))).otherwise(where)
    out = tied.where("shard is not null").select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long"))
    out = out.union(free.withColumn("to", where).select("doc_id", "size", "text_crc32", "to.shard", "to.slot"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def cut_edges(placed: DataFrame, key: str = "text_crc32") -> DataFrame:
    """Links between equal texts and how many of them cross shards, from counts per group (no pair is formed)."""
    per = placed.groupBy(key, "shard").agg(F.count("*").alias("n"))
    pairs = per.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("inside"))
    return pairs.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("links"), F.sum(F.col("n") * (F.col("n") - 1) / 2 - F.col("inside")).alias("cut"))
