"""N-gram Jaccard join with adaptive multi-match prefixes.

The set of a text is its distinct shingles of ``width`` words (fewer words: the whole sequence as one), as 64-bit hashes.
Sets are ordered by estimated frequency, rare first, then by hash. A text of n shingles that must share t with any partner
has the prefix of n - t + l shingles, and a partner shares at least l of them. Every text takes the l whose estimated cost
(entries to read plus candidates to verify) is least; two texts must share the smaller of their two l. Candidates are
verified on the whole sets, exactly: ``100 * common >= percent * union``.

Texts with equal sets form one class and only its smallest ``doc_id`` is compared. Entries of very long posting lists are not
paired with each other: first each is compared with a few pivots of the list, links found so far are closed to components,
and only pairs between different components are still compared. Of these pairs only those become candidates whose parity
signatures leave room for a link (an exact bound, see ``parities``). So a large group of near copies costs its members times
the pivots, and no link is lost, because a pair is left out only when it is connected already or cannot link.

The frequency estimate counts all shingles of all texts in a table of fixed size (``2 ** SKETCH_BITS`` counters, broadcast
as two bytes each). A counter is never below the frequency of its shingles, so shingles of low counters are surely rare, however
full the table is. The estimate sets the order only, never the result. Rows with one ``doc_id`` are one node; a null ``doc_id`` has no
component and links nothing; null and empty texts have an empty set and link nothing. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.numeric import Spans, lower, mix, pieces, words
from socialtext.llm.tables import components, prepare, probable, stored

SKETCH_BITS = 23
_SLICES = 64
#: Largest number of prefix matches asked for.
MOST_MATCHES = 4
#: Cost of verifying a candidate, in posting entries.
VERIFY_COST = 30.0
#: Longer posting lists go through pivots.
LONG_LIST = 64
#: 64-bit numbers of a parity signature.
PARITY = 8


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``text number, hash`` of the distinct shingles of each text, ordered by text and hash."""
    low = lower(data)
    start, end, text = words(low, offsets)
    word = Spans(low).hash(start, end)
    n = len(word)
    whole = np.zeros(n, np.uint64)
    for step in range(width):
        ahead = word[step: n - width + 1 + step] if n >= width else word[:0]
        whole[: len(ahead)] = mix(whole[: len(ahead)] + ahead)
    full = np.zeros(n, bool)
    if n >= width:
        full[: n - width + 1] = text[: n - width + 1] == text[width - 1:]
    number = np.bincount(text, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(number)])
    for row in np.flatnonzero((number > 0) & (number < width)):
        code = np.array([number[row]], np.uint64)
        for at in range(first[row], first[row + 1]):
            code = mix((code + word[at: at + 1]) * np.uint64(3))
        whole[first[row]], full[first[row]] = code[0], True
    text, value = text[full], whole[full]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def _pack(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _sets_and_counts(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """Per row ``doc_id, n, h1, h2`` (a hash of the set), and per task its shingle counts in slices."""

    def apply(batches):
        counts = np.zeros(1 << bits, np.uint32)
        names = ["doc_id", "n", "h1", "h2", "slice", "counts"]
        for batch in batches:
            for first, last, data, offsets in pieces(batch):
                text, value = shingles(data, offsets, width)
                np.add.at(counts, (value >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
                n = np.bincount(text, minlength=last - first)
                sums = []
                for salt in (0x1234567, 0x89ABCDE):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(salt)))])
                    ends = np.concatenate([[0], np.cumsum(n)])
                    sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                rows = last - first
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, rows).cast(pa.int64()), pa.array(n.astype(np.int32)), pa.array(sums[0]),
                                                  pa.array(sums[1]), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        if counts.any():
            parts = [_pack(p) for p in np.split(counts, _SLICES)]
            yield pa.RecordBatch.from_arrays([pa.nulls(_SLICES, pa.int64()), pa.nulls(_SLICES, pa.int32()), pa.nulls(_SLICES, pa.int64()), pa.nulls(_SLICES, pa.int64()),
                                              pa.array(np.arange(_SLICES, dtype=np.int32)), pa.array(parts, pa.binary())], names=names)

    return docs.select("doc_id", "text").mapInArrow(apply, "doc_id long, n int, h1 long, h2 long, slice int, counts binary")


def _frequency_classes(sketch: DataFrame, bits: int) -> np.ndarray:
    """Two bytes per counter: four times its square root, which keeps half a standard deviation apart at any count."""

    def add(frame):
        import pandas as pd

        total = sum(_unpack(c).astype(np.uint64) for c in frame["counts"])
        return pd.DataFrame([(int(frame["slice"].iloc[0]), _pack(np.minimum(total, 0xFFFFFFFF).astype(np.uint32)))], columns=["slice", "counts"])

    part = sketch.withColumn("_part", F.pmod(F.xxhash64("counts"), F.lit(32))).groupBy("slice", "_part").applyInPandas(add, "slice int, counts binary")
    rows = part.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()  # at most 2 ** bits counters
    counts = np.zeros(1 << bits, np.float32)
    step = (1 << bits) // _SLICES
    for row in rows:
        counts[row["slice"] * step: (row["slice"] + 1) * step] = _unpack(row["counts"])
    np.sqrt(counts, out=counts)
    return np.minimum(4 * counts, 65535).astype(np.uint16)


def least_common(n: Column, percent: int) -> Column:
    """Shingles that a text of n has in common with any partner."""
    return F.floor((n * percent + 99) / 100).cast("int")


def parities(text: np.ndarray, value: np.ndarray, texts: int) -> pa.ListArray:
    """Per text whether an odd number of its shingles falls into each of ``64 · PARITY`` slots, as 64-bit numbers.

    What two sets share cancels out, so the slots in which their signatures differ are never more than the shingles in which the
    sets differ: a bound that loses no link.
    """
    slots = 64 * PARITY
    slot = (mix(value ^ np.uint64(0x5EED)) >> np.uint64(32)).astype(np.int64) % slots
    odd = np.bincount(text * slots + slot, minlength=texts * slots).reshape(texts, slots) & 1
    packed = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * PARITY, pa.int32()), pa.array(packed.ravel()))


def _prefixes(docs: DataFrame, width: int, percent: int, classes: np.ndarray, bits: int) -> DataFrame:
    """``doc_id, n, tokens, parity``: the longest prefix that any l asks for, and the signature of the whole set."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def apply(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch):
                text, value = shingles(data, offsets, width)
                order = np.lexsort((value, shared.value[(value >> np.uint64(64 - bits)).astype(np.int64)], text))
                n = np.bincount(text, minlength=last - first)
                ends = np.concatenate([[0], np.cumsum(n)])
                size = np.minimum(n, n - (n * percent + 99) // 100 + MOST_MATCHES)
                place = np.arange(len(text)) - ends[text]
                chosen = value[order][place < size[text]].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(chosen))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first).cast(pa.int64()), pa.array(n.astype(np.int32)), lists,
                                                  parities(text, value, last - first)], ["doc_id", "n", "tokens", "parity"])

    return docs.select("doc_id", "text").mapInArrow(apply, "doc_id long, n int, tokens array<long>, parity array<long>")


def _whole_sets(docs: DataFrame, width: int) -> DataFrame:
    def apply(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch):
                text, value = shingles(data, offsets, width)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=last - first))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first).cast(pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))], ["doc_id", "items"])

    return docs.select("doc_id", "text").mapInArrow(apply, "doc_id long, items array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.where(F.col("common") * 100 >= (F.size("x") + F.size("y") - F.col("common")) * percent).select("a", "b")


def _fits(percent: int, x: str = "x", y: str = "y") -> Column:
    """Sizes and first common positions still allow the overlap that a link needs."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    need = (nx + ny) * percent / (100 + percent) - 1e-9
    return ((nx * 100 >= ny * percent) & (ny * 100 >= nx * percent)
            & (nx - F.col(f"{x}.first") >= need) & (ny - F.col(f"{y}.first") >= need))


def _near(percent: int, x: str = "x", y: str = "y") -> Column:
    """The signatures leave room for a link: two sets that link differ in at most ``nx + ny - 2 · need`` shingles."""
    differ = sum((F.bit_count(F.col(f"{x}.parity")[i].bitwiseXOR(F.col(f"{y}.parity")[i])) for i in range(PARITY)), F.lit(0))
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    return F.coalesce(differ <= total - 2 * (total * percent / (100 + percent)) + 1e-6, F.lit(True))


def join(docs: DataFrame, width: int = 3, percent: int = 90, bits: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame]:
    """``(nodes, links)``: per row ``doc_id, n, representative``, and the links ``a, b`` between representatives.

    Links between members of one component may be missing only where other links connect them.
    """
    prepare(docs.sparkSession)
    first_pass = stored(_sets_and_counts(docs, width, bits), "similar-sets")
    rows, sketch = first_pass.where("slice is null").select("doc_id", "n", "h1", "h2"), first_pass.where("slice is not null").select("slice", "counts")
    classes = stored(rows.where("n > 0 and doc_id is not null").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("representative")), "similar-classes")
    nodes = rows.join(classes, ["n", "h1", "h2"], "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("representative")).alias("representative"))

    prefixes = stored(_prefixes(docs, width, percent, _frequency_classes(sketch, bits), bits), "similar-prefixes")
    alone = classes.select(F.col("representative").alias("doc_id"), "n")
    entries = (prefixes.join(alone, ["doc_id", "n"], "left_semi").select("doc_id", "n", F.posexplode("tokens").alias("pos", "token")))
    many = entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    entries = stored(entries.join(many, "token"), "similar-entries")

    # The l of each text, and the first position that it can share with anyone.
    spare = F.col("n") - least_common(F.col("n"), percent)
    reads = [F.sum(F.when(F.col("pos") < spare + l, F.col("df") - 1).otherwise(0)).alias(f"r{l}") for l in range(1, MOST_MATCHES + 1)]
    # No text asks for more matches than it has in common with any partner: a small set may have fewer than MOST_MATCHES.
    costs = F.array(*[F.struct(F.when(least_common(F.col("n"), percent) >= l, F.col(f"r{l}") * (1 + VERIFY_COST / l)).otherwise(float("inf")).alias("cost"), F.lit(l).alias("l"))
                      for l in range(1, MOST_MATCHES + 1)])
    per = (entries.groupBy("doc_id", "n").agg(*reads, F.min("pos").alias("first"), F.count_if(F.col("df") > LONG_LIST).alias("crowd"))
           .select("doc_id", F.array_min(costs)["l"].alias("l"), "first", "crowd"))
    entries = stored(entries.join(per, "doc_id").where(F.col("pos") < spare + F.col("l"))
                     .select("token", "df", F.struct("doc_id", "n", "first", "l", "crowd").alias("x")), "similar-postings")

    short = entries.where(F.col("df") <= LONG_LIST)
    pairs = (short.join(short.select("token", F.col("x").alias("y")), "token").where((F.col("x.doc_id") < F.col("y.doc_id")) & _fits(percent))
             .groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
             .agg(F.count("*").alias("shared"), F.first(F.least("x.l", "y.l")).alias("least"), F.first(F.least("x.crowd", "y.crowd")).alias("more"))
             # Matches in long lists are not counted here, so as many as both could have there are granted.
             .where(F.col("shared") + F.col("more") >= F.col("least")).select("a", "b"))
    pairs = stored(pairs, "similar-pairs")
    # Rows of one doc_id with different sets have no signature, so nothing is left out for them.
    signs = prefixes.groupBy("doc_id").agg(F.min("parity").alias("_low"), F.max("parity").alias("_high"))
    signs = signs.select(F.col("doc_id").alias("_doc"), F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("parity"))
    long = (entries.where(F.col("df") > LONG_LIST).join(signs, F.col("x.doc_id") == F.col("_doc"))
            .select("token", "df", F.struct("x.*", "parity").alias("x")))
    long = stored(long, "similar-long")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(long.select("x.doc_id")).distinct()
    needed = stored(needed, "similar-needed")
    sets = stored(_whole_sets(probable(docs, needed, "doc_id", 1 << 18), width).join(needed, "doc_id", "left_semi"), "similar-whole")
    links = stored(_verified(pairs, sets, percent), "similar-links")
    if long.limit(1).count():
        links = _through_pivots(long, links, sets, percent)
    return nodes, links


def _through_pivots(long: DataFrame, links: DataFrame, sets: DataFrame, percent: int, rounds: int = 2) -> DataFrame:
    x = F.col("x")
    for number in range(rounds):
        # One order for all lists: the lists of a group of near copies get few different pivots, so few different pairs.
        order = F.struct(x["first"].alias("first"), F.xxhash64(x["doc_id"], F.lit(number)).alias("mix"))
        pivots = long.groupBy("token").agg(F.min_by("x", order).alias("y"))
        pairs = (long.join(pivots, "token").where((x["doc_id"] != F.col("y.doc_id")) & _fits(percent) & _near(percent))
                 .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct())
        links = links.union(stored(_verified(pairs, sets, percent), "similar-links"))
    known = components(links)
    label = F.coalesce(F.col("component"), F.col("x.doc_id"))
    parts = stored(long.join(known, F.col("x.doc_id") == F.col("node"), "left").select("token", "x", label.alias("part")), "similar-parts")
    # Between components: every list once with the others' entries; lists inside one component are finished.
    open_lists = parts.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("token")
    parts = stored(parts.join(open_lists, "token", "left_semi"), "similar-parts")
    other = parts.select("token", F.col("x").alias("y"), F.col("part").alias("other"))
    pairs = (parts.join(other, "token").where((F.col("part") != F.col("other")) & (x["doc_id"] < F.col("y.doc_id")) & _fits(percent) & _near(percent))
             .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct())
    return links.union(stored(_verified(pairs, sets, percent), "similar-links"))


def grouped(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    nodes, links = join(docs, width, percent)
    found = components(links).select(F.col("node").alias("representative"), "component")
    return nodes.join(found, "representative", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "representative", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller ``doc_id``, with all their columns."""
    from socialtext.llm.tables import without

    group = stored(grouped(docs, width, percent), "similar-groups")
    return without(docs, group.where("component_id < doc_id").select("doc_id"))
