"""Language identification by prediction by partial matching over bytes.

Per language a context tree of orders 0 to 3 gives the cost in bits of the next byte: from the longest context seen, with
escape probability (distinct symbols) / (count + distinct symbols) down to a uniform order -1. Statistics are frozen after
learning, so a whole text costs the sum over its bytes and the cheapest language wins. The four-byte tables of all languages
are merged: a byte triple names the longest context known to any language, a context and a byte name a row of costs.

Learned from at most ``TRAIN_ROWS`` documents per language (the first in the order of a hash of the id), whole texts, only
where ``crc32(doc_id) mod 3`` is not 1. Null text or a text without a letter is ``und`` with score 0, as is everything when
no language could be learned. Null ids are neither learned from nor held out. Repeated rows get equal results; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from socialtext.llm.numeric import pieces
from socialtext.llm.tables import prepare, stored

TRAIN_ROWS = 200
ORDER = 3


def _fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))


def grams(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``lang, gram, count``: counts of the four-byte strings (as a number) of the bounded training sample."""
    pool = docs.where("lang is not null and text is not null").where(_fold() != 1).select("doc_id", "lang")
    chosen = (pool.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
              .where(F.col("_n") <= train_rows).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")))
    sample = (docs.select("doc_id", "lang", "text")
              .join(F.broadcast(stored(chosen, "ppm-sample")), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
              .select("lang", "text"))

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, last, data, offsets in pieces(batch):
                for lang in set(langs[first:last]):
                    grams = [np.zeros(0, np.int64)]
                    for row in np.flatnonzero(langs[first:last] == lang):
                        text = data[offsets[row]: offsets[row + 1]].astype(np.int64)
                        # Texts start after three blanks, as a word does.
                        text = np.concatenate([np.full(ORDER, 32, np.int64), text])
                        grams.append((text[:-3] << 24) | (text[1:-2] << 16) | (text[2:-1] << 8) | text[3:])
                    gram, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "count"])

    return sample.mapInArrow(count, "lang string, gram long, count long").groupBy("lang", "gram").agg(F.sum("count").alias("count"))


class Tree:
    """Costs of bytes for all languages at once. ``context[a, b, c]`` is the longest known context, ``cost[context, byte]`` its bits."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        symbols = np.zeros(256, bool)
        for gram, _ in counts.values():
            symbols[np.unique(gram & 255)] = True
        symbols[32] = True
        #: Bytes that no training text has share one more symbol.
        self.code = np.full(256, symbols.sum(), np.int32)
        self.code[symbols] = np.arange(symbols.sum())
        a = self.size = int(symbols.sum()) + 1
        known = {}
        for lang, (gram, n) in counts.items():
            parts = [self.code[(gram >> s) & 255].astype(np.int64) for s in (24, 16, 8, 0)]
            known[lang] = parts, n
        # Nodes: order 0, all of order 1, and the contexts of orders 2 and 3 that some language has seen twice or more.
        frequent = []
        for width in (2, 3):
            keys = np.concatenate([sum(p * a ** (width - 1 - i) for i, p in enumerate(parts[3 - width: 3])) for parts, _ in known.values()])
            weights = np.concatenate([n for _, n in known.values()])
            key, where = np.unique(keys, return_inverse=True)
            frequent.append(key[np.bincount(where, weights) >= 2])
        nodes = 1 + a + sum(map(len, frequent))
        self.context = np.broadcast_to((1 + np.arange(a, dtype=np.int32)), (a * a, a)).reshape(-1).copy()
        two, three = (np.arange(len(f), dtype=np.int32) for f in frequent)
        every = np.arange(a) * a * a
        self.context[(every[:, None] + frequent[0][None, :]).ravel()] = np.tile(1 + a + two, a)
        self.context[frequent[1]] = 1 + a + len(two) + three
        self.cost = np.empty((nodes * a, len(self.languages)), np.float32)
        for column, lang in enumerate(self.languages):
            parts, n = known[lang]
            self.cost[:, column] = self._costs(parts, n, frequent, nodes).ravel()

    def _costs(self, parts, n, frequent, nodes) -> np.ndarray:
        a = self.size
        shares = np.full((nodes, a), 1.0 / a)
        table = np.bincount(parts[3], n, a)[None, :]
        shares[:1] = self._blend(table, shares[:1])
        table = np.bincount(parts[2] * a + parts[3], n, a * a).reshape(a, a)
        shares[1: 1 + a] = self._blend(table, shares[:1])
        first = 1 + a
        for width, keys in zip((2, 3), frequent):
            key = sum(p * a ** (width - 1 - i) for i, p in enumerate(parts[3 - width: 3]))
            at = np.searchsorted(keys, key).clip(max=max(len(keys) - 1, 0))
            hit = (keys[at] == key) if len(keys) else np.zeros(len(key), bool)
            table = np.bincount(at[hit] * a + parts[3][hit], n[hit], len(keys) * a).reshape(len(keys), a)
            shorter = 1 + keys % a if width == 2 else self.context[keys % (a * a)]
            shares[first: first + len(keys)] = self._blend(table, shares[shorter])
            first += len(keys)
        return -np.log2(shares)

    @staticmethod
    def _blend(table: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Escape to the shorter context with the weight of the distinct symbols (an unseen context escapes wholly)."""
        total, kinds = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
        return (table + np.where(total > 0, kinds, 1) * shorter) / np.where(total > 0, total + kinds, 1)

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text in every language."""
        code = self.code[data].astype(np.int64)
        blank = int(self.code[32])
        before = np.full((3, len(code)), blank, np.int64)
        for back in (1, 2, 3):
            before[back - 1, back:] = code[:-back] if len(code) > back else code[:0]
            for k in range(back):  # the first bytes of a text follow blanks
                at = offsets[:-1] + k
                before[back - 1, at[at < offsets[1:]]] = blank
        a = self.size
        node = self.context[(before[2] * a + before[1]) * a + before[0]]
        sums = np.zeros((len(code) + 1, len(self.languages)))
        np.cumsum(self.cost[node.astype(np.int64) * a + code], axis=0, dtype=np.float64, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Tree | None:
    """The tree from the bounded sample. The driver gets its four-byte counts: at most as many as the sample has bytes."""
    table = grams(docs, train_rows).toArrow()
    if not table.num_rows:
        return None
    langs, gram, n = (table.column(c) for c in ("lang", "gram", "count"))
    counts = {}
    for lang in pc.unique(langs).to_pylist():
        mine = pc.equal(langs, lang)
        order = np.argsort(gram.filter(mine).to_numpy(), kind="stable")
        counts[lang] = gram.filter(mine).to_numpy()[order], n.filter(mine).to_numpy()[order]
    return Tree(counts)


def predict(docs: DataFrame, tree: Tree | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred, score, shorter``.

    The score is the posterior of the winner with one text in sixteen bytes as evidence. ``shorter`` tells whether the winner codes
    the text in fewer bits than its plain bytes have, with 64 bits in favour of short texts: where it does not, no language fits.
    """
    has_letter = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("_letter")
    rows = docs.select(*keep, "text", has_letter)
    if tree is None:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("shorter"))
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    names = [*keep, "lang_pred", "score", "shorter"]

    def apply(batches):
        tree = shared.value
        names_of = np.array([*tree.languages, "und"], object)
        for batch in batches:
            best, score = np.full(batch.num_rows, len(names_of) - 1), np.zeros(batch.num_rows)
            shorter = np.zeros(batch.num_rows, bool)
            for first, last, data, offsets in pieces(batch):
                bits = tree.lengths(data, offsets)
                gap = bits - bits.min(1, keepdims=True)
                best[first:last] = bits.argmin(1)
                shorter[first:last] = bits.min(1) <= 8 * np.diff(offsets) + 64
                score[first:last] = 1 / np.exp2(-np.minimum(gap / np.maximum(1.0, np.diff(offsets) / 16)[:, None], 500)).sum(1)
            letter = np.array(batch.column("_letter").to_pylist(), bool)
            best[~letter], score[~letter] = len(names_of) - 1, 0.0
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(names_of[best], pa.string()), pa.array(score), pa.array(shorter)], names=names)

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(apply, ", ".join([*fields, "lang_pred string", "score double", "shorter boolean"]))


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    prepare(docs.sparkSession)
    found = predict(docs, learn(docs, train_rows))
    return found.select("doc_id", F.coalesce(_fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, languages: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language (one of ``languages`` if given), with all their columns.

    Texts without a letter go, and texts that no learned language codes in fewer bits than their bytes have.
    """
    prepare(docs.sparkSession)
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    found = predict(packed, learn(docs), ("row",))
    wanted = F.col("lang_pred") != "und" if languages is None else F.col("lang_pred").isin(*languages)
    return found.where(wanted & F.col("shorter")).select("row.*")
