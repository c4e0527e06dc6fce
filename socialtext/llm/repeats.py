"""Removes passages of ``LENGTH`` bytes and more that an earlier document has, found with suffix arrays.

A byte goes when a string of 50 bytes that covers it also starts in a document with a smaller ``doc_id``; strings are judged
on the input. Every such string contains an anchor: a string of 32 bytes whose hash is the least of its window of 19
positions, chosen alike wherever the string occurs. Around an anchor lie all strings that it stands for, its context.

1. Every task sends, once per anchor and context, hashes of the anchor, of its context and of the ``_NEAR`` bytes on either
   side. Anchors met in several places are noted in bit tables of fixed size (``2 ** FILTER_BITS`` bits each): those with one
   context everywhere, those with several, and those met very often; a fourth table notes anchor and bytes of a side that were
   met twice. Of the 18 bytes that a string has around the anchor nine or more are on one side, so an occurrence without a
   noted side has no string in common with another one. False hits of the tables cost time only.
2. A second scan deals the noted occurrences to tasks. With one context, every document but the smallest loses the whole context.
3. Where contexts differ around the same anchor, a task concatenates them, each once, and builds their suffix array by
   linear grouping (the anchor itself, equal in all of them, is one symbol). Neighbours in the array that agree in a whole
   string form the groups of equal strings, and the smallest document of a group decides.
4. Anchors met more than ``OFTEN`` times are not gathered: their smallest documents come from aggregates, their contexts are
   split into blocks with a suffix array each, and the groups of the blocks are brought together by the strings themselves.
   A task sends the occurrences of a context as one row, so a large group of copies makes few rows.

Null texts are empty. Documents with one ``doc_id`` do not remove from each other; a null ``doc_id`` neither removes nor
loses anything. Repeated rows get equal results; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from socialtext.llm.numeric import Spans, mix, pieces
from socialtext.llm.suffixes import suffix_array
from socialtext.llm.tables import bucket_of, prepare, stored

LENGTH = 50
ANCHOR = 32
FILTER_BITS = 26
#: Bytes on a side of the anchor, one of which at least any string has in full.
_NEAR = (LENGTH - ANCHOR + 1) // 2
#: Bits of an anchor that are sent besides its part.
_KEY_BITS = 24
#: Anchors that a task holds before it sends them on.
_HELD = 1 << 20
#: Contexts whose suffix array is built at once (more, if one anchor has more), and the most of one anchor in a block.
_TOGETHER = 3000
_BLOCK = 1500
#: Occurrences beyond which an anchor is not gathered in one task.
OFTEN = 20_000
#: Buckets of the broadcast filter for documents with a loss: at most so many numbers.
_BUCKETS = 1 << 18
#: Bytes of text for each part that is gathered in a task.
_PART_BYTES = 4 << 20


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every ``width`` neighbours, one per full window."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """``text number, position, start and end of the context, hash, hash of the context, hashes of the near sides`` of every anchor of a piece.

    The last are 8 bits for the bytes before the anchor and, below them, 8 for those after it.
    """
    window = length - anchor + 1
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(np.uint16)
    spans = Spans(data)
    at = np.arange(n - anchor + 1)
    values = spans.hash(at, at + anchor)
    least = _slide(values, window, np.minimum)
    # Windows that cross the border of two texts do not count.
    whole = np.ones(len(least), bool)
    for border in offsets[1:-1]:
        whole[max(0, border - length + 1): border] = False
    least[~whole] = 0
    pad = np.zeros(window - 1, np.uint64)
    highest = _slide(np.concatenate([pad, least, pad]), window, np.maximum)
    position = np.flatnonzero(highest[: len(values)] == values)
    text = np.searchsorted(offsets, position, side="right") - 1
    reach = length - anchor
    low = np.maximum(position - reach, offsets[text])
    high = np.minimum(position + anchor + reach, offsets[text + 1])
    context = mix(spans.hash(low, high) + (position - low).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    before = spans.hash(np.maximum(position - _NEAR, low), position) >> np.uint64(56)
    after = spans.hash(position + anchor, np.minimum(position + anchor + _NEAR, high)) >> np.uint64(56)
    # The least of a window is a small number: mixed once more, anchors fill parts and tables evenly.
    return text, position, low, high, mix(values[position]), context, (before << np.uint64(8) | after).astype(np.uint16)


def _pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """The bytes of the values plane by plane (of their differences, if ordered), which lets equal high bytes compress."""
    values = np.diff(values, prepend=values.dtype.type(0)) if ordered else np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpack(data: bytes, kind, ordered: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ordered else values


def _code(count: np.ndarray) -> np.ndarray:
    """A count in seven bits: exact below 64, then eight steps per doubling."""
    return np.where(count < 64, count, 64 + np.minimum(63, 8 * np.log2(np.maximum(count, 64) / 64))).astype(np.uint8)


def _decode(code: np.ndarray) -> np.ndarray:
    return np.where(code < 64, code, 64 * np.exp2((code.astype(float) - 64) / 8))


def _parts(docs: DataFrame, bits: int) -> int:
    """Bits of the number of parts: a part stays small in its task, however large the input."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(18, bits - 4, max(8, (size // _PART_BYTES).bit_length()))


def _near_slots(key: np.ndarray, sides: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The places, within the part, of the key of an anchor with the bytes before it and with those after it."""
    key = key.astype(np.uint64) << np.uint64(9)
    return tuple((mix(key | half.astype(np.uint64) << np.uint64(1) | np.uint64(side)) >> np.uint64(64 - bits)).astype(np.int64)
                 for side, half in enumerate((sides >> np.uint16(8), sides & np.uint16(255))))


def _noted(docs: DataFrame, bits: int, part_bits: int, often: int) -> list[np.ndarray]:
    """The bit tables: anchors met twice or more with one context, with several, and very often; anchors with a near side met twice."""
    rest = np.uint64(64 - part_bits)

    def collect(batches):
        held: list[tuple] = []
        size = 0

        def send():
            value, context, sides = (np.concatenate([h[i] for h in held]) for i in range(3))
            order = np.lexsort((context, value))
            value, context, sides = value[order], context[order], sides[order]
            first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (context[1:] != context[:-1])]))
            code = _code(np.diff(np.append(first, len(value))))
            # Within its part: _KEY_BITS of the anchor, 32 of the context, the near sides and the count.
            near = ((value[first] >> (rest - np.uint64(_KEY_BITS))) & np.uint64((1 << _KEY_BITS) - 1)).astype(np.uint32)
            around = (context[first] >> np.uint64(32)).astype(np.uint32)
            sides = sides[first]
            cut = np.searchsorted((value[first] >> rest).astype(np.int64), np.arange((1 << part_bits) + 1))
            filled = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array([pickle.dumps((_pack(near[x], True), _pack(around[x]), _pack(sides[x]), code[x].tobytes())) for x in (slice(cut[p], cut[p + 1]) for p in filled)], pa.binary())], ["part", "data"])

        for batch in batches:
            for _, _, data, offsets in pieces(batch):
                found = anchors(data, offsets)[4:]
                held.append(found)
                size += len(found[0])
                if size >= _HELD:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    def note(frame):
        blobs = [pickle.loads(d) for d in frame["data"]]
        key, context, sides = (np.concatenate([_unpack(b[i], kind, i == 0) for b in blobs]) for i, kind in enumerate((np.uint32, np.uint32, np.uint16)))
        times = _decode(np.concatenate([np.frombuffer(b[3], np.uint8) for b in blobs]))
        order = np.lexsort((context, key))
        key, context, sides, times = key[order], context[order], sides[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        last = np.append(first[1:], len(key)) - 1
        count = np.add.reduceat(times, first)
        mixed = context[first] != context[last]
        shared, near = np.zeros(len(key), bool), np.zeros(1 << (bits - part_bits), bool)
        several = np.flatnonzero(np.repeat(count > 1, last - first + 1))
        slots = _near_slots(key[several], sides[several], bits - part_bits)
        for half, slot in zip((sides[several] >> np.uint16(8), sides[several] & np.uint16(255)), slots):
            _, at = np.unique(key[several].astype(np.uint64) << np.uint64(8) | half, return_inverse=True)
            twice = np.bincount(at, weights=times[several])[at] > 1
            near[slot[twice]] = True
            shared[several[twice]] = True
        hot = np.add.reduceat(times * shared, first) > often
        place = (key[first] >> np.uint32(_KEY_BITS - (bits - part_bits))).astype(np.int64)
        tables = []
        for which in ((count > 1) & ~mixed, mixed, hot):
            table = np.zeros(1 << (bits - part_bits), bool)
            table[place[which]] = True
            tables.append(np.packbits(table).tobytes())
        return pd.DataFrame([(int(frame["part"].iloc[0]), *tables, np.packbits(near).tobytes())], columns=["part", *names])

    names = ["one", "several", "often", "near"]
    sent = docs.select("text").mapInArrow(collect, "part int, data binary")
    found = sent.groupBy("part").applyInPandas(note, "part int, " + ", ".join(f"{c} binary" for c in names))
    width = 1 << (bits - part_bits - 3)
    tables = [np.zeros(width << part_bits, np.uint8) for _ in names]
    for row in found.collect():  # 2 ** bits bits in each column, whatever the input
        at = row["part"] * width
        for table, name in zip(tables, names):
            table[at: at + width] = np.frombuffer(row[name], np.uint8)
    return tables


def _marked(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (table[slot >> 3] & (128 >> (slot & 7)).astype(np.uint8)) > 0


def _noted_anchors(batch: pa.RecordBatch, tables: list[np.ndarray], bits: int, part_bits: int, often: bool):
    """Per piece the noted anchors that are (or are not) met often: ``doc, mark, place, key, anchor, sides`` as arrays.

    ``sides`` is None for an anchor with one context, else the bytes before and after the anchor and the number before.
    """
    ids, marks = batch.column("doc_id").cast(pa.int64()).to_numpy(), batch.column("mark").to_numpy()
    for first, _, data, offsets in pieces(batch):
        text, position, low, high, value, context, sides = anchors(data, offsets)
        slot = (value >> np.uint64(64 - bits)).astype(np.int64)
        one, several, hot = (_marked(t, slot) for t in tables[:3])
        maybe = np.flatnonzero((one | several) & (hot == often))
        part = (value[maybe] >> np.uint64(64 - part_bits)).astype(np.int64) << (bits - part_bits)
        key = (value[maybe] >> np.uint64(64 - part_bits - _KEY_BITS)) & np.uint64((1 << _KEY_BITS) - 1)
        before, after = (_marked(tables[3], part | s) for s in _near_slots(key, sides[maybe], bits - part_bits))
        take = maybe[(several[maybe] & (before | after)) | (one[maybe] & before & after)]
        text, position, low, high, value, context = (x[take] for x in (text, position, low, high, value, context))
        raw = data.tobytes()
        sides = [(raw[a:p] + raw[p + ANCHOR: b], p - a) if d else None
                 for a, p, b, d in zip(low.tolist(), position.tolist(), high.tolist(), several[take].tolist())]
        yield ids[first + text], marks[first + text], position - offsets[text], context, value, sides


def equal_strings(contexts: list[tuple[int, bytes, int]], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``context number, offset, group`` of every string around the anchors: equal strings share a group number.

    A context is ``anchor number, bytes on both sides, bytes before``. In the concatenation an anchor is one symbol (257 and
    up), a byte is its value + 1 and a border is 0; the last symbol is -1. A string of ``length`` bytes around the anchor is
    ``length - anchor + 1`` symbols, offset 0 the one that starts ``length - anchor`` bytes before the anchor.
    """
    sizes, left = np.array([len(body) for _, body, _ in contexts]), np.array([left for _, _, left in contexts])
    starts = np.cumsum(sizes + 2) - sizes - 2
    middle = starts + left
    text = np.zeros(int((sizes + 2).sum()) + 1, np.int32)
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    at += at >= np.repeat(middle, sizes)
    text[at] = np.frombuffer(b"".join(body for _, body, _ in contexts), np.uint8).astype(np.int32) + 1
    text[middle], text[-1] = 257 + np.array([number for number, _, _ in contexts]), -1
    reach = length - anchor
    order = np.array(suffix_array(text), np.int64)
    owner = np.searchsorted(starts, order, side="right") - 1
    stops = np.append(starts[1:], len(text) - 1) - 1
    full = (order <= middle[owner]) & (order + reach >= middle[owner]) & (order + reach < stops[owner])
    order, owner = order[full], owner[full]
    if not len(order):
        return owner, order, order
    rows = np.lib.stride_tricks.sliding_window_view(text, reach + 1)[order]
    differs = np.concatenate([[False], (rows[1:] != rows[:-1]).any(1)])
    return owner, order - (middle[owner] - reach), np.cumsum(differs)


def _shared_bytes(anchor: np.ndarray, body: np.ndarray, begin: np.ndarray, length: np.ndarray, step: int) -> np.ndarray:
    """How many bytes, from ``begin`` on in steps of 1 or -1 and ``length`` at most, a context has in common with any other one of its anchor."""
    reach = LENGTH - ANCHOR
    at = np.arange(reach)
    inside = at < length[:, None]
    sides = np.zeros((len(anchor), -(-reach // 4) * 4), ">u2")  # a byte is its value + 1, what lies beyond is 0
    sides[:, :reach][inside] = body[(begin[:, None] + step * at)[inside]].astype(">u2") + 1
    words = sides.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], anchor))
    same = (sides[order[1:]] == sides[order[:-1]])[:, :reach]
    common = np.where(same.all(1), reach, same.argmin(1)) * (anchor[order[1:]] == anchor[order[:-1]])
    most = np.zeros(len(anchor), np.int64)
    most[order[1:]] = common
    most[order[:-1]] = np.maximum(most[order[:-1]], common)  # of sorted sides a neighbour has the most in common
    return np.minimum(most, length)


def _masks(anchor: np.ndarray, sides: list[tuple[bytes, int]], first: np.ndarray) -> np.ndarray:
    """Per context the offsets, as bits, whose string a context with an earlier first document has. Anchors come together.

    Bytes that no other context of the anchor shares are in no common string: the suffix arrays do without them, and without contexts
    that have no string left.
    """
    mask = np.zeros(len(anchor), np.int64)
    reach = LENGTH - ANCHOR
    sizes, left = np.array([len(body) for body, _ in sides]), np.array([before for _, before in sides])
    body = np.frombuffer(b"".join(x for x, _ in sides), np.uint8)
    middle = np.cumsum(sizes) - sizes + left
    a, b = _shared_bytes(anchor, body, middle - 1, left, -1), _shared_bytes(anchor, body, middle, sizes - left, 1)
    kept = np.flatnonzero(a + b >= reach)
    edges = np.flatnonzero(np.concatenate([[True], anchor[kept][1:] != anchor[kept][:-1]])) if len(kept) else kept
    number = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(kept))))
    at = 0
    while at < len(edges):
        stop = max(int(np.searchsorted(edges, edges[at] + _TOGETHER)), at + 1)
        numbers = kept[edges[at]: edges[stop] if stop < len(edges) else len(kept)]
        owner, offset, group = equal_strings([(n, sides[r][0][m - x: m + y], x) for n, r, m, x, y in zip(
            (number[edges[at]: edges[at] + len(numbers)] - at).tolist(), numbers.tolist(), left[numbers].tolist(), a[numbers].tolist(), b[numbers].tolist())])
        least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, first[numbers[owner]])
        early = least[group] < first[numbers[owner]]
        np.bitwise_or.at(mask, numbers[owner[early]], np.int64(1) << offset[early])
        at = stop
    return mask


_SPANS = "doc_id long, mark short, spans array<struct<place:int,mask:int>>"


def _by_document(doc: np.ndarray, mark: np.ndarray, place: np.ndarray, mask: np.ndarray) -> dict[str, pa.Array]:
    """One row per document: the offsets in question around its anchors, as a list."""
    keep = np.flatnonzero(mask)
    keep = keep[np.lexsort((mark[keep], doc[keep]))]
    doc, mark, place, mask = doc[keep], mark[keep], place[keep], mask[keep]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])) if len(doc) else keep
    spans = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(mask, pa.int32())], ["place", "mask"])
    return {"doc_id": pa.array(doc[first], pa.int64()), "mark": pa.array(mark[first], pa.int16()),
            "spans": pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)), pa.int32()), spans)}


def _gathered(docs: DataFrame, tables, bits: int, part_bits: int) -> DataFrame:
    """``doc_id, mark, spans``: anchors whose strings an earlier document has (mask -1: all of them); a document may come from several tasks."""

    def deal(batches):
        held: list[tuple] = []
        size = 0

        def send():
            doc, mark, place, key, anchor = (np.concatenate([h[i] for h in held]) for i in range(5))
            sides = [x for h in held for x in h[5]]
            differs = np.array([x is not None for x in sides], bool)
            part = (np.where(differs, anchor, key) >> np.uint64(64 - part_bits)).astype(np.int64)
            order = np.lexsort((key, part))
            cut = np.searchsorted(part[order], np.arange((1 << part_bits) + 1))
            blobs, filled = [], np.flatnonzero(np.diff(cut))
            for p in filled:
                rows = order[cut[p]: cut[p + 1]]
                plain, mixed = rows[~differs[rows]], rows[differs[rows]]
                # A context is sent once with its bytes; its other occurrences have its key only.
                new = mixed[np.unique(key[mixed], return_index=True)[1]]
                blobs.append(pickle.dumps((
                    *([_pack(key[x], True), *[_pack(y[x]) for y in (doc, mark, place)]] for x in (plain, mixed)),
                    [_pack(key[new], True), _pack(anchor[new]), bytes(sides[r][1] for r in new), bytes(len(sides[r][0]) for r in new), zlib.compress(b"".join(sides[r][0] for r in new), 1)])))
            return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])

        for batch in batches:
            for found in _noted_anchors(batch, shared.value, bits, part_bits, False):
                held.append((found[0], found[1], found[2].astype(np.int32), *found[3:]))
                size += len(found[0])
                if size >= _HELD // 2:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    def solve(dealt):
        blobs = [pickle.loads(d) for d in dealt["data"].to_pylist()]
        out = [(np.zeros(0, np.int64),) * 4]
        kinds = (np.uint64, np.int64, np.int16, np.int32)
        key, doc, mark, place = (np.concatenate([_unpack(b[0][i], kinds[i], i == 0) for b in blobs]) for i in range(4))
        if len(key):
            order = np.lexsort((doc, key))
            key, doc, mark, place = key[order], doc[order], mark[order], place[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            late = doc > np.repeat(doc[start], np.diff(np.append(start, len(key))))
            out.append((doc[late], mark[late], place[late], np.full(int(late.sum()), -1)))
        key, doc, mark, place = (np.concatenate([_unpack(b[1][i], kinds[i], i == 0) for b in blobs]) for i in range(4))
        if len(key):
            sent_key, sent_anchor = (np.concatenate([_unpack(b[2][i], np.uint64, i == 0) for b in blobs]) for i in range(2))
            sides = []
            for _, _, before, sizes, bodies in (b[2] for b in blobs):
                ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64).tolist()
                bodies = zlib.decompress(bodies)
                sides.extend((bodies[e - n: e], left) for e, n, left in zip(ends, sizes, before))
            known, at = np.unique(sent_key, return_index=True)
            first = np.full(len(known), np.iinfo(np.int64).max)
            number = np.searchsorted(known, key)
            np.minimum.at(first, number, doc)
            order = np.argsort(sent_anchor[at], kind="stable")
            mask = np.empty(len(known), np.int64)
            mask[order] = _masks(sent_anchor[at][order], [sides[r] for r in at[order]], first[order])
            out.append((doc, mark, place, np.where(doc > first[number], -1, mask[number])))
        return pa.table(_by_document(*(np.concatenate(c) for c in zip(*out))))

    shared = docs.sparkSession.sparkContext.broadcast(tables)
    return docs.mapInArrow(deal, "part int, data binary").groupBy("part").applyInArrow(solve, _SPANS)


def _frequent(docs: DataFrame, tables, bits: int, part_bits: int, block: int) -> DataFrame:
    """The same for anchors met very often, which no task gathers."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    names = ["key", "anchor", "sides", "before", "first_doc", "data"]

    def emit(batches):
        held: list[tuple] = []
        size = 0

        def send():
            doc, mark, place, key, anchor = (np.concatenate([h[i] for h in held]) for i in range(5))
            sides = [x for h in held for x in h[5]]
            order = np.lexsort((doc, key))
            first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            new, cut = order[first], np.append(first, len(key))
            data = [pickle.dumps([_pack(x[order[a:b]]) for x in (doc, mark, place)]) for a, b in zip(cut[:-1], cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(anchor[new].view(np.int64)), pa.array([sides[r] and sides[r][0] for r in new], pa.binary()),
                                               pa.array([sides[r] and sides[r][1] for r in new], pa.int32()), pa.array(doc[new]), pa.array(data, pa.binary())], names=names)

        for batch in batches:
            for found in _noted_anchors(batch, shared.value, bits, part_bits, True):
                held.append((found[0], found[1], found[2].astype(np.int32), *found[3:]))
                size += len(found[0])
                if size >= _HELD // 2:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    met = stored(docs.mapInArrow(emit, "key long, anchor long, sides binary, before int, first_doc long, data binary"), "repeat-frequent")
    contexts = stored(met.groupBy("key").agg(F.min("first_doc").alias("first_doc"), F.min("anchor").alias("anchor"), F.first("sides").alias("sides"), F.first("before").alias("before")), "repeat-contexts")
    mixed = contexts.where("sides is not null")
    sizes = mixed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    known = mixed.join(sizes, "anchor").withColumn("block", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / block)))
    dealt = known.groupBy("anchor", "block")

    def solve(frame):
        first = frame["first_doc"].to_numpy()
        bodies = list(zip(frame["sides"], frame["before"]))
        owner, offset, group = equal_strings([(0, *b) for b in bodies])
        least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, first[owner])
        reach = LENGTH - ANCHOR
        string = [bodies[o][0][bodies[o][1] - reach + p:][:reach] + bytes([p]) for o, p in zip(owner, offset)]
        return pd.DataFrame({"anchor": frame["anchor"].iloc[0], "string": string, "key": frame["key"].to_numpy()[owner], "first_doc": first[owner], "offset": offset, "least": least[group]})

    strings = stored(dealt.applyInPandas(solve, "anchor long, string binary, key long, first_doc long, offset int, least long"), "repeat-strings")
    # One row per block and string goes into the aggregate; the strings themselves are compared, not hashes of them.
    over = stored(strings.groupBy("anchor", "string").agg(F.min("least").alias("over")), "repeat-over")
    masks = (strings.join(over, ["anchor", "string"]).where("over < first_doc").groupBy("key").agg(F.bit_or(F.expr("shiftleft(1, offset)")).alias("mask")))
    decided = stored(contexts.select("key", "first_doc").join(masks, "key", "left"), "repeat-decided")

    def spread(batches):
        for batch in batches:
            found = [(np.zeros(0, np.int64),) * 4]
            for data, first, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
                doc, mark, place = (_unpack(x, kind) for x, kind in zip(pickle.loads(data), (np.int64, np.int16, np.int32)))
                found.append((doc, mark, place, np.where(doc > first, -1, mask or 0)))
            yield pa.RecordBatch.from_pydict(_by_document(*(np.concatenate(c) for c in zip(*found))))

    return met.select("key", "data").join(decided, "key").select("data", "first_doc", "mask").mapInArrow(spread, _SPANS)


def covered(docs: DataFrame, bits: int = FILTER_BITS, often: int = OFTEN, block: int = _BLOCK) -> DataFrame:
    """``doc_id, mark, spans``: per document with a loss the anchors and offsets whose strings an earlier document has."""
    prepare(docs.sparkSession)
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", _mark().alias("mark"), "text")
    part_bits = _parts(rows, bits)
    tables = _noted(rows, bits, part_bits, often)
    found = _gathered(rows, tables, bits, part_bits)
    if tables[2].any():
        found = found.union(_frequent(rows, tables, bits, part_bits, block))
    return found.groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _mark():
    """Tells rows with one ``doc_id`` and different texts apart."""
    return F.pmod(F.xxhash64("text"), F.lit(1 << 15)).cast("short")


def remove(docs: DataFrame, bits: int = FILTER_BITS, often: int = OFTEN, block: int = _BLOCK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes`` of every row; ``kept_bytes`` is null where nothing goes."""
    spans = stored(covered(docs, bits, often, block), "repeat-spans")
    hit = spans.select(bucket_of(F.col("doc_id"), buckets=_BUCKETS).alias("_bucket")).distinct()
    rows = docs.select("doc_id", _mark().alias("mark"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("_bucket", bucket_of(F.col("doc_id"), buckets=_BUCKETS))

    def untouched(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                         F.sha2("text", 256).alias("kept_sha256"), F.lit(None).cast("binary").alias("kept_bytes"))

    doubt = rows.join(F.broadcast(hit), "_bucket", "left_semi").join(spans, ["doc_id", "mark"], "left")

    reach = LENGTH - ANCHOR

    def cut(batches):
        for batch in batches:
            out = []
            lists = batch.column("spans")
            places, masks = (np.asarray(pc.struct_field(lists.flatten(), i), np.int64) for i in range(2))
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            for text, some, start, end in zip(batch.column("text").to_pylist(), lists.is_valid().to_pylist(), [0, *ends.tolist()], ends.tolist()):
                raw = text.encode()
                if not some:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), None))
                    continue
                place, mask = places[start:end], masks[start:end]
                whole = mask == -1
                which, offset = np.nonzero(mask[~whole, None] >> np.arange(reach + 1) & 1)
                low = np.append(np.maximum(place[whole] - reach, 0), place[~whole][which] - reach + offset)
                high = np.append(np.minimum(place[whole] + LENGTH, len(raw)), low[whole.sum():] + LENGTH)
                edge = np.bincount(low, minlength=len(raw) + 1) - np.bincount(high, minlength=len(raw) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(raw) else 0
                out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    # One join for all rows in doubt: the texts are shuffled once.
    compared = doubt.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")
    return untouched(rows.join(F.broadcast(hit), "_bucket", "left_anti")).union(compared)
