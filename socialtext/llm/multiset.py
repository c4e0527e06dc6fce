"""Fingerprints of texts as multisets of paragraphs: a homomorphic sum of wide hash vectors.

A paragraph (a line, cut after every sentence end, without spaces around it) hashes to 256 signs, the bits of its SHA-256. The
fingerprint is the sum of these vectors, lane by lane, modulo 2^16. So it does not depend on the order of the paragraphs; a
paragraph is inserted by adding its vector and deleted by subtracting it, and the fingerprint of a union is the sum. Equal multisets
have equal fingerprints; different ones agree in all lanes only by chance (with one paragraph more or less, never). Read as signed
numbers, two fingerprints show how alike two texts are: their cosine estimates that of the paragraph counts, with a
deviation of about 1/16 where nothing is shared.

A null text is empty and has the zero fingerprint; two empty texts are alike (1), an empty and another one are not (0). A lane may
wrap once a text holds more than 32,767 copies of one paragraph: equality still holds, likeness does not. Rows are in descending
order of ``doc_id``, null last, rows of one id by a hash of the text; identical rows are neighbours, and a single row is its own
neighbour. Very long texts are hashed 4,096 paragraphs at a time. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.tables import prepare
from socialtext.session import estimated_bytes

LANES = 256
_PARAGRAPH = re.compile(r"[^\n.!?]*[.!?]+|[^\n.!?]+")
#: Bytes of a range of documents that one task handles as a stream.
RANGE_BYTES = 64 << 20
#: Beyond so many ranges they get larger; they are streams, so only their sort grows. Tables of unknown size (an estimate from
#: ``UNKNOWN_BYTES`` on) get as many as there are shuffle partitions.
MOST_RANGES, UNKNOWN_BYTES = 1 << 14, 1 << 60
_CHUNK = 4096
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def paragraphs(text: str) -> list[str]:
    return [p for p in (m.strip(" ") for m in _PARAGRAPH.findall(text)) if p]


def total(found: Iterable[str]) -> np.ndarray:
    """Sum of the sign vectors, modulo 2^16."""
    found, ones = list(found), np.zeros(LANES, np.int64)
    for at in range(0, len(found), _CHUNK):
        digests = b"".join(hashlib.sha256(p.encode()).digest() for p in found[at: at + _CHUNK])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 32), axis=1).sum(axis=0, dtype=np.int64)
    return (2 * ones - len(found)).astype(np.uint16)


def insert(fingerprint: np.ndarray, found: Iterable[str]) -> np.ndarray:
    return fingerprint + total(found)


def delete(fingerprint: np.ndarray, found: Iterable[str]) -> np.ndarray:
    return fingerprint - total(found)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two fingerprints, 0 to 1 (rounded to six places)."""
    if (a == b).all():
        return 1.0
    x, y = a.view(np.int16).astype(np.int64), b.view(np.int16).astype(np.int64)
    size = float(x @ x) * float(y @ y)
    return min(1.0, max(0.0, math.floor(float(x @ y) / math.sqrt(size) * 1e6 + 0.5) / 1e6)) if size else 0.0


def text_of(fingerprint: np.ndarray) -> str:
    """Sixteen bits a lane, in base64."""
    return base64.b64encode(fingerprint.astype(">u2").tobytes()).decode()


def replaced(fingerprint: np.ndarray, text: str, keep: int, added: str) -> np.ndarray:
    """Fingerprint of ``text[:keep] + added``: paragraphs that end before the cut stay, those behind go, the new ones come."""
    whole = 0
    for m in _PARAGRAPH.finditer(text):
        if m.end() >= keep:  # it reaches the cut, where new text may be joined to it
            break
        whole = m.end()
    return insert(delete(fingerprint, paragraphs(text[whole:])), paragraphs(text[whole:keep] + added))


def _row(current: tuple, following: tuple) -> tuple:
    doc_id, text, print_ = current
    half = len(text) // 2
    keep, added = len(text) - half, following[1][:half]
    edited = replaced(print_, text, keep, added)
    return (doc_id, len(text), hashlib.sha256((text[:keep] + added).encode()).hexdigest(), text_of(print_), text_of(edited),
            likeness(print_, edited), likeness(print_, following[2]))


def _pairs(batches):
    """Rows come sorted by range and place; the row behind the last one of a range is a guest and gives no result."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    previous = None
    for batch in batches:
        out = []
        for range_, guest, doc_id, text in zip(*(batch.column(c) for c in ("range", "guest", "doc_id", "text"))):
            text = text.as_py()
            current = (doc_id.as_py(), text, total(paragraphs(text)))
            if previous and previous[0] == range_.as_py():
                out.append(_row(previous[1], current))
            previous = None if guest.as_py() else (range_.as_py(), current)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _place(doc_id: str, text: str) -> Column:
    """Ascending where the rows descend by id, null last."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.bitwise_not(F.coalesce(F.col(doc_id).cast("long"), F.lit(0))).alias("id"),
                    F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"))


def first_places(rows: DataFrame, ranges: int) -> list:
    """The first place of each of about ``ranges`` equal ranges: narrow keys are sorted, one key per range reaches the driver."""
    cut = rows.select("place").repartitionByRange(ranges, "place").groupBy(F.spark_partition_id().alias("range")).agg(F.min("place").alias("first"))
    return sorted(r["first"] for r in cut.collect())


def _with_range(rows: DataFrame, firsts: list) -> DataFrame:
    """``range`` (index of the last first place that is not behind the place) and whether the row is that first one.

    The first places come as blocks, one value of the plan: the block is sought among the heads, the range inside the block.
    """
    spark, width = rows.sparkSession, max(1, math.isqrt(len(firsts)))
    blocks = [firsts[i: i + width] for i in range(0, len(firsts), width)]
    place = "struct<none: boolean, id: bigint, hash: bigint>"
    table = spark.createDataFrame([(blocks, [b[0] for b in blocks])], f"blocks array<array<{place}>>, heads array<{place}>")
    rows = rows.select("*", table.select("blocks").scalar().alias("_blocks"), table.select("heads").scalar().alias("_heads"))
    rows = rows.withColumn("_at", F.size(F.filter("_heads", lambda f: f <= F.col("place"))))
    rows = rows.withColumn("_inside", F.size(F.filter(F.element_at("_blocks", F.col("_at")), lambda f: f <= F.col("place"))))
    return rows.select("doc_id", "text", "place", ((F.col("_at") - 1) * width + F.col("_inside") - 1).alias("range"),
                       (F.element_at(F.element_at("_blocks", F.col("_at")), F.col("_inside")) == F.col("place")).alias("is_first"))


def neighbours(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """``range, guest, doc_id, text`` of every row, sorted so that each row is followed by its next one.

    Every range also holds the first row of the range after it as a guest (the last range that of the first). Texts are shuffled
    once; ranges are cut by rows, so no key makes a task large but rows that are identical in id and text.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), _place(doc_id, text).alias("place"))
    if not ranges:
        size = estimated_bytes(rows)
        wanted = -(-size // RANGE_BYTES) if size < UNKNOWN_BYTES else 1
        ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(wanted, MOST_RANGES))
    firsts = first_places(rows, ranges)
    if not firsts:
        return rows.select(F.lit(0).alias("range"), F.lit(False).alias("guest"), "doc_id", "text")
    at = _with_range(rows, firsts)
    here = F.struct("range", F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(firsts))).alias("range"), F.lit(True).alias("guest"))
    both = at.withColumn("_as", F.explode(F.when(F.col("is_first"), F.array(here, before)).otherwise(F.array(here))))
    return (both.select(F.col("_as.range").alias("range"), F.col("_as.guest").alias("guest"), "place", "doc_id", "text")
            .repartition(ranges, "range").sortWithinPartitions("range", "guest", "place").select("range", "guest", "doc_id", "text"))


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edited text (its last half replaced by the beginning of the next document)."""
    prepare(docs.sparkSession)
    return neighbours(docs, ranges=ranges).mapInArrow(_pairs, SCHEMA)


def oracle() -> str:
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n_chars, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next,
 coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT doc_id, n_chars, next_id, text, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) AS edited FROM n),
p AS (SELECT doc_id, edit, unnest(list_filter(list_transform(regexp_extract_all(t, '[^\\n.!?]*[.!?]+|[^\\n.!?]+'), lambda x: trim(x, ' ')), lambda x: x <> '')) AS p
 FROM (SELECT doc_id, 0 AS edit, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e)),
s AS (SELECT doc_id, edit, sha256(p) AS x FROM p),
b AS (SELECT doc_id, edit, x, lane FROM s, range(64) AS r(lane)),
c AS (SELECT doc_id, edit, lane, count(*) AS n, CAST(sum(v // 8) AS BIGINT) AS b0, CAST(sum(v // 4 % 2) AS BIGINT) AS b1, CAST(sum(v // 2 % 2) AS BIGINT) AS b2, CAST(sum(v % 2) AS BIGINT) AS b3
 FROM (SELECT doc_id, edit, lane, instr('0123456789abcdef', x[lane + 1]) - 1 AS v FROM b) GROUP BY doc_id, edit, lane),
l AS (SELECT doc_id, edit, 4 * lane + i AS lane, ((2 * [b0, b1, b2, b3][i + 1] - n) % 65536 + 65536) % 65536 AS v FROM c, range(4) AS q(i)),
f AS (SELECT doc_id, edit, list(CASE WHEN v > 32767 THEN v - 65536 ELSE v END ORDER BY lane) AS v, to_base64(unhex(string_agg(format('{{:04x}}', v), '' ORDER BY lane))) AS print FROM l GROUP BY doc_id, edit),
z AS (SELECT list_transform(range({LANES}), lambda i: CAST(0 AS BIGINT)) AS v, to_base64(unhex(repeat('0000', {LANES}))) AS print),
g AS (SELECT a.doc_id, edit.edit, coalesce(f.v, z.v) AS v, coalesce(f.print, z.print) AS print FROM d a CROSS JOIN (SELECT unnest([0, 1]) AS edit) edit CROSS JOIN z
 LEFT JOIN f ON f.doc_id = a.doc_id AND f.edit = edit.edit),
j AS (SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint, a.v AS x, b.v AS y, c.v AS w
 FROM e JOIN g a ON a.doc_id = e.doc_id AND a.edit = 0 JOIN g b ON b.doc_id = e.doc_id AND b.edit = 1 JOIN g c ON c.doc_id = e.next_id AND c.edit = 0)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, {_cosine('x', 'y')} AS near_edited, {_cosine('x', 'w')} AS near_next FROM j"""


def _cosine(a: str, b: str) -> str:
    def dot(x, y):
        return f"list_sum(list_transform(range(1, {LANES + 1}), lambda i: {x}[i] * {y}[i]))::DOUBLE"

    size = f"{dot(a, a)} * {dot(b, b)}"
    return (f"CASE WHEN {a} = {b} THEN 1.0 WHEN {size} = 0 THEN 0.0 ELSE "
            f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, floor({dot(a, b)} / sqrt({size}) * 1e6 + 0.5) / 1e6)) END::DOUBLE")
