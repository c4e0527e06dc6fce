"""Truncated singular value decomposition of sparse rows, with both sides as tables.

Subspace iteration from hashed Gaussian columns (Halko, Martinsson and Tropp 2011): in a step every block of rows multiplies its
own part by the vectors of its terms and back, and the sums per term are the next vectors. They are made orthonormal by their Gram
matrix, twice, since once leaves rounding errors where the values fall fast. Only matrices of ``(k + oversample)²`` numbers reach
the driver; rows, terms and vectors never do.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from socialtext.operators import blocks
from socialtext.session import discarded, stored


@dataclass(frozen=True)
class SvdModel:
    """``terms``: ``term, weights``, the right singular vectors row by row, strongest first; ``values``: the singular values."""

    terms: DataFrame
    values: tuple[float, ...]


def _gaussian(key: Column, seed: int, width: int) -> Column:
    """Normal numbers from hashes of the key: the same for a term in every task and run."""
    def uniform(j: Column, salt: int) -> Column:
        return (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), j, F.lit(salt)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))

    return F.transform(F.sequence(F.lit(1), F.lit(width)),
                       lambda j: F.sqrt(-2 * F.ln(uniform(j, 0))) * F.cos(uniform(j, 1) * (2 * np.pi)))


def _there_and_back(rows: pa.Table, q: np.ndarray, entries) -> tuple[np.ndarray, np.ndarray]:
    """``Aᵀ A Q`` of one block: a line per term."""
    place, value, row = entries
    out = np.zeros_like(q)
    for at, _, local, starts in blocks.chunks(row):
        y = np.add.reduceat(value[at, None] * q[place[at]], starts)
        order = np.argsort(place[at], kind="stable")
        ranked = place[at][order]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        out[ranked[first]] += np.add.reduceat((value[at, None] * y[local])[order], first)
    return out, np.zeros(0)


def _projected(names: list[str]):
    """``A V`` of one block: a list per row, zeros where no term is known."""
    def run(rows: pa.Table, v: np.ndarray, entries) -> pa.Table:
        out = np.zeros((rows.num_rows, v.shape[1]))
        place, value, row = entries
        for at, here, _, starts in blocks.chunks(row):
            out[here] = np.add.reduceat(value[at, None] * v[place[at]], starts)
        return pa.table([*[rows.column(c) for c in names], blocks.lists_of(out)], names=[*names, "reduced"])

    return run


def _gram(vectors: DataFrame, width: int, name: str = "weights") -> np.ndarray:
    """Sum of the outer products of all lists; every task adds its own before one small shuffle."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = np.asarray(batch.column(0).flatten(), float).reshape(-1, width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), blocks.lists_of(total)], names=["i", "row"])

    parts = vectors.select(name).mapInArrow(run, "i int, row array<double>")
    found = {r["i"]: r["row"] for r in blocks.summed(parts, "i", width, "row").collect()}
    return np.array([found[i] for i in range(width)]) if found else np.zeros((width, width))


def _orthonormal(table: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Columns made orthonormal; directions below the precision of the Gram matrix are given up."""
    for _ in range(2):
        values, vectors = np.linalg.eigh(_gram(table, width))
        kept = values > max(values.max(initial=0.0), 0.0) * 1e-14
        turn = vectors[:, kept] / np.sqrt(values[kept])
        table, width = blocks.mapped(table, width, lambda m, _, turn=turn: m @ turn), int(kept.sum())
        if not width:
            break
    return stored(table, "svd-vectors"), width


def _rows(df: DataFrame, terms: Column, values: Column | None, keep: list[str]) -> DataFrame:
    empty = F.array().cast(df.select(terms).schema[0].dataType)
    columns = [F.coalesce(terms, empty).alias(blocks.TERMS), F.rand(0).alias("_u")]
    if values is not None:
        columns.append(F.coalesce(values, F.array()).cast("array<double>").alias(blocks.VALUES))
    return df.select(*keep, *columns)


def truncated_svd(df: DataFrame, terms: Column, values: Column | None = None, *, k: int = 50, oversample: int = 10,
                  steps: int = 4, seed: int = 24) -> SvdModel:
    """The ``k`` strongest singular values and right singular vectors of the rows.

    ``terms`` lists the columns in which a row is not zero (names or numbers, each once), ``values`` what stands there (1 if not
    given; null is 0). Each of the ``steps`` reads all rows once; values that lie closely together need more of them. Fewer than
    ``k`` values come back where the rows have a smaller rank. Null and empty lists are rows of zeros; an empty table has no values.
    """
    kept = stored(_rows(df, terms, values, []), "svd-rows")
    rows = blocks.dealt(kept, blocks.entry_count(kept))
    width = k + oversample
    names = rows.select(F.explode_outer(blocks.TERMS).alias("term")).where("term is not null").distinct()
    table = stored(names.select("term", _gaussian(F.col("term"), seed, width).alias("weights")), "svd-start")
    packed = blocks.pack(rows, table, width).kept()
    discarded(kept)
    for _ in range(steps):
        sums, _ = blocks.passed(packed, _there_and_back, width, lambda weights, sums, held: sums, "svd-sums")
        parts, width = _orthonormal(sums, width)
        discarded(sums)
        packed = packed.moved_on(parts, width)
        if not width:
            packed.without_rows()
            return SvdModel(table.limit(0), ())
    y = blocks.per_block(packed, _projected([]), "reduced array<double>")
    squares, turn = np.linalg.eigh(_gram(y, width, "reduced"))
    best = np.argsort(-squares)[: min(k, width)]
    best = best[squares[best] > squares.max() * 1e-14]
    packed = packed.without_rows().moved_on(stored(blocks.mapped(packed.weights, width, lambda m, _: m @ turn[:, best]), "svd-terms"), len(best))
    discarded(table)
    return SvdModel(packed.terms(), tuple(float(x) for x in np.sqrt(squares[best])))


def project(model: SvdModel, df: DataFrame, id_col: str, terms: Column, values: Column | None = None) -> DataFrame:
    """``id, reduced``: the rows times the right singular vectors; terms that the model does not know add nothing."""
    kept = stored(_rows(df, terms, values, [id_col]), "svd-rows")
    packed = blocks.pack(blocks.dealt(kept, blocks.entry_count(kept)), model.terms, len(model.values))
    discarded(kept)
    schema = T.StructType([df.schema[id_col], T.StructField("reduced", T.ArrayType(T.DoubleType()))])
    return blocks.per_block(packed, _projected([id_col]), schema)
