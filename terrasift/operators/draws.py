"""Bags of many trees, drawn row by row in one Arrow stage.

A row is in a tree as often as a Poisson draw with mean 1 from the hash of the row
and the tree says. Rows and label sums of every combination of bins are added up in
the task, so that neither a row's draws nor its copies ever leave it.
"""

from __future__ import annotations

import math
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_ROWS = 500_000    # rows that a task draws at a time
HELD_CELLS = 2_000_000  # sums, of all trees, that a task holds before it hands them on
BLOCK = 32_768          # rows whose hashes stay in the processor's cache
LABEL, BASE, GROUP, SUM = "_y", "_base", "_group", "_s"
MOST_COPIES = 12  # a draw above it has probability below 1e-9, less than the 32 bits of a hash can tell apart
POISSON = [sum(exp(-1.0) / factorial(i) for i in range(k + 1)) for k in range(MOST_COPIES)]
FIRST, SECOND, THIRD, FIFTH = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5  # primes of XXH64


def tree_copies(base: np.ndarray, tree: int) -> np.ndarray:
    """Copies of rows in a tree: Poisson numbers of ``xxhash64(seed, row key, tree)``, given ``xxhash64(seed, row key)``."""
    limits = np.array([math.ceil(p * 2 ** 53) for p in POISSON], np.uint64)
    out = np.empty(len(base))
    mark = np.uint64(tree * FIRST % 2 ** 64)
    for at in range(0, len(base), BLOCK):
        h = base[at:at + BLOCK].view(np.uint64) + np.uint64((FIFTH + 4) % 2 ** 64)
        h ^= mark
        high = h >> np.uint64(41)
        h <<= np.uint64(23)
        h |= high
        h *= np.uint64(SECOND)
        h += np.uint64(THIRD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(SECOND)
        h ^= h >> np.uint64(29)
        h *= np.uint64(THIRD)
        h ^= h >> np.uint64(32)
        h >>= np.uint64(11)
        number = (h >= limits[0]).astype(np.int8)
        for limit in limits[1:4]:
            number += h >= limit
        rare = np.flatnonzero(h >= limits[4])
        number[rare] = np.searchsorted(limits, h[rare], "right")
        out[at:at + BLOCK] = number
    return out


def merged(group, names, rows, sums) -> tuple:
    """Equal combinations added up. Those whose hash is equal lie together; only equal values are one."""
    order = np.argsort(group, kind="stable")
    group, names = group[order], names[:, order]
    starts = np.flatnonzero(np.r_[True, (names[:, 1:] != names[:, :-1]).any(axis=0)])
    return group[starts], names[:, starts], np.add.reduceat(rows[:, order], starts, axis=1), np.add.reduceat(sums[:, order], starts, axis=1)


def chunk_sums(group, names, label, base, trees) -> tuple:
    """Hash and values of the combinations in a chunk, and their rows and label sums for each tree."""
    order = np.argsort(group, kind="stable")
    group, names, label, base = group[order], names[:, order], label[order], base[order]
    starts = np.flatnonzero(np.r_[True, (names[:, 1:] != names[:, :-1]).any(axis=0)])
    rows, sums = np.empty((len(trees), len(starts))), np.empty((len(trees), len(starts)))
    with np.errstate(invalid="ignore"):
        for k, tree in enumerate(trees):
            number = tree_copies(base, tree)
            rows[k] = np.add.reduceat(number, starts)
            sums[k] = np.add.reduceat(number * label, starts)
    return group[starts], names[:, starts], rows, sums


def drawn_sums(rows: DataFrame, names, trees, tree_col: str, rows_col: str) -> DataFrame:
    """Tree, ``names``, rows drawn and the sum of their labels; a combination may come in several parts.

    ``rows`` has ``names``, the label, the hash of seed and row and that of ``names``.
    """
    names, trees = list(names), list(trees)
    kinds = [rows.schema[n].dataType.simpleString() for n in names]
    types = [pa.int32() if k == "int" else pa.float64() for k in kinds]
    columns = [*names, LABEL, BASE, GROUP]

    def handed_on(held):
        _, values, number, sums = held
        for k, tree in enumerate(trees):
            some = np.flatnonzero(number[k] > 0)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), tree, np.int32)), *[pa.array(v[some]).cast(t) for v, t in zip(values, types)],
                     pa.array(number[k][some]), pa.array(sums[k][some])], [tree_col, *names, rows_col, SUM])

    def summed(parts):
        table = pa.Table.from_batches(parts)
        values = np.vstack([table[n].to_numpy().astype(float) for n in names])
        return chunk_sums(table[GROUP].to_numpy(), values, table[LABEL].to_numpy(), table[BASE].to_numpy(), trees)

    def work(batches):
        held, parts, size = None, [], 0

        def add():
            found = summed(parts)
            return found if held is None else merged(*[np.concatenate(p, axis=-1) for p in zip(held, found)])
        for batch in batches:
            parts.append(batch)
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                held = add()
                parts, size = [], 0
                if held[2].size > HELD_CELLS:
                    yield from handed_on(held)
                    held = None
        if size:
            held = add()
        if held is not None:
            yield from handed_on(held)

    schema = ", ".join([f"{tree_col} int", *[f"{n} {k}" for n, k in zip(names, kinds)], f"{rows_col} double", f"{SUM} double"])
    return rows.select(*columns).mapInArrow(work, schema)
