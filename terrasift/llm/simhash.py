"""SimHash near-duplicates with pivot distance tables.

Each distinct fingerprint carries its Hamming distances to fixed reference
fingerprints. By the triangle inequality two fingerprints within ``RADIUS`` bits
differ by no more than ``RADIUS`` in any of these coordinates, so a pair whose
largest coordinate difference is above it is discarded without looking at its
bits, and only survivors are verified.

The pairs looked at share all bits of some blocks: ``RADIUS`` differing bits
touch at most ``RADIUS`` blocks, so with more blocks than that the others are
equal, and no link is lost. Equal fingerprints are one class from the start; a
block value that many classes share is compared in tiles of bounded size.

Defined cases: a null or blank text has fingerprint zero, linked like any other;
rows with a null ``doc_id`` take part and get the least id of their component,
null if it has none; repeated rows stay repeated; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import shuffle_partitions, spread_join, staged
from terrasift.llm.components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
PIVOTS = 24
GROUP_LIMIT = 512   # classes with one block value that a single pass compares; more go to tiles
TILE = 2048          # classes on a side of a tile
ROWS_PER_TASK = 30_000
PENDING = 200_000    # links a task holds before it joins them
HOT_ROWS = 500       # classes of a component, or documents of a class, that need no dealing
MEAN_GROUP = 64      # block values are made so wide that unrelated classes meet in groups of about this size


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints by rule: the hashes of the numbers from 0."""
    return np.array([xxhash.xxh64_intdigest(str(k), SEED) for k in range(count)], np.uint64)


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the 4-word shingles of a whole text."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change and only ASCII white space cuts
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = list(accumulate(map(len, found), lambda at, size: at + 1 + size))
        starts = [0, *(end + 1 for end in ends)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 65_536):
        counts += np.unpackbits(values[at:at + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(values), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(x) for x in batch.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    chosen = documents.select("doc_id", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, fp long")


def block_scheme(classes: int) -> list[list[tuple[int, int]]]:
    """Keys as lists of (shift, bits) of the blocks whose equality they ask for, wide enough for so many classes."""
    for spare in range(1, 5):
        count = RADIUS + spare
        sizes = [64 // count + (k < 64 % count) for k in range(count)]
        shifts = [sum(sizes[:k]) for k in range(count)]
        if classes <= MEAN_GROUP * 2 ** (64 * spare // count) or spare == 4:
            keys = [[(shifts[k], sizes[k]) for k in chosen] for chosen in combinations(range(count), spare)]
            assert len(keys) == comb(count, spare)
            return keys


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label``, the least index reachable from each row so far, after the links i-j are added."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _survivors(values: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are links: the pivot table discards first, the bits decide.

    A pivot that discards next to nothing shows a dense group, and the rest of the table is left out.
    """
    keep = np.arange(len(i))
    for column in table.T:
        left = keep[np.abs(column[i[keep]] - column[j[keep]]) <= RADIUS]
        dense, keep = len(left) > 0.9 * len(keep), left
        if dense:
            break
    return keep[np.bitwise_count(values[i[keep]] ^ values[j[keep]]) <= RADIUS]


def _distances(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ pivots()[None, :]).astype(np.int8)


def _stars(values: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    linked = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": values[linked].view(np.int64), "b": values[label[linked]].view(np.int64)})


def _compare_groups(rows: pd.DataFrame) -> pd.DataFrame:
    """Links inside each (key, value) group of some rows, as stars, so that there are at most as many as rows."""
    rows = rows.sort_values(["key", "value", "fp"], kind="stable")
    group = rows.groupby(["key", "value"], sort=False).ngroup().to_numpy()
    values = rows["fp"].to_numpy(np.int64).view(np.uint64)
    table = _distances(values)
    label, step, pending = np.arange(len(rows)), 1, []
    at = np.arange(len(rows) - 1)
    while len(at := at[at + step < len(rows)]) and len(at := at[group[at] == group[at + step]]):
        new = at[label[at] != label[at + step]]  # rows joined already need no comparison
        new = new[_survivors(values, table, new, new + step)]
        pending.append((new, new + step))
        if sum(len(x) for x, _ in pending) > PENDING:
            label, pending = _joined(label, *map(np.concatenate, zip(*pending))), []
        step += 1
    if pending:
        label = _joined(label, *map(np.concatenate, zip(*pending)))
    return _stars(values, label)


def _compare_tile(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the two sides of one tile (or inside it, if they are one), again as stars."""
    rows = rows.drop_duplicates("fp").sort_values("fp", kind="stable")
    values = rows["fp"].to_numpy(np.int64).view(np.uint64)
    table = _distances(values)
    label, size = np.arange(len(values)), 64
    for low in range(0, len(values), size):
        i, j = np.nonzero(label[low:low + size, None] != label[None, :])
        keep = _survivors(values, table, i + low, j)
        label = _joined(label, i[keep] + low, j[keep])
    return _stars(values, label)


def links(classes: DataFrame, group_limit: int = GROUP_LIMIT, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join the same classes as all pairs within ``RADIUS`` bits do; ``classes`` has distinct ``fp``."""
    spark = classes.sparkSession
    keys = block_scheme(classes.count())

    def value(blocks):
        cut = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(2 ** bits - 1)) for low, bits in blocks]
        out, used = cut[0], blocks[0][1]
        for part, (_, bits) in zip(cut[1:], blocks[1:]):
            out, used = out.bitwiseOR(F.shiftleft(part, used)), used + bits
        return out

    made = F.array(*[F.struct(F.lit(k).alias("key"), value(blocks).alias("value")) for k, blocks in enumerate(keys)])
    rows = classes.select("fp", F.inline(made))
    sizes = staged(rows.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    parts = max(shuffle_partitions(spark), -(-(sizes.filter(F.col("n") <= group_limit).agg(F.sum("n")).first()[0] or 0) // ROWS_PER_TASK))
    found = (rows.join(sizes.filter(F.col("n") <= group_limit).drop("n"), ["key", "value"])
             .withColumn("part", F.pmod(F.xxhash64("key", "value"), F.lit(parts)))
             .groupBy("part").applyInPandas(lambda x: _compare_groups(x), "a long, b long"))
    # A hot value: its classes are dealt into chunks by hash, and each pair of chunks is one tile.
    hot = rows.join(sizes.filter(F.col("n") > group_limit), ["key", "value"])
    chunks = F.ceil(F.col("n") / tile).cast("long")
    hot = hot.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    tiles = hot.select("key", "value", "fp", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
    tiles = tiles.select("key", "value", "fp", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"))
    return found.unionByName(tiles.groupBy("key", "value", "x", "y").applyInPandas(lambda x: _compare_tile(x), "a long, b long"))


def simhash_groups(documents: DataFrame, **settings) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = staged(with_fingerprints(documents), "fingerprints")
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("_rows")), "classes")
    roots = components(links(classes.select("fp"), **settings))
    lowest = staged(classes.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    # A component may hold any share of the classes, and a class any share of the documents.
    ids = staged(lowest.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_rows")), "components")
    ids = spread_join(lowest.select("fp", "root"), ids.drop("_rows"), ["root"], counts=ids.select("root", "_rows"), hot_rows=HOT_ROWS)
    rows = spread_join(prints, ids.select("fp", "component_id"), ["fp"], counts=classes.select("fp", "_rows"), hot_rows=HOT_ROWS)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(documents: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: the one with the least ``doc_id``.

    Of rows that repeat this id one stays. A row without an id stays only where its
    component has no id at all, and of such rows with one fingerprint one stays.
    """
    own = documents.columns
    groups = staged(simhash_groups(documents, **settings), "groups")
    firsts = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    firsts = staged(firsts.withColumnRenamed("doc_id", "_first"), "firsts")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    first = F.col("_row.doc_id") == F.col("_first")
    # The ids kept grow with the documents, so they are joined by shuffle at every size.
    kept = rows.join(firsts.filter("_n = 1").hint("merge"), first, "left_semi")
    if firsts.filter("_n > 1").take(1):
        again = rows.join(firsts.filter("_n > 1"), first, "left_semi")
        kept = kept.unionByName(again.withColumn("_id", F.col("_row.doc_id")).dropDuplicates(["_id"]).select("_row"))
    nameless = groups.filter("component_id IS NULL").select(F.col("fingerprint").alias("_print")).distinct()
    if nameless.take(1):
        unnamed = with_fingerprints(documents.filter("doc_id IS NULL").select(F.col("text").alias("doc_id"), "text"))
        hexed = unnamed.select(F.col("doc_id").alias("_text"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("_print")).distinct()
        hexed = hexed.join(nameless, "_print").groupBy("_print").agg(F.min(F.struct(F.col("_text").isNull(), "_text")).alias("_least"))
        texts = hexed.select(F.col("_least._text").alias("_text"))
        alone = rows.filter("_row.doc_id IS NULL").join(texts, F.col("_row.text").eqNullSafe(F.col("_text")), "left_semi")
        kept = kept.unionByName(alone.withColumn("_id", F.col("_row.text")).dropDuplicates(["_id"]).select("_row"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in own])
