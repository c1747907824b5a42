"""Substring deduplication by content-defined chunks.

A gear hash rolls over the words of a text: each step shifts it by ``SHIFT`` bits
and adds the word's gear, so it depends on the last ``ROLL`` words alone. A cut
falls where the hash is the least of some ``SPREAD`` neighbouring positions. Cuts thus
move with the text when something is inserted before them, chunks between cuts
vary from 1 to ``SPREAD`` words, and any passage of ``PASSAGE`` words has a cut
whose whole roll lies inside it. A chunk's digest is that of the roll that closes
it: the chunk and the words just before. Chunks whose digest occurs in another
document are repeated, and runs of them make spans.

A run may be shorter than the passage it comes from, by up to ``SPREAD`` - 1 words
at either end. The ends are therefore found exactly: around the first and the last
cut of every run, and around all cuts of runs below ``PASSAGE`` words, every window
of ``PASSAGE`` words is digested, in all documents that have such a cut, and those
found in another document are added; runs below ``PASSAGE`` words count by these
windows alone. So every passage of ``PASSAGE`` words or more that two documents share
is found to its last word, and shorter ones are left alone.

Defined cases: null, blank and short texts have no chunks; rows with equal
``doc_id`` and text are one document; repeats inside one document do not count;
a null ``doc_id`` is reported as null; empty tables give an empty result. Spans
count code points, end exclusive. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import spread_join, staged

SHIFT, ROLL = 2, 32   # 64 bits shifted by two forget a word after 32 steps
PASSAGE = 50
SPREAD = PASSAGE - ROLL + 1
BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\f\r", np.uint8))


def word_bounds(raw: bytes) -> np.ndarray:
    """Byte offsets (start, end) of the words, one row each."""
    edges = np.flatnonzero(np.diff(~BLANK[np.frombuffer(raw, np.uint8)], prepend=False, append=False))
    return edges.reshape(-1, 2)


def code_points(raw: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets as offsets in code points."""
    if raw.isascii():
        return at
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return before[at]


def gear_hashes(gears: np.ndarray) -> np.ndarray:
    """Rolling hash at each position from the last ``ROLL`` gears; built by doubling the span it covers."""
    out, span = gears.copy(), 1
    while span < ROLL:
        longer = out.copy()
        longer[span:] += out[:-span] << np.uint64(SHIFT * span)
        out, span = longer, span * 2
    return out


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or largest of each ``width`` neighbours, by doubling the span compared."""
    span = 1
    while span * 2 <= width:
        values, span = pick(values[:-span], values[span:]), span * 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def cuts(gears: np.ndarray) -> np.ndarray:
    """Positions of the words that close a chunk: those least among some ``SPREAD`` neighbours."""
    if len(gears) < PASSAGE:
        return np.empty(0, np.int64)
    hashes = gear_hashes(gears)[ROLL - 1:]
    least = _extreme(hashes, SPREAD, np.minimum)
    around = np.zeros(len(least) + 2 * (SPREAD - 1), np.uint64)
    around[SPREAD - 1:SPREAD - 1 + len(least)] = least
    return np.flatnonzero(_extreme(around, SPREAD, np.maximum) == hashes) + ROLL - 1


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.filter("text IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def chunk_cuts(documents: DataFrame) -> DataFrame:
    """(row, doc_id, digest, last, start, end) of every chunk: its closing word, and the span of its roll."""
    rows = _keyed(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        gears: dict[bytes, int] = {}
        for batch in batches:
            ids, keys, texts = (batch.column(k) for k in range(3))
            out, count = [[], [], [], []], []
            for text in texts.to_pylist():
                raw = text.encode()
                found = raw.split()
                for word in set(found):
                    if word not in gears:
                        gears[word] = xxhash.xxh64_intdigest(word, 1)
                last = cuts(np.fromiter(map(gears.__getitem__, found), np.uint64, len(found)))
                count.append(len(last))
                if len(last):
                    bounds = word_bounds(raw)
                    joined = b" ".join(found)
                    ends = np.cumsum(bounds[:, 1] - bounds[:, 0] + 1) - 1
                    starts = np.concatenate([[0], ends[:-1] + 1])
                    digests = [xxhash.xxh64_intdigest(joined[starts[k - ROLL + 1]:ends[k]], 7) for k in last]
                    for column, part in zip(out, (np.array(digests, np.uint64).view(np.int64), last,
                                                  code_points(raw, bounds[last - ROLL + 1, 0]), code_points(raw, bounds[last, 1]))):
                        column.append(part)
                if len(gears) > 200_000:
                    gears.clear()
            pick = pa.array(np.repeat(np.arange(len(count)), count), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pick), ids.take(pick), *(pa.array(np.concatenate([*c, np.empty(0, np.int64)]).astype(np.int64)) for c in out)],
                ["row", "doc_id", "digest", "last", "start", "end"])

    return rows.select("doc_id", "row", "text").mapInArrow(
        run, f"row long, doc_id {kind}, digest long, last long, start long, end long")


def _with_repeats(rows: DataFrame, label: str) -> DataFrame:
    """The rows whose digest is found in more than one document, with ``first_doc_id``; hot digests are dealt over tasks."""
    repeated = (rows.groupBy("digest").agg(F.min("row").alias("x"), F.max("row").alias("y"), F.min("doc_id").alias("first_doc_id"),
                                           F.count(F.lit(1)).alias("_rows"))
                .filter("x <> y").select("digest", "first_doc_id", "_rows"))
    repeated = staged(repeated, label)
    return spread_join(rows, repeated.drop("_rows"), ["digest"], counts=repeated.select("digest", "_rows"))


def _runs(rows: DataFrame) -> DataFrame:
    """Numbers the runs of overlapping or touching word ranges [first, last] of each row as ``run``."""
    before = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    reach = rows.withColumn("reach", F.max("last").over(before))
    opens = F.when(F.col("reach").isNull() | (F.col("first") > F.col("reach") + 1), 1).otherwise(0)
    return reach.withColumn("opens", opens).withColumn("run", F.sum("opens").over(upto)).drop("reach", "opens")


def _merged(rows: DataFrame) -> DataFrame:
    return _runs(rows).groupBy("row", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("doc_id").alias("doc_id"), F.min("first_doc_id").alias("first_doc_id"))


def passage_windows(documents: DataFrame, around: DataFrame) -> DataFrame:
    """All windows of ``PASSAGE`` words that hold the roll closed by a cut of ``around`` (row, last)."""
    wanted = around.groupBy("row").agg(F.collect_set("last").alias("cuts"))
    rows = _keyed(documents).join(wanted, "row").select("doc_id", "row", "text", "cuts")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for doc_id, row, text, at in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw = text.encode()
                bounds = word_bounds(raw)
                found = raw.split()
                first = sorted({k for c in at for k in range(max(0, c - PASSAGE + 1), min(c - ROLL + 1, len(found) - PASSAGE) + 1)})
                if not first:
                    continue
                joined, ends = b" ".join(found), np.cumsum(bounds[:, 1] - bounds[:, 0] + 1) - 1
                starts = np.concatenate([[0], ends[:-1] + 1])
                digests = np.array([xxhash.xxh64_intdigest(joined[starts[k]:ends[k + PASSAGE - 1]], 7) for k in first], np.uint64)
                first = np.array(first)
                last = first + PASSAGE - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(first), pa.int64()), pa.array([doc_id] * len(first), batch.schema.field(0).type),
                     pa.array(digests.view(np.int64)), pa.array(first), pa.array(last),
                     pa.array(code_points(raw, bounds[first, 0])), pa.array(code_points(raw, bounds[last, 1]))],
                    ["row", "doc_id", "digest", "first", "last", "start", "end"])

    return rows.mapInArrow(run, f"row long, doc_id {kind}, digest long, first long, last long, start long, end long")


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, start, end, n_words and first_doc_id of every passage that another document holds too.

    ``first_doc_id`` is the least id among the documents that share a part of the
    span: where it is the row's own, this is the copy to keep.
    """
    documents = documents.select("doc_id", "text")
    chunks = staged(chunk_cuts(documents), "chunks")
    shared = staged(_with_repeats(chunks, "digests").withColumn("first", F.col("last") - ROLL + 1), "repeated")
    numbered = _runs(shared)
    runs = Window.partitionBy("row", "run")
    begins, ends = F.min("last").over(runs), F.max("last").over(runs)
    sized = numbered.withColumn("n", ends - F.min("first").over(runs) + 1).withColumn("edge", (F.col("last") == begins) | (F.col("last") == ends))
    sized = staged(sized, "runs")
    # Cuts of short runs and those at the ends of long ones, wherever they occur, are checked with whole windows.
    edges = sized.filter((F.col("n") < PASSAGE) | F.col("edge")).groupBy("digest").agg(F.lit(1).alias("_edge")).select("digest")
    around = spread_join(sized.select("digest", "row", "last"), edges, ["digest"])
    windows = staged(passage_windows(documents, around.select("row", "last")), "windows")
    confirmed = _with_repeats(windows, "window-digests")
    columns = ["row", "doc_id", "first", "last", "start", "end", "first_doc_id"]
    spans = _merged(sized.filter(F.col("n") >= PASSAGE).select(*columns).unionByName(confirmed.select(*columns)))
    return spans.select("doc_id", "start", "end", (F.col("last") - F.col("first") + 1).alias("n_words"), "first_doc_id")
