"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every task holds the postings of its own documents, a batch at a time. For each
term of an item the batch has one list of documents by falling impact. The lists
are read side by side; each document met is looked up in all lists of the item
(direct access), so its score is whole, and its places in all of them count as
seen. The best position of a list is the end of its unbroken run of seen places.
A document not met yet lies behind the best position of every list, so it scores
at most the sum of the impacts there: reading stops when that sum is strictly
below the k-th score found. Places seen by direct access push the best position
beyond the last place read, so the sum falls sooner than with last-read places.
The k best carry over from batch to batch of a task; the k best of all tasks are
merged in two steps.

The items are a stated query set: they are taken to the driver in blocks of at
most ``BLOCK_ITEMS``, and each block reads all documents.

Defined cases: a null text or one without terms matches nothing and is no
document of the statistics; equal rows of items are one item, rows that share an
``item_id`` but not the text are ranked apart; every row of documents is a
document of its own, those without an id come last among equal scores; a term
that every document holds may weigh 0, and no score of 0 is returned; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import staged

TOP = 20
BLOCK_ITEMS = 2_000      # items that one scan of the documents answers
BLOCK_TERMS = 200_000    # a block ends with the item that reaches so many distinct terms
STRIDE = 64              # places read from each list at a time, doubled from step to step
DENSE = 256              # lists from this length on are looked up by row, shorter ones by search
PARTS = 64               # of an item, in which its candidates are cut before they meet
# Bytes that end a term: all ASCII but digits and letters. Letters become small; other bytes are parts of letters.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text, in order and with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def term_weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with terms: its length, and what it holds of the vocabulary."""
    def run(batches):
        for batch in batches:
            ids, lengths, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                found = terms_of(text)
                if found:
                    tf: dict[int, int] = {}
                    for number in map(vocabulary.get, found):
                        if number is not None:
                            tf[number] = tf.get(number, 0) + 1
                    ids.append(doc_id)
                    lengths.append(len(found))
                    terms.extend(tf)
                    counts.extend(tf.values())
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists],
                                             ["doc_id", "n", "terms", "tfs"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class ImpactList:
    """Documents of one term in a batch: rows by falling impact, with access by row."""

    def __init__(self, rows: np.ndarray, impacts: np.ndarray, batch_rows: int):
        order = np.argsort(-impacts, kind="stable")
        self.rows, self.impacts = rows[order], impacts[order]
        self.by_row = None
        if len(rows) >= DENSE:
            self.by_row = np.full(batch_rows, -1, np.int32)
            self.by_row[self.rows] = np.arange(len(rows), dtype=np.int32)
        else:
            self.known = rows  # ascending
            self.places = np.empty(len(rows), np.int64)
            self.places[order] = np.arange(len(rows))

    def places_of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted rows are in the list, and their places."""
        if self.by_row is not None:
            places = self.by_row[wanted]
            inside = places >= 0
            return inside, places[inside]
        at = np.minimum(np.searchsorted(self.known, wanted), len(self.known) - 1)
        inside = self.known[at] == wanted
        return inside, self.places[at[inside]]


def best_positions(lists: list[tuple[ImpactList, int]], batch_rows: int, top: int, floor_score: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a score that may be among the ``top`` best, and these scores.

    ``lists`` holds (list, how often the item repeats the term). ``floor_score``
    is the score of the k-th document that earlier batches have given, or 0:
    nothing strictly below it is needed.
    """
    seen = [np.zeros(len(one.rows), bool) for one, _ in lists]
    best = [0] * len(lists)  # places before this one are all seen
    met = np.zeros(batch_rows, bool)
    rows, scores = [], []
    kth, read, stride = floor_score, 0, STRIDE
    while True:
        ahead = sum(times * int(one.impacts[at]) for (one, times), at in zip(lists, best) if at < len(one.rows))
        if ahead == 0 or ahead < kth:
            break
        parts = [one.rows[read:read + stride] for one, _ in lists if read < len(one.rows)]
        new = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        new = new[~met[new]]
        met[new] = True
        total = np.zeros(len(new), np.int64)
        for k, (one, times) in enumerate(lists):
            inside, places = one.places_of(new)
            total[inside] += times * one.impacts[places]
            seen[k][places] = True
            rest = seen[k][best[k]:]
            best[k] += len(rest) if rest.all() else int(rest.argmin())
        rows.append(new)
        scores.append(total)
        every = np.concatenate(scores)
        if len(every) >= top:
            kth = max(kth, int(np.partition(every, len(every) - top)[len(every) - top]))
        read, stride = read + stride, stride * 2
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, scores = np.concatenate(rows), np.concatenate(scores)
    keep = (scores >= kth) & (scores > 0)
    return rows[keep], scores[keep]


def _best(ids: np.ndarray, unnamed: np.ndarray, scores: np.ndarray, top: int):
    order = np.lexsort((ids, unnamed, -scores))[:top]
    return ids[order], unnamed[order], scores[order]


def _rank_batch(batch, items, weights, documents, terms, top, found):
    """Update ``found`` (per item: ids, unnamed, scores) by the documents of one batch."""
    ids = batch.column(0)
    unnamed = np.asarray(ids.is_null())
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    lengths = batch.column(1).to_numpy()
    holds = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
    flat, tf = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(ids)), holds)
    spread = 75 + (25 * lengths * documents) // terms
    impacts = weights[flat] * ((1_000_000_000 * tf) // (1000 * tf + 12 * spread[row]))
    order = np.argsort(flat, kind="stable")  # rows stay ascending inside a term
    flat, row, impacts = flat[order], row[order], impacts[order]
    numbers, starts = np.unique(flat, return_index=True)
    ends = np.append(starts[1:], len(flat))
    where = {int(t): (int(a), int(b)) for t, a, b in zip(numbers, starts, ends)}
    made: dict[int, ImpactList] = {}
    for number, wanted in enumerate(items):
        lists = []
        for term, times in wanted:
            if term in where:
                if term not in made:
                    a, b = where[term]
                    made[term] = ImpactList(row[a:b], impacts[a:b], len(ids))
                lists.append((made[term], times))
        old = found[number]
        kth = int(old[2][-1]) if old is not None and len(old[2]) == top else 0
        rows, scores = best_positions(lists, len(ids), top, kth)
        if len(rows):
            new = (ids[rows], unnamed[rows], scores)
            found[number] = _best(*(new if old is None else map(np.concatenate, zip(old, new))), top)


def _rank_block(documents: DataFrame, block: list[tuple], top: int) -> DataFrame:
    spark = documents.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for _, text in block:
        wanted: dict[int, int] = {}
        for term in terms_of(text):
            number = vocabulary.setdefault(term, len(vocabulary))
            wanted[number] = wanted.get(number, 0) + 1
        items.append(sorted(wanted.items()))
    kept = staged(postings(documents, vocabulary), "postings")
    size = kept.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_documents, n_terms = size[0], size[1] or 1
    holding = np.zeros(len(vocabulary), np.int64)  # bounded by the block, not by the documents
    for number, count in kept.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[number] = count
    weights = np.array([term_weight(n_documents, int(x)) for x in holding], np.int64)

    def run(batches):
        found = [None] * len(items)
        for batch in batches:
            _rank_batch(batch, items, weights, n_documents, n_terms, top, found)
        for number, one in enumerate(found):
            if one is not None:
                ids, unnamed, scores = one
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), number, np.int32)), pa.array(ids, pa.int64(), mask=unnamed), pa.array(scores, pa.int64())],
                    ["item", "doc_id", "score"])

    ranked = kept.filter(F.size("terms") > 0).mapInArrow(run, "item int, doc_id long, score long")
    ordered = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = ranked.withColumn("part", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(PARTS)))
    for keys in (["item", "part"], ["item"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered))).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], "item int, item_id long")
    # One row for each item of the block, at most BLOCK_ITEMS.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _blocks(items: DataFrame):
    block, terms = [], set()
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct().toLocalIterator():
        block.append((row["item_id"], row["text"]))
        terms.update(terms_of(row["text"]))
        if len(block) >= BLOCK_ITEMS or len(terms) >= BLOCK_TERMS:
            yield block
            block, terms = [], set()
    if block:
        yield block


def rank_documents(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` best documents of every item."""
    blocks = [_rank_block(documents, block, top) for block in _blocks(items)]
    if len(blocks) > 1:
        blocks = [staged(one, "ranked") for one in blocks]
    if not blocks:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = blocks[0]
    for one in blocks[1:]:
        result = result.unionByName(one)
    return result
