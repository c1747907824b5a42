"""N-gram Jaccard join by grouped prefixes.

A document's set is its distinct 5-word shingles; sets that share 80 % of their
union are linked. Shingles are ordered from rare to frequent. Two linked sets
share a shingle among the first ``n - ceil(0.8 n) + 1`` of each, its prefix.

1. Shingles are counted over all documents in ``BUCKETS`` hashed buckets. The
   order by (bucket count, hash) is the same for all sets, which is all that the
   prefixes need; the counts only keep frequent shingles out of them.
2. Documents with equal sets are one class, classes with equal size and prefix
   are one group. Only prefix shingles of at least two groups go on.
3. Groups that share a prefix shingle are filtered by size, by the overlap that
   the places of the shingle leave possible, and by parity bitmaps of their sets,
   whose differing bits are a lower bound of the differing shingles. Groups left
   with a partner are expanded to their classes and verified by their whole sets.

Pairs are not enumerated. Each bucket of a shingle is first compared with one pivot
group, which joins most near copies; what is then still apart in some bucket is
compared in cells of two bounded chunks of classes. A cell holds the
sets of both chunks, finds all overlaps from the common shingles and returns a
tree of the links, so no link between different texts is lost.

Shingles are 64-bit hashes of their words; a class is known by 128 bits of its set.

Defined cases: a null or blank text has no set and is linked with nothing; fewer
than five words are one shingle; rows with a null ``doc_id`` take part and get the
least id of their component, null if it has none; repeated rows stay repeated; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import shuffle_partitions, spread_join, staged
from terrasift.llm.components import components

WORDS = 5
PERCENT = 80                # of the union that linked sets share
BUCKETS = 1 << 20           # counters of hashed shingles; the driver and every task hold them, 8 MB
SLICE = 1 << 14             # counters that are summed together
TESTS = 2_048               # groups of one bucket that look for a partner by bitmaps; in larger buckets the others stay untested
CHUNK_SHINGLES = 200_000    # shingles of the classes on one side of a cell
ROUNDS = 1                  # of pivots
CACHED_WORDS = 100_000      # word hashes a task keeps
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes; hashes of words are kept from text to text."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change and only ASCII white space cuts
        if not found:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(found).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        size = min(WORDS, len(found))
        mixed = np.full(len(found) - size + 1, size, np.uint64)
        for k in range(size):
            mixed = mixed + hashes[k:len(found) - size + 1 + k] * MIX[k]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[(k + 1) % WORDS]
        return np.unique(mixed.view(np.int64))


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(44)).astype(np.int64)  # 20 bits


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def count_buckets(documents: DataFrame) -> np.ndarray:
    """How many sets hold a shingle of each bucket, over all documents; ``BUCKETS`` numbers at any size."""
    def count(batches):
        shingles, counts, held, size = Shingler(), np.zeros(BUCKETS, np.int32), [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingles(text.as_py()))
                size += len(held[-1])
                if size > BUCKETS:
                    counts += np.bincount(bucket(np.concatenate(held)), minlength=BUCKETS).astype(np.int32)
                    held, size = [], 0
        if held:
            counts += np.bincount(bucket(np.concatenate(held)), minlength=BUCKETS).astype(np.int32)
        for k, part in enumerate(counts.reshape(-1, SLICE)):
            yield slices([k], [part.tobytes()])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(k, np.zeros(SLICE, np.int64))
                sums[k] += np.frombuffer(part.as_buffer(), np.int32)
        for k, total in sums.items():
            yield slices([k], [total.tobytes()])

    def slices(numbers, parts):
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    spark = documents.sparkSession
    parts = documents.select("text").mapInArrow(count, "slice int, counts binary")
    found = parts.repartition(min(BUCKETS // SLICE, shuffle_partitions(spark)), "slice").mapInArrow(add, "slice int, counts binary").toArrow()
    total = np.zeros(BUCKETS, np.int64)
    for k, part in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        total[k * SLICE:(k + 1) * SLICE] = np.frombuffer(part, np.int64)
    return total


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """One bit for each value of the low bits of a shingle, set if an odd number of shingles has it; a bit a shingle, or up to two."""
    bits = 1 << max(6, (len(tokens) - 1).bit_length())
    return np.packbits(np.bincount(tokens & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def mark_documents(documents: DataFrame, counts: np.ndarray) -> DataFrame:
    """Per document its ``key``, set size ``n``, class (c0, c1), group ``gid``, ``prefix`` and ``bitmap``; these two are
    null where the same part of the table has given the group before."""
    def halves(values: np.ndarray) -> tuple[int, int]:
        low = xxhash.xxh3_128_intdigest(values.tobytes())
        return tuple(x - (1 << 64) if x >> 63 else x for x in (low >> 64, low & (1 << 64) - 1))

    def run(batches):
        shingles, given = Shingler(), set()
        for batch in batches:
            sizes, c0, c1, gids, prefixes, bitmaps = [], [], [], [], [], []
            for text in batch.column(2):
                tokens = shingles(text.as_py())
                n = len(tokens)
                one, two = halves(tokens)
                kept = None
                if n:
                    size = prefix_length(n)
                    by = np.lexsort((tokens, counts[bucket(tokens)]))[:size]
                    kept = tokens[by]
                    gid = halves(np.append(kept, n))[0]
                sizes.append(n)
                c0.append(one)
                c1.append(two)
                gids.append(gid if n else None)
                new = n > 0 and gid not in given
                prefixes.append(kept if new else None)
                bitmaps.append(parity_bitmap(tokens) if new else None)
                if new:
                    given.add(gid)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (sizes, c0, c1, gids)],
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())],
                ["doc_id", "key", "n", "c0", "c1", "gid", "prefix", "bitmap"])

    return keyed(documents).mapInArrow(run, "doc_id long, key long, n long, c0 long, c1 long, gid long, prefix array<long>, bitmap binary")


def keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, key, text): a number by which the text is found again, without an id the hash of the text."""
    doc_id = F.col("doc_id").cast("long")
    return documents.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.xxhash64("text")).alias("key"), F.col("text"))


def shared_entries(marks: DataFrame) -> DataFrame:
    """(token, gid, n, place) of the prefix shingles that two groups or more have.

    The entries are sorted in ranges, so that a shingle of very many groups
    spreads over several; at the ends of a range all entries are kept.
    """
    def run(batches):
        last, needed, first_token = None, False, None  # the last row so far, held back until its successor is known
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            if last is not None:
                rows = np.concatenate([last, rows])
            if not len(rows):
                continue
            rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))]  # a group given by several parts
            first_token = rows[0, 0] if first_token is None else first_token
            same = rows[1:, 0] == rows[:-1, 0]
            wanted = np.append(same, False) | np.append(needed, same) | (rows[:, 0] == first_token)
            last, needed = rows[-1:], bool(wanted[-1])
            yield batch_of(rows[:-1][wanted[:-1]])
        if last is not None:
            yield batch_of(last)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[:, k], pa.int64()) for k in range(4)], ["token", "gid", "n", "place"])

    spark = marks.sparkSession
    every = marks.filter("prefix IS NOT NULL").select("gid", "n", F.posexplode("prefix").alias("place", "token"))
    every = every.select("token", "gid", "n", F.col("place").cast("long").alias("place"))
    ranges = every.repartitionByRange(shuffle_partitions(spark), "token", "gid").sortWithinPartitions("token", "gid")
    return ranges.mapInArrow(run, "token long, gid long, n long, place long")


def _fold(bitmaps: np.ndarray, length: int) -> np.ndarray:
    while bitmaps.shape[1] > length:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


FEW = 16  # groups of a bucket that are compared one by one


def _partnered_few(n, place, bitmaps: list) -> list:
    """The same as :func:`partnered` for small buckets, with bitmaps as whole numbers."""
    maps = [int.from_bytes(one) for one in bitmaps]
    bits = [8 * len(one) for one in bitmaps]
    keep = [False] * len(n)
    for j in range(1, len(n)):
        for i in range(j):
            x, y, total = n[i], n[j], n[i] + n[j]
            if keep[i] and keep[j] or 100 * min(x, y) < PERCENT * max(x, y):
                continue
            if (100 + PERCENT) * (min(place[i], place[j]) + min(x - place[i], y - place[j])) < PERCENT * total:
                continue
            a, b, wide, short = maps[i], maps[j], bits[i], bits[j]
            if wide < short:
                a, b, wide, short = b, a, short, wide
            while wide > short:
                wide //= 2
                a = (a >> wide) ^ (a & (1 << wide) - 1)
            if (100 + PERCENT) * (a ^ b).bit_count() <= (100 - PERCENT) * total:
                keep[i] = keep[j] = True
    return keep


def partnered(n: np.ndarray, place: np.ndarray, bitmaps: list) -> np.ndarray:
    """Which groups of a bucket may be linked with another one of it."""
    keep = np.array([one is None for one in bitmaps])  # several classes: no bitmap holds for all
    if keep.any():
        return np.ones(len(n), bool)
    lengths = np.array([len(one) for one in bitmaps])
    where = {int(length): np.flatnonzero(lengths == length) for length in np.unique(lengths)}
    tables = {length: np.frombuffer(b"".join(bitmaps[k] for k in at), np.uint8).reshape(len(at), length) for length, at in where.items()}
    for tested, k in enumerate(range(len(n))):
        if keep[k]:
            continue
        if tested >= TESTS:
            return np.ones(len(n), bool)
        ahead = np.minimum(place[k], place) + np.minimum(n[k] - place[k], n - place)
        fits = (100 * np.minimum(n[k], n) >= PERCENT * np.maximum(n[k], n)) & ((100 + PERCENT) * ahead >= PERCENT * (n[k] + n))
        fits[k] = False
        own = np.frombuffer(bitmaps[k], np.uint8)[None, :]
        for length, at in where.items():
            some = np.flatnonzero(fits[at])
            if len(some):
                short = min(length, own.shape[1])
                apart = np.bitwise_count(_fold(tables[length][some], short) ^ _fold(own, short)).sum(axis=1, dtype=np.int64)
                found = at[some[(100 + PERCENT) * apart <= (100 - PERCENT) * (n[k] + n[at[some]])]]
                keep[found] = True
                keep[k] |= len(found) > 0
    return keep


def surviving_entries(entries: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The entries whose group may be linked with another group of the bucket. ``bitmaps``: (gid, bitmap), at most one a group.

    Buckets are read in ranges; those at the ends of a range may go on in the next and stay whole.
    """
    def run(batches):
        token, held, first = None, [], True
        for batch in batches:
            out = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if row[0] != token:
                    out += judged(held, first)
                    first, token, held = token is None, row[0], []
                held.append(row)
            yield batch_of(out)
        yield batch_of(held)

    def judged(held, whole):
        if whole or not held:
            return held
        if len(held) == 1:
            return []
        _, _, n, place, maps = zip(*held)
        few = len(held) <= FEW and None not in maps
        keeps = _partnered_few(n, place, maps) if few else partnered(np.array(n), np.array(place), maps)
        return [row for row, keep in zip(held, keeps) if keep]

    def batch_of(rows):
        columns = list(zip(*rows))[:4] or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["token", "gid", "n", "place"])

    mapped = entries.join(bitmaps, "gid", "left").select("token", "gid", "n", "place", "bitmap")
    ranges = mapped.repartitionByRange(shuffle_partitions(entries.sparkSession), "token", "gid").sortWithinPartitions("token", "gid")
    return ranges.mapInArrow(run, "token long, gid long, n long, place long")


def tree_of_links(members: DataFrame) -> DataFrame:
    """(a, b): links that join the same classes as all links between the two sides of every cell do.

    ``members``: cell, cid, label, side (1, 2, or 3 for both) and the shingles ``tokens``; classes of one label are joined already.
    """
    def links_of(cids, labels, sides, sets):
        parent = {label: label for label in labels}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x
        ones = [k for k, side in enumerate(sides) if side & 1]
        twos = [k for k, side in enumerate(sides) if side & 2]
        if len(ones) > len(twos):
            ones, twos = twos, ones
        sizes = np.array([len(sets[k]) for k in twos])
        owner = np.repeat(np.arange(len(twos)), sizes)
        tokens = np.concatenate([sets[k] for k in twos])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for a in ones:
            low, high = np.searchsorted(tokens, sets[a], "left"), np.searchsorted(tokens, sets[a], "right")
            width = high - low
            at = np.repeat(low - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum())
            common = np.bincount(owner[at], minlength=len(twos))
            for j in np.flatnonzero(100 * common >= PERCENT * (len(sets[a]) + sizes - common)):
                x, y = root(labels[a]), root(labels[twos[j]])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    yield cids[a], cids[twos[j]]

    def run(batches):
        cell, held = None, []
        for batch in batches:
            out = []
            tokens = batch.column(4)
            for k, (at, cid, label, side) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if at != cell:
                    out += links_of(*zip(*held)) if held else []
                    cell, held = at, []
                held.append((cid, label, side, tokens[k].values.to_numpy()))
            yield batch_of(out)
        if held:
            yield batch_of(list(links_of(*zip(*held))))

    def batch_of(pairs):
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    parts = shuffle_partitions(members.sparkSession)
    chosen = members.select("cell", "cid", "label", "side", "tokens")
    return chosen.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def may_link(n, m, place, other):
    """Filter of a pair of groups by sizes and by the places of one common shingle."""
    ahead = F.least(place, other) + 1 + F.least(n - place, m - other) - 1
    return (F.lit(100) * F.least(n, m) >= F.lit(PERCENT) * F.greatest(n, m)) & (F.lit(100 + PERCENT) * ahead >= F.lit(PERCENT) * (n + m))


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links).select(F.col("a").alias("cid"), F.col("b").alias("root"))
    return staged(classes.join(roots, "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root"), "labelled")


def _around_pivots(entries: DataFrame, classes: DataFrame, turn: int, chunk: int) -> DataFrame:
    """Cells (cell, cid, label, side) of one pivot class each, with what shares a shingle or the group with it."""
    order = F.xxhash64(F.lit(turn), "gid")
    pivots = entries.groupBy("token").agg(F.min(F.struct(order.alias("o"), "gid", "n", "place")).alias("p")).select(
        "token", F.col("p.gid").alias("pivot"), F.col("p.n").alias("m"), F.col("p.place").alias("other"))
    met = spread_join(entries, pivots, ["token"]).filter(F.col("gid") != F.col("pivot"))
    met = met.filter(may_link(F.col("n"), F.col("m"), F.col("place"), F.col("other"))).select("pivot", "gid").distinct()
    met = staged(met.unionByName(classes.select(F.col("gid").alias("pivot"), "gid").distinct()), "met")
    firsts = staged(classes.groupBy("gid").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "cid").alias("o"), "cid", "label")).alias("p")).select(
        F.col("gid").alias("pivot"), F.col("p.cid").alias("first"), F.col("p.label").alias("first_label")), "firsts")
    pairs = spread_join(met, firsts, ["pivot"]).join(classes.select("gid", "cid", "label", "n"), "gid")
    pairs = staged(pairs.filter(F.col("label") != F.col("first_label")).select("first", "first_label", "cid", "label", "n").distinct(), "pairs")
    load = pairs.groupBy("first").agg(F.ceil(F.sum("n") / chunk).cast("long").alias("parts"))
    pairs = spread_join(pairs, load, ["first"])
    pairs = pairs.withColumn("cell", F.xxhash64("first", F.pmod(F.xxhash64("cid"), "parts")))
    centres = pairs.select("cell", F.col("first").alias("cid"), F.col("first_label").alias("label"), F.lit(1).alias("side")).distinct()
    return pairs.select("cell", "cid", "label", F.lit(2).alias("side")).unionByName(centres)


def _what_is_apart(entries: DataFrame, classes: DataFrame, chunk: int) -> DataFrame:
    """Cells of two chunks for all classes that share a bucket but no label."""
    spans = classes.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    inside = spans.filter("low <> high").select(F.xxhash64("gid", "low").alias("token"), "gid")  # a group is a bucket too
    rows = staged(entries.select("token", "gid").unionByName(inside).join(spans, "gid"), "spans")
    apart = rows.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l <> h").select("token")
    rows = staged(spread_join(rows, apart, ["token"]), "apart")
    counts = rows.groupBy("token", "low").agg(F.count(F.lit(1)).alias("n"))
    major = counts.groupBy("token").agg(F.max(F.struct("n", "low")).alias("m")).select("token", F.col("m.low").alias("major"))
    # A group's home is its own label where that leads a bucket, or else the least label that leads one of its buckets.
    homes = spread_join(rows, major, ["token"]).groupBy("gid").agg(
        F.coalesce(F.min(F.when(F.col("low") == F.col("major"), F.col("low"))), F.min("major")).alias("home"))
    placed = staged(classes.join(homes, "gid").select("cid", "gid", "label", "n", "home"), "placed")
    load = placed.groupBy("home").agg(F.ceil(F.sum("n") / chunk).cast("long").alias("parts"))
    placed = staged(spread_join(placed, load, ["home"]).select(
        "cid", "gid", "label", "n", F.xxhash64("home", F.col("label") == F.col("home"), F.pmod(F.xxhash64("cid"), "parts")).alias("chunk")), "chunks")
    held = spread_join(rows.select("token", "gid"), placed.groupBy("gid", "chunk").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.max("n").alias("n")), ["gid"])
    held = staged(held.groupBy("token", "chunk").agg(
        F.min("l").alias("l"), F.max("h").alias("h"), F.min("n").alias("least"), F.max("n").alias("most")), "held")
    other = held.select("token", *[F.col(c).alias(f"{c}2") for c in ("chunk", "l", "h", "least", "most")])
    cells = spread_join(held, other, ["token"]).filter(
        (F.col("chunk") <= F.col("chunk2")) & (F.least("l", "l2") != F.greatest("h", "h2"))
        & (F.lit(100) * F.col("most") >= F.lit(PERCENT) * F.col("least2")) & (F.lit(100) * F.col("most2") >= F.lit(PERCENT) * F.col("least")))
    cells = staged(cells.select(F.xxhash64("chunk", "chunk2").alias("cell"), "chunk", "chunk2").distinct(), "cells")
    sides = cells.select("cell", "chunk", F.when(F.col("chunk") == F.col("chunk2"), 3).otherwise(1).alias("side")).unionByName(
        cells.filter("chunk <> chunk2").select("cell", F.col("chunk2").alias("chunk"), F.lit(2).alias("side")))
    return spread_join(staged(sides, "sides"), placed.select("chunk", "cid", "label"), ["chunk"])


def jaccard_groups(documents: DataFrame, rounds: int = ROUNDS, chunk: int = CHUNK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    counts = count_buckets(documents)
    marks = staged(mark_documents(documents, counts), "marks")
    classes = marks.filter("n > 0").groupBy("c0", "c1").agg(
        F.min("gid").alias("gid"), F.min("n").alias("n"), F.min("doc_id").alias("least"), F.min("key").alias("key"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    entries = staged(shared_entries(marks), "entries")
    several = classes.groupBy("gid").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gid")
    bitmaps = marks.filter("bitmap IS NOT NULL").select("gid", "bitmap").join(entries.select("gid").distinct(), "gid", "left_semi")
    bitmaps = bitmaps.groupBy("gid").agg(F.first("bitmap").alias("bitmap")).join(several, "gid", "left_anti")
    entries = staged(surviving_entries(entries, bitmaps), "surviving")
    involved = entries.select("gid").unionByName(several).distinct()
    involved = staged(classes.join(involved, "gid", "left_semi"), "involved")
    sets = staged(sets_of(documents, involved), "sets")

    current, links = involved.withColumn("label", F.col("cid")), None
    for turn in range(rounds + 1):
        cells = _around_pivots(entries, current, turn, chunk) if turn < rounds else _what_is_apart(entries, current, chunk)
        cells = staged(cells, "members")
        found = tree_of_links(spread_join(cells, sets, ["cid"]))
        links = staged(found if links is None else links.unionByName(found), "links")
        current = _labelled(involved, links)

    ids = current.groupBy("label").agg(F.min("least").alias("component_id"))
    named = spread_join(current.select("c0", "c1", "label"), ids, ["label"]).select("c0", "c1", F.col("component_id").alias("_named"))
    ends = classes.join(named, ["c0", "c1"], "left").select("c0", "c1", F.coalesce("_named", "least").alias("component_id"))
    rows = spread_join(marks.filter("n > 0").select("doc_id", "n", "c0", "c1"), ends, ["c0", "c1"])
    alone = marks.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return rows.select("doc_id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles").select("doc_id", "n_shingles", "component_id")


def sets_of(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, tokens) of the given classes, each from one of its documents."""
    def run(batches):
        shingles = Shingler()
        for batch in batches:
            cids, sets = [], []
            for cid, c0, c1, text in zip(*(column.to_pylist() for column in batch.columns)):
                tokens = shingles(text)
                low = xxhash.xxh3_128_intdigest(tokens.tobytes())
                if (low >> 64) == c0 % (1 << 64) and low & (1 << 64) - 1 == c1 % (1 << 64):  # the key may be another text's too
                    cids.append(cid)
                    sets.append(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cid", "tokens"])

    # The classes grow with the documents, so texts and classes meet by shuffle at every size.
    texts = keyed(documents).select("key", "text").join(classes.select("key", "cid", "c0", "c1").hint("merge"), "key")
    found = texts.select("cid", "c0", "c1", "text").mapInArrow(run, "cid long, tokens array<long>")
    return found.dropDuplicates(["cid"])
