"""Trie of the shared prefixes of conversations, summed up by time-forward processing.

**Sequences.** Turns are dealt into ranges of (conversation, order), so a
conversation of any length is spread over tasks; each range is numbered where it
lies and starts after the ranges before it. A prefix is known by its length and
by four running sums of 32 hash bits of (place, role, text), 128 bits in all.

**Shards.** The size of a node counts the turns of its members from its depth on.
Nodes up to a limit are light, and the topmost light nodes are shard roots: a
shard has no more nodes than the limit. All others are heavy. The heavy nodes are
cut into chains, one for each heavy node without heavy children; the limit grows
with the rows so that there are at most ``CHAINS`` of these.

**Time-forward processing.** The nodes of a shard are sorted outside memory in
reverse level order. Each node takes the totals sent to it from a priority queue,
which spills sorted runs when it grows, adds its own and sends the sum forward to
its parent. Shard roots send theirs to the heavy nodes. Across shard roots the
chains are processed in the same way, each as one node, and running sums from the
bottom of every chain then give its nodes their totals.

Defined cases: rows without a conversation id are left out; a null role or text
is empty, and so different from no turn; turns of one conversation with equal
numbers are ordered by role, then by the MD5 of the text; repeated rows are turns
of their own; a conversation left without turns belongs to the root; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import shuffle_partitions, spread_join, staged
from terrasift.operators.ranks import running_totals

BLOCK, HEADS = 100, 6      # the conversation that lends its head, and the remainders that say how much of it
SHARD_ROWS = 1_000         # turns below a shard root, or a CHAINS-th part of all, if that is more
CHAINS = 10_000
QUEUE_ROWS = 200_000       # messages that a queue keeps in memory
IDS_PER_PIECE = 4_096      # ids that are joined before they are sent to the task that hashes them
ROOT = hashlib.md5(b"0,0,0,0,0").digest()  # the empty prefix


def _dealt(rows: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """Rows sorted by (conv_id, order) in staged ranges, with ``_range`` and ``_at``; and for each conversation and
    range the rows ``before`` it, its ``first`` place and the rows ``total`` of the conversation."""
    keys = ["conv_id", *order]
    spark = rows.sparkSession
    ranges = rows.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    ranges = staged(ranges.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "ranges")
    pieces = ranges.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    whole = Window.partitionBy("conv_id")
    before = F.sum("n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return ranges, pieces.select("conv_id", "_range", "first", F.coalesce(before, F.lit(0)).alias("before"),
                                 F.sum("n").over(whole).alias("total"), (F.sum("n").over(whole) > F.col("n")).alias("spans"))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, said, chars): the turns of every rebuilt conversation in order of ``place``; and all conv_ids."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # A turn travels as the hash of its role and text, so that texts are read once and never shuffled.
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.md5(text)).alias("words"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("said"),
        F.length(text).cast("long").alias("chars"))
    turns = staged(turns, "turns").withColumn("tie", F.monotonically_increasing_id())
    ranges, pieces = _dealt(turns, ["turn", "role", "words", "tie"])
    numbered = ranges.join(pieces, ["conv_id", "_range"]).select(
        "conv_id", "said", "chars", (F.col("_at") - F.col("first") + F.col("before") + 1).alias("place"))
    numbered = staged(numbered, "numbered")
    ids = staged(numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select("conv_id"), "ids")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS))
    own = numbered.filter(F.col("place") > head).select("conv_id", "place", "said", "chars")
    lent = numbered.filter((F.col("conv_id") % BLOCK == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "lender")
    heads = (ids.withColumn("lender", F.col("conv_id") - F.col("conv_id") % BLOCK).withColumn("head", head)
             .join(lent, "lender").filter("place <= head").select("conv_id", "place", "said", "chars"))
    return own.unionByName(heads), ids


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, length, node, parent, chars): every rebuilt conversation at each of its depths from 1 on."""
    ranges, pieces = _dealt(turns, ["place"])
    local = Window.partitionBy("conv_id", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    halves = [half for k in (1, 2) for half in (
        F.xxhash64(F.lit(k), "depth", "said").bitwiseAND(F.lit(0xFFFFFFFF)),
        F.shiftrightunsigned(F.xxhash64(F.lit(k), "depth", "said"), 32))]
    placed = ranges.join(pieces, ["conv_id", "_range"]).withColumn("depth", F.col("_at") - F.col("first") + F.col("before") + 1)
    placed = placed.select("conv_id", "_range", "_at", "spans", "depth", F.col("total").alias("length"), "chars",
                           *[half.alias(f"x{k}") for k, half in enumerate(halves)])
    placed = staged(placed.select("*", *[F.sum(f"x{k}").over(local).alias(f"s{k}") for k in range(4)]), "sums")
    # Sums of the ranges before, for conversations that lie in several: at most two such parts in a range.
    parts = placed.filter("spans").groupBy("conv_id", "_range").agg(*[F.sum(f"x{k}").alias(f"p{k}") for k in range(4)])
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("conv_id", "_range", *[F.sum(f"p{k}").over(before).alias(f"c{k}") for k in range(4)])
    carried = staged(carried, "carried")
    totals = [F.col(f"s{k}") + F.coalesce(f"c{k}", F.lit(0)) for k in range(4)]
    key = lambda depth, sums: F.unhex(F.md5(F.concat_ws(",", depth, *sums)))
    return placed.join(carried, ["conv_id", "_range"], "left").select(
        "conv_id", "depth", "length", "chars", key(F.col("depth"), totals).alias("node"),
        key(F.col("depth") - 1, [total - F.col(f"x{k}") for k, total in enumerate(totals)]).alias("parent"))


class SpillingQueue:
    """Priority queue of tuples that writes sorted runs to unnamed files of its task when it grows.

    A run is gone with the task; no other task reads it.
    """

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            run = tempfile.TemporaryFile()
            self.heap.sort()
            for at in range(0, len(self.heap), 1_000):
                pickle.dump(self.heap[at:at + 1_000], run)
            run.seek(0)
            self.heap = []
            self.runs += 1
            self._advance(self._read(run), self.runs)

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while True:
                try:
                    yield from pickle.load(run)
                except EOFError:
                    return

    def _advance(self, run: Iterator[tuple], number: int) -> None:
        item = next(run, None)
        if item is not None:
            heapq.heappush(self.heads, (item, number, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and yield the items that begin with ``key``, the smallest there is."""
        size = len(key)
        while self.heap and self.heap[0][:size] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:size] == key:
            item, number, run = heapq.heappop(self.heads)
            yield item
            self._advance(run, number)


SUMMED = "node binary, leaves long, saved long"


def send_forward(rows: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(node, leaves, saved): totals of the subtrees inside each shard.

    ``rows``: shard, level, node, parent, parent_level, leaves, saved; all of a
    shard in one partition, in order of shard, falling level and node.
    """
    def run(batches):
        queue, shard = SpillingQueue(queue_rows), None
        for batch in batches:
            nodes, leaves_out, saved_out = [], [], []
            for top, level, node, parent, parent_level, leaves, saved in zip(*(column.to_pylist() for column in batch.columns)):
                if top != shard:
                    queue, shard = SpillingQueue(queue_rows), top
                for message in queue.take((-level, node)):
                    leaves += message[2]
                    saved += message[3]
                if parent is not None and node != top:
                    queue.push((-parent_level, parent, leaves, saved))
                nodes.append(node)
                leaves_out.append(leaves)
                saved_out.append(saved)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(leaves_out, pa.int64()), pa.array(saved_out, pa.int64())],
                                             ["node", "leaves", "saved"])

    return rows.select("shard", "level", "node", "parent", "parent_level", "leaves", "saved").mapInArrow(run, SUMMED)


def _added(rows: DataFrame, sent: DataFrame) -> DataFrame:
    """``rows`` with what was sent to each node (node, leaves, saved; several rows of a node are summed) added to its own."""
    sums = sent.groupBy("node").agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    joined = rows.join(sums, "node", "left")
    return joined.select(*[c for c in rows.columns if c not in ("leaves", "saved")],
                         *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")])


def subtree_totals(nodes: DataFrame, rows: DataFrame, limit: int, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(node, leaves, saved) of every subtree; ``nodes`` has its own ``leaves`` and ``saved``, ``rows`` are the members."""
    spark = nodes.sparkSession
    heavy = staged(nodes.filter(F.col("size") > limit).select("node", "parent", "depth", "conv_id", "leaves", "saved"), "heavy")
    # The topmost light node of every conversation: the shard root of the light nodes that it represents.
    flagged = spread_join(rows.select("conv_id", "depth", "node"), heavy.select("node", F.lit(True).alias("is_heavy")), ["node"], "left")
    tops = flagged.filter("is_heavy IS NULL").groupBy("conv_id").agg(F.min_by("node", "depth").alias("shard"))
    light = nodes.filter(F.col("size") <= limit).join(tops, "conv_id", "left")
    whole = nodes.filter((F.col("depth") == 0) & (F.col("size") <= limit)).take(1)  # then the root is the root of the only shard
    light = light.withColumn("shard", F.lit(ROOT)) if whole else light
    light = light.select("shard", F.col("depth").alias("level"), "node", "parent", (F.col("depth") - 1).alias("parent_level"), "leaves", "saved")
    ordered = light.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", F.desc("level"), "node")
    inside = staged(send_forward(ordered, queue_rows), "inside")

    roots = inside.join(light.filter("node = shard AND parent IS NOT NULL").select("node", "parent"), "node")
    heavy = staged(_added(heavy, roots.select(F.col("parent").alias("node"), "leaves", "saved")), "heavy")
    ends = heavy.join(heavy.select(F.col("parent").alias("node")), "node", "left_anti")
    # Their subtrees share no turn and each has more than the limit, so there are at most CHAINS of them.
    ends = F.broadcast(staged(ends.select(F.col("conv_id"), F.col("depth").alias("end_depth"), F.col("node").alias("chain")), "ends"))
    walks = rows.select("conv_id", "depth", "node").join(ends, "conv_id").filter("depth <= end_depth").select("node", "chain")
    walks = walks.unionByName(ends.select(F.lit(ROOT).alias("node"), "chain"))
    chained = staged(heavy.join(walks.groupBy("node").agg(F.min("chain").alias("chain")), "node"), "chained")
    chains = chained.groupBy("chain").agg(
        F.min("depth").alias("level"), F.min_by("parent", "depth").alias("above"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    chains = staged(chains, "chains")
    levels = chains.select(F.col("chain").alias("parent"), F.col("level").alias("parent_level"))
    hung = chained.select(F.col("node").alias("above"), F.col("chain").alias("parent"))
    chains = chains.join(hung, "above", "left").join(levels, "parent", "left")
    linked = staged(chains.select(F.lit(b"").alias("shard"), "level", F.col("chain").alias("node"), "parent", "parent_level", "leaves", "saved", "above"), "linked")
    across = send_forward(linked.repartition(1).sortWithinPartitions("shard", F.desc("level"), "node"), queue_rows)  # at most CHAINS rows
    sent = across.join(linked.select("node", "above"), "node").filter("above IS NOT NULL")
    chained = _added(chained, sent.select(F.col("above").alias("node"), "leaves", "saved"))
    summed = running_totals(chained.select("chain", "depth", "node", "leaves", "saved"), "depth", ["leaves", "saved"], ["chain"], ascending=False)
    return inside.unionByName(summed.select("node", F.col("cum_leaves").alias("leaves"), F.col("cum_saved").alias("saved")))


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): the SHA-256 of the ascending ids of each node, comma-joined.

    Ids are sorted and joined in ranges; the hash of a node, which can only be
    taken in order, then reads one row for each ``IDS_PER_PIECE`` ids.
    """
    def join(batches):
        node, ids = None, []
        for batch in batches:
            out = []
            for key, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
                if key != node or len(ids) == IDS_PER_PIECE:
                    if ids:
                        out.append((node, ids[0], ",".join(map(str, ids))))
                    node, ids = key, []
                ids.append(conv_id)
            yield pieces(out)
        if ids:
            yield pieces([(node, ids[0], ",".join(map(str, ids)))])

    def pieces(out):
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                          ["node", "first", "ids"])

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield found(out)
        if node is not None:
            yield found([(node, state.hexdigest())])

    def found(out):
        columns = list(zip(*out)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"])

    parts = shuffle_partitions(ends.sparkSession)
    joined = ends.select("node", "conv_id").repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        join, "node binary, first long, ids string")
    return joined.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, chains: int = CHAINS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations, with its subtree totals."""
    turns, ids = rebuilt_turns(conversations)
    rows = staged(members(turns), "members")
    nodes = rows.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("size"))
    n_rows = rows.count()
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("chars"), F.lit(n_rows + 1).cast("long").alias("size"))
    nodes = nodes.unionByName(root)
    nodes = staged(nodes, "nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = staged(nodes.select("*", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                                ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "nodes")
    totals = subtree_totals(nodes, rows, max(shard_rows, n_rows // chains), queue_rows)
    last = rows.filter("depth = length").select("node", "conv_id")
    silent = ids.join(last.select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    digests = digests_of_ends(last.unionByName(silent))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = spread_join(nodes.select("node", "parent", "conv_id", "depth", "n_convs", "n_children"), above, ["parent"], "left")
    return named.join(totals, "node").join(digests, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
