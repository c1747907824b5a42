import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrasift.llm.common import spread_join, staged
from terrasift.llm.prefix_trie import SpillingQueue, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows: (conv_id, turn, role, text). Every prefix of every rebuilt conversation, by plain sets."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).digest(), text))
    original = {c: [(role, text) for _, role, _, text in sorted(found)] for c, found in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = original.get(lender, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    below = defaultdict(list)
    for path in nodes:
        for d in range(len(path) + 1):
            below[path[:d]].append(path)
    parents = {path[:-1] for path in nodes if path}
    out = []
    for path, members in nodes.items():
        ends = sorted(c for c in members if len(rebuilt[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(p[:-1] == path and p != path for p in below[path] if len(p) == len(path) + 1),
                    sum(p not in parents for p in below[path]),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below[path] if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **settings):
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **settings)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(((*r,) for r in got.collect()), key=str) == brute(rows)


@pytest.fixture(scope="module")
def bushy():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(250, 280), -5, -100, -105]:  # the lender 200 is absent
        for t in range(rng.choice([1, 2, 3, 5, 8, 12])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["hello", "", None, "word " * 4, "ü漢🙂"])))
    rows += [(7, 3, "user", "again")] * 3 + [(8, None, "user", "first"), (None, 1, "user", "lost"), (9, None, None, None)]
    rows += [(600, t, "user", f"turn {t % 7}") for t in range(400)]  # one conversation with a large part of the rows
    return rows + [(c, t, "user", "copy") for c in range(300, 320) for t in range(6)]


def test_plain(spark, bushy):
    check(spark, bushy)


def test_small_shards_chains_and_queues(spark, bushy):
    check(spark, bushy, shard_rows=15, chains=10**6, queue_rows=2)


def test_only_heavy_nodes(spark, bushy):
    check(spark, bushy, shard_rows=0, chains=10**6, queue_rows=3)


def test_nested_conversations(spark):
    check(spark, [(c, t, "user", f"t{t}") for c in (700, 1200, 1800, 2100) for t in range(c // 100)], shard_rows=5, chains=10**6)


def test_empty_and_silent(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    check(spark, [(lone, 0, "user", "dropped, and nothing is lent")])


def test_extra_columns(spark, bushy):
    extra = spark.createDataFrame(bushy[:40], SCHEMA).selectExpr("*", "1 AS depth", "2 AS node", "3 AS place", "4 AS n")
    assert sorted(((*r,) for r in prefix_trie(extra).collect()), key=str) == brute(bushy[:40])


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(2)
    queue, want = SpillingQueue(10), []
    for _ in range(3_000):
        item = (-rng.randrange(9), bytes([rng.randrange(4)]), rng.randrange(100), 1)
        queue.push(item)
        want.append(item)
    got = [item for key in sorted({x[:2] for x in want}) for item in queue.take(key)]
    assert sorted(got) == sorted(want) and [x[:2] for x in got] == sorted(x[:2] for x in want)


def test_spread_join_deals_hot_keys(spark):
    left = staged(spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"), "t")
    right = spark.range(0, 6_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        want = left.join(right, ["k"], how)
        got = spread_join(left, right, ["k"], how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
