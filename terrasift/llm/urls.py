"""URL filter on a sorted digest array.

Entries (host and path prefix) are keyed by the 64-bit xxhash of their full
string. Each shard of the index is one row: sorted digests, and the strings they
stand for. A task maps its shard into memory, finds the digests of its probes by
vectorised binary search, and accepts a hit only if the stored string is equal,
so two strings with one digest never stand for each other.

Defined cases: a url that is null or has no ``://`` has empty host and path; an
entry with an empty path covers the whole host; of several entries that fit, a
stated rule goes before a listed one and then the longest wins (the longer host
on a tie, then block); pages with one url share its verdict; without pages the
result is empty; without entries everything is allowed. Other columns of the
pages are not read.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import ascii_lower, shuffle_partitions, staged

ENTRIES_PER_SHARD = 500_000
ENTRY_COLUMNS = ("host", "path", "verdict", "stated")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, as plain cuts of the url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def build_index(entries: DataFrame) -> DataFrame:
    """Staged shards of the digest array: shard, digests, offsets, strings, verdicts as one binary column each."""
    keyed = entries.select(F.concat("host", "path").alias("entry"), F.length("host").alias("host_chars"), "verdict", "stated")
    keyed = keyed.withColumn("digest", F.xxhash64("entry")).distinct()
    shards = max(shuffle_partitions(entries.sparkSession), -(-keyed.count() // ENTRIES_PER_SHARD))

    def shard_row(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["digest", "entry", "stated", "verdict"], kind="stable")
        texts = [x.encode() for x in rows["entry"]]
        ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
        info = np.column_stack([rows["stated"].to_numpy(np.int64), rows["verdict"].eq("block").to_numpy(np.int64),
                                rows["host_chars"].to_numpy(np.int64)])
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "shards": [shards],
                             "digests": [rows["digest"].to_numpy(np.int64).tobytes()],
                             "ends": [ends.tobytes()], "strings": [b"".join(texts)], "info": [info.tobytes()]})

    rows = keyed.withColumn("shard", F.pmod(F.col("digest"), F.lit(shards)).cast("long"))
    index = rows.groupBy("shard").applyInPandas(
        shard_row, "shard long, shards long, digests binary, ends binary, strings binary, info binary")
    return staged(index, "url-index")


def probe(index: DataFrame, probes: DataFrame, shards: int) -> DataFrame:
    """Entries among ``probes`` (column ``entry``, distinct): entry, host_chars, verdict, stated."""
    out, columns = "entry string, host_chars long, verdict string, stated boolean", ["entry", "host_chars", "verdict", "stated"]

    def search(keys: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(keys) or not len(shard):
            return pd.DataFrame([], columns=columns, dtype=object)
        with tempfile.TemporaryDirectory() as folder:
            def mapped(name, kind, width=1):
                path = os.path.join(folder, name)
                with open(path, "wb") as file:
                    file.write(shard[name].iloc[0])
                got = np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.empty(0, kind)
                return got.reshape(-1, width) if width > 1 else got

            digests, ends, strings, info = (mapped("digests", np.int64), mapped("ends", np.int64),
                                            mapped("strings", np.uint8), mapped("info", np.int64, 3))
            wanted = keys["digest"].to_numpy(np.int64)
            low, high = np.searchsorted(digests, wanted, "left"), np.searchsorted(digests, wanted, "right")
            found = []
            for k in np.flatnonzero(high > low):
                text = keys["entry"].iloc[k]
                raw = text.encode()
                for at in range(low[k], high[k]):
                    start = ends[at - 1] if at else 0
                    if strings[start:ends[at]].tobytes() == raw:  # not only the digest
                        found.append((text, int(info[at, 2]), "block" if info[at, 1] else "allow", bool(info[at, 0])))
            del digests, ends, strings, info
        return pd.DataFrame(found, columns=columns, dtype=object)

    keyed = probes.select("entry", F.xxhash64("entry").alias("digest"))
    keyed = keyed.withColumn("shard", F.pmod(F.col("digest"), F.lit(shards)).cast("long"))
    return keyed.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(search, out)


def judge_urls(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id``, ``url``, host, path, rule and verdict of every row of ``pages``.

    ``entries`` has host, path, verdict ("allow" or "block") and ``stated``:
    whether the entry is a rule, whose string is reported, or comes from a list.
    The probes of an address are its host and parents cut to the label counts,
    and its path cut to the path lengths, that occur among the entries.
    """
    entries = staged(entries.select(*ENTRY_COLUMNS), "url-entries")
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    shapes = [(r[0], r[1]) for r in entries.select(
        F.size(F.split("host", r"\.")), F.length("path")).distinct().collect()]
    if not shapes:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    index = build_index(entries)
    shards = index.select("shards").first()[0]
    labels = F.size(F.split("host", r"\."))
    # The null of a shape that does not fit costs nothing: array_compact drops it.
    cuts = [F.when((labels >= n) & (F.length("path") >= size),
                   F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, size))) for n, size in sorted(shapes)]
    addresses = pages.select("host", "path").distinct()
    probes = addresses.select("host", "path", F.explode(F.array_compact(F.array(*cuts))).alias("entry"))
    hits = probe(index, probes.select("entry").distinct(), shards)
    rank = F.struct(F.col("stated"), F.length("entry"), F.col("host_chars"), F.col("verdict") == "block")
    best = (probes.join(hits, "entry").groupBy("host", "path")
            .agg(F.max_by(F.struct("entry", "stated", "verdict"), rank).alias("best")))
    joined = pages.join(best, ["host", "path"], "left")
    return joined.select("page_id", "url", "host", "path",
                         F.when(F.col("best.stated"), F.col("best.entry")).alias("rule"),
                         F.coalesce(F.col("best.verdict"), F.lit("allow")).alias("verdict"))
