"""Seeded row hashes that any SQL engine can recompute.

``md5`` of ``seed|length:key|...`` in hex, ``null`` standing for a null: uniform,
stable across retries, partitions and engines, so a split never depends on how
Spark happened to place the rows. The lengths keep keys with separators apart.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from terrasift.functions.numeric import quoted

HEX_DIGITS = 8


def key_text(key_cols) -> Column:
    texts = [quoted(c).cast("string") for c in key_cols]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("null")) for t in texts])


def seeded_hash(seed: Column, text: Column) -> Column:
    return F.md5(F.concat_ws("|", seed, text).cast("binary"))


def row_hash(key_cols, seed) -> Column:
    return seeded_hash(F.lit(str(seed)), key_text(key_cols))


def unit_interval(hash_col: Column) -> Column:
    """The leading 32 bits of the hash as a double in [0, 1)."""
    leading = F.conv(F.substring(hash_col, 1, HEX_DIGITS), 16, 10).cast("double")
    return leading / F.lit(float(16 ** HEX_DIGITS))
