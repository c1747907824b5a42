"""Reproducible train/validation/test splits."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from terrasift.functions.hashing import row_hash, unit_interval
from terrasift.functions.numeric import quoted
from terrasift.operators.ranks import hash_thresholds, numbered
from terrasift.session import stage_table

# Seeds and shares.
SPLIT_SEED = 1234
HOLDOUT_SEED = 42
TRAIN_SHARE, VAL_SHARE = 0.7, 0.15
HOLDOUT_SHARE = 0.2
# End of fixed values.


def check_ratios(train: float, val: float, test: float | None = None) -> tuple:
    """Shares in [0, 1] that add up to 1; ``test`` defaults to the remainder."""
    shares = (train, val, 1.0 - train - val if test is None else test)
    for name, share in zip(("train", "val", "test"), shares):
        if not -1e-6 <= share <= 1:
            raise ValueError(f"{name} share {share} is outside [0, 1]")
    if abs(sum(shares) - 1.0) > 1e-6:
        raise ValueError(f"shares {shares} do not add up to 1")
    return shares


def random_split(df: DataFrame, key_cols, train=0.8, seed=SPLIT_SEED) -> DataFrame:
    """Add ``split``: train with probability ``train``, else test.

    Decided row by row from the key's hash: no shuffle, and the same rows in
    every run, whatever the partitioning. Sizes are random, as in
    ``randomSplit``.
    """
    draw = unit_interval(row_hash(key_cols, seed))
    return df.select("*", F.when(draw < train, "train").otherwise("test").alias("split"))


def random_parts(df: DataFrame, key_cols, train=0.8, seed=SPLIT_SEED, staged=False) -> tuple:
    """Both parts of :func:`random_split`; ``staged`` writes the split rows once, for tables that are read many times."""
    parts = random_split(df, key_cols, train, seed)
    parts = stage_table(parts, "split") if staged else parts
    return tuple(parts.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


def _cut(df, key_cols, strata, seed, cuts, names, digits, staged=False):
    """Split at exact ranks of the order by key hash, then row hash.

    Rows that are equal in every column and stand at a cut are numbered, and as
    many as the cut needs fall below it. ``staged`` writes the rows with their
    hashes once, so that they are not read and hashed again for every step.
    """
    columns, keys = df.columns, [f"s{i}" for i in range(len(strata))]
    full = F.concat(row_hash(key_cols, seed), F.lower(F.lpad(F.hex(F.xxhash64(*[quoted(c) for c in columns])), 16, "0")))
    marked = df.select(F.struct(*[quoted(c) for c in columns]).alias("_row"), full.alias("_h"),
                       *[quoted(s).alias(f"_{k}") for k, s in zip(keys, strata)])
    if staged:
        marked = stage_table(marked, "hashed")
    hashed = marked.select(*[F.col(f"_{k}").alias(k) for k in keys], F.col("_h").alias("h"))
    # One row per stratum, staged so the join's broadcast rests on its real size.
    limits = stage_table(hash_thresholds(hashed, keys, cuts, digits), "split-limits")
    places = range(len(names) - 1)
    if strata:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"_{k}").eqNullSafe(F.col(k))
        marked = marked.join(limits, on, "left")
    else:
        row = limits.first()
        marked = marked.withColumns({f"{c}{i}": F.lit(row and row[f"{c}{i}"]).cast("string" if c == "t" else "long")
                                     for i in places for c in "tkm"})
    at_cut = [(F.col("_h") == F.col(f"t{i}")) & (F.col(f"k{i}") < F.col(f"m{i}")) for i in places]
    split_copies = F.coalesce(reduce(or_, at_cut), F.lit(False))

    def named(number):
        split = F
        for i, name in zip(places, names):
            split = split.when((F.col("_h") < F.col(f"t{i}")) | ((F.col("_h") == F.col(f"t{i}")) & (number <= F.col(f"k{i}"))), name)
        return split.otherwise(names[-1]).alias("split")

    own = [F.col("_row").getField(c).alias(c) for c in columns]
    if limits.filter(reduce(or_, [F.col(f"k{i}") < F.col(f"m{i}") for i in places])).isEmpty():
        return marked.select(*own, named(F.lit(0)))
    copies = numbered(marked.filter(split_copies), ["_h", *[f"_{k}" for k in keys]])
    return marked.filter(~split_copies).select(*own, named(F.lit(0))).unionByName(copies.select(*own, named(F.col("number"))))


def stratified_split(df: DataFrame, class_col: str, key_cols, train=TRAIN_SHARE, val=VAL_SHARE, test=None,
                     seed=SPLIT_SEED, digits=4) -> DataFrame:
    """Add ``split`` with ``floor(train·n)`` train and ``floor(val·n)`` val rows per class.

    Order within a class is the hash of ``key_cols``, which may repeat, and then
    that of the row; see :func:`terrasift.operators.ranks.hash_thresholds` for
    how the exact cuts are found. ``digits`` sets the hash buckets per class
    and step (16**digits).
    """
    train, val, _ = check_ratios(train, val, test)

    def cuts(n):
        first = F.floor(F.lit(float(train)) * n)
        return [first, first + F.floor(F.lit(float(val)) * n)]
    return _cut(df, key_cols, [class_col], seed, cuts, ["train", "val", "test"], digits)


def holdout_split(df: DataFrame, key_cols, share=HOLDOUT_SHARE, seed=HOLDOUT_SEED, digits=4, staged=False) -> DataFrame:
    """Add ``split`` with ``ceil(share·n)`` test rows, at least one. ``staged`` is for tables that are read many times."""
    def cuts(n):
        return [n - F.greatest(F.lit(1), F.ceil(F.lit(float(share)) * n))]
    return _cut(df, key_cols, [], seed, cuts, ["train", "test"], digits, staged)


def split_sizes(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by, "split").agg(F.count("*").alias("n"))
