"""Reading delimited text whose encoding and separator are not known.

Both are settled by one distributed aggregate over every line, so a stray GBK
byte at the end of a file counts as much as one at its start.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from terrasift.functions.numeric import quoted
from terrasift.sources.tables import _naming_missing_path

# What is tried, in this order.
ENCODINGS = ["utf-8", "gbk", "latin1"]
SEPARATORS = [",", ";", "\t", r"\s+"]
# End of fixed values.

SPARK_CHARSET = {"utf-8": "UTF-8", "gbk": "GBK", "latin1": "ISO-8859-1"}
GBK_PAIR = r"[\x81-\xFE][\x40-\x7E\x80-\xFE]"
QUOTED_FIELD = r'"[^"]*"'


@dataclass(frozen=True)
class Sniffed:
    encoding: str
    separator: str
    header: tuple
    lines: int


def _regex(sep: str) -> str:
    return sep if sep == r"\s+" else re.escape(sep)


def _field_count(text, sep):
    bare = F.regexp_replace(text, QUOTED_FIELD, "")
    return F.size(F.split(F.trim(bare) if sep == r"\s+" else bare, _regex(sep)))


def sniff(spark: SparkSession, path: str, delimiter=None, skiprows=0, encodings=ENCODINGS) -> Sniffed:
    """Encoding that decodes every line, separator that splits most lines alike.

    A separator must give the header more than one field; among those the one
    with the most lines of the header's width wins, earlier candidates on ties.
    """
    lines = _naming_missing_path(lambda: spark.read.text(path), path, "delimited text")
    head = [bytes(r[0]) for r in lines.select(F.col("value").cast("binary")).head(skiprows + 1)]
    if len(head) <= skiprows:
        raise ValueError(f"no data in {path}")
    candidates = [delimiter] if delimiter else SEPARATORS
    # Separators and quotes are ASCII and never part of a multi-byte character in
    # UTF-8 or GBK, so fields can be counted before the encoding is known.
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    header_line = re.sub(QUOTED_FIELD, "", head[-1].decode("latin-1"))
    widths = [len(re.split(_regex(s), header_line.strip() if s == r"\s+" else header_line)) for s in candidates]
    beyond_ascii = r"[\x80-\xFF]"
    leftovers = latin.rlike(beyond_ascii) & F.regexp_replace(latin, GBK_PAIR, "").rlike(beyond_ascii)
    # Only a separator that parts the header can be chosen, so only these are counted.
    usable = [i for i, w in enumerate(widths) if w > 1] or [0]
    facts = lines.agg(
        F.count("*").alias("lines"),
        F.every(F.is_valid_utf8(F.col("value"))).alias("utf-8"),
        F.every(~leftovers).alias("gbk"),
        *[F.count_if(_field_count(latin, candidates[i]) == widths[i]).alias(f"sep{i}") for i in usable],
    ).first()
    encoding = next((e for e in encodings if e not in ("utf-8", "gbk") or facts[e]), "latin1")
    best = max(usable, key=lambda i: (facts[f"sep{i}"], -i))
    sep = candidates[best]
    header = head[-1].decode(encoding).lstrip("﻿")
    fields = re.split(r"\s+", header.strip()) if sep == r"\s+" else _split_quoted(header, sep)
    return Sniffed(encoding, sep, tuple(fields), facts["lines"])


def _split_quoted(line, sep):
    parts = re.findall(rf'(?:^|{re.escape(sep)})("(?:[^"]|"")*"|[^{re.escape(sep)}]*)', line)
    return [p[1:-1].replace('""', '"') if p.startswith('"') else p for p in parts]


def read_delimited(spark: SparkSession, path: str, delimiter=None, skiprows=0, names=None,
                   encoding="utf-8", infer=True) -> DataFrame:
    """Read a delimited file after settling its encoding and separator.

    ``names`` replaces the header: the first line is then data. ``skiprows``
    leading lines are ignored. A missing file raises ``FileNotFoundError``,
    an empty one ``ValueError``.
    """
    order = [encoding] + [e for e in ENCODINGS if e != encoding]
    found = sniff(spark, path, delimiter, skiprows, order)
    charset = SPARK_CHARSET.get(found.encoding, found.encoding)
    if charset == "GBK" and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError("GBK files need a session with spark.sql.legacy.javaCharsets=true, as build_session makes it")
    if skiprows == 0 and found.separator != r"\s+":
        df = (spark.read.option("header", names is None).option("sep", found.separator)
              .option("encoding", charset).option("inferSchema", infer).csv(path))
        return df.toDF(*names) if names else df
    columns = list(names) if names else list(found.header)
    rows = _body_lines(spark, path, charset, skiprows if names else skiprows + 1)
    if found.separator == r"\s+":
        parts = F.split(F.trim(F.col("line")), r"\s+")
        table = rows.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])
    else:
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
        parsed = F.from_csv(F.col("line"), schema.simpleString()[7:-1].replace(":", " "), {"sep": found.separator})
        table = rows.select(parsed.alias("r")).select(
            *[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])
    return settle_types(table) if infer else table


def _body_lines(spark, path, charset, skip):
    """Decoded lines after the first ``skip`` of every file.

    The lines of a file's first block have consecutive ids, so a line's place
    follows from the least id of its file; nothing is numbered or sorted.
    """
    raw = F.col("value").cast("binary")
    text = F.col("value") if charset == "UTF-8" else F.decode(raw, charset)
    lines = spark.read.text(path).select(
        text.alias("line"), F.monotonically_increasing_id().alias("id"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    if skip:
        starts = lines.filter("block = 0").groupBy("file").agg(F.min("id").alias("start"))
        lines = lines.join(starts, "file").filter((F.col("block") > 0) | (F.col("id") - F.col("start") >= skip))
    return lines.filter(F.length(F.trim(F.col("line"))) > 0).select("line")


def settle_types(df: DataFrame) -> DataFrame:
    """Cast text columns to bigint or double where every value allows it (one aggregate)."""
    checks = []
    for i, name in enumerate(df.columns):
        filled = F.length(F.trim(quoted(name))) > 0
        checks += [F.every(~filled | quoted(name).try_cast("bigint").isNotNull()).alias(f"i{i}"),
                   F.every(~filled | quoted(name).try_cast("double").isNotNull()).alias(f"d{i}")]
    facts = df.agg(*checks).first()
    kinds = ["bigint" if facts[f"i{i}"] else "double" if facts[f"d{i}"] else None for i in range(len(df.columns))]
    return df.select(*[quoted(c).try_cast(k).alias(c) if k else quoted(c) for c, k in zip(df.columns, kinds)])
