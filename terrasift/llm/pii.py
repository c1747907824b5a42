"""Personal data: proposed by patterns, confirmed by validators, weighed by context.

Each kind has a pattern that proposes spans, and a validator: Luhn's sum for
cards, the value of the parts for addresses, the number of digits for phones and
the remainder by 97 for bank accounts (IBAN). A span's score starts at the prior
of its kind, gains ``CONFIRMED`` if a checksum held and ``CONTEXT`` if a word of
its kind stands within ``NEAR`` characters. Kinds in ``STATED`` need only their
validator; of the others, spans below ``LEAST`` are dropped.

Only DataFrame functions are used; each row is judged on its own, so nothing is
shuffled. Patterns are written so that matching stays linear in the text.

Defined cases: a null or empty text has no spans; spans of different kinds may
overlap; rows with one ``doc_id`` are judged each; an empty table gives an empty
result. Positions count code points, end exclusive. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.target_rules import bound

# Fixed patterns. ``(?:(?<!x)|\G)`` lets a run of x be entered at its start or where the last match ended, which is where
# the leftmost match begins in any case; possessive marks (``++``) stop retries that cannot succeed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[\x20.-]{0,2})(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
STATED = ("email", "ip", "card", "phone")
MARK = {"email": "@", "phone": "+"}  # a text without it has no such span
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.4, "local": 0.4}
WORDS = {"email": "mail|contact", "ip": "ip|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|tel|call|fax|mobile",
         "iban": "iban|account|bank|konto", "ssn": "ssn|social|security", "local": "phone|tel|call|fax|mobile"}
SHORTEST = {"email": 5, "ip": 7, "card": 1, "phone": 4, "iban": 15, "ssn": 11, "local": 12}  # characters of a match
CONFIRMED, CONTEXT, LEAST, NEAR = 0.4, 0.3, 0.6, 40
BLOCK = 512


def starts(pieces: Column, matches: Column) -> Column:
    """Where each match starts, from the pieces between matches. Written in blocks, as appending copies an array."""
    def add(acc, k):
        at = (acc["end"] + F.length(F.get(pieces, k))).cast("int")
        full = F.size(acc["open"]) >= BLOCK
        return F.struct(
            (at + F.length(F.get(matches, k))).cast("int").alias("end"),
            F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(at)).otherwise(F.concat(acc["open"], F.array(at))).alias("open"))

    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<array<int>>").alias("done"), F.array().cast("array<int>").alias("open"))
    return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), zero, add,
                       lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["open"]))))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """12 to 19 digits whose Luhn sum ends in 0."""
    def holds(digits):
        def add(total, k):
            value = F.substring(digits, -k, 1).cast("int")
            twice = value * 2
            return (total + F.when(k % 2 == 1, value).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0

    return bound(_digits(match), lambda d: F.when(F.length(d).between(12, 19), holds(d)).otherwise(F.lit(False)))


def mod97(match: Column) -> Column:
    """The account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1 by 97."""
    def holds(plain):
        moved = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")

        def add(rest, c):
            digit = c.try_cast("int")
            return F.coalesce((rest * 10 + digit) % 97, (rest * 100 + F.ascii(c) - 55) % 97).cast("int")
        return F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0), add) == 1

    return bound(F.regexp_replace(match, " ", ""), lambda p: F.length(p).between(15, 34) & holds(p))


def valid(kind: str, match: Column) -> Column:
    if kind == "card":
        return luhn(match)
    if kind == "iban":
        return mod97(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(part.try_cast("decimal(38,0)") <= 255, F.lit(False)))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """Array of (start, order, end, kind, score) of the confirmed spans of one kind."""
    pattern, order = PATTERNS[kind], list(PATTERNS).index(kind)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,score:double>>")

    # So many neighbouring matches, with the pieces beside them, fill ``NEAR`` characters.
    reach = 2 * -(-NEAR // SHORTEST[kind]) + 1

    def spans(matches, heads, tails, at):
        def one(match, k):
            # Match k is element 2k + 2 of the parts, counted from 1.
            low = F.greatest(2 * k + 2 - reach, F.lit(1))
            before = F.array_join(F.slice(tails, low, 2 * k + 2 - low), "")
            after = F.array_join(F.slice(heads, 2 * k + 3, F.lit(reach)), "")
            near = F.lower(F.concat_ws(" ", F.right(before, F.lit(NEAR)), F.left(after, F.lit(NEAR))))
            score = F.lit(PRIOR[kind] + (CONFIRMED if kind in ("card", "iban") else 0.0)) + F.when(
                near.rlike(rf"(?<![a-z])({WORDS[kind]})"), F.lit(CONTEXT)).otherwise(F.lit(0.0))
            return F.when(valid(kind, match), F.struct(
                at[k].alias("start"), F.lit(order).alias("order"), (at[k] + F.length(match)).cast("int").alias("end"),
                F.lit(kind).alias("kind"), score.alias("score")))

        found = F.filter(F.transform(matches, one), lambda x: x.isNotNull())
        return found if kind in STATED else F.filter(found, lambda x: x["score"] >= LEAST)

    def build(matches):
        def cut(pieces):
            # Pieces and matches in turn, of each only the ends that can stand within ``NEAR`` characters of another match.
            def ends(side):
                return F.flatten(F.transform(pieces, lambda piece, k: F.array(
                    side(piece, F.lit(NEAR)), side(F.coalesce(F.get(matches, k), F.lit("")), F.lit(NEAR)))))
            return bound(starts(pieces, matches), lambda at: bound(ends(F.left), lambda heads: bound(
                ends(F.right), lambda tails: spans(matches, heads, tails, at))))
        return F.when(F.size(matches) == 0, none).otherwise(bound(F.split(text, pattern, -1), cut))

    present = F.contains(text, F.lit(MARK[kind])) if kind in MARK else F.col("has_digits")
    found = F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return bound(found, build)


def with_spans(documents: DataFrame) -> DataFrame:
    """doc_id and ``spans``: all spans, with their scores, by start and then kind."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("has_digits", F.col("text").rlike("[0-9]"))
    rows = rows.select("doc_id", *[spans_of(kind, F.col("text")).alias(kind) for kind in PATTERNS])
    return rows.select("doc_id", F.array_sort(F.concat(*PATTERNS)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the stated kinds, and all spans as one string, of every document."""
    rows = with_spans(documents)
    base = F.filter("spans", lambda x: x["order"] < len(STATED))

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in STATED]
    return rows.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
