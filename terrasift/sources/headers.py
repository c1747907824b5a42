"""Column-name clean-up for catalogue headers."""

from __future__ import annotations

from collections import Counter


def clean_name(name: str) -> str:
    """Trim and turn full-width brackets into ASCII ones."""
    return str(name).strip().replace("（", "(").replace("）", ")")


def clean_headers(df):
    return df.toDF(*[clean_name(c) for c in df.columns])


def safe_names(raw) -> list:
    """Raw header names -> the names Spark's CSV reader gives them.

    Names that collide without regard to case get their zero-based position
    appended, so ``mb, mB`` at positions 8 and 9 read back as ``mb8, mB9``.
    """
    seen = Counter(name.lower() for name in raw)
    return [f"{name}{i}" if seen[name.lower()] > 1 else name for i, name in enumerate(raw)]


def apply_safe_names(df):
    return df.toDF(*safe_names(df.columns))


def resolve_columns(wanted, actual) -> list:
    """Configured names as a table read from CSV has them.

    A name that is absent but present with its position appended (``mb`` as
    ``mb8`` in column 8) is one the reader told apart; others stay as they are,
    so that a later check can name them.
    """
    numbered = {name: i for i, name in enumerate(actual)}

    def resolve(name):
        if name in numbered:
            return name
        return next((c for c, i in numbered.items() if c == f"{name}{i}"), name)
    return [resolve(name) for name in wanted]
