"""Vectors, arrays and class scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

__all__ = ["bound", "confidence", "expand", "softmax", "top_index", "vector_to_array"]


def expand(array: Column, names, prefix: str = "") -> list:
    """One named column per array element."""
    return [array[i].alias(f"{prefix}{name}") for i, name in enumerate(names)]


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as the variable of a lambda."""
    return F.transform(F.array(value), body)[0]


def softmax(scores: Column) -> Column:
    """Softmax of an array column, shifted by its maximum so it cannot overflow.

    Maximum, exponentials and total are each computed once a row, so the cost
    is linear in the number of scores.
    """
    def shifted(most):
        return F.transform(scores, lambda x: F.exp(x - most))

    def share(parts):
        return bound(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(parts, lambda x: x / total))

    return bound(bound(F.array_max(scores), shifted), share)


def top_index(scores: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)
