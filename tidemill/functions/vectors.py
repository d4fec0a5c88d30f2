"""Expressions over arrays of scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def argmax(scores: Column) -> Column:
    """Index of the largest score, the first one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(scores: Column, label: Column) -> Column:
    """Softmax cross-entropy of one row, shifted by the largest score.

    A label that is none of the classes is an error; without a label there is no loss.
    """

    def shifted(top: Column) -> Column:
        total = F.aggregate(scores, F.lit(0.0), lambda sum_, z: sum_ + F.exp(z - top))
        return F.ln(total) + top - F.element_at(scores, label + 1)

    outside = (label < 0) | (label >= F.size(scores))
    message = F.concat(F.lit("no class has the label "), label.cast("string"))
    return F.when(outside, F.raise_error(message).cast("double")).otherwise(
        let(F.array_max(scores), shifted)
    )
