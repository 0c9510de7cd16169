"""Logits to scores and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def threshold_logit(z: Column) -> Column:
    """1 where ``sigmoid(z) > 0.5``, strictly; the comparison is made on the logit itself."""
    return (z > 0).cast("int")


def softmax_score(logits: Column, index: int = 1) -> Column:
    """Softmax probability of one class, with the largest logit subtracted first."""
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - top))
    return F.exp(F.get(logits, F.lit(index)) - top) / total


def argmax_class(logits: Column) -> Column:
    """Index of the largest logit, the first one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def row_log_loss(logit: Column, label: Column) -> Column:
    """Binary cross-entropy of one row, stable for large logits."""
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))
