"""Thresholds and confidence on a probability column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The cut-offs of serving, tuning / pseudo-labels, and self-training.
SERVING_THRESHOLD = 0.35
EVEN_THRESHOLD = 0.50
CONFIDENCE = 0.95


def threshold(p: Column, cut: float = SERVING_THRESHOLD, strict: bool = True) -> Column:
    return (p > F.lit(cut) if strict else p >= F.lit(cut)).cast("int")


def is_confident(p: Column, cut: float = CONFIDENCE) -> Column:
    """Strictly outside [1 - cut, cut]. An unknown probability is not confident."""
    return F.coalesce((p > F.lit(cut)) | (p < F.lit(1 - cut)), F.lit(False))
