"""Turning numbers and nested ids into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def bucket(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose threshold ``value`` exceeds; steps go from high to low."""
    label = F.lit(otherwise)
    for threshold, name in reversed(steps):
        label = F.when(value > threshold, F.lit(name)).otherwise(label)
    return label


def first_present(candidates: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """Result paired with the first non-null candidate."""
    result = otherwise
    for candidate, value in reversed(candidates):
        result = F.when(candidate.isNotNull(), value).otherwise(result)
    return result
