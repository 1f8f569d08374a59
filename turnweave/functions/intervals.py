"""Column expressions on intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length that two intervals share; 0 where they only touch or lie apart."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def midpoint(start: Column, end: Column) -> Column:
    return (start + end) / 2


def near_source_edge(start: Column, end: Column, duration: Column, margin: float | int) -> tuple[Column, Column]:
    """Whether an interval begins, and ends, within `margin` of the recording's edges."""
    return start <= margin, duration - end <= margin


def contains(start: Column, end: Column, point: Column) -> Column:
    """Both ends included, so a point on a shared edge lies in two touching intervals."""
    return (start <= point) & (point <= end)
