"""Interval arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the intersection, never negative."""
    return F.greatest(F.lit(0.0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def touches(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Strict overlap: sharing only an end does not count."""
    return (a_start < b_end) & (a_end > b_start)


def inside(t: Column, start: Column, end: Column) -> Column:
    """Half-open membership."""
    return (t >= start) & (t < end)


def shares(s_start: Column, s_end: Column, g_start: Column, g_end: Column) -> tuple[Column, Column, Column]:
    """Intersection over union, over the segment, and over the annotated range."""
    length, truth = s_end - s_start, F.greatest(g_end - g_start, F.lit(1e-9))
    common = overlap(s_start, s_end, g_start, g_end)
    union = length + truth - common
    over = lambda x: F.when(x > 0, common / x).otherwise(F.lit(0.0))
    return over(union), over(length), common / truth


def is_match(s_start: Column, s_end: Column, g_start: Column, g_end: Column) -> Column:
    """Whether an annotated range makes a segment positive."""
    iou, of_segment, of_truth = shares(s_start, s_end, g_start, g_end)
    rule = (iou > C.MIN_IOU) | (of_segment > C.MIN_SEGMENT_SHARE) | ((of_truth > C.MIN_TRUTH_SHARE) & (of_segment >= C.MIN_SHARE_FOR_TRUTH))
    return (s_end > s_start) & (overlap(s_start, s_end, g_start, g_end) > 0) & rule
