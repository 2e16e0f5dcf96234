"""Ratios that are zero when there is nothing to divide by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def precision_recall_f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return p, r, ratio(2 * p * r, p + r)
