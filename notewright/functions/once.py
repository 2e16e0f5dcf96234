"""Keeping an expensive column from being computed more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with the named columns computed below this point only.

    A filter on a derived column is pushed below the projection that derives it, with the
    column's whole expression in it, and a join on a column that comes from a chain of
    projections is traced down and written out, doubling at every step. Passing a one-row
    generator, the named columns have no expression to trace; filters on the other columns still
    go through to the scan. Everything named is computed, read or not, so name what is needed.
    """
    others = [c for c in df.columns if c not in columns]
    row = F.struct(*[F.col(c).alias(c) for c in columns])
    return df.select(*others, F.inline_outer(F.array(row))).select(*df.columns)
