"""Deduplication.

Keep-first/keep-last per key is written as an aggregation
(``min_by``/``max_by`` of the whole row struct) rather than a
``row_number`` window: the aggregation combines map-side, so a key holding a
third of all rows is reduced inside every map task before the shuffle,
whereas a window would pull that key's rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def keep_one_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """W02 (first) / W03 (last): one row per key, chosen by ``order``."""
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by if last else F.min_by
    return (df.groupBy(*keys)
              .agg(pick(row, _order_struct(order)).alias("_row"))
              .select("_row.*")
              .select(*cols))


def keep_first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_one_per_key(df, keys, order, last=False)


def keep_last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_one_per_key(df, keys, order, last=True)


def drop_exact_duplicates(df: DataFrame, seq_col: str = "_seq") -> DataFrame:
    """Exact duplicate rows (all columns but the file-order column)
    collapse to their first occurrence."""
    data_cols = [c for c in df.columns if c != seq_col]
    return df.groupBy(*data_cols).agg(F.min(seq_col).alias(seq_col)).select(*df.columns)
