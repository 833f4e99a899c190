"""Computed columns that are worked out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, out: str, value: Column | str) -> DataFrame:
    """Add a dear column that is about to be filtered on.

    A filter on a plain computed column moves below the projection by repeating the whole expression, so
    the work is done twice. A one-row generator stops it: the value is made once and then tested.
    """
    cell = (F.expr(value) if isinstance(value, str) else value).alias(out)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != out], F.inline_outer(F.array(F.struct(cell))))
