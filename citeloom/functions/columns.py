"""Helpers for columns that are dear to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, name: str) -> Column:
    """A column behind a one-row generator, so that it is computed once.

    Otherwise the optimizer copies the expression into every later filter,
    hash and loop that mentions the column.
    """
    return F.explode(F.array(value)).alias(name)


def together(df: DataFrame) -> DataFrame:
    """The rows behind a one-row generator, so that every reading asks for all of their columns.

    Of a table that is read twice the optimizer keeps other columns each time,
    so the shuffles below differ and are done twice; here they are the same and
    done once. Columns that no reading needs should go before.
    """
    return df.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))
