"""Freshness and expiry of operational rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.events import before


def unexpired(ts_col: str, seconds: int, as_of: Column | str) -> Column:
    """Does the row's time plus ``seconds`` lie after ``as_of``? NULL times never expire."""
    return (F.col(ts_col) > before(as_of, seconds)) | F.col(ts_col).isNull()


def retain(df: DataFrame, ts_col: str, seconds: int, as_of: Column | str) -> DataFrame:
    """Rows not yet expired."""
    return df.filter(unexpired(ts_col, seconds, as_of))


def fresh(df: DataFrame, ts_col: str, seconds: int, as_of: Column | str) -> DataFrame:
    """Rows whose time is at most ``seconds`` before ``as_of``."""
    return df.filter(F.col(ts_col) >= before(as_of, seconds))
