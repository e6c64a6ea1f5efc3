"""Checks that fail the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """``df``, failing with ``message`` on the first row where ``ok`` is not true.

    A filter, since an error inside a column goes away when that column is pruned. A later filter
    on the same column may be evaluated in its place: use ``keep_checked`` to check and select at once.
    """
    return df.where(F.when(ok, True).otherwise(F.raise_error(message).cast("boolean")))


def keep_checked(df: DataFrame, keep: Column, allowed: Column, message: Column) -> DataFrame:
    """Rows where ``keep`` is true, failing with ``message`` on a row that is neither kept nor ``allowed``."""
    return df.where(F.when(keep, True).when(allowed, False).otherwise(F.raise_error(message).cast("boolean")))
