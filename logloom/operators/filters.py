"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.time import as_instant


def time_range(records: DataFrame, min_timestamp=None, max_timestamp=None) -> DataFrame:
    """Records with ``min_timestamp <= @timestamp < max_timestamp``.

    A bound is a text, a ``datetime`` or a column; without one that side is
    open.
    """
    ts = F.col("`@timestamp`")
    if min_timestamp is not None:
        records = records.where(ts >= as_instant(min_timestamp))
    if max_timestamp is not None:
        records = records.where(ts < as_instant(max_timestamp))
    return records
