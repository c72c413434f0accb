"""Predicates of the pipeline (F1) as Column expressions.

All are plain comparisons on stored columns, so Catalyst pushes them into the
Parquet scan (row-group statistics) or turns them into partition filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.functions import timeutil as tu


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_day_range(ts, start_day: str, end_day: str, tz: str = tu.LOCAL_TZ) -> Column:
    """Half-open range of local days ``[start_day, end_day)`` on an instant (F1).

    The bounds are folded to UTC instants at planning time, so the predicate
    stays a simple range on the stored column.
    """
    lo = F.to_utc_timestamp(F.lit(start_day).cast("timestamp"), tz)
    hi = F.to_utc_timestamp(F.lit(end_day).cast("timestamp"), tz)
    return (_c(ts) >= lo) & (_c(ts) < hi)
