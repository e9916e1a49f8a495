"""Join-side sizing.

A side is broadcast only when its row count has a *static* bound (for
example 24 hours of the day × 7 weekdays when no meter key is grouped on).
Any other side is left to adaptive execution, which measures the shuffled
size at run time and switches to a broadcast join only below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join stays a
shuffled join, with skewed partitions split (``skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is copied to every executor; 1M narrow rows is tens of MB.
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast only for a proven-small side."""
    if max_rows is not None and max_rows <= MAX_BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def profile_bound(by: Sequence[str], keys_per_group: int) -> int | None:
    """Row bound of a profile keyed by ``by`` + a fixed calendar key: known
    only when ``by`` is empty (otherwise it grows with the number of meters)."""
    return keys_per_group if not by else None
