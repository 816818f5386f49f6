"""Find the few keys that hold too many rows for one task.

The answer is computed from exact counts, so every branch of a plan that asks
sees the same set, also after a lost executor recomputes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group up to this many rows is ordinary work for one task, at any size of the data.
ROWS_PER_TASK = 1_000_000


def heavy_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows.

    One narrow scan with map-side counting. There are never more than all rows divided
    by ``rows_per_task`` of them, but that grows with the data, so no join here is
    forced to broadcast them: Spark does while the set is small, and shuffles beyond.
    """
    known = df.filter(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > rows_per_task).select(key)


def split_by_weight(df: DataFrame, heavy: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, rows of heavy keys). Rows with a null key are ordinary."""
    return df.join(heavy, key, "left_anti"), df.join(heavy, key, "left_semi")
