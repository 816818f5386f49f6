"""Date keys and surrogate keys."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.casts import cast_date
from bazaarlake.functions.columns import literal
from bazaarlake.functions.names import quoted

log = logging.getLogger(__name__)


def joined_sql(parts: Sequence[str], separator: str = "_") -> str:
    """Parts as text joined by a separator; a null part counts as empty text.

    ``concat_ws`` alone would skip nulls and shift the later parts.
    """
    texts = [f"coalesce(cast({quoted(p)} as string), '')" for p in parts]
    return f"concat_ws({literal(separator)}, {', '.join(texts)})"


def surrogate_key(
    df: DataFrame, columns: Sequence[str], name: str = "surrogate_key", separator: str = "_"
) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        log.error("columns %s not found; no surrogate key made", missing)
        return df
    return df.withColumn(name, F.expr(joined_sql(columns, separator)))


def date_key(df: DataFrame, column: str, name: str = "date_key") -> DataFrame:
    """The calendar day of a timestamp; an unreadable value gives null."""
    if column not in df.columns:
        log.warning("column %r not found; no date key made", column)
        return df
    return df.withColumn(name, F.expr(cast_date(quoted(column), df.schema[column].dataType)))
