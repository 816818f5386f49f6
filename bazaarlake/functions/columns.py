"""Projection helpers: first-of-many spellings, nested fields, defaults, conforming."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.casts import cast_to
from bazaarlake.functions.names import quoted

log = logging.getLogger(__name__)

Nested = Iterable[tuple[str, str]]


def _is_scalar(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def literal(value: object) -> str:
    """A Python text, number or truth value as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower()


def nested_field(df: DataFrame, column: str, path: str) -> tuple[str, T.DataType] | None:
    """SQL and type of a dotted path below a struct; None when absent or not a scalar."""
    if column not in df.columns:
        return None
    value, dtype = quoted(column), df.schema[column].dataType
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return None
        value, dtype = f"{value}.{quoted(part)}", dtype[part].dataType
    return (value, dtype) if _is_scalar(dtype) else None


def coalesce_sql(
    df: DataFrame,
    candidates: Iterable[str],
    type_name: str,
    nested: Nested = (),
    default: object = None,
) -> str:
    """First non-null candidate, then cast, as SQL text.

    The choice is made on the raw values, so a present but unreadable value
    hides later candidates and ends as null. Catalyst needs one type per
    expression: mixed raw types meet as text before the cast.
    """
    present = set(df.columns)
    found = [
        (quoted(c), df.schema[c].dataType)
        for c in dict.fromkeys(candidates)
        if c in present and _is_scalar(df.schema[c].dataType)
    ]
    found += [hit for column, path in nested if (hit := nested_field(df, column, path))]
    if not found:
        found = [("cast(null as string)", T.StringType())]
    dtype = found[0][1]
    if any(t != dtype for _, t in found):
        dtype = T.StringType()
    parts = [v if t == dtype else f"cast({v} as string)" for v, t in found]
    chosen = parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"
    value = cast_to(chosen, dtype, type_name)
    return value if default is None else f"coalesce({value}, {literal(default)})"


def coalesce_columns(
    df: DataFrame,
    candidates: Iterable[str],
    type_name: str,
    nested: Nested = (),
    default: object = None,
) -> Column:
    return F.expr(coalesce_sql(df, candidates, type_name, nested, default))


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add each missing column as a typed null."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type: missing null, extra dropped."""
    present = set(df.columns)

    def column(field: T.StructField) -> str:
        name = quoted(field.name)
        if field.name not in present:
            return f"cast(null as {field.dataType.simpleString()}) as {name}"
        if df.schema[field.name].dataType == field.dataType:
            return name
        return f"cast({name} as {field.dataType.simpleString()}) as {name}"

    return df.selectExpr(*[column(f) for f in schema], *[c for c in keep if c in present])


def default_sql(df: DataFrame, column: str, value: str | None) -> str:
    constant = "cast(null as string)" if value is None else literal(value)
    if column not in df.columns:
        return constant
    return f"coalesce(cast({quoted(column)} as string), {constant})"


def default_literal(df: DataFrame, column: str, value: str | None) -> Column:
    """The column with nulls filled by a constant; the constant alone when absent."""
    return F.expr(default_sql(df, column, value))


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls per column by a constant of the column's own type."""
    fills = {}
    for name, value in values.items():
        if name not in df.columns:
            log.warning("column %r not found for filling", name)
            continue
        fills[name] = F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
    return df.withColumns(fills) if fills else df


def line_total_sql(total: str, quantity: str, price: str) -> str:
    """A given total, or quantity times price with nulls as zero."""
    product = f"coalesce({quantity}, 0D) * double(coalesce({price}, 0))"
    return f"coalesce({total}, try_cast({product} as decimal(18,2)))"
