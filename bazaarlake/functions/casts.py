"""Tolerant casts: a value that does not fit its type becomes null, never an error.

Each cast maps SQL text to SQL text, so a builder hands Spark one expression
per column.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.fixed_values import FALSE_TOKENS, TRUE_TOKENS
from bazaarlake.functions.names import quoted

log = logging.getLogger(__name__)

MONEY = "decimal(18,2)"


def _words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def cast_int(value: str, source: T.DataType) -> str:
    """Whole numbers only: ``10`` and ``10.0`` pass, ``10.5`` gives null."""
    if isinstance(source, T.IntegralType):
        return f"cast({value} as bigint)"
    exact = f"try_cast({value} as decimal(38,6))"
    return f"case when {exact} = floor({exact}) then try_cast({exact} as bigint) end"


def cast_double(value: str, source: T.DataType) -> str:
    return f"nullif(try_cast({value} as double), double('NaN'))"


def cast_money(value: str, source: T.DataType) -> str:
    return f"try_cast({value} as {MONEY})"


def cast_string(value: str, source: T.DataType) -> str:
    return value if isinstance(source, T.StringType) else f"cast({value} as string)"


def cast_bool(value: str, source: T.DataType) -> str:
    if isinstance(source, T.BooleanType):
        return value
    token = f"lower(trim(cast({value} as string)))"
    return (f"case when {token} in ({_words(TRUE_TOKENS)}) then true "
            f"when {token} in ({_words(FALSE_TOKENS)}) then false end")


def cast_timestamp(value: str, source: T.DataType) -> str:
    if isinstance(source, T.TimestampType):
        return value
    if isinstance(source, T.NumericType):
        value = f"cast({value} as string)"
    return f"try_cast({value} as timestamp)"


def cast_date(value: str, source: T.DataType) -> str:
    if isinstance(source, T.DateType):
        return value
    return f"to_date({cast_timestamp(value, source)})"


_BY_NAME = {
    "int": cast_int, "int64": cast_int, "integer": cast_int,
    "float": cast_double, "float64": cast_double,
    "numeric": cast_money, "number": cast_money,
    "string": cast_string, "str": cast_string,
    "bool": cast_bool, "boolean": cast_bool,
    "datetime": cast_timestamp, "datetime64[ns]": cast_timestamp,
    "date": cast_date,
}


def cast_to(value: str, source: T.DataType, type_name: str) -> str:
    try:
        caster = _BY_NAME[type_name.lower()]
    except KeyError:
        raise ValueError(f"unknown type name {type_name!r}; known: {sorted(_BY_NAME)}") from None
    return caster(value, source)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Apply ``{column: type name}`` in one projection; absent columns only warn."""
    casts = {}
    for name, type_name in types.items():
        if name not in df.columns:
            log.warning("column %r not found for type casting", name)
            continue
        casts[name] = F.expr(cast_to(quoted(name), df.schema[name].dataType, type_name))
    return df.withColumns(casts) if casts else df
