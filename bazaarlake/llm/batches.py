"""Arrow batches in, the same columns plus computed ones out."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Words of the query contracts: runs without space, tab, line feed, VT, FF, CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Texts of a batch are worked on in runs of about this many characters.
RUN_CHARS = 4_000_000


def quoted(name: str) -> str:
    """A column reference that survives dots and backticks in names."""
    return "`" + name.replace("`", "``") + "`"


def lower_ascii(text: str) -> str:
    return text.translate(_LOWER)


def runs(texts: list[str | None], limit: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of a list with bounded characters (one long text may exceed the bound)."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def with_text_columns(
    df: DataFrame, text: str, schema: str,
    make: Callable[[], Callable[[list[str | None]], dict[str, list]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with the columns of ``schema`` computed from the column ``text``.

    ``make()`` runs once per task and returns a function from a list of texts to
    lists of values by column name. As with ``withColumn``, an input column of the
    same name (in any case) is replaced; all other columns pass through untouched
    as Arrow data. ``keep`` names the columns to carry (all by default).
    """
    added = T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    # Positional names on the way, as names with dots cannot pass to Python tasks.
    source = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)],
                       F.col(quoted(text)).cast("string").alias("text"))
    result = T.StructType([*source.schema.fields[:-1], *added.fields])
    kinds = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added]

    def work(batches):
        compute = make()
        for batch in batches:
            for start, end in runs(texts := batch.column(batch.num_columns - 1).to_pylist()):
                part = batch.slice(start, end - start)
                values = compute(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    part.columns[:-1] + [pa.array(values[k.name], k.type) for k in kinds],
                    schema=pa.schema([*[part.schema.field(i)
                                        for i in range(part.num_columns - 1)], *kinds]))

    return source.mapInArrow(work, result).toDF(*kept, *added.names)
