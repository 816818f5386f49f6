"""Tables in the Spark catalog: write modes, day partitions, clustering, upsert."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators.upsert import merge_customer_aggregates
from bazaarlake.schemas import TABLES, Table
from bazaarlake.session import write_and_read

log = logging.getLogger(__name__)

WRITE_MODES = ("WRITE_APPEND", "WRITE_EMPTY", "WRITE_TRUNCATE")


def write_mode(name: str) -> str:
    normal = name.strip().upper()
    if normal not in WRITE_MODES:
        raise ValueError(f"unknown write mode {name!r}; known: {WRITE_MODES}")
    return normal


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def day_column(df: DataFrame, partition_by: str) -> tuple[DataFrame, str]:
    """The daily partition column: a date serves itself, a timestamp gets ``*_day``."""
    if isinstance(df.schema[partition_by].dataType, T.DateType):
        return df, partition_by
    name = f"{partition_by}_day"
    return df.withColumn(name, F.to_date(partition_by)), name


def lay_out(df: DataFrame, day: str | None, cluster_by: Sequence[str]) -> DataFrame:
    """Rows of a day together, near cluster values together, no task too large.

    The rebalance exchange brings the rows of a day (without a day, of equal cluster
    values) into one partition, so a day has few files, and at run time cuts what
    exceeds the advisory partition size and merges what is small. So a hot day, or a
    hot customer inside it, becomes as many files as its size asks for, at any size of
    the table; each is sorted by the cluster columns.
    """
    order = [c for c in (day, *cluster_by) if c]
    if not order:
        return df
    return df.hint("rebalance", *(order[:1] if day else order)).sortWithinPartitions(*order)


def _write(
    df: DataFrame,
    schema: str,
    table: str,
    mode: str,
    partition_by: str | None,
    cluster_by: Sequence[str],
    metrics: dict[str, Column],
    helpers: Sequence[str] = (),
) -> dict[str, int]:
    """Write without the helper columns; returns the metrics, taken by the write job itself."""
    spark, mode = df.sparkSession, write_mode(mode)
    missing = [c for c in cluster_by if c not in df.columns]
    if partition_by and partition_by not in df.columns:
        raise ValueError(f"partition column {partition_by!r} not found")
    if missing:
        raise ValueError(f"cluster columns not found: {missing}")
    ensure_schema(spark, schema)
    target = f"{schema}.{table}"
    exists = spark.catalog.tableExists(target)
    if mode == "WRITE_EMPTY" and exists and not spark.table(target).isEmpty():
        raise ValueError(f"{target} holds rows already")
    rows, day = df, None
    if partition_by:
        rows, day = day_column(rows, partition_by)
    taken = Observation()
    rows = lay_out(rows, day, cluster_by)
    rows = rows.observe(taken, *[m.alias(n) for n, m in metrics.items()]).drop(*helpers)
    writer = rows.write.format("parquet")
    if day:
        writer = writer.partitionBy(day)
    writer.mode("overwrite" if mode == "WRITE_TRUNCATE" else "append").saveAsTable(target)
    return taken.get


def write_table(
    df: DataFrame,
    schema: str,
    table: str,
    mode: str = "WRITE_APPEND",
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
) -> int:
    """Write a table by mode, day partition and clustering; returns the rows written."""
    if df.isEmpty():
        raise ValueError(f"nothing to write to {schema}.{table}: no rows")
    rows = {"rows": F.count(F.lit(1))}
    return _write(df, schema, table, mode, partition_by, cluster_by, rows)["rows"]


def run_sql(
    spark: SparkSession, query: str, args: dict[str, object] | None = None,
    to_dataframe: bool = False,
) -> DataFrame | Iterator[Row]:
    """Run SQL with named parameters; a lazy frame, or rows streamed one partition at a time."""
    result = spark.sql(query, args=args or {})
    return result if to_dataframe else result.toLocalIterator()


def load_tables(
    tables: dict[str, DataFrame], schema: str, mode: str = "WRITE_TRUNCATE",
    day_folders: bool = True,
) -> dict[str, int]:
    """Write each table by its layout in ``schemas.TABLES``; empty ones count 0.

    Tables with a day have a folder per day, whatever their size, unless the caller
    asks for none: then rows are kept in day order.
    """
    summary, mode = {}, write_mode(mode)
    for name, df in tables.items():
        spec = TABLES[name]
        if df.isEmpty():
            log.warning("%s is empty, not loaded", name)
            summary[name] = 0
            continue
        rows = {"rows": F.count(F.lit(1))}
        day, cluster = _layout(spec, day_folders)
        summary[name] = _write(df, schema, name, mode, day, cluster, rows)["rows"]
    return summary


def _layout(spec: Table, day_folders: bool) -> tuple[str | None, tuple[str, ...]]:
    if day_folders or not spec.day:
        return spec.day, spec.cluster
    return None, (spec.day, *spec.cluster)


def load_dimensions(tables: dict[str, DataFrame], schema: str, mode: str = "WRITE_TRUNCATE",
                    day_folders: bool = True):
    order = ("dim_customers", "dim_products", "dim_locations", "dim_date")
    return load_tables({t: tables[t] for t in order if t in tables}, schema, mode, day_folders)


def load_facts(tables: dict[str, DataFrame], schema: str, mode: str = "WRITE_TRUNCATE",
               day_folders: bool = True):
    order = ("fact_orders", "fact_order_items", "fact_payments", "fact_cart_events",
             "fact_bank_transactions")
    return load_tables({t: tables[t] for t in order if t in tables}, schema, mode, day_folders)


def day_files(spark: SparkSession, target: str) -> DataFrame:
    """(day, files, bytes) per day folder of a table, from the listing of its files alone."""
    day = _day_folder(spark, target)
    place = spark.sql(f"DESCRIBE FORMATTED {target}").filter("col_name = 'Location'").first()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(place["data_type"])
    named = F.regexp_extract("path", f"/{day}=([^/]+)/", 1)
    return listed.select(named.alias("name"), "length").groupBy(
        F.when(F.col("name") != "__HIVE_DEFAULT_PARTITION__", F.col("name")).cast("date").alias(
            "day")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _day_folder(spark: SparkSession, target: str) -> str:
    folders = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    if len(folders) != 1:
        raise ValueError(f"{target} has no day folders")
    return folders[0]


def compact_days(
    spark: SparkSession, schema: str, table: str, cluster_by: Sequence[str] = (),
    file_bytes: int = 128 * 2**20,
) -> int:
    """Rewrite the day folders with more files than their bytes ask for; returns how many.

    Appends leave files in a day's folder. Folders that are well packed are not read. Days to
    rewrite share tasks while they are small, and a large one takes several (see
    ``lay_out``). Rows go through the shared folder, then each folder is replaced.
    """
    target = f"{schema}.{table}"
    day = _day_folder(spark, target)
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes))
    crowded = day_files(spark, target).filter(F.col("files") > needed).select("day").collect()
    if not crowded:
        return 0
    days = [row["day"] for row in crowded]  # one value per folder to rewrite
    known = [d for d in days if d is not None]
    wanted = F.col(day).isin(known) if known else F.lit(False)
    if None in days:
        wanted = wanted | F.col(day).isNull()
    ready = write_and_read(spark.table(target).filter(wanted), table)
    _replace_folders(lay_out(ready, day, cluster_by), target)
    return len(days)


def _replace_folders(rows: DataFrame, target: str) -> None:
    """Overwrite the partitions that ``rows`` have, each when its new files are complete.

    The mode of inserts into a table is a setting of the session, so it is set meanwhile.
    """
    spark, name = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "dynamic")
    try:
        rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def update_customer_aggregates(spark: SparkSession, schema: str) -> int:
    """Upsert order aggregates into ``dim_customers``; returns the customers matched.

    Plain tables have no MERGE. With day folders only the folders that hold a matched
    customer are rewritten, each replaced when its new files are complete; the others
    keep their files, and the table stays in place. The merged rows are written to
    the shared folder first, so what is read is never what is replaced, and a failed
    replacement can be repeated from the copy.
    """
    target, spec = f"{schema}.dim_customers", TABLES["dim_customers"]
    customers, orders = spark.table(target), spark.table(f"{schema}.fact_orders")
    folders = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    merged = merge_customer_aggregates(customers, orders)
    if not folders:
        ready = write_and_read(merged, "dim_customers")
        return _write(ready, schema, "dim_customers", "WRITE_TRUNCATE", None,
                      _layout(spec, False)[1], {"matched": F.count_if("is_matched")},
                      helpers=["is_matched"])["matched"]
    day = folders[0]
    merged, made = day_column(merged, spec.day)
    ready = write_and_read(merged.withColumnRenamed(made, day), "dim_customers")
    touched = ready.filter("is_matched").select(F.col(day).alias("_day")).distinct()
    changed = ready.join(touched, ready[day].eqNullSafe(touched["_day"]), "left_semi")
    taken = Observation()
    rows = lay_out(changed, day, spec.cluster).observe(
        taken, F.count_if("is_matched").alias("matched"))
    _replace_folders(rows, target)
    return taken.get["matched"]
