"""JDBC snapshot / increment reader.

The reference reads a whole source table (or ``WHERE mark > last``) through one
connection. Here the increment is a DataFrame filter that Catalyst pushes into
the database's WHERE clause, and a numeric ``partition_column`` with bounds
splits the read into ``num_partitions`` parallel range queries.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from medallion.operators.silver import incremental_slice


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def jdbc_read(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    load_type: str | None = None,
    watermark_column: str | None = None,
    last_mark: str | None = None,
    one_task: bool = False,
    **partitioning,
) -> DataFrame:
    """``SELECT * FROM table`` (FULL) or ``... WHERE mark > last`` (APPEND/MERGE with a mark).

    Without a ``partition_column`` one task reads the whole table; ``one_task=True`` says that this is meant."""
    if not one_task and not partitioning.get("partition_column"):
        raise ValueError(f"{table}: give partition_column with its bounds, or one_task=True to read it in a single task")
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **partitioning)).load()
    return incremental_slice(df, load_type, watermark_column, last_mark)


def jdbc_reader(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    **partitioning,
):
    """``read(load_type, watermark_column, last_mark)`` for ``Lakehouse.ingest_frame``."""
    return lambda load_type, watermark_column, last_mark: jdbc_read(
        spark, url, table, properties, load_type, watermark_column, last_mark, **partitioning
    )


def source_table_name(source_schema: str | None, source_table: str) -> str:
    return f"{source_schema}.{source_table}" if source_schema else source_table
