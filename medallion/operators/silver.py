"""Bronze -> silver operators: incremental slice, audit columns, next watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_TYPES = ("FULL", "APPEND", "MERGE")
INCREMENTAL = ("APPEND", "MERGE")


def validate_load_type(load_type: str | None) -> str:
    if load_type not in LOAD_TYPES:
        raise ValueError(f"Unsupported load_type: {load_type}")
    return load_type


def uses_watermark(load_type: str | None, watermark_column: str | None) -> bool:
    return load_type in INCREMENTAL and bool(watermark_column)


def mark_literal(df: DataFrame, column: str, mark: str) -> Column:
    """The stored text mark cast to the column's own type (explicit, no implicit string compare)."""
    return F.lit(mark).cast(df.schema[column].dataType)


def incremental_slice(df: DataFrame, load_type: str | None, watermark_column: str | None, last_mark: str | None) -> DataFrame:
    """Rows after the mark (strict ``>``) for APPEND/MERGE with a mark; everything otherwise.

    Rows whose mark column is null are never selected once a mark exists.
    """
    if uses_watermark(load_type, watermark_column) and last_mark:
        return df.filter(F.col(watermark_column) > mark_literal(df, watermark_column, last_mark))
    return df


def latest_file(bronze: DataFrame, time_column: str = "insert_timestamp") -> DataFrame:
    """Rows of the last delivery only: all files (or the bounded read) of the latest ingest time.

    For file tables re-delivered as full snapshots, where FULL over all of bronze
    would stack every delivery. The time is found with a global aggregate
    (exactly one row, so broadcasting it is bounded) and selected by an equi-join.
    """
    best = bronze.agg(F.max(time_column).alias("_latest_delivery"))
    return bronze.join(F.broadcast(best), F.col(time_column) == F.col("_latest_delivery"), "inner").drop("_latest_delivery")


def null_mark_rows(df: DataFrame, watermark_column: str) -> DataFrame:
    """Rows an incremental load can never pick up (null mark) — for reporting."""
    return df.filter(F.col(watermark_column).isNull())


def stamp(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def with_silver_audit(df: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """insert_timestamp and update_timestamp set to now (replacing bronze's insert_timestamp)."""
    now = stamp(as_of)
    return df.withColumns({"insert_timestamp": now, "update_timestamp": now})


def with_bronze_audit(df: DataFrame, file_path: Column | None = None, as_of: datetime | Column | None = None) -> DataFrame:
    """insert_timestamp = now; source_file_name = file path, or a null string for database sources."""
    src = file_path if file_path is not None else F.lit(None).cast("string")
    return df.withColumns({"insert_timestamp": stamp(as_of), "source_file_name": src})


def max_mark(df: DataFrame, column: str) -> Column:
    """Aggregate for the new mark as text, made in the engine (the driver's time zone plays no part).

    A zoned timestamp is written with its offset, so it reads back the same in any session zone."""
    top = F.max(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.date_format(top, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return top.cast("string")


def next_marks(slices: DataFrame, key: str, watermark_column: str) -> DataFrame:
    """max(watermark column) per key as text — bulk form of the per-table mark advance."""
    return slices.groupBy(key).agg(F.max(watermark_column).cast("string").alias("last_watermark_value")).filter(
        F.col("last_watermark_value").isNotNull()
    )


def advance_marks(marks: DataFrame, new_marks: DataFrame, key: str = "table_id") -> DataFrame:
    """Upsert of new marks; keys without a new mark (empty slice) keep the old one."""
    from medallion.operators.upsert import upsert_frames

    return upsert_frames(marks, new_marks.select(*marks.columns), [key])
