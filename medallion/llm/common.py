"""Small helpers shared by the operators.

Every operator first selects the columns it needs under its own names, so extra
columns of the input, whatever they are called, never clash with internal ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import checkpoint_dir

#: Deletes exactly the characters [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[ \t\n\x0B\f\r]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made different from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame, name: str = "_rid") -> tuple[DataFrame, str]:
    """``df`` with a row number that is the same in every evaluation of the same scan.

    ``monotonically_increasing_id`` follows the partition and the place in it, so it is
    stable for a file scan or a staged table (also when a lost task runs again).
    Operators that need it twice call it on such inputs only.
    """
    rid = fresh(df, name)
    return df.withColumn(rid, F.monotonically_increasing_id()), rid


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    It cuts the lineage: a lost executor costs a re-read of files, not a re-run."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows: what a task holds in Python objects at a time is bounded by them."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))
