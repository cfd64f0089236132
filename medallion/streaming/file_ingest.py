"""Landing folder -> bronze with Structured Streaming.

Each call processes exactly the files not yet recorded in the table's
checkpoint (``trigger(availableNow=True)``), appends them to the bronze table
through the Parquet file sink (its commit log makes the append exactly-once,
also when executors are lost and tasks retried) and stops.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medallion.operators.silver import with_bronze_audit
from medallion.sources.csv import RESCUE_COLUMN, csv_stream, rescue_misfits

PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


@dataclass
class IngestResult:
    table: str
    batches: int
    rows: int


def ingest_files(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    table: str,
    table_path: str,
    checkpoint_path: str,
    rescue_column: str | None = RESCUE_COLUMN,
    max_files_per_trigger: int | None = None,
    by_field: bool = False,
) -> IngestResult:
    """New CSV files under ``source_path`` -> append to ``table`` (external Parquet at ``table_path``).

    Returns the rows read by this call (from the query progress, not a recount of
    the whole table). The query keeps the progress of all its micro-batches, however many files there are.
    ``by_field`` rescues the misfit fields of a row as JSON instead of its whole line.
    """
    session = _session_of_its_own(spark)
    session.conf.set(PROGRESS_KEPT, str(2**31 - 1))
    path = F.col("_metadata.file_path")
    if by_field:
        texts = csv_stream(session, source_path, _texts(schema), rescue_column or RESCUE_COLUMN, max_files_per_trigger)
        out = rescue_misfits(with_bronze_audit(texts, file_path=path), schema, rescue_column or RESCUE_COLUMN, keep=("insert_timestamp", "source_file_name"))
    else:
        out = with_bronze_audit(csv_stream(session, source_path, schema, rescue_column, max_files_per_trigger), file_path=path)
    query = _start(out, table, table_path, checkpoint_path)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p]
    rows = sum(int(p.get("numInputRows", 0) or 0) for p in progress)
    batches = sum(1 for p in progress if int(p.get("numInputRows", 0) or 0) > 0)
    spark.catalog.refreshTable(table)
    return IngestResult(table=table, batches=batches, rows=rows)


def _texts(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _session_of_its_own(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark``; settings of one stream don't reach another one's."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def _start(out: DataFrame, table: str, table_path: str, checkpoint_path: str) -> StreamingQuery:
    return (
        out.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .option("path", table_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .toTable(table)
    )
