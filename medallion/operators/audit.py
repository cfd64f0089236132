"""Run-audit operators over ``pipeline_runs`` (run_id, table_id, layer, start_time,
end_time, status, number_of_records, error_message).

The pipeline appends events and reads the rows folded from them (``run_rows``). ``apply_begin`` and ``apply_end``
are the same as upserts of a run table, in bulk form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.latest import latest_per_key
from medallion.operators.upsert import upsert_frames

RUN_KEYS = ["run_id", "table_id"]
RUN_COLUMNS = ["run_id", "table_id", "layer", "start_time", "end_time", "status", "number_of_records", "error_message"]
INPROGRESS, SUCCESS, FAILED = "INPROGRESS", "SUCCESS", "FAILED"
BEGIN, JOIN, END = "begin", "join", "end"

#: Events of runs. ``seq`` orders events of one time.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("table_id", T.IntegerType()),
        T.StructField("layer", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("number_of_records", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def apply_begin(runs: DataFrame, begins: DataFrame) -> DataFrame:
    """``begins`` (run_id, table_id, layer, start_time): row set to INPROGRESS, end/count/error cleared.

    Several begins for one (run_id, table_id) collapse to the latest start.
    """
    rows = begins.select(
        F.col("run_id").cast("bigint"),
        F.col("table_id").cast("int"),
        F.col("layer").cast("string"),
        F.col("start_time"),
        F.lit(None).cast(runs.schema["end_time"].dataType).alias("end_time"),
        F.lit(INPROGRESS).alias("status"),
        F.lit(None).cast("bigint").alias("number_of_records"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return upsert_frames(runs, rows, RUN_KEYS, order=["start_time"])


def apply_end(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` (run_id, table_id, end_time, status, number_of_records, error_message).

    Like an UPDATE ... WHERE: only existing rows change, layer and start are kept.
    Several ends for one (run_id, table_id) collapse to the latest end.
    """
    current = runs.select("run_id", "table_id", "layer", "start_time")
    new = ends.select(
        F.col("run_id").cast("bigint"),
        F.col("table_id").cast("int"),
        "end_time",
        F.col("status").cast("string"),
        F.col("number_of_records").cast("bigint"),
        F.col("error_message").cast("string"),
    )
    latest = latest_per_key(new, RUN_KEYS, ["end_time"], drop_null_keys=True)
    updated = current.join(latest, RUN_KEYS, "inner").select(*RUN_COLUMNS)
    return upsert_frames(runs, updated, RUN_KEYS)


def fold_events(events: DataFrame) -> DataFrame:
    """Run rows of ``events`` (run_id, table_id, layer, time, status, number_of_records, error_message).

    Every event begins its row, so the newest one gives the start; the newest SUCCESS or FAILED event ends it
    (ties: the greater status, count, error). The rows are those of ``apply_begin`` and ``apply_end`` on an empty
    table, from one scan and one shuffle with a partial step before it. Null ids form a row of their own.
    """
    ended = F.col("status").isin(SUCCESS, FAILED)
    end = F.struct(F.col("time").alias("end_time"), "status", F.col("number_of_records").cast("bigint").alias("number_of_records"), "error_message")
    rows = events.groupBy(F.col("run_id").cast("bigint"), F.col("table_id").cast("int")).agg(
        F.max(F.struct("time", "layer")).alias("begin"), F.max(F.when(ended, end)).alias("end")
    )
    return rows.select(
        *RUN_KEYS,
        "begin.layer",
        F.col("begin.time").alias("start_time"),
        "end.end_time",
        F.coalesce("end.status", F.lit(INPROGRESS)).alias("status"),
        "end.number_of_records",
        "end.error_message",
    )


def begin_kind(layer: str) -> str:
    """A bronze step starts its run row anew; a silver step only adds a row that isn't there."""
    return JOIN if layer.lower() == "silver" else BEGIN


def run_rows(log: DataFrame) -> DataFrame:
    """Run rows of an append-only ``log`` (LOG_SCHEMA), one per (run_id, table_id).

    The latest BEGIN opens the row; without one the earliest JOIN does. The latest END since then closes it, so a run
    that was begun again after an end is INPROGRESS, with end, count and error empty, while it runs. An END without
    an opening changes nothing. Events are ordered by (time, seq); one shuffle with a partial step before it.
    """
    at = F.struct("time", "seq")
    opened = F.struct(at.alias("at"), F.col("layer").alias("layer"))
    ended = F.struct(at.alias("at"), "status", "number_of_records", "error_message")
    rows = log.groupBy(*RUN_KEYS).agg(
        F.coalesce(F.max(F.when(F.col("kind") == BEGIN, opened)), F.min(F.when(F.col("kind") == JOIN, opened))).alias("o"),
        F.max(F.when(F.col("kind") == END, ended)).alias("e"),
    )
    rows = rows.filter(F.col("o").isNotNull()).withColumn("e", F.when(F.col("e.at") >= F.col("o.at"), F.col("e")))
    return rows.select(
        *RUN_KEYS,
        F.col("o.layer").alias("layer"),
        F.col("o.at.time").alias("start_time"),
        F.col("e.at.time").alias("end_time"),
        F.coalesce("e.status", F.lit(INPROGRESS)).alias("status"),
        F.col("e.number_of_records").alias("number_of_records"),
        F.col("e.error_message").alias("error_message"),
    )


def run_summary(runs: DataFrame, tables: DataFrame, run_id: int | None = None) -> DataFrame:
    """Runs (of one id, or all) with table names, columns renamed for the report, by table."""
    src = runs if run_id is None else runs.filter(F.col("run_id") == F.lit(run_id))
    names = tables.select("table_id", "table_name")
    return (
        src.join(names, "table_id", "left")
        .select(
            F.col("run_id").alias("Run_ID"),
            F.col("table_id").alias("Table_ID"),
            F.col("table_name").alias("Table_Name"),
            F.col("layer").alias("Layer"),
            F.col("start_time").alias("Start_Time"),
            F.col("end_time").alias("End_Time"),
            F.col("status").alias("Status"),
            F.col("number_of_records").alias("Number_Of_Records"),
            F.col("error_message").alias("Error_Message"),
        )
        .orderBy("Run_ID", "Table_ID")
    )


def run_status(runs: DataFrame, run_id: int | None = None) -> DataFrame:
    """Per run: total rows, failed (status != SUCCESS; null not counted), overall status."""
    src = runs if run_id is None else runs.filter(F.col("run_id") == F.lit(run_id))
    agg = src.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("status") != SUCCESS).alias("failed_tables"),
    )
    return agg.withColumn("overall_status", F.when(F.col("failed_tables") > 0, FAILED).otherwise(SUCCESS))


def run_status_of(runs: DataFrame, run_id: int) -> dict:
    """One run's status as a dict; a run with no rows is SUCCESS with zero tables."""
    rows = run_status(runs, run_id).collect()
    if not rows:
        return {"run_id": run_id, "total_tables": 0, "failed_tables": 0, "overall_status": SUCCESS}
    return rows[0].asDict()


def run_history(runs: DataFrame) -> DataFrame:
    """All runs, newest start first."""
    return runs.orderBy(F.col("start_time").desc_nulls_last(), "run_id", "table_id")
