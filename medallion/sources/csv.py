"""CSV sources: batch reads and the incremental (streaming) landing-folder reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUE_COLUMN = "_rescued_data"
#: Key under which a row with too few or too many fields keeps its whole line.
LINE_KEY = "_line"


def csv_batch(spark: SparkSession, path: str, header: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Batch CSV. Without a schema every column is a string (no inference pass over the data);
    without a header columns are ``_c0, _c1, ...``."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def with_rescue(schema: T.StructType, rescue_column: str = RESCUE_COLUMN) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(rescue_column, T.StringType(), True)])


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rescue_column: str | None = RESCUE_COLUMN,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded CSV file source with an explicit schema.

    Header names are checked against the schema (``enforceSchema=false``) so a
    reordered file fails instead of shifting values between columns. Rows that
    do not fit the schema are kept; the raw line goes to ``rescue_column`` and
    misfit fields become null.
    """
    reader = spark.readStream.format("csv").option("header", True).option("enforceSchema", False)
    if rescue_column:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue_column)
        schema = with_rescue(schema, rescue_column)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(schema).load(path)


def rescue_misfits(texts: DataFrame, schema: T.StructType, rescue_column: str = RESCUE_COLUMN, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns -> ``schema``'s types; ``rescue_column`` holds the fields that do not fit, as JSON by field name.

    ``texts`` has every field as text and the whole line of odd rows in ``rescue_column`` (null for others). A field
    that can't be cast becomes null and keeps its text in the JSON; the row's other fields keep their values.
    Rows without a misfit have a null there. ``keep`` names further columns to pass on."""
    misfits = [
        F.struct(F.lit(f.name).alias("key"), F.when(F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.col(f"`{f.name}`")).alias("value"))
        for f in schema.fields
        if f.dataType != T.StringType()
    ]
    found = F.filter(F.array(*misfits, F.struct(F.lit(LINE_KEY).alias("key"), F.col(rescue_column).alias("value"))), lambda x: x["value"].isNotNull())
    rescued = F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found)))
    return texts.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields], rescued.alias(rescue_column), *keep)
