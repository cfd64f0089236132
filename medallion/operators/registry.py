"""Metadata registry operators (pure DataFrame in / DataFrame out).

Registry tables are tiny (tens of rows) but the functions are written as plans
so they also work on large key-value tables (e.g. the test-table mappings).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion import seed

PARAMETER_NAMES = ("load_type", "primary_key", "watermark_column")
SOURCE_SYSTEMS = ("sqlserver", "blob")

TABLES_SCHEMA = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("source_schema", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("target_layer", T.StringType()),
        T.StructField("bronze_schema", T.StringType()),
        T.StructField("silver_schema", T.StringType()),
        T.StructField("gold_schema", T.StringType()),
        T.StructField("active_flag", T.BooleanType()),
        T.StructField("load_order", T.IntegerType()),
    ]
)
PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("parameter_name", T.StringType()),
        T.StructField("parameter_value", T.StringType()),
    ]
)
WATERMARKS_SCHEMA = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("last_watermark_value", T.StringType()),
        T.StructField("last_run_id", T.LongType()),
    ]
)
SCHEMAS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("active_flag", T.BooleanType()),
    ]
)
RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("table_id", T.IntegerType()),
        T.StructField("layer", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("number_of_records", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

_CREATED = T.StructField("created_at", T.TimestampType())
#: One row per advance of a mark; the latest one (by ``seq``) of a table is its mark.
MARK_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("last_watermark_value", T.StringType()),
        T.StructField("last_updated_at", T.TimestampType()),
        T.StructField("last_run_id", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
#: Schema and partition columns of the stored registry tables.
STORED = {
    "tables": (T.StructType([*TABLES_SCHEMA.fields, _CREATED]), ("table_id",)),
    "table_parameters": (T.StructType([*PARAMS_SCHEMA.fields, _CREATED]), ("table_id",)),
    "schemas": (T.StructType([*SCHEMAS_SCHEMA.fields, _CREATED]), ("table_name", "schema_version")),
    "table_watermarks": (MARK_LOG_SCHEMA, ("table_id",)),
}


def marks_of(log: DataFrame) -> DataFrame:
    """The mark of every table in a mark log: its latest row."""
    columns = [f.name for f in MARK_LOG_SCHEMA.fields if f.name not in ("table_id", "seq")]
    latest = log.groupBy("table_id").agg(F.max(F.struct("seq", *columns)).alias("m"))
    return latest.select("table_id", *[F.col(f"m.{c}").alias(c) for c in columns])


def seed_frames(spark: SparkSession, landing_root: str = "landing") -> dict[str, DataFrame]:
    """Seed rows as DataFrames with ``created_at`` / ``last_updated_at`` = now."""
    now = F.current_timestamp()
    return {
        "tables": spark.createDataFrame(seed.table_rows(landing_root), TABLES_SCHEMA).withColumn("created_at", now),
        "table_parameters": spark.createDataFrame(seed.parameter_rows(), PARAMS_SCHEMA).withColumn("created_at", now),
        "table_watermarks": spark.createDataFrame(seed.watermark_rows(), WATERMARKS_SCHEMA)
        .withColumn("last_updated_at", now)
        .select("table_id", "last_watermark_value", "last_updated_at", "last_run_id"),
        "schemas": spark.createDataFrame(seed.schema_rows(), SCHEMAS_SCHEMA).withColumn("created_at", now),
        "pipeline_runs": spark.createDataFrame([], RUNS_SCHEMA),
    }


def plan_tables(tables: DataFrame, source_system: str) -> DataFrame:
    """Active tables of one source system (case-insensitive), in load order (ties by table_id)."""
    if not source_system:
        raise ValueError("source_system is required")
    return (
        tables.filter(F.col("active_flag") & (F.lower(F.col("source_system")) == source_system.lower()))
        .orderBy("load_order", "table_id")
    )


def table_params(params: DataFrame, table_id: int | None = None, names: Sequence[str] = PARAMETER_NAMES) -> DataFrame:
    """Key-value parameter rows folded to one record per table.

    A repeated parameter name keeps the value with the latest ``created_at``
    (ties: greatest value), which makes the reference's "last collected row
    wins" deterministic. ``pivot`` with the value list given avoids a pass to
    discover the names.
    """
    src = params
    if table_id is not None:
        if not table_id:
            raise ValueError("table_id must be a positive id")
        src = src.filter(F.col("table_id") == F.lit(table_id))
    order = F.struct(F.col("created_at"), F.col("parameter_value")) if "created_at" in params.columns else F.col("parameter_value")
    return (
        src.groupBy("table_id")
        .pivot("parameter_name", list(names))
        .agg(F.max_by("parameter_value", order))
    )


def table_params_dict(params: DataFrame, table_id: int, names: Sequence[str] = PARAMETER_NAMES) -> dict[str, str | None]:
    """One table's parameters as a dict: its few key-value rows are filtered on the
    executors (no shuffle) and folded on the driver with the same rule as
    ``table_params`` (latest ``created_at``, ties: greatest value)."""
    if not table_id:
        raise ValueError("table_id must be a positive id")
    cols = ["parameter_name", "parameter_value"] + (["created_at"] if "created_at" in params.columns else [])
    rows = params.filter(F.col("table_id") == F.lit(table_id)).select(*cols).collect()
    if not rows:
        raise ValueError(f"no parameters for table_id {table_id}")
    best: dict[str, tuple] = {}
    for r in rows:
        rank = (r["created_at"] if "created_at" in cols else None, r["parameter_value"])
        current = best.get(r["parameter_name"])
        if current is None or _later(rank, current):
            best[r["parameter_name"]] = rank
    return {n: (best[n][1] if n in best else None) for n in names}


def _later(a: tuple, b: tuple) -> bool:
    """Order of ``max_by(value, struct(created_at, value))``: nulls lowest."""
    for x, y in zip(a, b):
        if x == y:
            continue
        if x is None:
            return False
        if y is None:
            return True
        return x > y
    return False


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """Per table, the JSON of the highest active version (one aggregate for all tables)."""
    return (
        schemas.filter(F.col("active_flag"))
        .groupBy("table_name")
        .agg(
            F.max("schema_version").alias("schema_version"),
            F.max_by("schema_json", "schema_version").alias("schema_json"),
        )
    )


def latest_schema(schemas: DataFrame, table_name: str) -> str:
    """JSON of the highest active version of one table; error when none."""
    rows = (
        schemas.filter(F.col("active_flag") & (F.col("table_name") == table_name))
        .orderBy(F.col("schema_version").desc())
        .select("schema_json")
        .limit(1)
        .collect()
    )
    if not rows:
        raise ValueError(f"no active schema registered for {table_name}")
    return rows[0][0]


_TYPES = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "integer": T.IntegerType()}


def schema_from_json(text: str) -> T.StructType:
    """``[{"name","type"}]`` -> all-nullable StructType; unknown types become string."""
    fields = json.loads(text)
    return T.StructType([T.StructField(f["name"], _TYPES.get(f["type"], T.StringType()), True) for f in fields])


def load_type_listing(tables: DataFrame, params: DataFrame) -> DataFrame:
    """Table name with its load type (inner join on table_id)."""
    lt = params.filter(F.col("parameter_name") == "load_type").select("table_id", "parameter_value")
    return tables.select("table_id", "table_name").join(lt, "table_id").select(
        "table_name", F.col("parameter_value").alias("load_type")
    )


def metadata_counts(tables: DataFrame, params: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Row counts of the three registry tables (expected 51 / 110 / 28 for the seed)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in (("tables", tables), ("table_parameters", params), ("table_watermarks", watermarks))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def registry_check(tables: DataFrame, params: DataFrame, schemas: DataFrame) -> list[str]:
    """Configuration problems: MERGE without key, file table without schema, key not in schema."""
    problems = []
    p = {r["table_id"]: r.asDict() for r in table_params(params).collect()}
    t = {r["table_id"]: r.asDict() for r in tables.collect()}
    sch = {r["table_name"]: r["schema_json"] for r in latest_schemas(schemas).collect()}
    for tid, row in sorted(t.items()):
        par = p.get(tid, {})
        if par.get("load_type") == "MERGE" and not par.get("primary_key"):
            problems.append(f"{row['table_name']}: MERGE without primary_key")
        if (row["source_system"] or "").lower() == "blob":
            if row["table_name"] not in sch:
                problems.append(f"{row['table_name']}: no registered schema")
            else:
                names = {f.name for f in schema_from_json(sch[row["table_name"]]).fields}
                for k in (par.get("primary_key") or "").split(","):
                    if k and k.strip() not in names:
                        problems.append(f"{row['table_name']}: key {k.strip()} not in schema")
    return problems
