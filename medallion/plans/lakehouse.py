"""The pipeline: metadata setup, source -> bronze, bronze -> silver, gold, run report.

Only this module (with sources.store / streaming) touches storage; the logic
lives in the DataFrame operators. Per table the flow is the reference's:
run row INPROGRESS -> read source -> bronze append -> silver slice by mark ->
FULL / APPEND / MERGE -> advance mark -> run row SUCCESS / FAILED.
"""

from __future__ import annotations

import contextlib
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.operators import audit, registry
from medallion.operators.silver import (
    incremental_slice,
    latest_file,
    max_mark,
    null_mark_rows,
    uses_watermark,
    validate_load_type,
    with_bronze_audit,
    with_silver_audit,
)
from medallion.operators.upsert import dedup_updates, split_keys
from medallion.plans.gold import MARTS
from medallion.sources.folder import PartitionedFolder
from medallion.sources.jdbc import jdbc_reader, source_table_name
from medallion.sources.store import BUCKETS, TableStore
from medallion.streaming.file_ingest import ingest_files

METADATA = "metadata"
RUN_LOG = "run_log"


def now() -> datetime:
    return datetime.now()


def concurrently(tasks: list[Callable[[], object]]) -> None:
    """Run independent driver-side actions (each its own Spark job) at the same time;
    the first error is raised after all have finished."""
    if len(tasks) <= 1:
        for t in tasks:
            t()
        return
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
    for f in futures:
        f.result()


@dataclass
class RunRecord:
    """Filled in by the step; written to pipeline_runs when the step ends."""

    records: int | None = None
    info: dict = field(default_factory=dict)
    slice: DataFrame | None = None

    def known(self) -> int:
        """Rows of the step; when its write failed before they were counted, those of the slice it was given."""
        if self.records is None and self.slice is not None:
            with contextlib.suppress(Exception):  # a slice that can't be read has no count
                self.records = self.slice.count()
        return self.records or 0


class Lakehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing_root: str | None = None,
        namespace: str = "",
        jdbc: Mapping | None = None,
    ):
        """``jdbc``: connection for 'sqlserver' tables without an explicit reader —
        ``{"url": ..., "properties": {...}, "partitioning": {table_name: {partition_column,
        lower_bound, upper_bound, num_partitions}}}``."""
        self.spark = spark
        self.store = TableStore(spark, root, namespace)
        self.root = root.rstrip("/")
        self.landing_root = (landing_root or f"{self.root}/landing").rstrip("/")
        self.jdbc = dict(jdbc or {})
        kinds = {**registry.STORED, RUN_LOG: (audit.LOG_SCHEMA, ("table_id",))}
        self.folders = {n: PartitionedFolder(spark, self.store.table_dir(METADATA, n), schema, keys) for n, (schema, keys) in kinds.items()}

    # ---- metadata ------------------------------------------------------------------------
    def setup(self, reset: bool = False, seed: bool = True, layers: bool = False) -> None:
        """Layers + metadata tables, seeded from ``medallion.seed`` (51 / 110 / 28 rows)
        unless ``seed=False`` (empty registry, tables added with ``register``). ``reset``
        writes the metadata tables anew; with ``layers`` it first drops bronze, silver and
        gold with their files, and the streams' checkpoints, so every file counts as new."""
        if layers and not reset:
            raise ValueError("layers=True drops data: it needs reset=True")
        if layers:
            for db in ("bronze", "silver", "gold"):
                self.store.drop_database(db)
            fs, p = self.store._fs(f"{self.root}/_checkpoints")
            fs.delete(p, True)
        for db in ("bronze", "silver", "gold"):
            self.store.ensure_database(db)
        frames = registry.seed_frames(self.spark, self.landing_root)
        frames["table_watermarks"] = frames["table_watermarks"].withColumn("seq", F.lit(0))

        def fill(name: str) -> None:
            folder = self.folders[name]
            if reset or not folder.exists():
                folder.clear()
                if seed and name != RUN_LOG:
                    folder.put(frames[name])

        concurrently([lambda n=name: fill(n) for name in self.folders])

    def meta(self, name: str) -> DataFrame:
        """A metadata table. Runs and marks are folded from their events."""
        if name == "pipeline_runs":
            return audit.run_rows(self.folders[RUN_LOG].read())
        rows = self.folders[name].read()
        return registry.marks_of(rows) if name == "table_watermarks" else rows

    def register(
        self,
        table_id: int,
        table_name: str,
        source_system: str,
        params: Mapping[str, str | None],
        load_order: int = 1,
        source_path: str | None = None,
        schema_json: str | None = None,
        initial_mark: str | None = "1900-01-01 00:00:00",
    ) -> None:
        """Add or replace one table's registry, parameter, watermark and schema rows: only the table's own
        partitions are written (independent jobs, submitted together)."""
        ts = now()
        row = self.spark.createDataFrame(
            [(table_id, table_name, source_system, None, table_name, source_path, "silver", "bronze", "silver", "gold", True, load_order)],
            registry.TABLES_SCHEMA,
        ).withColumn("created_at", F.lit(ts))
        prm = self.spark.createDataFrame(
            [(table_id, k, v) for k, v in params.items() if v is not None], registry.PARAMS_SCHEMA
        ).withColumn("created_at", F.lit(ts))
        writes = [
            lambda: self._put("tables", row, table_id=table_id),
            lambda: self._put("table_parameters", prm, table_id=table_id),
        ]
        if params.get("load_type") in ("APPEND", "MERGE") and initial_mark is not None:
            writes.append(lambda: self.advance_mark(table_id, None, initial_mark))
        if schema_json is not None:
            sch = self.spark.createDataFrame([(table_name, 1, schema_json, True)], registry.SCHEMAS_SCHEMA).withColumn(
                "created_at", F.lit(ts)
            )
            writes.append(lambda: self.folders["schemas"].put(sch))
        concurrently(writes)

    def table_row(self, table_id: int) -> dict:
        rows = self.folders["tables"].read(table_id).collect()
        if not rows:
            raise ValueError(f"table_id {table_id} not registered")
        return rows[0].asDict()

    def params(self, table_id: int) -> dict:
        return registry.table_params_dict(self.folders["table_parameters"].read(table_id), table_id, (*registry.PARAMETER_NAMES, "buckets"))

    def last_mark(self, table_id: int) -> str | None:
        rows = registry.marks_of(self.folders["table_watermarks"].read(table_id)).select("last_watermark_value").collect()
        return rows[0][0] if rows else None

    # ---- audit -----------------------------------------------------------------------------
    # Events are appended, so a call costs the same after any number of runs and tables can be
    # loaded at the same time; ``meta("pipeline_runs")`` folds them into rows.
    def run_begin(self, run_id: int, table_id: int, layer: str, start: datetime) -> None:
        self._log(run_id, table_id, layer, audit.begin_kind(layer), start)

    def run_end(self, run_id: int, table_id: int, status: str, records: int | None, error: str | None) -> None:
        self._log(run_id, table_id, None, audit.END, now(), status, records, error)

    def _log(self, run_id, table_id, layer, kind, at, status=None, records=None, error=None) -> None:
        event = (run_id, table_id, layer, kind, at, time.time_ns(), status, records, error)
        self.folders[RUN_LOG].append(self.spark.createDataFrame([event], audit.LOG_SCHEMA), table_id)

    def log_runs(self, events: DataFrame) -> None:
        """Append any number of run events (``audit.LOG_SCHEMA``) in one job."""
        self.folders[RUN_LOG].append_all(events)

    @contextlib.contextmanager
    def audited(self, run_id: int, table_id: int, layer: str, end_on_success: bool = True) -> Iterator[RunRecord]:
        """INPROGRESS at entry; FAILED with the error text on exception (re-raised);
        SUCCESS with the record count at exit when ``end_on_success``."""
        self.run_begin(run_id, table_id, layer, now())
        rec = RunRecord()
        try:
            yield rec
        except Exception as e:  # noqa: BLE001 - recorded and re-raised
            self.run_end(run_id, table_id, audit.FAILED, rec.known(), str(e))
            raise
        if end_on_success:
            self.run_end(run_id, table_id, audit.SUCCESS, rec.records, None)

    # ---- source -> bronze -------------------------------------------------------------------
    def ingest_files(self, table_id: int, run_id: int, source_path: str | None = None, table: dict | None = None) -> RunRecord:
        with self.audited(run_id, table_id, "Bronze", end_on_success=False) as rec:
            t = table or self.table_row(table_id)
            name = t["table_name"]
            schema = registry.schema_from_json(registry.latest_schema(self.meta("schemas"), name))
            bronze_db = t["bronze_schema"] or "bronze"
            rescue = self.folders["table_parameters"].read(table_id).filter("parameter_name = 'rescue'").select("parameter_value").collect()
            by_field = [r[0] for r in rescue] == ["fields"]
            self.store.ensure_database(bronze_db)
            res = ingest_files(
                self.spark,
                source_path or t["source_path"],
                schema,
                self.store.qualified(bronze_db, name),
                f"{self.store.table_dir(bronze_db, name)}/stream",
                f"{self.root}/_checkpoints/{name}",
                by_field=by_field,
            )
            rec.records = res.rows
        return rec

    def ingest_frame(
        self,
        table_id: int,
        run_id: int,
        read: Callable[[str | None, str | None, str | None], DataFrame],
        table: dict | None = None,
    ) -> RunRecord:
        """Bounded source (e.g. ``sources.jdbc.jdbc_read``) -> bronze append.

        ``read(load_type, watermark_column, last_mark)`` returns the slice to load.
        """
        with self.audited(run_id, table_id, "Bronze", end_on_success=False) as rec:
            t = table or self.table_row(table_id)
            # inside the audited block: a missing parameter row ends the run as FAILED
            p = self.params(table_id)
            load_type, mark_col = p.get("load_type"), p.get("watermark_column")
            last = self.last_mark(table_id) if uses_watermark(load_type, mark_col) else None
            src = with_bronze_audit(read(load_type, mark_col, last))
            obs = Observation(f"bronze_{table_id}_{int(time.time() * 1000)}")
            self.store.append(t["bronze_schema"] or "bronze", t["table_name"], src.observe(obs, F.count(F.lit(1)).alias("n")))
            rec.records = int(obs.get["n"])
        return rec

    def dispatch(self, table_id: int, run_id: int, readers: Mapping[str, Callable] | None = None) -> RunRecord:
        """source_system 'blob' -> file stream; 'sqlserver' -> bounded reader; other -> ValueError."""
        try:
            t = self.table_row(table_id)
            system = (t["source_system"] or "").lower()
            if system not in ("blob", "sqlserver"):
                raise ValueError(f"Unsupported source_system: {system}")
            reader = None
            if system == "sqlserver":
                reader = (readers or {}).get(t["table_name"]) or (self.jdbc_reader(t) if self.jdbc.get("url") else None)
                if reader is None:
                    raise ValueError(f"no reader configured for table_id {table_id}")
        except Exception as e:
            with self.audited(run_id, table_id, "Bronze"):  # the run ends as FAILED with this error
                raise e
        return self.ingest_frame(table_id, run_id, reader, table=t) if reader else self.ingest_files(table_id, run_id, table=t)

    def jdbc_reader(self, t: Mapping) -> Callable[[str | None, str | None, str | None], DataFrame]:
        """Reader over ``source_schema.source_table`` of the registry row (the mark filter is
        pushed into the database's WHERE; optional range partitioning per table)."""
        name = source_table_name(t.get("source_schema"), t.get("source_table") or t["table_name"])
        parts = (self.jdbc.get("partitioning") or {}).get(t["table_name"], {})
        return jdbc_reader(self.spark, self.jdbc["url"], name, self.jdbc.get("properties"), **parts)

    # ---- bronze -> silver ---------------------------------------------------------------------
    def load_silver(
        self,
        table_id: int,
        run_id: int,
        as_of: datetime | None = None,
        strict: bool = False,
        snapshot: str = "all",
        preserve_insert_timestamp: bool = False,
        append_guard: bool = False,
        report_null_marks: bool = False,
    ) -> RunRecord:
        """Bronze -> silver for one table.

        ``strict`` raises on duplicate source keys in a MERGE instead of keeping the
        latest row. ``snapshot='latest_file'`` makes a FULL load take only the last
        landed file instead of all of bronze. ``preserve_insert_timestamp`` keeps a
        row's first silver ``insert_timestamp`` when a MERGE updates it. ``append_guard``
        makes an APPEND skip rows whose primary key is already in silver, so a run
        repeated after a failed mark update adds nothing twice (costs a join with
        the silver keys). ``report_null_marks`` counts the bronze rows an incremental
        load can never pick up because their mark column is null (``info``; the
        ``IS NULL`` filter reaches the scan, so row groups without nulls are skipped).
        """
        if snapshot not in ("all", "latest_file"):
            raise ValueError(f"Unsupported snapshot: {snapshot}")
        with self.audited(run_id, table_id, "Silver") as rec:
            t = self.table_row(table_id)
            name = t["table_name"]
            bronze_db, silver_db = t["bronze_schema"] or "bronze", t["silver_schema"] or "silver"
            # inside the audited block: a missing parameter row ends the run as FAILED
            p = self.params(table_id)
            load_type, key, mark_col = p.get("load_type"), p.get("primary_key"), p.get("watermark_column")
            validate_load_type(load_type)
            bronze = self.store.read(bronze_db, name)
            incremental = uses_watermark(load_type, mark_col)
            if incremental and report_null_marks:
                rec.info["null_mark_rows"] = null_mark_rows(bronze, mark_col).count()
            last = self.last_mark(table_id) if incremental else None
            sl = incremental_slice(bronze, load_type, mark_col, last)
            if snapshot == "latest_file" and load_type == "FULL":
                sl = latest_file(sl)
            rec.slice = sl = sl.drop("insert_timestamp")
            buckets = int(p.get("buckets") or BUCKETS)
            exists = self.store.exists(silver_db, name)
            if load_type == "MERGE" and exists:
                keys = split_keys(key or "")
                # The slice is used twice by the upsert (keys + rows) and once for the
                # mark: materialise it once (reliable checkpoint) so all three agree.
                sl = with_silver_audit(sl, as_of).checkpoint(eager=True)
                stats = sl.agg(F.count(F.lit(1)).alias("n"), *( [max_mark(sl, mark_col).alias("mx")] if incremental else [])).first()
                rec.records = int(stats["n"])
                self.store.upsert(
                    silver_db,
                    name,
                    sl,
                    keys,
                    order=[mark_col] if mark_col else None,
                    strict=strict,
                    bucketed=True,
                    preserve=["insert_timestamp"] if preserve_insert_timestamp else (),
                    buckets=buckets,
                )
            else:
                obs = Observation(f"silver_{table_id}_{int(time.time() * 1000)}")
                metrics = [F.count(F.lit(1)).alias("n")] + ([max_mark(sl, mark_col).alias("mx")] if incremental else [])
                out = with_silver_audit(sl, as_of).observe(obs, *metrics)
                if not exists and load_type == "MERGE" and key:
                    # first load of an upsert table: bucketed by its key from the start
                    # and one row per key, as later upserts keep it
                    out = dedup_updates(out, split_keys(key), [mark_col] if mark_col else None, strict)
                    self.store.replace(silver_db, name, out, bucket_by=split_keys(key), buckets=buckets)
                elif not exists or load_type == "FULL":
                    self.store.replace(silver_db, name, out)
                else:
                    if append_guard and key:
                        keys = split_keys(key)
                        have = self.store.read(silver_db, name).select(*keys)
                        out = out.join(have, keys, "left_anti")
                    self.store.append(silver_db, name, out)
                stats = obs.get
            rec.records = int(stats["n"])
            if incremental:
                mx = stats["mx"]
                if mx is not None:
                    self.advance_mark(table_id, run_id, mx)
        return rec

    def advance_mark(self, table_id: int, run_id: int | None, value: str) -> None:
        row = (table_id, value, now(), run_id, time.time_ns())
        self.folders["table_watermarks"].append(self.spark.createDataFrame([row], registry.MARK_LOG_SCHEMA), table_id)

    def _put(self, name: str, rows: DataFrame, table_id: object) -> None:
        """Replace one table's rows of a registry table."""
        if rows.isEmpty():
            self.folders[name].remove(table_id)
        else:
            self.folders[name].put(rows)

    # ---- gold -------------------------------------------------------------------------------
    def silver_tables(self, names) -> dict[str, DataFrame]:
        return {n: self.store.read("silver", n) for n in names if self.store.exists("silver", n)}

    def build_gold(self, marts=None, silver: Mapping[str, DataFrame] | None = None, as_of=None) -> dict[str, int]:
        """Full recompute of each mart (CREATE OR REPLACE semantics); returns row counts."""
        counts = {}
        for name in marts or MARTS:
            src = silver if silver is not None else self.silver_tables(
                ["study_master", "subject", "lims_sample", "accession", "analysis", "result",
                 "lims_sample_location", "shipment_header", "shipment_item", "delivery_header",
                 "freezer", "rack", "storage_box", "storage_position"]
            )
            obs = Observation(f"gold_{name}_{time.time_ns()}")  # counted by the write itself
            self.store.replace("gold", name, MARTS[name].build(src, as_of).observe(obs, F.count(F.lit(1)).alias("n")))
            counts[name] = int(obs.get["n"])
        return counts

    # ---- report -----------------------------------------------------------------------------
    def summary(self, run_id: int) -> DataFrame:
        return audit.run_summary(self.meta("pipeline_runs"), self.meta("tables"), run_id)

    def status(self, run_id: int) -> dict:
        return audit.run_status_of(self.meta("pipeline_runs"), run_id)
