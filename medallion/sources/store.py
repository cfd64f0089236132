"""Parquet tables with versioned directories, registered in the Spark catalog.

* ``replace`` writes a new directory ``<root>/<database>/<table>/v=<n>`` and points the catalog entry at it, so a
  table can be rebuilt from a plan that reads it. With an unchanged schema that is one catalog call. A changed
  schema needs DROP and CREATE; if CREATE fails the old entry is put back, and an entry that is gone (the driver
  died in between) is registered again over the newest complete version (``_SUCCESS``) at the next access.
* ``upsert`` keeps a table in ``n`` hash buckets of its key, as partitions of the column ``_bucket_<n>_<key digest>``,
  and replaces the touched ones with Spark's dynamic partition overwrite. ``n`` is fixed when the table is made
  (``BUCKETS``, or ``buckets``; a bucket of about 1 GB is a good size, so a table of 100 TB asks for 65,536). The
  merged buckets are first written to the folder ``_merge``; a complete one that is left over is applied at
  the next access, so a driver lost at any point leaves the table as before or as after. Other buckets are
  neither read nor written.

One writer per table; readers are not isolated from a change of the table they read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import split_keys, upsert_frames

VERSION_PREFIX = "v="
BUCKET_PREFIX = "_bucket_"
#: Buckets of an upsert table unless the caller names another count.
BUCKETS = 64
MERGE_FOLDER = "_merge"


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n))


def bucket_column(keys: Sequence[str], n: int) -> str:
    """Partition column of a table in ``n`` buckets of ``keys``. The name says both, so a table read back from its
    files alone is never taken for one with other buckets."""
    return f"{BUCKET_PREFIX}{n}_{zlib.crc32(','.join(keys).encode()):08x}"


def without_buckets(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(BUCKET_PREFIX)])


class TableStore:
    """``namespace`` prefixes every database name (``<namespace>_bronze`` ...), so
    several pipelines can share one catalog."""

    def __init__(self, spark: SparkSession, root: str, namespace: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self._databases: set[str] = set()

    # ---- names and paths -------------------------------------------------------------
    def db(self, database: str) -> str:
        return f"{self.namespace}_{database}" if self.namespace else database

    def qualified(self, database: str, table: str) -> str:
        return f"{self.db(database)}.{table}"

    def fqn(self, database: str, table: str) -> str:
        return f"`{self.db(database)}`.`{table}`"

    def table_dir(self, database: str, table: str) -> str:
        return f"{self.root}/{database}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jpath.getFileSystem(conf), jpath

    def _has(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def versions(self, database: str, table: str) -> list[int]:
        fs, p = self._fs(self.table_dir(database, table))
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(VERSION_PREFIX) and name[len(VERSION_PREFIX):].isdigit():
                out.append(int(name[len(VERSION_PREFIX):]))
        return sorted(out)

    def version_path(self, database: str, table: str, version: int) -> str:
        return f"{self.table_dir(database, table)}/{VERSION_PREFIX}{version:06d}"

    def next_path(self, database: str, table: str) -> str:
        vs = self.versions(database, table)
        return self.version_path(database, table, vs[-1] + 1 if vs else 1)

    # ---- catalog ---------------------------------------------------------------------
    def ensure_database(self, database: str) -> None:
        if database not in self._databases:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db(database)}`")
            self._databases.add(database)

    def exists(self, database: str, table: str) -> bool:
        """Whether the table exists; a lost entry and an unfinished upsert are repaired first."""
        found = self.spark.catalog.tableExists(self.qualified(database, table)) or self.recover(database, table)
        if found:
            self._apply_merge(database, table)
        return found

    def recover(self, database: str, table: str) -> bool:
        """Register the newest complete version of a table without a catalog entry."""
        for v in reversed(self.versions(database, table)):
            path = self.version_path(database, table, v)
            if self._has(f"{path}/_SUCCESS"):
                fs, p = self._fs(path)
                if [st.getPath().getName() for st in fs.listStatus(p)] == ["_SUCCESS"]:
                    return False  # buckets without a row: there is nothing to register
                self._register(database, table, path)
                return True
        return False

    def location(self, database: str, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.fqn(database, table)}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def read_raw(self, database: str, table: str) -> DataFrame:
        """The table with its storage column."""
        return self.spark.table(self.fqn(database, table))

    def read(self, database: str, table: str) -> DataFrame:
        self.exists(database, table)
        return without_buckets(self.read_raw(database, table))

    def _create(self, database: str, table: str, path: str, schema: T.StructType | None) -> None:
        """The one place that makes a catalog entry. Without a schema it and the partitions come from the files."""
        if schema is None:
            self.spark.catalog.createTable(self.qualified(database, table), path=path, source="parquet")
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        buckets = [f"PARTITIONED BY (`{f.name}`)" for f in schema.fields if f.name.startswith(BUCKET_PREFIX)]
        self.spark.sql(f"CREATE TABLE {self.fqn(database, table)} ({columns}) USING parquet {''.join(buckets)} LOCATION '{path}'")

    def _register(self, database: str, table: str, path: str, schema: T.StructType | None = None) -> None:
        self.ensure_database(database)
        self._create(database, table, path, schema)
        if any(c.startswith(BUCKET_PREFIX) for c in self.read_raw(database, table).columns):
            self.spark.catalog.recoverPartitions(self.qualified(database, table))

    def _point(self, database: str, table: str, path: str, schema: T.StructType, partitioned: bool) -> None:
        """Make the existing entry's files those under ``path``."""
        name = self.fqn(database, table)
        have = self.read_raw(database, table).schema
        if not partitioned and have.simpleString() == schema.simpleString():
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")  # a failure leaves the previous version in place
            self.spark.catalog.refreshTable(name)
            return
        old = self.location(database, table)
        self.spark.sql(f"DROP TABLE {name}")
        try:
            self._register(database, table, path, schema)
        except Exception:
            self._delete(path)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._register(database, table, old, have)
            raise

    # ---- writes ----------------------------------------------------------------------
    def replace(self, database: str, table: str, df: DataFrame, bucket_by: Sequence[str] = (), buckets: int = BUCKETS) -> str:
        """Write ``df`` as a new version and make it the table (schema replaced too); with ``bucket_by`` in
        buckets of that key. A new table without buckets is registered first, so its rows are never there twice
        if the load is repeated after a failure."""
        exists = self.exists(database, table)
        self._delete(f"{self.table_dir(database, table)}/{MERGE_FOLDER}")
        path = self.next_path(database, table)
        if bucket_by:
            column = bucket_column(bucket_by, buckets)
            rows = without_buckets(df).withColumn(column, bucket_of(bucket_by, buckets)).hint("rebalance", column)
            rows.write.partitionBy(column).parquet(path)
            if exists:
                self._point(database, table, path, rows.schema, True)
            else:
                self._register(database, table, path, rows.schema)
        elif exists:
            df.write.parquet(path)
            self._point(database, table, path, df.schema, False)
        else:
            self._register(database, table, path, df.schema)
            try:
                df.write.mode("append").parquet(path)
            except Exception:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.fqn(database, table)}")
                raise
            self.spark.catalog.refreshTable(self.qualified(database, table))
        return path

    def buckets(self, database: str, table: str) -> tuple[str, int] | None:
        """(storage column, bucket count) of an upsert table."""
        for c in self.read_raw(database, table).columns:
            if c.startswith(BUCKET_PREFIX):
                return c, int(c[len(BUCKET_PREFIX):].split("_")[0])
        return None

    def _typed_keys(self, database: str, table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Key columns cast to the table's types: the bucket hash depends on the type
        (an int and a bigint key of equal value hash differently)."""
        schema = self.read_raw(database, table).schema
        return df.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})

    def append(self, database: str, table: str, df: DataFrame, keys: Sequence[str] = ()) -> None:
        """Add rows to the current version (creates the table when absent). Columns bind by name. A table in
        buckets needs the ``keys`` it was made with."""
        if not self.exists(database, table):
            self.replace(database, table, df)
            return
        cols = self.read_raw(database, table).columns
        extra = set(df.columns) - set(cols)
        if extra:
            raise ValueError(f"columns not in {database}.{table}: {sorted(extra)}")
        if spec := self.buckets(database, table):
            column, n = spec
            if bucket_column(keys, n) != column:
                raise ValueError(f"{database}.{table} is in buckets of another key than {list(keys)}")
            df = self._typed_keys(database, table, df, keys).withColumn(column, bucket_of(keys, n))
        df.select(*cols).write.insertInto(self.qualified(database, table))
        self.spark.catalog.refreshTable(self.qualified(database, table))

    def upsert(
        self,
        database: str,
        table: str,
        updates: DataFrame,
        keys: str | Sequence[str],
        order: Sequence[str] | None = None,
        strict: bool = False,
        bucketed: bool = False,
        preserve: Sequence[str] = (),
        buckets: int = BUCKETS,
    ) -> None:
        """MERGE update-all / insert-all on ``keys``; creates the table when absent.

        ``bucketed`` keeps the table in hash buckets of ``keys`` (``buckets`` of them if it is made by this
        call) and rewrites only the buckets the updates touch.
        """
        key_list = split_keys(keys)
        by = {"bucket_by": key_list, "buckets": buckets} if bucketed else {}
        if not self.exists(database, table):
            merged = upsert_frames(updates.limit(0), updates, key_list, order, strict, preserve)
            self.replace(database, table, merged, **by)
            return
        spec = self.buckets(database, table)
        if not bucketed or spec is None or spec[0] != bucket_column(key_list, spec[1]):
            # no buckets, or buckets of another key: the whole table
            self.replace(database, table, upsert_frames(self.read(database, table), updates, key_list, order, strict, preserve), **by)
            return
        column, n = spec
        upd = self._typed_keys(database, table, updates, key_list).withColumn(column, bucket_of(key_list, n))
        touched = sorted(r[0] for r in upd.select(column).distinct().collect())  # at most n small ints
        if not touched:
            return
        target = self.read_raw(database, table).filter(F.col(column).isin(touched))
        merged = upsert_frames(target, upd, key_list, order, strict, preserve).hint("rebalance", column)
        folder = f"{self.table_dir(database, table)}/{MERGE_FOLDER}"
        merged.write.mode("overwrite").partitionBy(column).parquet(folder)
        self._apply_merge(database, table)

    def _apply_merge(self, database: str, table: str) -> None:
        """Replace the buckets that a complete ``_merge`` folder holds. May be repeated."""
        folder = f"{self.table_dir(database, table)}/{MERGE_FOLDER}"
        if not self._has(f"{folder}/_SUCCESS"):
            return
        rows = self.spark.read.schema(self.read_raw(database, table).schema).parquet(folder)
        column, _ = self.buckets(database, table)
        write = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
        write.parquet(self.location(database, table))
        self.spark.catalog.recoverPartitions(self.qualified(database, table))  # buckets that had no rows before
        self._delete(folder)

    # ---- removal ---------------------------------------------------------------------
    def drop_database(self, database: str) -> None:
        """Drop a layer: its catalog entries and its files under the store's root."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.db(database)}` CASCADE")
        self._databases.discard(database)
        self._delete(f"{self.root}/{database}")

    def drop(self, database: str, table: str) -> None:
        """Drop a table with its files (an entry alone would come back)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.fqn(database, table)}")
        self._delete(self.table_dir(database, table))

    def vacuum(self, database: str, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions, never the current one; returns the deleted ones."""
        current = self.location(database, table)
        vs = self.versions(database, table)
        gone = [v for v in (vs[:-keep] if keep > 0 else vs) if not current.endswith(f"{VERSION_PREFIX}{v:06d}")]
        for v in gone:
            self._delete(self.version_path(database, table, v))
        return gone
