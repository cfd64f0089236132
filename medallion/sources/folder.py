"""Metadata folders: Parquet partitioned by table, written one partition at a time.

The registry tables are replaced per table with dynamic partition overwrite. Run events and marks are appended
to their table's own directory. Writers of different tables share no file, no ``_temporary`` folder and no
catalog entry, so loads of different tables can run at the same time; a write costs the same however
long the history is. Each table has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PartitionedFolder:
    """Rows of ``schema`` under ``path``, partitioned by ``keys`` (the first is an id or a plain name)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        fs, p = self._fs(self.path)
        return bool(fs.exists(p))

    def clear(self) -> None:
        """An empty folder."""
        fs, p = self._fs(self.path)
        fs.delete(p, True)
        fs.mkdirs(p)

    def partition(self, value: object) -> str:
        return f"{self.path}/{self.keys[0]}={value}"

    def read(self, value: object = None) -> DataFrame:
        """All rows, or those of one value of the first key: only its directory is listed and read."""
        where = self.path if value is None else self.partition(value)
        fs, p = self._fs(where)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(where)
        return rows.select(*self.schema.fieldNames())

    def put(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` fall into, and no others."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows.repartition(*self.keys).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*self.keys).parquet(self.path)

    def remove(self, value: object) -> None:
        fs, p = self._fs(self.partition(value))
        fs.delete(p, True)

    def append(self, rows: DataFrame, value: object) -> None:
        """Add rows of one value of the only key, as one file in its directory."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields if f.name != self.keys[0]])
        rows.coalesce(1).write.mode("append").parquet(self.partition(value))

    def append_all(self, rows: DataFrame) -> None:
        """Add rows of many tables in one job (no other writer at that time)."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows.repartition(*self.keys).write.mode("append").partitionBy(*self.keys).parquet(self.path)
