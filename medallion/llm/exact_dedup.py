"""Exact dedup by content-defined chunk recipes.

1. One pass over the rows deletes white space, cuts the text where a rolling hash of the
   last 16 bytes says so (so equal texts have equal cuts) and gives each chunk a 64-bit
   fingerprint. Only the list of fingerprints, the text's length and digest go on.
2. Chunks are moved once, as (fingerprint, content) groups that are combined on the map
   side; a fingerprint with a single content is a verified identifier. Contents that share
   a fingerprint get different ordinals, and only texts holding such a fingerprint are
   renumbered.
3. Texts are equal exactly if their ordered identifier lists are; lists are grouped with
   a map-side min, so a group holding a third of all rows is one row per map task.

Null counts as the empty text; empty texts are equal to each other. Of equal texts the
row with most code points, then the smallest id (null last) stays; of rows that are the
same in both, one. Long documents are never moved after step 2's single pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import BLANKS, col, keyed, read_table, stage, text_or_empty

WINDOW_STEPS = 4  # the rolling hash covers 2**4 bytes
_TABLE = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
_BLANK_BYTES = BLANKS.encode()


def cut_points(data: bytes, mean: int, most: int) -> list[int]:
    """Ends of the chunks of ``data`` (the last is its length; empty data is one empty chunk)."""
    n = len(data)
    h = _TABLE[np.frombuffer(data, np.uint8)]
    for step in range(WINDOW_STEPS):
        d = 1 << step
        if n > d:
            h[d:] = h[d:] + (h[:-d] << np.uint32(d))
    cuts = np.flatnonzero((h >> np.uint32(8)) % np.uint32(mean) == 0) + 1
    ends, last = [], 0
    for c in [*cuts[cuts < n].tolist(), n]:
        while c - last > most:
            last += most
            ends.append(last)
        if c - last >= mean // 4 or c == n:
            ends.append(c)
            last = c
    return ends


def _chunks(data: bytes, mean: int, most: int) -> list[bytes]:
    out, last = [], 0
    for e in cut_points(data, mean, most):
        out.append(data[last:e])
        last = e
    return out


def _fingerprints(data: list[bytes]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(c) - (1 << 63) for c in data]


def recipes(df: DataFrame, text: str, rid: str, id_col: str, mean: int, most: int) -> DataFrame:
    """rid, id, code points, digest of the normalised text, chunk fingerprints in order."""
    src = df.select(col(rid).alias("rid"), col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("t").to_pylist()
            data = [t.encode().translate(None, _BLANK_BYTES) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("rid"),
                    b.column("id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                    pa.array([_fingerprints(_chunks(d, mean, most)) for d in data], pa.list_(pa.int64())),
                ],
                ["rid", "id", "n_cp", "sha", "recipe"],
            )

    return src.mapInArrow(run, f"rid long, id {kind}, n_cp long, sha string, recipe array<long>")


def chunk_contents(df: DataFrame, text: str, mean: int, most: int) -> DataFrame:
    """Fingerprint and content of every chunk, equal ones within a batch once."""
    src = df.select(text_or_empty(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {c for t in b.column("t").to_pylist() for c in _chunks(t.encode().translate(None, _BLANK_BYTES), mean, most)}
            parts = sorted(seen)
            yield pa.RecordBatch.from_arrays([pa.array(_fingerprints(parts), pa.int64()), pa.array(parts, pa.binary())], ["fp", "content"])

    return src.mapInArrow(run, "fp long, content binary")


def verified_recipes(df: DataFrame, text: str, rid: str, id_col: str, mean: int = 2048, most: int = 1 << 16) -> DataFrame:
    """``recipes`` with ``ids``: the ordered list of verified identifiers (fingerprint:ordinal)."""
    lists = stage(recipes(df, text, rid, id_col, mean, most), "recipes")
    contents = chunk_contents(df, text, mean, most).groupBy("fp", "content").agg(F.count(F.lit(1)).alias("n"))
    per_print = contents.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("one")).filter("n > 1")
    shared = stage(per_print.select("fp"), "collisions")
    if shared.isEmpty():
        return lists.withColumn("ids", F.transform("recipe", lambda x: x.cast("string")))
    ordinals = (
        chunk_contents(df, text, mean, most).join(shared, "fp").distinct()
        .withColumn("ordinal", F.row_number().over(Window.partitionBy("fp").orderBy("content")))
    )
    touched = lists.select("rid", F.explode(F.array_distinct("recipe")).alias("fp")).join(shared, "fp").select("rid").distinct()
    rows = df.select(col(rid).alias("rid"), text_or_empty(text).alias("t")).join(touched, "rid")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, t in zip(b.column("rid").to_pylist(), b.column("t").to_pylist(), strict=True):
                parts = _chunks(t.encode().translate(None, _BLANK_BYTES), mean, most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()), pa.array(_fingerprints(parts), pa.int64()), pa.array(parts, pa.binary())],
                    ["rid", "at", "fp", "content"],
                )

    spelled = rows.mapInArrow(spell, "rid long, at long, fp long, content binary").join(ordinals, ["fp", "content"], "left")
    name = F.concat_ws(":", F.col("fp").cast("string"), F.col("ordinal").cast("string"))
    fixed = spelled.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", name.alias("name")))).alias("l")).select("rid", F.col("l.name").alias("fixed"))
    return lists.join(fixed, "rid", "left").withColumn("ids", F.coalesce("fixed", F.transform("recipe", lambda x: x.cast("string")))).drop("fixed")


def exact_groups(df: DataFrame, text: str, rid: str, id_col: str, **chunking: int) -> DataFrame:
    """Per row: rid, id, keep_id, group_size, kept, sha (digest of the normalised text)."""
    rows = verified_recipes(df, text, rid, id_col, **chunking).select("rid", "id", "n_cp", "sha", F.concat_ws(",", "ids").alias("list"))
    first = F.min(F.struct((-F.col("n_cp")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("c"), F.col("rid").alias("d")))
    groups = rows.groupBy("list").agg(first.alias("f"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "list").select(
        "rid", "id", F.col("f.c").alias("keep_id"), "group_size", (F.col("rid") == F.col("f.d")).alias("kept"), "sha"
    )


def drop_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, all columns. ``df`` must be a file scan (see ``keyed``)."""
    rows, rid = keyed(df)
    gone = exact_groups(rows, text, rid, id_col).filter(~F.col("kept")).select(F.col("rid").alias(rid))
    return rows.join(gone, rid, "left_anti").select(*[col(c) for c in df.columns])


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rid = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return exact_groups(docs, "text", rid, "doc_id").select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


OP3_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), g AS (
  SELECT t, count(*) AS group_size, arg_min(doc_id, struct_pack(a := -cp, b := doc_id)) AS keep_id FROM n GROUP BY t
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
