"""Suffix-array dedup of long repeated byte strings, by interval expansion on Burrows-Wheeler transforms.

A window is ``LENGTH`` bytes. Its minimiser is the smallest hash of the ``GRAM``-byte grams in it
(the leftmost of equal ones), so equal windows have equal minimisers at equal places. A document falls
into segments: runs of windows with one minimiser, at most 2 * LENGTH - GRAM bytes long.

1. One pass gives each segment its minimiser and a 128-bit digest; no text is moved. Minimisers that occur
   once belong to windows that occur once.
2. Segments with equal digests are copies of each other: all their windows occur twice. Digests are
   counted on the map side, so copied documents are a row per task.
3. Different segments with one minimiser can share some of their windows. One text of each is fetched,
   all of a minimiser come into one block, and the block's Burrows-Wheeler transform is expanded breadth
   first by increasing common prefix, up to LENGTH (``bwt.py``). A minimiser with more than ``MANY``
   different segments (the border of a passage that very many documents hold) is not put into one block:
   its windows are counted one by one, by digest.
4. The windows found cover the bytes to remove; each document's ranges are merged.

Documents are byte strings in UTF-8; matches never cross documents. Null counts as empty; shorter texts have no
window. Repeated rows are copies of each other, so their windows all occur twice.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.bwt import repeated_starts
from medallion.llm.common import col, keyed, read_table, stage, text_or_empty

LENGTH, GRAM = 400, 64
MANY = 2048
BLOCK_BYTES = 1 << 19
_TABLE = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of every GRAM bytes (GRAM is a power of two), by doubling."""
    h = _TABLE[np.frombuffer(data, np.uint8)]
    d, power = 1, _BASE
    while d < GRAM:
        h = h[:-d] * np.uint64(power) + h[d:]
        power = power * power % (1 << 64)
        d *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def segments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window, place of the minimiser and its hash, for each segment."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    h = gram_hashes(data)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, span = 1, LENGTH - GRAM + 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
    place = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    return first, last, place[first], h[place[first]].view(np.int64)


def _dealt(df: DataFrame, *key: str) -> DataFrame:
    """``df``, of one row for each key, dealt by another hash than a join on ``key`` uses.

    The join then shuffles both sides itself and may split its skewed partitions, as it may for a staged table,
    but no files are written: on a local disk Spark starts several processes for each file."""
    return df.repartition(F.xxhash64(*key, F.lit(0)))


def segment_rows(df: DataFrame, text: str, rid: str) -> DataFrame:
    src = df.select(col(rid).alias("rid"), text_or_empty(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                owner, parts, digests = [], [], []
                for r, t in zip(b.column("rid").to_pylist(), b.column("t").to_pylist(), strict=True):
                    data = t.encode()
                    found = segments(data)
                    digests += [xxhash.xxh3_128_digest(data[s : e + LENGTH]) for s, e in zip(found[0].tolist(), found[1].tolist(), strict=True)]
                    owner.append(np.full(len(found[0]), r))
                    parts.append(found)
                two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                cols = [np.concatenate([p[k] for p in parts]) for k in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owner).astype(np.int64)), *[pa.array(c.astype(np.int32)) for c in cols[:2]], pa.array(cols[2]), *[pa.array(np.ascontiguousarray(two[:, k])) for k in (0, 1)]],
                    ["rid", "s", "e", "mini", "d0", "d1"],
                )

    return src.mapInArrow(run, "rid long, s int, e int, mini long, d0 long, d1 long")


def _ranges(hit: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge.tolist()


def _fetch(picks: DataFrame, docs: DataFrame, text: str, rid: str) -> DataFrame:
    """mini, d0, d1, kinds, data: the text of one segment of each digest."""
    per_row = picks.groupBy("rid").agg(F.collect_list(F.struct("s", "e", "mini", "d0", "d1", "kinds")).alias("l"))
    src = docs.select(col(rid).alias("docs_rid"), text_or_empty(text).alias("t")).join(per_row, F.col("docs_rid") == F.col("rid")).select("t", "l")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                rows = []
                for t, l in zip(b.column("t").to_pylist(), b.column("l").to_pylist(), strict=True):
                    data = t.encode()
                    rows += [(x["mini"], x["d0"], x["d1"], x["kinds"], data[x["s"] : x["e"] + LENGTH]) for x in l]
                c = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds, strict=True)], ["mini", "d0", "d1", "kinds", "data"])

    return src.mapInArrow(cut, "mini long, d0 long, d1 long, kinds long, data binary")


_HITS = "mini long, d0 long, d1 long, hits array<int>"


def _block_hits(texts: DataFrame, blocks: int) -> DataFrame:
    """Repeated windows of every segment, by interval expansion on the segments of a block."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("mini")
        mini, data = t.column("mini").to_numpy(), [x.as_py() for x in t.column("data")]
        ends = np.flatnonzero(np.concatenate([mini[1:] != mini[:-1], [True]])) + 1
        hits: list[list[int]] = []
        first = size = 0
        for e in ends.tolist():  # whole minimisers, about BLOCK_BYTES at a time
            size += sum(len(x) for x in data[max(first, len(hits)) : e])
            if size >= BLOCK_BYTES or e == len(data):
                hits += [_ranges(x) for x in repeated_starts(data[first:e], LENGTH)]
                first, size = e, 0
        return pa.table([t.column("mini"), t.column("d0"), t.column("d1"), pa.array(hits, pa.list_(pa.int32()))], ["mini", "d0", "d1", "hits"])

    block = F.pmod(F.xxhash64("mini"), F.lit(blocks)).alias("block")
    return texts.select("mini", "d0", "d1", "data", block).repartition(blocks, "block").groupBy("block").applyInArrow(run, _HITS)


def _window_hits(texts: DataFrame) -> DataFrame:
    """The same for minimisers with very many segments, by counting the digests of their windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                n = len(x["data"]) - LENGTH + 1
                two = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x["data"][j : j + LENGTH]) for j in range(n)), np.int64).reshape(-1, 2)
                fixed = [pa.array(np.full(n, x[c])) for c in ("mini", "d0", "d1")]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(np.arange(n, dtype=np.int32)), *[pa.array(np.ascontiguousarray(two[:, k])) for k in (0, 1)]], ["mini", "d0", "d1", "j", "w0", "w1"])

    rows = stage(texts.mapInArrow(windows, "mini long, d0 long, d1 long, j int, w0 long, w1 long"), "windows")
    twice = _dealt(rows.groupBy("w0", "w1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "w0", "w1")
    found = rows.join(twice, ["w0", "w1"]).groupBy("mini", "d0", "d1").agg(F.sort_array(F.collect_list("j")).alias("js"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = []
            for js in b.column("js").to_pylist():
                flag = np.zeros(2 * LENGTH, bool)
                flag[js] = True
                hits.append(_ranges(flag))
            yield pa.RecordBatch.from_arrays([b.column("mini"), b.column("d0"), b.column("d1"), pa.array(hits, pa.list_(pa.int32()))], ["mini", "d0", "d1", "hits"])

    return found.mapInArrow(merge, _HITS)


def repeated_ranges(docs: DataFrame, text: str, rid: str) -> DataFrame:
    """rid, a, b: byte ranges covered by windows that start anywhere else too (they may overlap)."""
    rows = stage(segment_rows(docs, text, rid), "segments")
    again = _dealt(rows.groupBy("mini").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mini"), "mini")
    rows = stage(rows.join(again, "mini"), "shared-segments")
    one = F.min(F.struct("rid", "s", "e")).alias("one")
    digests = stage(rows.groupBy("mini", "d0", "d1").agg(F.count(F.lit(1)).alias("n"), one), "digests")
    several = _dealt(digests.groupBy("mini").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "mini")
    picks = digests.join(several, "mini").select("mini", "d0", "d1", "kinds", "one.*")
    texts = stage(_fetch(picks, docs, text, rid), "texts")
    usual = texts.filter(F.col("kinds") <= MANY)
    size = usual.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    hits = _block_hits(usual, max(1, math.ceil(size / (4 * BLOCK_BYTES)))).union(_window_hits(texts.filter(F.col("kinds") > MANY)))
    hits = hits.filter(F.size("hits") > 0)
    judged = stage(digests.select("mini", "d0", "d1", "n").join(hits, ["mini", "d0", "d1"], "left").filter("n > 1 OR hits IS NOT NULL"), "judged")
    found = rows.select("rid", "s", "e", "mini", "d0", "d1").join(judged, ["mini", "d0", "d1"])
    pairs = F.when(F.col("n") > 1, F.array(F.struct(F.lit(0).alias("x"), (F.col("e") - F.col("s") + 1).alias("y")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)), lambda k: F.struct(F.get("hits", k).alias("x"), F.get("hits", k + 1).alias("y")))
    )
    return found.select("rid", "s", F.inline(pairs)).select("rid", (F.col("s") + F.col("x")).alias("a"), (F.col("s") + F.col("y") - 1 + LENGTH).alias("b"))


def removed(docs: DataFrame, text: str, rid: str, id_col: str) -> DataFrame:
    """rid, id, n_bytes, n_removed, n_spans, kept (bytes that stay), spans (array of from, to)."""
    per_row = repeated_ranges(docs, text, rid).groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("l"))
    src = docs.select(col(rid).alias("docs_rid"), col(id_col).alias("id"), text_or_empty(text).alias("t")).join(per_row, F.col("docs_rid") == F.col("rid"), "left").select("docs_rid", "id", "t", "l")
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                sizes, gone, spans, kept = [], [], [], []
                for t, l in zip(b.column("t").to_pylist(), b.column("l").to_pylist(), strict=True):
                    data = t.encode()
                    merged: list[list[int]] = []
                    for x in sorted((x["a"], x["b"]) for x in l or []):
                        if merged and x[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], x[1])
                        else:
                            merged.append([*x])
                    sizes.append(len(data))
                    gone.append(sum(y - x for x, y in merged))
                    spans.append([p for r in merged for p in r])
                    kept.append(b"".join(data[x:y] for x, y in zip([0, *[r[1] for r in merged]], [*[r[0] for r in merged], len(data)], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("docs_rid"), b.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(spans, pa.list_(pa.int64()))],
                    ["rid", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    return src.mapInArrow(run, f"rid long, id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rid = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed(docs, "text", rid, "doc_id").select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
