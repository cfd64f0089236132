"""Packing documents into fixed-length sequences by fitted length patterns.

1. Every document becomes ids and an end id; one longer than a sequence is cut into full
   pieces with the shorter piece first. Pieces are staged without their ids.
2. The histogram of lengths (at most ``size`` rows) goes to the driver. Patterns of up to
   three lengths that fill a sequence are enumerated, repeat counts are fitted to the
   histogram by non-negative least squares (accelerated projected gradient; the pattern
   matrix is never formed), rounded with the error carried on, and never take more pieces
   than there are. The rest of the histogram is packed best-fit, in whole counts per step.
3. The plan says which ranks of a length go to which sequences. A piece's rank in its
   length is its number among the pieces of that length that its task made (counted as they are
   staged) plus that task's first rank. So no row is sorted or grouped for it, a length that a third of
   all rows have is no hot group, and no two pieces tie.

Nothing is dropped or capped; the plan's size depends on ``size`` only, not on the data.
Null and empty texts are one end id. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm import tokens
from medallion.llm.common import col, read_table, slices, stage, text_or_empty

SIZE = 2048
END = 0
FIT_STEPS = 300
ROWS_AT_ONCE = 256


def pieces(df: DataFrame, text: str, id_col: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32, task and nth (the task that made it and its number among those of its length there) and, if asked for, the ids."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = [0] * (size + 1), TaskContext.get().partitionId()
        for b in slices(batches, ROWS_AT_ONCE):
            owner, rows, raw = [], [], []
            for i, t in enumerate(b.column("t").to_pylist()):
                ids = np.append(tokens.encode(t), np.uint32(END)).astype("<u4")
                edges = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
                for k, (s, e) in enumerate(zip(edges, edges[1:], strict=False)):
                    data = ids[s:e].tobytes()
                    owner.append(i)
                    rows.append((k, s, e - s, zlib.crc32(data), task, seen[e - s]))
                    seen[e - s] += 1
                    if with_ids:
                        raw.append(data)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            arrays = [b.column("id").take(pa.array(owner, pa.int64())), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(raw, pa.binary())] if with_ids else []), names + (["ids"] if with_ids else []))

    return src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, task long, nth long" + (", ids binary" if with_ids else ""))


def patterns(size: int, depth_step: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, that add up to ``size``; triples on a grid of ``depth_step`` for c."""
    a = np.arange((size + 1) // 2, size + 1)
    out = [np.stack([a, size - a, np.zeros_like(a)], 1)]
    for c in range(depth_step, size // 3 + 1, depth_step):
        b = np.arange(c, (size - c) // 2 + 1)
        out.append(np.stack([size - c - b, b, np.full_like(b, c)], 1))
    return np.concatenate(out)


def fit_counts(rows: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative repeat counts x that bring the patterns' lengths close to the histogram in least squares."""
    n = len(histogram)

    def lengths(x: np.ndarray) -> np.ndarray:
        got = sum(np.bincount(rows[:, k], x, n) for k in range(3))
        got[0] = 0
        return got

    def back(r: np.ndarray) -> np.ndarray:
        return r[rows[:, 0]] + r[rows[:, 1]] + r[rows[:, 2]]

    target = histogram.astype(float)
    target[0] = 0
    v = np.ones(len(rows))
    for _ in range(30):  # largest eigenvalue, for the step width
        v = back(lengths(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        r = target - lengths(y)
        r[0] = 0
        new = np.maximum(0, y + back(r) / (1.05 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


@dataclass
class Plan:
    """For each length (sorted), runs of ranks: first rank, pieces per sequence, first sequence, offset."""

    length: np.ndarray
    rank: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        span = np.int64(1) << np.int64(48)
        i = np.searchsorted(self.length * span + self.rank, length * span + rank, "right") - 1
        t = rank - self.rank[i]
        return self.sequence[i] + t // self.per[i], self.offset[i] + t % self.per[i] * length


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    left = np.zeros(size + 1, np.int64)
    for k, v in histogram.items():
        left[k] = v
    made: list[tuple[tuple[tuple[int, int], ...], int]] = []  # ((length, times), ...), count
    if left[size]:
        made.append((((size, 1),), int(left[size])))
        left[size] = 0
    open_: dict[int, list[list]] = {}  # free space -> [pattern, count]
    if left.sum():
        rows = patterns(size, max(1, size // 128))
        rows = rows[(rows[:, 0] < size) & (left[rows[:, 0]] > 0) & (left[rows[:, 1]] > 0) & ((rows[:, 2] == 0) | (left[rows[:, 2]] > 0))]
        if len(rows):
            x = fit_counts(rows, left)
            order = np.argsort(-x, kind="stable")
            rows, x = rows[order], x[order]
            whole = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0).astype(np.int64)
            for p, k in zip(rows[whole > 0].tolist(), whole[whole > 0].tolist(), strict=True):
                need: dict[int, int] = {}
                for length in p:
                    if length:
                        need[length] = need.get(length, 0) + 1
                k = min([k, *(int(left[n]) // m for n, m in need.items())])
                if k > 0:
                    made.append((tuple(need.items()), k))
                    for n, m in need.items():
                        left[n] -= m * k
    for n in range(size, 0, -1):  # the rest, best fit: the longest first, into the least free space that holds it
        c = int(left[n])
        while c:
            free = next((f for f in range(n, size) if open_.get(f)), size)
            if free == size:
                times = min(size // n, c)
                k = c // times
                was, have = (), k
            else:
                was, have = open_[free].pop()
                times = min(free // n, c)
                k = min(have, c // times)
                if k < have:
                    open_[free].append([was, have - k])
            c -= k * times
            open_.setdefault(free - n * times, []).append([(*was, (n, times)), k])
    made += [(p, k) for same in open_.values() for p, k in same]

    used: dict[int, int] = {}
    runs, sequence = [], 0
    for p, k in made:
        offset = 0
        for n, times in p:
            runs.append((n, used.get(n, 0), times, sequence, offset))
            used[n] = used.get(n, 0) + times * k
            offset += n * times
        sequence += k
    runs.sort()
    a = np.array(runs, np.int64).reshape(-1, 5)
    return Plan(a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy(), a[:, 3].copy(), a[:, 4].copy(), sequence)


def pack(staged: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (staged) with sequence_id and offset."""
    histogram = {int(r["length"]): int(r["n"]) for r in staged.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
    if not histogram:
        return staged.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    made = plan(histogram, size)
    sizes = staged.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = staged.join(firsts, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("first"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s, o = made.place(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": s, "offset": o})

    return ranked.withColumn("at", place("length", "rank")).select(*[col(c) for c in staged.columns], "at.sequence_id", "at.offset")


def pack_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id", size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Every piece of every document and its place: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    return pack(stage(pieces(df, text, id_col, size, with_ids), "pieces"), size).drop("task", "nth").withColumnRenamed("id", id_col)


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
