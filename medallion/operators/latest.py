"""Latest row per key.

The reference keeps ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY t DESC) = 1``.
A window needs every row of a key in one task, sorted; a key holding a third of
the data then becomes one huge task. ``max(struct(order..., payload...))`` gives
the same row (``DESC NULLS LAST`` order, then payload as the last tie-break) as an
aggregate with a map-side partial step (a sort aggregate, as structs can't be hash-aggregated in
place), so a hot key is reduced on every mapper before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """One row per ``keys``: the greatest ``order`` tuple (nulls lowest).

    ``columns`` are the columns to keep (default: all). Ties on ``order`` are
    broken by the remaining columns, so the result is deterministic. Null keys
    form one group unless ``drop_null_keys`` (use it before an equi-join, where
    null keys never match anyway).
    """
    keys, order = list(keys), list(order)
    cols = list(columns) if columns is not None else df.columns
    payload = [c for c in cols if c not in keys and c not in order]
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    packed = F.struct(*[F.col(c) for c in order + payload]).alias("_best")
    best = src.groupBy(*keys).agg(F.max(packed).alias("_best"))
    out_cols = [c for c in cols if c not in keys]
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in out_cols])


def latest_per_key_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The literal window form (row_number = 1), kept for comparison in tests and the bench."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
