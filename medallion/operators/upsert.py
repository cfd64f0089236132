"""Upsert (MERGE update-all / insert-all) as a plan: anti-join + union.

``target`` rows whose key appears in ``updates`` are replaced by the update row,
other update rows are inserted. Null keys never match (as ``t.k = s.k``), so
null-key rows of both sides stay: those of the updates are kept out of the join, those of the target pass
the anti-join (one scan of the target; adaptive execution splits a partition that many of them share).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.latest import latest_per_key


class DuplicateKeyError(ValueError):
    pass


def split_keys(keys: str | Sequence[str]) -> list[str]:
    """``'shipment_id,item_id'`` -> ``['shipment_id', 'item_id']`` (composite registry keys)."""
    if isinstance(keys, str):
        out = [k.strip() for k in keys.split(",") if k.strip()]
    else:
        out = [k.strip() for k in keys]
    if not out:
        raise ValueError("a MERGE load needs its key columns")
    return out


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def dedup_updates(updates: DataFrame, keys: Sequence[str], order: Sequence[str] | None, strict: bool = False) -> DataFrame:
    """One update row per non-null key: the latest by ``order`` (ties: the other columns).

    ``strict`` raises instead when a key repeats (one small aggregate action).
    """
    keys = list(keys)
    present = keys_present(keys)
    with_key, without_key = updates.filter(present), updates.filter(~present)
    if strict:
        dup = with_key.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"several source rows for key {dup[0].asDict()}")
        return updates
    if not order:  # no mark: still one row per key, the largest in its other columns
        order = [c for c in with_key.columns if c not in keys] or keys
    best = latest_per_key(with_key, keys, list(order), with_key.columns)
    return best.select(*updates.columns).unionByName(without_key)


def keep_target_values(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Update rows whose key exists in ``target`` take ``columns`` from the target
    (earliest value when the target repeats a key); new keys keep their own."""
    old = (
        target.filter(keys_present(keys))
        .groupBy(*keys)
        .agg(*[F.min(c).alias(f"_old_{c}") for c in columns])
    )
    j = updates.join(old, list(keys), "left")
    return j.select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in updates.columns])


def upsert_frames(
    target: DataFrame,
    updates: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str] | None = None,
    strict: bool = False,
    preserve: Sequence[str] = (),
) -> DataFrame:
    """The merged table: target rows without a matching update, plus all update rows.

    ``preserve`` names columns an update does not overwrite (e.g. the row's
    first ``insert_timestamp``).
    """
    keys = split_keys(keys)
    missing = [k for k in keys if k not in target.columns or k not in updates.columns]
    if missing:
        raise ValueError(f"merge key columns missing: {missing}")
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    upd = dedup_updates(updates, keys, order, strict)
    if preserve:
        upd = keep_target_values(target, upd, keys, list(preserve))
    kept = target.join(upd.filter(keys_present(keys)).select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(upd.select(*target.columns))
