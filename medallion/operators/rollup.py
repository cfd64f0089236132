"""Left-join chains rolled up without materialising the fan-out.

The marts join parent -> child -> grandchild ... with left joins and then
aggregate by attributes of the parent: distinct counts of each level's id and
sums of conditions over the joined (leaf) rows. Joining first and aggregating
after multiplies rows and, with several COUNT(DISTINCT), makes Catalyst expand
every row once per distinct aggregate before two shuffles.

Here each level is reduced to *path counts*: ``(group, node_id, _w)`` where
``_w`` is how many joined rows reach ``node_id`` from ``group`` (0 where the id
is null: such a row only keeps its group). Descending one level is a join of
that (small, already aggregated) table with the child table on the child's
parent key, followed by a re-aggregation. Then

* distinct count of level k per group = number of distinct ids in the level-k
  path table;
* SUM(CASE ...) over joined rows = sum of ``_w * condition`` over leaf rows.

Both are exact for any data (duplicate keys included); nothing assumes unique
ids. The only pass over the big leaf table is one join with the level above
(AQE broadcasts that side when its measured size allows, else sort-merge) and
one aggregate with a map-side partial step.

Every consumer of a path table reads it through ``live`` or ``distinct_nodes``.
Both test ``_w``, an aggregate's output, so no null filter is pushed below that
aggregate for one of them only: the consumers' plans stay alike, Spark runs the
level's exchange once and reuses it, and each table is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

W = "_w"


def root_paths(root: DataFrame, group: Sequence[str], node: str) -> DataFrame:
    """Path counts at the root level: rows of ``root`` per (group, node), 0 for a null node."""
    cols = list(dict.fromkeys([*group, node]))
    return root.groupBy(*cols).agg(F.count(node).alias(W))


def live(paths: DataFrame, group: Sequence[str], node: str, name: str) -> DataFrame:
    """The rows of a path table that have an id: group columns, the id as ``name``, ``_w``.

    Null ids never match an equi-join, so this also keeps a null-key hot spot out of the shuffle.
    """
    there = F.col(W) > 0
    return paths.filter(there).select(*group, F.when(there, F.col(node)).alias(name), W)


def descend(paths: DataFrame, group: Sequence[str], node: str, child: DataFrame, parent_key: str, child_node: str) -> DataFrame:
    """Path counts one level down: ``paths`` joined to ``child`` on ``child.parent_key = paths.node``."""
    up = live(paths, group, node, "_parent")
    down = child.filter(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("_parent"), F.col(child_node).alias("_child"))
    joined = up.join(down, "_parent")
    weight = F.when(F.col("_child").isNotNull(), F.col(W)).otherwise(0)
    return joined.groupBy(*group, F.col("_child").alias(child_node)).agg(F.sum(weight).alias(W))


def distinct_nodes(levels: Sequence[tuple[DataFrame, str, str]], by: Sequence[str]) -> DataFrame:
    """COUNT(DISTINCT node) per ``by`` for several path tables at once; ``levels``: (path table, node, output name).

    The levels are stacked, each id in a column of its own, and share one distinct and one count. Every
    group of any level has a row.
    """
    names = [name for _, _, name in levels]
    stacked: DataFrame | None = None
    for paths, node, name in levels:
        rows = paths.select(*by, F.when(F.col(W) > 0, F.col(node)).alias(name))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no levels")
    return stacked.distinct().groupBy(*by).agg(*[F.count(name).alias(name) for name in names])


def fold_stats(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Combine per-key stat frames that each carry a subset of columns.

    Rows are stacked (missing columns null) and folded with ``max`` per key,
    which keeps null keys as their own group (an equi-join would lose them).
    Every input has at most one row per key, so ``max`` just picks the value.
    """
    keys = list(keys)
    value_cols: list[str] = []
    for f in frames:
        value_cols += [c for c in f.columns if c not in keys and c not in value_cols]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in value_cols])
