from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp(as_of: datetime | Column | None) -> Column:
    """gold_insert_timestamp: the query's current_timestamp(), or a fixed value for tests."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def need(silver: Mapping[str, DataFrame], *names: str) -> list[DataFrame]:
    missing = [n for n in names if n not in silver]
    if missing:
        raise KeyError(f"silver tables missing: {missing}")
    return [silver[n] for n in names]
