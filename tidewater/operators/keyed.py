"""Per-key ranking operators: latest row per key, top-N per key, rank column.

The order list must spell its NULL placement (``desc_nulls_first()`` ...):
the warehouse dialect the models were written for sorts NULL as the
largest value, Spark's defaults do the opposite.  Callers append a
deterministic tie-break so ties never depend on shuffle order.

``row_number() <= n`` over a window is planned by Catalyst as a
``WindowGroupLimit``: a partial limit runs on each map partition *before*
the shuffle, so even a key holding a third of all rows ships at most n
rows per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                 rank_col: str | None = None) -> DataFrame:
    """At most ``n`` rows per key, the first ones in ``order``."""
    rn = rank_col or "_rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exactly one row per key: the first in ``order`` (QUALIFY row_number() = 1)."""
    return top_n_by_key(df, keys, order, 1)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Unique 1..n position of each row inside its key (ties broken by ``order``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))
