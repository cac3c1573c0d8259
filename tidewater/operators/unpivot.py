"""Two-sided unpivot: one row per (input row, side) in a single scan.

``UNION ALL`` of a home-side and an away-side select reads the input twice;
``inline(array(struct(home...), struct(away...)))`` reads it once and
emits the same rows (a Generate node inside the same codegen stage).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided_unpivot(df: DataFrame, common: Sequence[str], sides: Mapping[str, Mapping[str, Column]],
                      side_col: str = "side") -> DataFrame:
    """``sides`` maps a side name to {output column: expression}; every side
    must produce the same output columns.  ``side_col`` is the side's index."""
    structs = [
        F.struct(F.lit(i).alias(side_col), *[expr.alias(name) for name, expr in attrs.items()])
        for i, attrs in enumerate(sides.values())
    ]
    return df.select(*common, F.inline(F.array(*structs)))
