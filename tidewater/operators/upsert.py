"""Keyed table-maintenance operators, as plain DataFrame algebra.

Spark rejects ``MERGE INTO`` / ``DELETE`` on plain parquet tables, so the
three keyed writes of the raw and curated layers are expressed as joins:

* ``replace_by_key``   DELETE rows whose key is in the batch, INSERT the batch
* ``insert_if_absent`` MERGE ... WHEN NOT MATCHED THEN INSERT
* ``merge_upsert``     MERGE ... WHEN MATCHED UPDATE ALL / NOT MATCHED INSERT ALL

All are anti-join + union: the anti-join shuffles both sides on the key
(or becomes a broadcast join when AQE measures the batch side small), and
NULL keys never match, exactly like SQL equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def replace_by_key(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from the batch, plus the whole batch."""
    keys = _keys(key)
    # distinct keys: copies of one key collapse map-side before the shuffle,
    # so a key repeated in a third of the batch does not land in one task
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The batch rows to *append*: one per new key, none for keys already present.

    ``dropDuplicates`` keeps one row per key inside the batch (its partial
    aggregation runs map-side, before the shuffle).
    """
    keys = _keys(key)
    fresh = batch.dropDuplicates(keys)
    return fresh.join(target.select(*keys), keys, "left_anti").select(*target.columns)


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Matched keys take the source row whole (NULLs included), new keys are
    inserted, target-only keys are kept."""
    return replace_by_key(target, source, key)
