"""Parquet tables of the lake (bronze / silver / gold / ops folders).

No table format is installed, so keyed writes are done the way a Spark
user does them on plain parquet:

* append        -> ``mode("append")``
* full rebuild  -> ``mode("overwrite")``
* keyed upsert  -> compute the new content of the *touched partitions only* and
  write it once with ``partitionOverwriteMode=dynamic``: the files go to a
  staging folder of the write itself and are swapped in when every task is
  done, so a table may be read and replaced in the same job.

Every table has a declared schema, and is read with it: values are never
inferred from folder names.  Partition columns whose values matter as data
(codes such as ``'01'``, ``''`` or NULL) are *derived* copies; the column itself
stays in the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import fs


def partition_value(value: Column) -> Column:
    """A folder-safe copy that tells NULL, '' and every other value apart."""
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value.cast("string")))


# A parquet writer measures pages and row groups first after 100 rows: of documents, these may be 100 MB.  A reader
# takes up to a row group of them at once, and they are several times larger there than in the file.
DOCUMENT_FILES = {"parquet.page.size.row.check.min": 1, "parquet.block.size": 4 << 20}


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: str, partition_by: list[str] | None = None,
                 derived: dict[str, Callable[[], Column]] | None = None, compact: bool = False, documents: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema)
        self.derived = derived or {}
        self.partition_by = [*(partition_by or []), *self.derived]
        self.compact = compact  # shuffle a write by partition, so that it leaves few files
        self.documents = documents  # its rows are whole documents: a writer looks at its bytes after each

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def exists(self) -> bool:
        """Whether it holds any data file, as a reader would see it (no marker file is asked for)."""
        return bool(fs.data_files(self.spark, self.path, first=True))

    def _read(self) -> DataFrame:
        """With the derived partition columns."""
        full = T.StructType([*self.schema.fields, *(T.StructField(c, T.StringType()) for c in self.derived)])
        if not self.exists():
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(self.path).select(*full.names)

    def read(self) -> DataFrame:
        """All rows; an absent table is an empty one (create-if-absent)."""
        return self._read().select(*self.columns)

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` in the table's columns, with its partition columns."""
        df = df.select(*self.columns)
        return df.withColumns({c: f() for c, f in self.derived.items()}) if self.derived else df

    def writer(self, df: DataFrame):
        """A writer of ``df`` in the table's columns and partitions."""
        df = self.placed(df)
        if self.compact:
            # as many tasks as the data needs: a large partition is split, small ones share a task
            df = df.hint("rebalance", *self.partition_by)
        w = df.write.format("parquet")
        if self.documents:
            w = w.options(**DOCUMENT_FILES)
        return w.partitionBy(*self.partition_by) if self.partition_by else w

    def overwrite(self, df: DataFrame, reads_self: bool = False) -> "Table":
        """Replace the whole table; ``reads_self``: ``df`` reads it, so its rows are set down first."""
        if not reads_self:
            self.writer(df).mode("overwrite").option("partitionOverwriteMode", "static").save(self.path)
            return self
        aside = f"{self.path}__aside/{uuid.uuid4().hex}"
        df.select(*self.columns).write.parquet(aside)
        self.overwrite(self.spark.read.schema(self.schema).parquet(aside))
        fs.delete(self.spark, aside)
        return self

    def append(self, df: DataFrame) -> "Table":
        self.writer(df).mode("append").save(self.path)
        return self

    def touched(self, df: DataFrame) -> list[tuple]:
        """Distinct partition values of ``df`` (few: days of a batch, competitions and seasons)."""
        return [tuple(r) for r in self.placed(df).select(*self.partition_by).distinct().collect()]

    def any_partition_exists(self, values: list[tuple]) -> bool:
        """Whether any of the partitions already holds data (folder check, no scan)."""
        return any(fs.exists(self.spark, self._folder(v)) for v in values)

    def read_partitions(self, values: list[tuple]) -> DataFrame:
        """Rows of the listed partitions only, as a literal filter: static
        partition pruning at the scan, no join against the whole table."""
        df = self._read()
        return df.where(values_filter(self.partition_by, values) if values else F.lit(False)).select(*self.columns)

    def read_where(self, column: str, values: list) -> DataFrame:
        """Rows of the partitions with these values of one partition column."""
        return self._read().where(F.col(column).isin(*values)).select(*self.columns)

    def places_of(self, keys: DataFrame, key: str) -> list[tuple]:
        """Partitions that hold a row of these keys (reads the key column alone)."""
        found = self._read().select(key, *self.partition_by).join(keys.select(key).distinct(), key, "left_semi")
        return [tuple(r) for r in found.select(*self.partition_by).distinct().collect()]

    def replace_partitions(self, df: DataFrame, expected: list[tuple] | None = None) -> "Table":
        """Make the touched partitions hold exactly ``df``; others stay untouched.

        ``expected``: partitions that are replaced even if ``df`` has no row for
        them.  Those that the write left alone have come out empty and go.
        """
        if not self.partition_by:
            return self.overwrite(df, reads_self=True)
        before = {v: fs.data_files(self.spark, self._folder(v)) for v in expected or []}
        self.writer(df).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(self.path)
        for values, files in before.items():
            if files and set(files) == set(fs.data_files(self.spark, self._folder(values))):
                fs.delete(self.spark, self._folder(values))
        return self

    def drop_partition(self, values: tuple) -> None:
        """Remove one partition's folder."""
        fs.delete(self.spark, self._folder(values))

    def _folder(self, values: tuple) -> str:
        return "/".join([self.path, *(f"{c}={escape(x)}" for c, x in zip(self.partition_by, values))])


def values_filter(cols: list[str], values: list[tuple]) -> Column:
    """OR of per-partition equality (NULL-safe) over the partition columns."""
    if len(cols) == 1:
        plain = [v[0] for v in values if v[0] is not None]
        cond = F.col(cols[0]).isin(plain) if plain else F.lit(False)
        return cond | F.col(cols[0]).isNull() if any(v[0] is None for v in values) else cond
    cond = F.lit(False)
    for v in values:
        one = F.lit(True)
        for c, x in zip(cols, v):
            one = one & (F.col(c).isNull() if x is None else (F.col(c) == F.lit(x)))
        cond = cond | one
    return cond


# characters the file source escapes in partition folder names (Hive style)
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^')


def escape(value) -> str:
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value)
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED or ord(ch) < 0x20 else ch for ch in text)
