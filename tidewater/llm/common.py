"""Helpers shared by the corpus operators.

Conventions that hold for every operator of this subpackage:

* only the columns an operator names are read; any other column of the
  input is carried along or ignored, whatever its name;
* a null text is an empty text;
* a null ``doc_id`` sorts after every other id (``LAST_ID``);
* rows agreeing in ``doc_id`` and text get the same result, one per row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_dir

#: ASCII white space that ends a word; everything else belongs to words.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
#: Place of a null doc_id in every order of ids.
LAST_ID = (1 << 63) - 1
#: Rows of whole texts that travel to a Python worker together, and their bytes.
TEXTS_PER_BATCH = 256
BYTES_PER_BATCH = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the texts a Python worker holds at once, for very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs inside send Python workers batches of about ``most`` bytes (a larger row goes alone)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a copy that survives lost executors, evaluates
    ``df`` once however often it is used, and gives Spark the real size.
    """
    path = scratch_dir(df.sparkSession, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def co_located(df: DataFrame, key: str, label: str, compression: str = "snappy") -> DataFrame:
    """``scratch`` in buckets of ``key``: joins on it shuffle only the other side, stage after stage.

    The table is external to the catalog's warehouse (its files are in the shared scratch folder) and
    has as many buckets as the session has shuffle partitions.
    """
    spark = df.sparkSession
    name = f"llm_{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("compression", compression).bucketBy(buckets, key).option("path", scratch_dir(spark, "llm", name)).saveAsTable(name)
    return spark.table(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_order(name: str = "doc_id") -> Column:
    """The id as a number that orders null last."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(LAST_ID))


def words_of(text: Column) -> Column:
    """Words between runs of ASCII white space; an empty array for none."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, and only if needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))

