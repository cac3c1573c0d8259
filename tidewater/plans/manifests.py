"""Landing-side operators: document writer, manifest build/reconcile, competitions flatten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import exprs as X

LANDING_PARTITIONS = ["endpoint", "competition", "dateFrom", "dateTo", "dt", "run_id"]


def landing_write(docs: DataFrame, root: str) -> None:
    """Write one JSON document per row under Hive-style landing folders.

    ``docs`` has the partition columns and one ``matches`` array column, so
    each row becomes exactly one ``{"matches": [...]}`` object (one record
    per file); Spark names the files, so ``run_id`` is a folder rather than
    the file name.  No shuffle: every task writes the documents it holds.
    """
    (docs.select(*LANDING_PARTITIONS, "matches")
     .write.mode("append").option("maxRecordsPerFile", 1)
     .partitionBy(*LANDING_PARTITIONS).json(root))


def element_count(v: Column, path: str = "$.matches") -> Column:
    """Number of elements at ``path`` (an object counts its fields; absent -> 0)."""
    return F.coalesce(
        F.array_size(F.try_variant_get(v, path, "array<variant>")),
        F.size(F.try_variant_get(v, path, "map<string,variant>")),
        F.lit(0),
    ).cast("bigint")


def manifest_build(raw: DataFrame, endpoint: str = "matches", bucket: str = "bronze",
                   fetched_at: Column | None = None, carry: Sequence[Column] = ()) -> DataFrame:
    """Manifest record of each raw data document (no shuffle: one row in, one out); ``carry``: columns of ``raw`` that go along."""
    fetched = fetched_at if fetched_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    out = raw.select(
        F.col("file_key").alias("data_key"),
        "run_id",
        F.lit(endpoint).alias("endpoint"),
        F.col("competition_code").alias("competition"),
        F.col("date_from").cast("string").alias("date_from"),
        F.col("date_to").cast("string").alias("date_to"),
        F.col("dt").cast("string").alias("dt_partition"),
        element_count(F.col("payload")).alias("record_count"),
        F.lit(bucket).alias("bucket"),
        fetched.alias("fetched_at_utc"),
        *carry,
    )
    manifest = F.to_json(F.struct(
        "run_id", "endpoint", "competition",
        F.struct(F.col("date_from").alias("dateFrom"), F.col("date_to").alias("dateTo")).alias("params"),
        "dt_partition", "fetched_at_utc", "record_count", "bucket", "data_key",
    ))
    return out.withColumn("manifest_key", X.manifest_key_for(F.col("data_key"))).withColumn("manifest", manifest)


def landing_pairs(raw: DataFrame, endpoint: str = "matches", fetched_at: Column | None = None) -> DataFrame:
    """key, body of every document and of its manifest, in the object layout (one row each)."""
    m = manifest_build(raw, endpoint, fetched_at=fetched_at, carry=[F.to_json("payload").alias("document")])
    # both from one read of the document
    data = F.struct(F.col("data_key").alias("key"), F.col("document").alias("body"))
    return m.select(F.inline(F.array(data, F.struct(F.col("manifest_key").alias("key"), F.col("manifest").alias("body")))))


def manifest_reconcile(raw_matches: DataFrame, raw_manifests: DataFrame, unmatched: bool = False) -> DataFrame:
    """Data documents whose manifest ``record_count`` differs from the payload count.

    ``unmatched``: also documents without a manifest and manifests without a document.
    """
    m = raw_manifests.select(
        F.col("file_key").alias("manifest_key"),
        F.variant_get(F.col("manifest"), "$.record_count", "bigint").alias("manifest_count"),
    )
    d = raw_matches.select(
        F.col("file_key").alias("data_key"),
        X.manifest_key_for(F.col("file_key")).alias("manifest_key"),
        element_count(F.col("payload")).alias("payload_count"),
    )
    both = d.join(m, "manifest_key", "full" if unmatched else "inner")
    return both.where(~F.col("manifest_count").eqNullSafe(F.col("payload_count")))


def competitions_flatten(raw_competitions: DataFrame) -> DataFrame:
    """One row per element of ``payload:competitions`` (id, code, name)."""
    src = raw_competitions.select("file_key", "run_id", "dt", "payload")
    ex = src.lateralJoin(
        src.sparkSession.tvf.variant_explode(F.variant_get(F.col("payload").outer(), "$.competitions", "variant"))
    )
    c = F.variant_get(F.col("value"), "$", "struct<id bigint, code string, name string>")
    return ex.select("file_key", "run_id", "dt", c.alias("c")).select(
        "file_key", "run_id", "dt",
        F.col("c.id").alias("competition_id"), F.col("c.code").alias("code"), F.col("c.name").alias("name"))
