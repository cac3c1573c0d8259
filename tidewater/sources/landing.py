"""Landing-zone sources: object listing, key parsing, whole-document reads.

A landing object is one immutable JSON document stored under a Hive-style
key (``endpoint=matches/competition=PL/.../run_id=<id>.json``) with an
optional ``.manifest.json`` side-car.  Listing reads no file content (the
``binaryFile`` source prunes ``content`` when it is not selected), so the
ledger anti-join runs before any document is opened.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import exprs as X
from tidewater.sources import fs

LISTING_SCHEMA = T.StructType([
    T.StructField("file_key", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("size", T.LongType()),
])

#: Ranges of file names that a read is pruned by; beyond them one range for each folder.
MAX_RANGES = 200


def list_objects(spark: SparkSession, landing: str, prefix: str = "", since: date | None = None, back: int | None = None) -> DataFrame:
    """``*.json`` objects below ``landing/prefix`` (recursive): key, path, uri (the path as a reader reports it), size.

    ``since``: only landing days (``dt=`` folders) from that one on; folders of earlier days are not listed.  ``back``: the
    endpoint's request windows begin at most that many days before their landing day, so that ``dateFrom=`` folders
    that begin earlier are not entered either.
    """
    root = landing.rstrip("/") + "/" + prefix.lstrip("/")
    if not fs.exists(spark, root):
        return spark.createDataFrame([], LISTING_SCHEMA)
    folders = [root] if since is None else [fs.literal(f) for f in day_folders(spark, root, since, back)]
    if not folders:
        return spark.createDataFrame([], LISTING_SCHEMA)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(folders)
        .select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size"))
    )
    return listing.select(X.relative_key(F.col("path")).alias("file_key"), "path", "uri", "size")


def day_folders(spark: SparkSession, root: str, since: date, back: int | None = None) -> list[str]:
    """Landing-day folders below ``root`` from ``since`` on (competitions x days of the look-back)."""
    found, todo = [], [root.rstrip("/")]
    while todo:
        folder = todo.pop()
        for name in fs.folders(spark, folder):
            key, _, value = name.partition("=")
            if key == "dt":
                if value >= since.isoformat():
                    found.append(f"{folder}/{name}")
            elif not (key == "dateFrom" and back is not None and value < (since - timedelta(days=back)).isoformat()):
                todo.append(f"{folder}/{name}")
    return sorted(found)


def object_classify(listing: DataFrame, key: str = "file_key") -> DataFrame:
    """Tag each object as ``data`` or ``manifest`` (other objects dropped)."""
    k = F.col(key)
    kind = F.when(X.is_manifest_key(k), "manifest").when(X.is_data_key(k), "data")
    return listing.withColumn("kind", kind).where(F.col("kind").isNotNull())


def key_parse(df: DataFrame, key: str = "file_key") -> DataFrame:
    """Add run_id, dt, competition, date_from, date_to parsed from the key.

    Each pattern is independent; a key it does not match yields NULL.
    """
    k = F.col(key)
    return df.select(
        "*",
        X.regex_group(k, X.RUN_ID_RE).alias("run_id"),
        X.regex_group(k, X.DT_RE).alias("dt"),
        X.regex_group(k, X.COMPETITION_RE).alias("competition"),
        X.regex_group(k, X.DATE_FROM_RE).alias("date_from"),
        X.regex_group(k, X.DATE_TO_RE).alias("date_to"),
    )


def latest_object(listing: DataFrame, key: str = "file_key") -> DataFrame:
    """The greatest data key in plain string order (one row, or none)."""
    data = listing.where(X.is_data_key(F.col(key)))
    return data.agg(F.max(key).alias("latest_key")).where(F.col("latest_key").isNotNull())


def read_documents(spark: SparkSession, objects: DataFrame, listing: DataFrame | None = None,
                   kind: Callable[[Column], Column] | None = None) -> DataFrame:
    """Whole-text read of the listed objects (columns file_key, path, uri): (file_key, text).

    The driver learns the distinct landing-day folders (competitions x days of a batch) and ranges of names
    between objects of ``listing`` that are not wanted, however many objects they hold.  A predicate on the file's
    path keeps files outside the ranges closed; the objects wanted are picked by key from what is left.
    ``kind``: what the names of all these objects (and of ``listing``) have in common, such as ``is_manifest_key``;
    documents and manifests lie side by side, and files of the other kind stay closed as well.
    """
    ranges = name_ranges(objects, listing)
    docs = _whole_texts(spark, [fs.literal(f) for f in sorted({f for f, _, _ in ranges})], [(lo, hi) for _, lo, hi in ranges], kind)
    return docs.join(objects.select("file_key").distinct(), "file_key", "left_semi")


def name_ranges(objects: DataFrame, listing: DataFrame | None = None) -> list[tuple[str, str, str]]:
    """(folder, first, last uri) that cover the objects; runs of neighbours in ``listing``, unless there are too many."""
    folder = X.landing_folder(F.col("path")).alias("folder")
    wanted = objects.select(folder, "uri").distinct().withColumn("wanted", F.lit(1))
    if listing is not None:
        every = listing.select(folder, "uri").distinct().join(wanted, ["folder", "uri"], "left")
        # objects between two that are not wanted have the same number of these before them
        before = F.sum(F.when(F.col("wanted").isNull(), 1).otherwise(0)).over(Window.partitionBy("folder").orderBy("uri"))
        runs = every.withColumn("run", before).where("wanted = 1").groupBy("folder", "run").agg(F.min("uri").alias("lo"), F.max("uri").alias("hi"))
        found = runs.select("folder", "lo", "hi").limit(MAX_RANGES + 1).collect()
        if len(found) <= MAX_RANGES:
            return [tuple(r) for r in found]
    return [tuple(r) for r in wanted.groupBy("folder").agg(F.min("uri"), F.max("uri")).collect()]


def read_tree(spark: SparkSession, landing: str, prefix: str) -> DataFrame:
    """Whole-text read of every object below a prefix: (file_key, text)."""
    root = landing.rstrip("/") + "/" + prefix.lstrip("/")
    return _whole_texts(spark, [root] if fs.exists(spark, root) else [])


def _whole_texts(spark: SparkSession, folders: list[str], ranges: list[tuple[str, str]] | None = None,
                 kind: Callable[[Column], Column] | None = None) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], "file_key string, text string")
    docs = (spark.read.option("wholetext", True).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.json").text(folders))
    uri = F.col("_metadata.file_path")
    if ranges:
        docs = docs.where(_any_of([uri.between(lo, hi) for lo, hi in ranges]))
    if kind is not None:
        docs = docs.where(kind(uri))
    return docs.select(X.file_key(uri).alias("file_key"), F.col("value").alias("text"))


def _any_of(conditions: list[Column]) -> Column:
    """OR as a balanced tree."""
    while len(conditions) > 1:
        conditions = [reduce(operator.or_, conditions[k : k + 2]) for k in range(0, len(conditions), 2)]
    return conditions[0]
