"""Bronze loaders: landing objects -> raw tables, with a load-state ledger.

One Spark job per batch of files (not one statement per file):

    list (no content) -> classify -> anti-join ledger -> pair manifests
    -> whole-text read of pending objects only -> parse_json
    -> replace_by_key into the touched dt partitions -> ledger insert

Both the data key and its manifest key are marked in the ledger only
after both raw tables are written, so a failure in between leaves the
pair pending instead of losing the manifest.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.operators.upsert import insert_if_absent
from tidewater.operators.windows import DAYS_BACK
from tidewater.plans.lake import Lake
from tidewater.session import configure
from tidewater.sources import landing as L

# --- fixed values: endpoints and their ledger names ---
ENDPOINTS = {
    "matches": ("matches_incremental", "matches_incremental_manifest"),
    "matches_backfill": ("matches_backfill", "matches_backfill_manifest"),
}
# --- end fixed values ---


def prefix_of(endpoint: str) -> str:
    return f"endpoint={endpoint}/"


def ledger_of(ledger: DataFrame, endpoint: str) -> DataFrame:
    """Data keys of one endpoint in the ledger (its partition is the only one read)."""
    names = ENDPOINTS[endpoint]
    return ledger.where(F.col("endpoint").isin(*names) & F.col("file_key").startswith(prefix_of(endpoint))).select("file_key")


def load_state_pending(data: DataFrame, ledger: DataFrame, endpoint: str) -> DataFrame:
    """Data objects whose key is not yet in the ledger (ledger read by prefix)."""
    return data.join(ledger_of(ledger, endpoint), "file_key", "left_anti")


def manifest_pairing(data: DataFrame, manifests: DataFrame) -> DataFrame:
    """Each data object with its expected manifest key and, if landed, its path."""
    # listed uris, where the listing has them, go with the paths
    uri = [F.col("uri").alias("manifest_uri")] if "uri" in manifests.columns else []
    m = manifests.select(F.col("file_key").alias("manifest_key"), F.col("path").alias("manifest_path"), *uri)
    d = data.withColumn("manifest_key", X.manifest_key_for(F.col("file_key")))
    return d.join(m, "manifest_key", "left").withColumn("manifest_found", F.col("manifest_path").isNotNull())


def flag_pending(data: DataFrame, ledger: DataFrame, manifests: DataFrame, endpoint: str) -> DataFrame:
    """Every data object with ``pending`` (key not in the ledger) and its manifest pairing."""
    loaded = ledger_of(ledger, endpoint).distinct().withColumn("_loaded", F.lit(True))
    flagged = data.join(loaded, "file_key", "left") \
        .withColumn("pending", ~F.coalesce(F.col("_loaded"), F.lit(False))).drop("_loaded")
    return manifest_pairing(flagged, manifests)


def loader_metrics(prefix: str, flagged: DataFrame) -> DataFrame:
    """One row: prefix + 4 file counters (all zero when nothing is found)."""
    return flagged.agg(
        F.lit(prefix).alias("prefix"),
        F.count(F.lit(1)).alias("files_discovered"),
        F.count_if("pending").alias("files_to_load"),
        F.count_if("pending").alias("data_files_loaded"),
        F.count_if(F.col("pending") & F.col("manifest_found")).alias("manifests_loaded"),
    )


def _parsed(docs: DataFrame, strict: bool) -> Column:
    """Each document's value: as it was parsed before (column document), or from its text."""
    if "document" in docs.columns:
        return F.col("document")
    return F.parse_json("text") if strict else F.try_parse_json("text")


def raw_matches_rows(docs: DataFrame, loaded_at: Column, strict: bool = True) -> DataFrame:
    """RAW_MATCHES rows of data documents (key fields parsed from the key)."""
    parsed = L.key_parse(docs)
    return parsed.select(
        "file_key",
        F.col("competition").alias("competition_code"),
        F.col("date_from").cast("date").alias("date_from"),
        F.col("date_to").cast("date").alias("date_to"),
        "run_id",
        F.col("dt").cast("date").alias("dt"),
        _parsed(docs, strict).alias("payload"),
        loaded_at.cast("timestamp").alias("loaded_at"),
    )


def raw_manifest_rows(docs: DataFrame, default_endpoint: str, strict: bool = True, fill: bool = True) -> DataFrame:
    """RAW_MANIFESTS rows: manifest fields win, key-parsed values fill in (``a or b``).

    ``fill=False`` (the one-off load of the latest object) takes the manifest's own values as they are.
    """
    parsed = L.key_parse(docs).withColumn("manifest", _parsed(docs, strict))
    field = lambda name: F.try_variant_get(F.col("manifest"), f"$.{name}", "string")
    own = (lambda name, other: X.falsy_or(field(name), other)) if fill else (lambda name, other: field(name))
    return parsed.select(
        "file_key",
        own("endpoint", F.lit(default_endpoint)).alias("endpoint"),
        own("run_id", F.col("run_id")).alias("run_id"),
        own("dt_partition", F.col("dt")).cast("date").alias("dt"),
        "manifest",
    )


def raw_competitions_rows(docs: DataFrame, strict: bool = True) -> DataFrame:
    parsed = L.key_parse(docs)
    return parsed.select(
        "file_key", "run_id", F.col("dt").cast("date").alias("dt"),
        (F.parse_json("text") if strict else F.try_parse_json("text")).alias("payload"),
    )


def upsert_by_key_partitions(table, batch: DataFrame, key: str = "file_key", parsed: str | None = None,
                             keys: DataFrame | None = None, touched: list[tuple] | None = None) -> tuple[int, int]:
    """replace_by_key restricted to the partitions the batch touches; (rows written, rows with NULL in ``parsed``).

    The counts are observed on the batch's rows by the job that writes them.  Where the batch's ``keys`` and
    ``touched`` partitions are known without its rows, these are computed once, by that job; else they are
    kept in between.

    Every table it is used on is partitioned by something a key determines (the
    landing day inside the key), so replacing inside touched partitions equals
    replacing in the whole table.
    """
    known = keys is not None and touched is not None
    if not known:
        batch = batch.cache()  # used twice: touched partitions, then the write
        keys, touched = batch.select(key), table.touched(batch)
    if not touched:
        batch.unpersist()
        return 0, 0
    seen = Observation()
    good = F.lit(True) if parsed is None else F.col(parsed).isNotNull()
    rows = batch.observe(seen, F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    if not table.any_partition_exists(touched):
        table.append(rows)  # the usual daily case: a new landing day, nothing to replace
    else:
        target = table.read_partitions(touched)  # only the batch's partitions are read and rewritten
        kept = target.join(keys.select(key).distinct(), key, "left_anti")
        table.replace_partitions(kept.unionByName(rows.select(*target.columns)))
    counts = seen.get
    if not known:
        batch.unpersist()
    return counts["good"], counts["bad"]


def append_new(table, batch: DataFrame, key: str = "file_key") -> bool:
    """Append the batch's rows whose key is not in the table yet; whether it had any of them.

    Reads the key column of the touched partitions and rewrites nothing.  Right
    where a key's content never changes, as in a file stream: it makes a retried
    micro-batch add nothing.  The batch is read for its keys and then for its rows, so
    it is one that can be read twice; rows are joined only where some of them are there already.
    """
    touched = table.touched(batch)
    held = None
    if table.any_partition_exists(touched):
        held = table.read_partitions(touched).select(key).join(batch.select(key), key, "left_semi")
        held = None if held.isEmpty() else held
    if touched:
        table.append(batch if held is None else batch.join(held, key, "left_anti"))
    return held is not None


def log_load(lake: Lake, days: DataFrame, load_id: str, loaded_at: Column) -> None:
    """Note which landing days (column dt) a load touched, after its rows are written and before its keys are marked.

    Downstream publishes from this log, so rows are found whichever job loaded
    them and however far it came afterwards.
    """
    rows = days.select(F.lit(load_id).alias("load_id"), loaded_at.cast("timestamp").alias("loaded_at"), F.col("dt").cast("date").alias("dt"))
    lake.loads.append(rows.distinct().coalesce(1))


# --- fixed values: days that a request window of each endpoint begins before its landing day ---
WINDOW_BACK = {"matches": DAYS_BACK}
# --- end fixed values ---

#: Landing days that are listed again before the last one seen, for objects that arrive late.
LOOK_BACK_DAYS = 7


def frontier(lake: Lake, endpoint: str, look_back: int | None) -> date | None:
    """The first landing day to list; None: all of them (nothing seen yet, or no look-back)."""
    if look_back is None:
        return None
    seen = lake.landing_frontier.read().where(F.col("endpoint") == endpoint).agg(F.max("dt")).collect()[0][0]
    return None if seen is None else seen - timedelta(days=look_back)


def load_matches(spark: SparkSession, landing: str, lake: Lake, endpoint: str = "matches",
                 loaded_at: str | None = None, on_empty: str = "zeros", strict: bool = True,
                 until_dt: str | None = None, look_back: int | None = None) -> dict:
    """Load pending data files (and their manifests) of one endpoint into bronze.

    Returns the loader metrics record.  ``on_empty``: ``zeros`` (incremental)
    returns zero counters, ``error`` (backfill) raises when nothing is landed.
    ``until_dt`` leaves objects of later landing days for another run.
    ``look_back``: list only the landing days from that many before the last one a load has seen; objects
    that arrive later than that are found by a run without it, which lists everything.

    What is counted as loaded was observed on the rows as they were written; documents
    that ``strict=False`` sets aside are counted apart, as ``quarantined``.
    """
    configure(spark)
    prefix = prefix_of(endpoint)
    data_ep, manifest_ep = ENDPOINTS[endpoint]
    since = frontier(lake, endpoint, look_back)
    objects = L.object_classify(L.list_objects(spark, landing, prefix, since, WINDOW_BACK.get(endpoint)))
    if until_dt is not None:
        objects = objects.where(X.regex_group(F.col("file_key"), X.DT_RE) <= until_dt)
    objects = objects.cache()
    data = objects.where(F.col("kind") == "data").drop("kind")
    manifests = objects.where(F.col("kind") == "manifest").drop("kind")
    # every data object flagged pending-or-not and paired with its manifest: the
    # counters and the pending set come from this one table (two joins, one pass)
    flagged = flag_pending(data, lake.load_state.read(), manifests, endpoint).cache()
    found = loader_metrics(prefix, flagged).collect()[0].asDict()
    last = objects.agg(F.max(X.regex_group(F.col("file_key"), X.DT_RE))).collect()[0][0]
    metrics = found | {"data_files_loaded": 0, "manifests_loaded": 0}
    paired = flagged.where("pending")
    # nothing new since the frontier is no empty landing
    if metrics["files_discovered"] == 0 and on_empty == "error" and since is None:
        objects.unpersist()
        flagged.unpersist()
        raise RuntimeError(f"No {endpoint} files found with prefix: {prefix}")
    if metrics["files_to_load"] > 0:
        # one load time for the whole batch, fixed on the driver (a recomputed task sees the same value)
        loaded_at = loaded_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        ts = F.lit(loaded_at).cast("timestamp")
        with_manifest = paired.where("manifest_found")
        matched = with_manifest.select(
            F.col("manifest_key").alias("file_key"), F.col("manifest_path").alias("path"), F.col("manifest_uri").alias("uri"))
        data_rows = raw_matches_rows(L.read_documents(spark, paired, data, X.is_data_key), ts, strict)
        man_rows = raw_manifest_rows(L.read_documents(spark, matched, manifests, X.is_manifest_key), endpoint, strict)
        # both tables are partitioned by the landing day in the key: no document is opened to learn it
        metrics["data_files_loaded"], bad_data = upsert_by_key_partitions(
            lake.raw_matches, data_rows, parsed="payload", keys=paired, touched=_days(paired))
        metrics["manifests_loaded"], bad_manifests = upsert_by_key_partitions(
            lake.raw_manifests, man_rows, parsed="manifest", keys=matched,
            touched=lake.raw_manifests.touched(_manifest_shape(lake, with_manifest)))
        if not strict:
            # tolerant mode: unparsable documents are loaded with a NULL payload, set aside by key and counted
            metrics["quarantined"] = bad_data + bad_manifests
            if metrics["quarantined"]:
                lake.quarantine.append(_set_aside(lake, paired, ts))
        log_load(lake, L.key_parse(paired.select("file_key")), uuid.uuid4().hex, ts)
        marks = paired.select("file_key", F.lit(data_ep).alias("endpoint")).unionByName(
            paired.where("manifest_found").select(F.col("manifest_key").alias("file_key"),
                                                  F.lit(manifest_ep).alias("endpoint")))
        mark(lake, marks, [data_ep, manifest_ep])
    if last is not None and until_dt is None and (since is None or last > (since + timedelta(days=look_back)).isoformat()):
        seen = spark.createDataFrame([(endpoint, last)], "endpoint string, dt string")
        lake.landing_frontier.append(seen.select("endpoint", F.col("dt").cast("date").alias("dt"), F.current_timestamp().alias("loaded_at")).coalesce(1))
    objects.unpersist()
    flagged.unpersist()
    return metrics


def _set_aside(lake: Lake, paired: DataFrame, ts: Column) -> DataFrame:
    """Quarantine rows of this load: its landing days' documents whose payload did not parse."""
    data = lake.raw_matches.read_partitions(_days(paired)).where(F.col("payload").isNull() & (F.col("loaded_at") == ts))
    manifests = lake.raw_manifests.read_partitions(lake.raw_manifests.touched(_manifest_shape(lake, paired))).where(F.col("manifest").isNull())
    mine = manifests.join(paired.select(F.col("manifest_key").alias("file_key")), "file_key", "left_semi")
    rows = [data.select("file_key", F.lit("data").alias("kind")), mine.select("file_key", F.lit("manifest").alias("kind"))]
    return rows[0].unionByName(rows[1]).withColumn("loaded_at", ts)


def _days(paired: DataFrame) -> list[tuple]:
    return [tuple(r) for r in L.key_parse(paired.select("file_key")).select(F.col("dt").cast("date")).distinct().collect()]


def _manifest_shape(lake: Lake, paired: DataFrame) -> DataFrame:
    """The manifests' keys in the columns of their table."""
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in lake.raw_manifests.schema if f.name != "file_key"]
    return paired.select(F.col("manifest_key").alias("file_key"), *rest)


def mark(lake: Lake, marks: DataFrame, endpoints: list[str]) -> None:
    """Add keys to the ledger that it does not have (reads these endpoints' partitions of it)."""
    ledger = lake.load_state.read().where(F.col("endpoint").isin(*endpoints))
    lake.load_state.append(insert_if_absent(ledger, marks, "file_key"))


def load_competitions(spark: SparkSession, landing: str, lake: Lake, strict: bool = True) -> int:
    """Keyed replace of every landed competitions document into RAW_COMPETITIONS."""
    docs = L.read_tree(spark, landing, prefix_of("competitions"))
    rows = raw_competitions_rows(docs, strict)
    upsert_by_key_partitions(lake.raw_competitions, rows)
    return lake.raw_competitions.read().count()


def load_latest_matches(spark: SparkSession, landing: str, lake: Lake, endpoint: str = "matches",
                        loaded_at: str | None = None) -> str:
    """Upsert only the greatest data key (and its manifest, if landed).

    Ignores the ledger and marks nothing, like the one-off "load latest" job.
    """
    prefix = prefix_of(endpoint)
    objects = L.object_classify(L.list_objects(spark, landing, prefix))
    latest = L.latest_object(objects).collect()
    if not latest:
        raise RuntimeError(f"No {endpoint} files found with prefix: {prefix}")
    key = latest[0]["latest_key"]
    loaded_at = loaded_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    ts = F.lit(loaded_at).cast("timestamp")
    pick = objects.where(F.col("file_key") == key)
    upsert_by_key_partitions(lake.raw_matches, raw_matches_rows(L.read_documents(spark, pick), ts))
    man = objects.where((F.col("kind") == "manifest") & (F.col("file_key") == X.manifest_key_for(F.lit(key))))
    upsert_by_key_partitions(lake.raw_manifests, raw_manifest_rows(L.read_documents(spark, man), endpoint, fill=False))
    log_load(lake, L.key_parse(pick.select("file_key")), uuid.uuid4().hex, ts)
    return key
