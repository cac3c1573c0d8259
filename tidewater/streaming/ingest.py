"""Ledgered file pickup as Structured Streaming.

The file-stream source lists the landing folder, remembers every file it
has handed out in its checkpoint (the ledger), and gives each new file to
exactly one micro-batch; ``Trigger.AvailableNow`` drains what is landed
and stops, which is the daily run.

``foreachBatch`` is at-least-once.  An epoch's load id and load time are fixed
once, in the *epoch journal* inside the checkpoint, before anything is written;
a retry reads them again, so its rows, its load log entry and its delta are the
same as those of the attempt that was stopped, wherever it was stopped.  Every
sink step is idempotent by key: bronze appends the keys it does not have (it
never rewrites a day), the delta's folder is the load's own.  So is the folder
that the batch's documents are set down in, parsed, while the epoch lasts: nothing
of a micro-batch is kept in executors.

With ``latest`` a micro-batch adds its latest snapshots as a delta, so its cost
follows the batch.  ``runs.latest_now`` reads base and deltas in the order of
W1; when the deltas have grown to a part of the base, ``runs.compact_latest``
merges them.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.plans import silver
from tidewater.plans.lake import Lake
from tidewater.plans.loader import ENDPOINTS, append_new, log_load, mark, raw_manifest_rows, raw_matches_rows
from tidewater.plans.runs import compact_latest
from tidewater.session import configure
from tidewater.sources import fs
from tidewater.sources.landing import object_classify

# bytes of landed documents in a micro-batch
MAX_BYTES_PER_TRIGGER = 8 << 30
# deltas are merged when they hold this part of the base's bytes, and this many
COMPACT_PART, COMPACT_BYTES = 0.25, 256 << 20


def epoch_load(spark: SparkSession, checkpoint: str, epoch: int) -> tuple[str, str]:
    """(load id, load time) of an epoch: fixed by its first attempt, read again by every other."""
    path = f"{checkpoint.rstrip('/')}/load_epochs/{epoch}.json"
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if not fs.exists(spark, path):
        fs.put_if_absent(spark, path, json.dumps({"load_id": uuid.uuid4().hex, "loaded_at": now}))
    found = json.loads(fs.read_text(spark, path))
    return found["load_id"], found["loaded_at"]


def landing_stream(spark: SparkSession, landing: str, endpoint: str = "matches",
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming (file_key, kind, text) of the data and manifest objects of one endpoint."""
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    docs = reader.load(f"{landing.rstrip('/')}/endpoint={endpoint}/")
    keyed = docs.select(X.file_key(F.col("_metadata.file_path")).alias("file_key"), F.col("value").alias("text"))
    return object_classify(keyed)


def stream_bronze_ingest(spark: SparkSession, landing: str, lake: Lake, checkpoint: str,
                         loaded_at: Column | None = None, endpoint: str = "matches",
                         max_files_per_trigger: int | None = None, latest: bool = False,
                         max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
                         compact_part: float = COMPACT_PART, compact_bytes: int = COMPACT_BYTES) -> None:
    """Drain landed files into RAW_MATCHES / RAW_MANIFESTS and mark them in the
    load-state ledger (so the batch loader skips them); with ``latest``, also
    add the latest snapshot of every match in the batch as a delta of matches_latest.

    A manifest may arrive in another micro-batch than its data file: both
    writes are keyed, so order does not matter.  ``loaded_at`` defaults to
    the epoch's time.  A micro-batch is sized by bytes unless a
    number of files is given.  Deltas are merged when their bytes reach ``compact_bytes`` and
    ``compact_part`` of the base's.
    """
    configure(spark)
    data_ep, manifest_ep = ENDPOINTS[endpoint]

    def sink(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        load_id, now = epoch_load(spark, checkpoint, epoch)
        ts = loaded_at if loaded_at is not None else F.lit(now).cast("timestamp")
        # a landed document is parsed once, whatever is made of it; what is set down is a small part of its text
        staged = lake.staged_documents(load_id)
        staged.overwrite(batch.select("file_key", "kind", F.parse_json("text").alias("document")))
        rows = raw_matches_rows(staged.read_where("kind", ["data"]), ts)
        mine = rows
        if append_new(lake.raw_matches, rows):
            # the epoch's own rows, whichever attempt wrote them; not those of keys that another job had loaded
            stored = lake.raw_matches.read_partitions(lake.raw_matches.touched(rows)).select("file_key", "loaded_at")
            mine = rows.join(stored, ["file_key", "loaded_at"], "left_semi")
        append_new(lake.raw_manifests, raw_manifest_rows(staged.read_where("kind", ["manifest"]), endpoint))
        if latest:
            newest = silver.matches_latest(silver.flatten_matches(mine, keep_pos=True))
            lake.latest_deltas.replace_partitions(newest.withColumn("load_id", F.lit(load_id)))
        log_load(lake, mine.select("dt", "loaded_at"), load_id, F.col("loaded_at"))
        keys = staged.read().select("file_key", F.when(F.col("kind") == "data", data_ep).otherwise(manifest_ep).alias("endpoint"))
        mark(lake, keys, [data_ep, manifest_ep])
        fs.delete(spark, staged.path)  # a stop before this line leaves it to the epoch's retry
        if latest:
            waiting = fs.size(spark, lake.latest_deltas.path)
            if waiting >= compact_bytes and waiting >= compact_part * fs.size(spark, lake.matches_latest.path):
                compact_latest(lake)

    q = (landing_stream(spark, landing, endpoint, max_files_per_trigger, max_bytes_per_trigger).writeStream
         .foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
