"""Structured Streaming pickup: batch = stream, re-run adds nothing."""

import uuid

from pyspark.sql import functions as F

from helpers import SF_SMALL
from tidewater.plans.fixture_lake import fixture_lake
from tidewater.plans.lake import Lake
from tidewater.plans.registry import queries
from tidewater.plans.runs import latest_now
from tidewater.session import scratch_dir
from tidewater.streaming.ingest import stream_bronze_ingest


def test_small_batches_equal_batch_model_and_rerun_is_noop(spark):
    fx = fixture_lake(spark, SF_SMALL)
    root = scratch_dir(spark, "test-stream", uuid.uuid4().hex[:10])
    lake = Lake(spark, f"{root}/lake")
    load_hour = F.concat(F.col("dt"), F.lit(" 02:00:00")).cast("timestamp")
    # two files per micro-batch: many batches, each merged with order comparison
    stream_bronze_ingest(spark, fx.landing, lake, f"{root}/_ckpt", loaded_at=load_hour,
                         max_files_per_trigger=2, latest=True)
    got = latest_now(lake)
    want = queries()["matches_latest"](spark, SF_SMALL)
    cols = sorted(want.columns)
    a = got.select([F.col(c).cast(want.schema[c].dataType) for c in cols])
    b = want.select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    n_raw = lake.raw_matches.read().count()
    # the checkpoint is the ledger: a second drain finds nothing new
    stream_bronze_ingest(spark, fx.landing, lake, f"{root}/_ckpt", loaded_at=load_hour, latest=True)
    assert lake.raw_matches.read().count() == n_raw


def test_stream_loads_manifests_and_marks_ledger(spark):
    from tidewater.plans.loader import load_matches

    fx = fixture_lake(spark, SF_SMALL)
    root = scratch_dir(spark, "test-stream", uuid.uuid4().hex[:10])
    lake = Lake(spark, f"{root}/lake")
    stream_bronze_ingest(spark, fx.landing, lake, f"{root}/_ckpt", max_files_per_trigger=7)
    assert lake.raw_manifests.read().count() == fx.lake.raw_manifests.read().count()
    assert lake.load_state.read().count() == fx.lake.load_state.read().count()
    # the batch loader sees everything as already loaded
    m = load_matches(spark, fx.landing, lake)
    assert m["files_to_load"] == 0 and m["files_discovered"] > 0


def test_nothing_of_a_micro_batch_is_kept_in_executors(spark, tmp_path, monkeypatch):
    """Documents are parsed once, into a folder of the epoch that goes with it; no step's rows wait in memory for the next."""
    fx = fixture_lake(spark, SF_SMALL)
    lake = Lake(spark, str(tmp_path / "lake"))
    kept, table, seen = spark.sparkContext._jsc.sc().getPersistentRDDs, type(lake.raw_matches), {}
    before, append, replace = kept().size(), table.append, table.replace_partitions

    def watched(write):
        def run(self, df):
            texts = [f for f in df.inputFiles() if f.endswith(".json")]
            seen.setdefault(self.path.rsplit("/", 1)[1], []).append((kept().size() - before, len(texts)))
            return write(self, df)
        return run

    monkeypatch.setattr(table, "append", watched(append))
    monkeypatch.setattr(table, "replace_partitions", watched(replace))
    stream_bronze_ingest(spark, fx.landing, lake, str(tmp_path / "ckpt"), max_files_per_trigger=9, latest=True)
    assert {*seen} == {"raw_matches", "raw_manifests", "latest_deltas", "loads", "load_state"}
    assert {s for steps in seen.values() for s in steps} == {(0, 0)}
    assert not [p for p in (tmp_path / "lake" / "bronze" / "staged_documents").rglob("*.parquet")]
    n = fx.lake.raw_matches.read()
    assert lake.raw_matches.read().count() == n.count() == n.select("file_key").distinct().count()
