"""Stored tables: codes and schemas round-trip, markers are not asked for, keys survive odd characters."""

import pytest

from helpers import data_key, match, put
from tidewater.plans.lake import Lake
from tidewater.plans.loader import load_matches
from tidewater.plans.manifests import manifest_reconcile
from tidewater.sources import fs


def test_codes_and_seasons_round_trip(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    rows = [(code, season, k) for k, code in enumerate(["01", "02", "", None, "a/b=c d%"]) for season in (7, None)]
    df = spark.createDataFrame(rows, "competition_code string, season_id bigint, team_id bigint")
    table = lake.league_table_snapshot
    missing = [f for f in table.schema.fields if f.name not in df.columns]
    table.overwrite(df.selectExpr("*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in missing]))
    got = table.read()
    assert got.schema.simpleString() == table.schema.simpleString()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select("competition_code", "season_id", "team_id").collect()), key=key) == sorted(rows, key=key)


def test_tables_are_found_without_success_markers(spark, tmp_root):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        put(f"{tmp_root}/landing", data_key(), {"matches": [match(1)]})
        lake = Lake(spark, f"{tmp_root}/lake")
        load_matches(spark, f"{tmp_root}/landing", lake)
        put(f"{tmp_root}/landing", data_key(day="2024-01-03"), {"matches": [match(2)]})
        assert load_matches(spark, f"{tmp_root}/landing", lake)["files_to_load"] == 1
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_keys_with_odd_characters_join_everywhere(spark, tmp_root):
    land, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")
    keys = [data_key(comp=c, run=f"0{k}") for k, c in enumerate(["A B", "50%", "C+D", "E%20F"])]
    for k in keys:
        put(land, k, {"matches": [match(1)]})
        put(land, k.replace(".json", ".manifest.json"), {"record_count": 1})
    m = load_matches(spark, land, lake)
    assert m["files_to_load"] == m["manifests_loaded"] == 4
    raw = {r.file_key for r in lake.raw_matches.read().collect()}
    ledger = {r.file_key for r in lake.load_state.read().collect()}
    assert raw == set(keys) == {k for k in ledger if ".manifest." not in k}
    assert manifest_reconcile(lake.raw_matches.read(), lake.raw_manifests.read()).count() == 0
    assert load_matches(spark, land, lake)["files_to_load"] == 0


def test_replayed_manifest_with_another_day_replaces_the_row(spark, tmp_root):
    from tidewater.plans.loader import raw_manifest_rows, upsert_by_key_partitions

    lake = Lake(spark, tmp_root)
    key = data_key().replace(".json", ".manifest.json")
    for day in ("2024-01-02", "2024-02-09"):
        docs = spark.createDataFrame([(key, '{"dt_partition": "%s"}' % day)], "file_key string, text string")
        upsert_by_key_partitions(lake.raw_manifests, raw_manifest_rows(docs, "matches"))
    rows = lake.raw_manifests.read().collect()
    assert [str(r.dt) for r in rows] == ["2024-02-09"]


def test_documents_and_manifests_that_lack_the_other_are_reported(spark, tmp_root):
    land, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")
    for run, doc, manifest in (("0a", True, True), ("0b", True, False)):
        put(land, data_key(run=run), {"matches": [match(1)]})
        if manifest:
            put(land, data_key(run=run).replace(".json", ".manifest.json"), {"record_count": 1})
    load_matches(spark, land, lake)
    other = lake.raw_manifests.read().selectExpr("replace(file_key, '0a', '0c') AS file_key", "endpoint", "run_id", "dt", "manifest")
    both = lake.raw_manifests.read().unionByName(other)
    got = manifest_reconcile(lake.raw_matches.read(), both, unmatched=True).collect()
    assert sorted((r.data_key is None, r.manifest_count is None) for r in got) == [(False, True), (True, False)]


def test_paths_mean_what_they_mean_to_spark(spark, tmp_root):
    assert fs.qualify(spark, tmp_root) == fs.qualify(spark, f"file:{tmp_root}")
    with pytest.raises(Exception, match="s3a|S3A"):
        fs.exists(spark, "s3a://bucket/x")


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from tidewater import session

    conf = SimpleNamespace(get=lambda k, d=None: None)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake)
