"""Hand-written edge rows: NULLs, ties, empty arrays, malformed JSON, replays, offsets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import data_key, match, put
from tidewater.plans import gold, silver
from tidewater.plans.lake import Lake
from tidewater.plans.loader import load_matches
from tidewater.plans.manifests import element_count


def _load(spark, root, loaded_at="2024-01-02 02:00:00", **kw):
    lake = Lake(spark, f"{root}/lake")
    m = load_matches(spark, f"{root}/landing", lake, loaded_at=loaded_at, **kw)
    return lake, m


def _latest(lake):
    return silver.matches_latest(silver.flatten_matches(lake.raw_matches.read(), keep_pos=True))


def test_absent_null_empty_matches_give_no_rows(spark, tmp_root):
    land = f"{tmp_root}/landing"
    put(land, data_key(run="01"), {"count": 0})
    put(land, data_key(run="02"), {"matches": None})
    put(land, data_key(run="03"), {"matches": []})
    put(land, data_key(run="04"), {"matches": [match(7)]})
    lake, m = _load(spark, tmp_root)
    assert m["files_discovered"] == 4 and m["manifests_loaded"] == 0
    flat = silver.flatten_matches(lake.raw_matches.read())
    assert [r.match_id for r in flat.collect()] == [7]
    counts = {r.file_key[-7:]: r.n for r in lake.raw_matches.read().select(
        "file_key", element_count(F.col("payload")).alias("n")).collect()}
    assert counts == {"01.json": 0, "02.json": 0, "03.json": 0, "04.json": 1}


def test_malformed_json_strict_raises_tolerant_keeps_null(spark, tmp_root):
    land = f"{tmp_root}/landing"
    put(land, data_key(run="0b"), '{"matches": [')
    with pytest.raises(Exception):
        _load(spark, tmp_root)
    lake, m = _load(spark, tmp_root, strict=False)
    rows = lake.raw_matches.read().collect()
    assert len(rows) == 1 and rows[0].payload is None
    assert m["quarantined"] == 1
    assert [r.file_key for r in lake.quarantine.read().collect()] == [rows[0].file_key]


def test_null_ids_and_missing_objects(spark, tmp_root):
    land = f"{tmp_root}/landing"
    m1 = match(None)
    m2 = match(2, home=None)
    m3 = match(3)
    m3["competition"]["code"] = None
    put(land, data_key(), {"matches": [m1, m2, m3]})
    lake, _ = _load(spark, tmp_root)
    latest = _latest(lake)
    rows = {r.match_id: r for r in latest.collect()}
    assert set(rows) == {None, 2, 3}
    assert rows[2].home_team_id is None and rows[3].competition_code is None
    long = gold.team_results_long(latest).collect()
    assert all(r.team_id is not None for r in long)
    assert sorted(r.team_id for r in silver.teams(latest).collect()) == [1, 2]


def test_latest_ties_and_null_last_updated(spark, tmp_root):
    land = f"{tmp_root}/landing"
    # same match twice in one file: the later array position wins
    put(land, data_key(run="0a"), {"matches": [match(1, status="SCHEDULED"), match(1, status="IN_PLAY")]})
    # same match in two files of one load with equal loaded_at: NULL last_updated wins
    put(land, data_key(run="0b"), {"matches": [match(2, status="SCHEDULED", last_updated="2024-01-05T00:00:00Z")]})
    m_null = match(2, status="FINISHED")
    del m_null["lastUpdated"]
    put(land, data_key(run="0c"), {"matches": [m_null]})
    lake, _ = _load(spark, tmp_root)
    got = {r.match_id: r.status for r in _latest(lake).collect()}
    assert got == {1: "IN_PLAY", 2: "FINISHED"}


def test_late_load_wins_even_if_older_update(spark, tmp_root):
    land = f"{tmp_root}/landing"
    put(land, data_key(run="0a"), {"matches": [match(1, status="FINISHED", last_updated="2024-01-09T00:00:00Z")]})
    lake, _ = _load(spark, tmp_root, loaded_at="2024-01-02 02:00:00")
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [match(1, status="POSTPONED",
                                                                        last_updated="2024-01-01T00:00:00Z")]})
    lake, m = _load(spark, tmp_root, loaded_at="2024-01-03 02:00:00")
    assert m["files_discovered"] == 2 and m["files_to_load"] == 1
    assert [r.status for r in _latest(lake).collect()] == ["POSTPONED"]


def test_points_null_winner_null_goals_and_ranking(spark, tmp_root):
    land = f"{tmp_root}/landing"
    ms = [
        # team 1 and 2: one draw each vs each other -> equal points
        match(1, home=1, away=2, hg=1, ag=1, winner="DRAW", utc="2024-01-01T10:00:00Z"),
        # finished but no winner: played, 0 points, no w/d/l
        match(2, home=3, away=4, hg=None, ag=None, winner=None, utc="2024-01-02T10:00:00Z"),
        # team 5 vs 6 draw with NULL goals -> NULL goal difference for both
        match(3, home=5, away=6, hg=None, ag=None, winner="DRAW", utc="2024-01-03T10:00:00Z"),
        match(4, home=1, away=5, hg=0, ag=0, winner="DRAW", utc="2024-01-04T10:00:00Z"),
    ]
    put(land, data_key(), {"matches": ms})
    lake, _ = _load(spark, tmp_root)
    table = {r.team_id: r for r in gold.league_table(_latest(lake)).collect()}
    assert table[3].played == 1 and table[3].points == 0 and table[3].wins + table[3].draws + table[3].losses == 0
    assert table[6].goal_diff is None and table[6].goals_for is None
    # team 6 (1 pt, NULL diff) outranks team 2 (1 pt, diff 0): NULL sorts first in desc order
    assert table[6].rank < table[2].rank
    ranks = sorted(r.rank for r in table.values())
    assert ranks == list(range(1, len(table) + 1))


def test_form_last5_null_kickoff_counts_as_latest(spark, tmp_root):
    land = f"{tmp_root}/landing"
    ms = [match(i, home=1, away=2, hg=1, ag=0, winner="HOME_TEAM",
                utc=f"2024-01-{i:02d}T10:00:00Z") for i in range(1, 8)]
    ms.append(match(20, home=1, away=3, hg=0, ag=3, winner="AWAY_TEAM", utc=None))
    put(land, data_key(), {"matches": ms})
    lake, _ = _load(spark, tmp_root)
    form = {r.team_id: r for r in gold.team_form(_latest(lake), 5).collect()}
    assert form[1].games_played_last5 == 5
    assert form[1].losses_last5 == 1 and form[1].wins_last5 == 4
    assert form[3].games_played_last5 == 1


def test_team_renamed_and_two_competitions(spark, tmp_root):
    land = f"{tmp_root}/landing"
    ms = [
        match(1, home=1, away=2, utc="2024-01-01T10:00:00Z", home_name="Old Name"),
        match(2, home=1, away=3, utc="2024-01-05T10:00:00Z", home_name="New Name", comp="CL", season=99),
    ]
    put(land, data_key(), {"matches": ms})
    lake, _ = _load(spark, tmp_root)
    latest = _latest(lake)
    t = {r.team_id: r for r in silver.teams(latest).collect()}
    assert t[1].name == "New Name" and t[1].competition_code == "CL"
    # gold keeps the alphabetical max per group, not the latest
    form = {(r.competition_code, r.team_id): r.team_name for r in gold.team_form(latest).collect()}
    assert form[("PL", 1)] == "Old Name" and form[("CL", 1)] == "New Name"


def test_non_utc_offset_is_the_same_instant(spark, tmp_root):
    land = f"{tmp_root}/landing"
    put(land, data_key(), {"matches": [match(1, utc="2024-01-01T12:00:00+05:45")]})
    lake, _ = _load(spark, tmp_root)
    got = _latest(lake).select(F.col("utc_date").cast("timestamp_ntz").alias("u")).collect()[0].u
    assert got == dt.datetime(2024, 1, 1, 6, 15)


def test_numbers_round_like_a_scale0_cast(spark, tmp_root):
    land = f"{tmp_root}/landing"
    m = match(1, hg=2, ag=0)
    m["score"]["fullTime"]["home"] = 1.6
    put(land, data_key(), {"matches": [m]})
    lake, _ = _load(spark, tmp_root)
    assert _latest(lake).collect()[0].ft_home_goals == 2


def test_replay_missing_manifest_odd_keys(spark, tmp_root):
    land = f"{tmp_root}/landing"
    k1 = data_key(run="0a")
    put(land, k1, {"matches": [match(1)]})
    put(land, k1.replace(".json", ".manifest.json"), {"record_count": 1, "endpoint": "", "run_id": None})
    k2 = "endpoint=matches/competition=PL/dt=2024-01-02/no_run.json"        # no run_id in the key
    put(land, k2, {"matches": [match(2)]})
    k3 = "endpoint=matches/competition=PL.json/dt=2024-01-02/run_id=0c.json"  # '.json' twice
    put(land, k3, {"matches": [match(3)]})
    lake, m = _load(spark, tmp_root)
    assert m == {"prefix": "endpoint=matches/", "files_discovered": 3, "files_to_load": 3,
                 "data_files_loaded": 3, "manifests_loaded": 1}
    raw = {r.file_key: r for r in lake.raw_matches.read().collect()}
    assert raw[k2].run_id is None and raw[k3].run_id == "0c" and raw[k3].competition_code == "PL.json"
    man = lake.raw_manifests.read().collect()
    # falsy manifest fields fall back: '' endpoint -> default, NULL run_id -> parsed from the key
    assert man[0].endpoint == "matches" and man[0].run_id == "0a"
    # a re-run finds nothing new; a replay of the same key replaces, never duplicates
    lake, m2 = _load(spark, tmp_root, loaded_at="2024-01-03 02:00:00")
    assert m2["files_to_load"] == 0
    assert lake.raw_matches.read().count() == 3
    ledger = lake.load_state.read()
    assert ledger.count() == 4 and ledger.select("file_key").distinct().count() == 4


def test_empty_landing_incremental_zeros_backfill_error(spark, tmp_root):
    lake, m = _load(spark, tmp_root)
    assert m == {"prefix": "endpoint=matches/", "files_discovered": 0, "files_to_load": 0,
                 "data_files_loaded": 0, "manifests_loaded": 0}
    with pytest.raises(RuntimeError):
        load_matches(spark, f"{tmp_root}/landing", lake, endpoint="matches_backfill", on_empty="error")


def test_status_outside_list_and_null_status(spark, tmp_root):
    from tidewater.operators.quality import DataTest, run_tests, ACCEPTED_STATUSES

    land = f"{tmp_root}/landing"
    put(land, data_key(), {"matches": [match(1, status="ABANDONED"), match(2, status=None),
                                       match(3, status="ABANDONED"), match(4)]})
    lake, _ = _load(spark, tmp_root)
    tests = [DataTest("m", "status", "accepted_values", ACCEPTED_STATUSES), DataTest("m", "status", "not_null"),
             DataTest("m", "match_id", "unique")]
    rep = {(r.column_name, r.test): (r.failures, r.state) for r in run_tests({"m": _latest(lake)}, tests).collect()}
    assert rep[("status", "accepted_values")] == (1, "fail")     # one distinct bad value, NULL passes
    assert rep[("status", "not_null")] == (1, "fail")
    assert rep[("match_id", "unique")] == (0, "pass")


def test_backfill_run_and_load_latest(spark, tmp_root):
    from tidewater.plans.loader import load_latest_matches
    from tidewater.plans.runs import run_backfill

    land = f"{tmp_root}/landing"
    lake = Lake(spark, f"{tmp_root}/lake")
    with pytest.raises(RuntimeError):
        run_backfill(spark, land, lake, loaded_at="2024-01-02 02:00:00")
    put(land, data_key(endpoint="matches_backfill", run="0a"), {"matches": [match(1), match(2, home=3, away=4)]})
    k2 = data_key(endpoint="matches_backfill", day="2024-01-03", run="0a")
    put(land, k2, {"matches": [match(1, status="POSTPONED")]})
    put(land, k2.replace(".json", ".manifest.json"), {"endpoint": "matches_backfill", "record_count": 1})
    out = run_backfill(spark, land, lake, loaded_at="2024-01-04 02:00:00")
    assert out["loader"]["files_to_load"] == 2 and out["loader"]["manifests_loaded"] == 1
    latest = {r.match_id: r.status for r in lake.matches_latest.read().collect()}
    assert latest == {1: "POSTPONED", 2: "FINISHED"}   # equal load time: the later update wins
    # both runs recorded a row: the one that found nothing never reached the tests
    states = {r.dbt_test_state: r.dag_id for r in lake.pipeline_run_metrics.read().collect()}
    assert states == {"upstream_failed": "backfill_manual", "success": "backfill_manual"}
    endpoints = {r.endpoint for r in lake.load_state.read().collect()}
    assert endpoints == {"matches_backfill", "matches_backfill_manifest"}
    # load-latest: only the greatest key, ledger untouched
    put(land, data_key(day="2024-01-05", run="0f"), {"matches": [match(9)]})
    key = load_latest_matches(spark, land, lake, loaded_at="2024-01-05 02:00:00")
    assert key.endswith("run_id=0f.json")
    assert lake.raw_matches.read().where(F.col("file_key") == key).count() == 1
    assert lake.load_state.read().where(F.col("file_key") == key).count() == 0


def test_spark_written_landing_round_trips_through_the_loader(spark, tmp_root):
    """K1 writes `run_id=<id>/part-*.json` (one document per file); the loader reads that layout too."""
    from helpers import SF_SMALL
    from tidewater.plans.manifests import landing_write
    from tidewater.sources.fixture import landing_rows, snapshots

    docs = landing_rows(snapshots(spark.read.parquet(f"{SF_SMALL}/orders.parquet")))
    landing_write(docs, f"{tmp_root}/landing")
    lake, m = _load(spark, tmp_root)
    n_docs = docs.count()
    assert m["files_discovered"] == n_docs == m["files_to_load"] and m["manifests_loaded"] == 0
    raw = lake.raw_matches.read()
    assert raw.where("run_id is null or competition_code is null or dt is null").count() == 0
    n_matches = docs.select(F.sum(F.size("matches"))).collect()[0][0]
    assert silver.flatten_matches(raw).count() == n_matches
