"""Daily run end to end: idempotence, invariants, metrics row, incremental = full recompute."""

import uuid

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, assert_equal_to_full_recompute
from tidewater.plans.fixture_lake import fixture_lake, load_time
from tidewater.plans.lake import Lake
from tidewater.plans.runs import models, refresh_models, run_daily
from tidewater.plans.registry import queries
from tidewater.session import scratch_dir
from tidewater.sources import fs


def _files(lake, group):
    """Files that a reader of this group of matches_latest opens."""
    return {f for d in lake.versions.current().folders(lake.matches_latest.name, {lake.matches_latest.group(group)})
            for f in fs.data_files(lake.spark, f"{lake.matches_latest.path}/{d}")}


def _fresh_lake(spark):
    return Lake(spark, scratch_dir(spark, "test", uuid.uuid4().hex[:10]))


def test_daily_run_idempotent_and_equal_to_batch_model(spark):
    fx = fixture_lake(spark, SF_SMALL)
    lake = _fresh_lake(spark)
    r1 = run_daily(spark, fx.landing, lake, loaded_at=load_time(2), run_id="r1")
    assert r1["loader"]["files_to_load"] == r1["loader"]["files_discovered"] > 0
    assert r1["test_state"] == "failed"          # the fixture plants faults
    m1 = models(lake)
    latest1 = sorted(m1["matches_latest"].drop("loaded_at").collect())
    r2 = run_daily(spark, fx.landing, lake, loaded_at=load_time(3), run_id="r2")
    assert r2["loader"]["files_to_load"] == 0
    latest2 = sorted(models(lake)["matches_latest"].drop("loaded_at").collect())
    assert latest1 == latest2
    # one load of all days picks the same snapshot as three daily loads
    batch = queries()["matches_latest"](spark, SF_SMALL).drop("loaded_at")
    ours = models(lake)["matches_latest"].drop("loaded_at")
    assert ours.select(sorted(ours.columns)).exceptAll(
        batch.select([F.col(c).cast(ours.schema[c].dataType) for c in sorted(ours.columns)])).count() == 0
    runs = lake.pipeline_run_metrics.read().orderBy("run_id").collect()
    assert [r.run_id for r in runs] == ["r1", "r2"]
    assert runs[1].files_to_load == 0 and runs[0].dbt_test_state == "failed"


def test_incremental_days_equal_full_recompute(spark):
    """Three daily runs (merge with order comparison) equal the model recomputed from all raw rows."""
    fx = fixture_lake(spark, SF_SMALL)
    full = queries()["league_table_snapshot"](spark, SF_SMALL)
    gold = fx.lake  # raw tables of the fixture were loaded day by day

    lake = Lake(spark, scratch_dir(spark, "test", uuid.uuid4().hex[:10]))
    # reuse the fixture's raw layer, refresh day by day
    for day in range(3):
        raw_day = gold.raw_matches.read().where(F.col("loaded_at") == F.lit(load_time(day)).cast("timestamp"))
        lake.raw_matches.append(raw_day)
        refresh_models(spark, lake, load_time(day))
    ours = models(lake)["league_table_snapshot"]
    cols = sorted(full.columns)
    a = ours.select([F.col(c).cast(full.schema[c].dataType) for c in cols])
    b = full.select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_league_and_form_invariants(spark):
    q = queries()
    table = q["league_table_snapshot"](spark, SF_SMALL)
    long = q["team_results_long"](spark, SF_SMALL)
    per_season = table.groupBy("competition_code", "season_id").agg(
        F.sum("points").alias("pts"), F.sum("goals_for").alias("gf"), F.sum("goals_against").alias("ga"),
        F.count(F.lit(1)).alias("n"), F.max("rank").alias("max_rank"), F.min("rank").alias("min_rank"),
        F.count_distinct("rank").alias("nd"))
    for r in per_season.collect():
        assert r.min_rank == 1 and r.max_rank == r.n == r.nd
    # points from both sides of every match with two known teams: 3 per decided match, 2 per draw
    both = long.groupBy("match_id").agg(F.count(F.lit(1)).alias("sides"), F.sum("pts").alias("pts"),
                                        F.max("result").alias("res"))
    assert both.where("sides = 2 and res in ('W', 'L') and pts != 3").count() == 0
    assert both.where("sides = 2 and res = 'D' and pts != 2").count() == 0
    form = q["team_form_last5"](spark, SF_SMALL)
    assert form.where("games_played_last5 > 5").count() == 0
    assert form.where("wins_last5 + draws_last5 + losses_last5 > games_played_last5").count() == 0
    assert table.where("wins + draws + losses > played").count() == 0


def test_incremental_gold_drops_emptied_groups_and_keeps_others(spark, tmp_path):
    from helpers import data_key, match, put

    land = str(tmp_path / "landing")
    lake = Lake(spark, str(tmp_path / "lake"))
    put(land, data_key(run="0a"), {"matches": [
        match(1, home=1, away=2, season=11), match(2, home=3, away=4, season=12),
        match(3, home=5, away=6, season=21, comp="SA")]})
    run_daily(spark, land, lake, loaded_at="2024-01-02 02:00:00", run_id="a")
    before = {(r.competition_code, r.season_id, r.team_id) for r in lake.league_table_snapshot.read().collect()}
    assert ("PL", 12, 3) in before and ("SA", 21, 5) in before
    # day 2: the only finished match of PL season 12 is re-published as postponed
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [match(2, home=3, away=4, season=12,
                                                                        status="POSTPONED", winner=None)]})
    run_daily(spark, land, lake, loaded_at="2024-01-03 02:00:00", run_id="b")
    after = {(r.competition_code, r.season_id, r.team_id) for r in lake.league_table_snapshot.read().collect()}
    assert after == before - {("PL", 12, 3), ("PL", 12, 4)}
    # the incremental result equals a full rebuild from the merged latest table
    full = gold_league_from(lake)
    got = lake.league_table_snapshot.read()
    assert got.exceptAll(full.select(got.columns)).count() == 0 and full.select(got.columns).exceptAll(got).count() == 0
    form = {(r.competition_code, r.team_id) for r in lake.team_form_last5.read().collect()}
    assert ("PL", 3) not in form and ("SA", 5) in form


def gold_league_from(lake):
    from tidewater.plans import gold

    return gold.league_table(lake.matches_latest.read())


def test_interrupted_first_run_rebuilds_missing_marts(spark, tmp_path):
    """If a first run stopped after writing some gold tables, the next run rebuilds
    the missing ones in full instead of writing only the touched groups."""
    from helpers import data_key, match, put

    land = str(tmp_path / "landing")
    lake = Lake(spark, str(tmp_path / "lake"))
    put(land, data_key(run="0a"), {"matches": [match(1, home=1, away=2), match(2, home=3, away=4, comp="SA")]})
    run_daily(spark, land, lake, loaded_at="2024-01-02 02:00:00", run_id="a")
    # simulate a lost form table: a fresh lake that shares everything but the form mart
    lake2 = Lake(spark, str(tmp_path / "lake2"))
    for name in ("raw_matches", "raw_manifests", "load_state", "loads", "matches_latest", "teams", "league_table_snapshot"):
        getattr(lake2, name).overwrite(getattr(lake, name).read())
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [match(1, home=1, away=2, hg=0, ag=2,
                                                                        winner="AWAY_TEAM")]})
    run_daily(spark, land, lake2, loaded_at="2024-01-03 02:00:00", run_id="b")
    comps = {r.competition_code for r in lake2.team_form_last5.read().collect()}
    assert comps == {"PL", "SA"}


def _two_days(land):
    from helpers import data_key, match, put

    put(land, data_key(run="0a"), {"matches": [match(1, home=1, away=2), match(2, home=3, away=4, season=12)]})
    yield "2024-01-02 02:00:00"
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [
        match(1, home=1, away=2, status="POSTPONED", winner=None), match(5, home=7, away=8, comp="SA")]})
    yield "2024-01-03 02:00:00"


@pytest.mark.parametrize("first", [True, False])
def test_stopped_run_is_caught_up(spark, tmp_path, monkeypatch, first):
    """A run stopped in its refresh says so in its metrics row; the next run heals it."""
    from tidewater.plans import runs

    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _two_days(land)
    if not first:
        run_daily(spark, land, lake, loaded_at=next(days))
    at = next(days)

    def broken(*args, **kwargs):
        raise InterruptedError("stopped")

    with monkeypatch.context() as m:
        m.setattr(runs.gold, "league_table", broken)
        with pytest.raises(InterruptedError):
            run_daily(spark, land, lake, loaded_at=at, run_id="stopped")
    out = run_daily(spark, land, lake, run_id="retried")
    assert out["loader"]["files_to_load"] == 0
    assert_equal_to_full_recompute(lake)
    states = {r.run_id: r.dbt_test_state for r in lake.pipeline_run_metrics.read().collect()}
    assert states["stopped"] == "upstream_failed" and states["retried"] == "success"


def test_loads_of_other_jobs_are_published(spark, tmp_path):
    from helpers import data_key, match, put
    from tidewater.plans.loader import load_latest_matches, load_matches
    from tidewater.streaming.ingest import stream_bronze_ingest

    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _two_days(land)
    run_daily(spark, land, lake, loaded_at=next(days))
    next(days)
    stream_bronze_ingest(spark, land, lake, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    run_daily(spark, land, lake)
    assert_equal_to_full_recompute(lake)
    put(land, data_key(day="2024-01-04", run="0c"), {"matches": [match(9, home=1, away=9)]})
    load_matches(spark, land, lake)
    put(land, data_key(day="2024-01-05", run="0d"), {"matches": [match(9, home=1, away=9, status="POSTPONED", winner=None)]})
    load_latest_matches(spark, land, lake)
    run_daily(spark, land, lake)
    assert_equal_to_full_recompute(lake)
    assert lake.matches_latest.read().where("match_id = 9").count() == 1


def test_match_moving_group_leaves_one_row(spark, tmp_path):
    from helpers import data_key, match, put

    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    put(land, data_key(run="0a"), {"matches": [match(1, season=11), match(2, home=3, away=4, comp="SA", season=21)]})
    run_daily(spark, land, lake, loaded_at="2024-01-02 02:00:00")
    sa = _files(lake, ("vSA", "v21"))
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [match(1, comp="CL", season=31)]})
    run_daily(spark, land, lake, loaded_at="2024-01-03 02:00:00")
    rows = lake.matches_latest.read().where("match_id = 1").collect()
    assert [(r.competition_code, r.season_id) for r in rows] == [("CL", 31)]
    # the other competition's files were not touched
    assert sa and sa == _files(lake, ("vSA", "v21"))
    assert_equal_to_full_recompute(lake)


def test_first_run_on_an_empty_landing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    out = run_daily(spark, str(tmp_path / "landing"), lake, run_id="empty")
    assert out["loader"]["files_discovered"] == 0 and out["test_state"] == "success"
    assert lake.league_table_snapshot.read().count() == 0 and lake.teams.read().count() == 0
