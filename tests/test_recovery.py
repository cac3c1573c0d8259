"""Jobs stopped at every write in turn: readers stay where they were, the retry equals a full recompute."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import assert_equal_to_full_recompute, data_key, match, put
from tidewater.plans.lake import Lake
from tidewater.plans.loader import load_matches
from tidewater.plans.runs import compact_latest, latest_now, refresh_models, run_daily
from tidewater.sources import fs, versions
from tidewater.streaming import ingest
from tidewater.streaming.ingest import stream_bronze_ingest


class Stopped(RuntimeError):
    pass


def stopping(fn, at, done):
    """``fn`` that stops before its call number ``at``, counting in ``done``."""

    def run(*args, **kwargs):
        if len(done) == at:
            raise Stopped(at)
        done.append(1)
        return fn(*args, **kwargs)

    return run


def seen(lake):
    """The files that readers of the derived tables open, with their times."""
    now = lake.versions.current()
    folders = [f"{t.path}/{f}" for t in lake.derived_tables() for f in now.folders(t.name)]
    return now, [fs.stamp(lake.spark, f) for f in folders]


def _days(land):
    """Day 1; day 2 moves match 1 to another season, empties a season, changes a status and has an unknown team."""
    put(land, data_key(run="0a"), {"matches": [
        match(1, season=11), match(2, home=3, away=4, season=12), match(3, home=5, away=6, comp="SA", season=21),
        match(None, home=8, away=9)]})
    yield "2024-01-02 02:00:00"
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [
        match(1, season=12, home_name="Renamed"), match(3, home=5, away=6, comp="SA", season=21, status="ABANDONED", winner=None),
        match(4, home=None, away=2, season=11, utc=None)]})
    yield "2024-01-03 02:00:00"


@pytest.mark.parametrize("first", [False, True])
def test_refresh_stopped_at_every_write(spark, tmp_path, monkeypatch, first):
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _days(land)
    load_matches(spark, land, lake, loaded_at=next(days))
    if not first:
        refresh_models(spark, lake)
        load_matches(spark, land, lake, loaded_at=next(days))
    before, at = seen(lake), 0
    while True:
        done = []
        with monkeypatch.context() as m:
            # every write of the draft, and its commit
            m.setattr(versions.Draft, "_write", stopping(versions.Draft._write, at, done))
            m.setattr(versions.Versions, "put", stopping(versions.Versions.put, at, done))
            try:
                refresh_models(spark, lake)
                break
            except Stopped:
                assert seen(lake) == before, at
        at += 1
    assert at >= 8
    assert_equal_to_full_recompute(lake)
    rows = lake.league_table_snapshot.read().where("team_id = 1").collect()
    assert [r.season_id for r in rows] == ([11] if first else [12])
    # what the stopped attempts wrote goes, what is read stays
    assert lake.versions.expire(lake.derived_tables(), keep=1) > 0
    assert_equal_to_full_recompute(lake)


def test_one_load_is_published_alone(spark, tmp_path):
    """Two loads wait; refreshing the second leaves the first to the next run."""
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    run_daily(spark, land, lake)
    days = _days(land)
    for _ in range(2):
        at = next(days)
        load_matches(spark, land, lake, loaded_at=at)
    refresh_models(spark, lake, at)
    assert {r.match_id for r in lake.matches_latest.read().collect()} == {1, 3, 4}
    refresh_models(spark, lake)
    assert_equal_to_full_recompute(lake)


def test_two_drafts_on_one_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.createDataFrame([(1,)], lake.touched_teams.schema)
    one, other = lake.versions.begin(), lake.versions.begin()
    for draft in (one, other):
        draft.overwrite(lake.touched_teams, rows)
    one.commit()
    with pytest.raises(versions.Conflict):
        other.commit()
    assert lake.touched_teams.read().count() == 1


def test_stream_epoch_stopped_after_each_step(spark, tmp_path, monkeypatch):
    """Every retry of the epoch has the load time and id of the first attempt: nothing is lost, nothing comes twice."""
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _days(land)
    next(days)
    run_daily(spark, land, lake)
    next(days)

    def stopped_after(fn):
        def run(*args, **kwargs):
            fn(*args, **kwargs)
            raise Stopped(fn.__name__)

        return run

    checkpoint = str(tmp_path / "checkpoint")
    for step in ("append_new", "raw_manifest_rows", "log_load", "mark"):
        with monkeypatch.context() as m:
            m.setattr(ingest, step, stopped_after(getattr(ingest, step)))
            with pytest.raises(StreamingQueryException):
                stream_bronze_ingest(spark, land, lake, checkpoint, latest=True)
    stream_bronze_ingest(spark, land, lake, checkpoint, latest=True)
    assert lake.raw_matches.read().count() == 2 and lake.raw_matches.read().select("file_key").distinct().count() == 2
    loads = lake.loads.read().distinct()
    assert loads.count() == 2 and loads.join(lake.raw_matches.read(), ["loaded_at", "dt"], "left_anti").count() == 0
    latest = {(r.match_id, r.season_id) for r in latest_now(lake).collect()}
    assert latest == {(1, 12), (2, 12), (3, 21), (4, 11), (None, 11)}
    run_daily(spark, land, lake)
    assert_equal_to_full_recompute(lake)


def test_compaction_keeps_what_gold_has_to_follow(spark, tmp_path, monkeypatch):
    """A compaction merges the deltas; gold, refreshed later, follows the moved match out of its old season."""
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _days(land)
    next(days)
    run_daily(spark, land, lake)
    next(days)
    stream_bronze_ingest(spark, land, lake, str(tmp_path / "checkpoint"), latest=True, max_files_per_trigger=1)
    want = sorted(map(str, latest_now(lake).collect()))
    base = sorted(map(str, lake.matches_latest.read().collect()))
    assert want != base
    with monkeypatch.context() as m:
        m.setattr(versions.Versions, "put", stopping(versions.Versions.put, 0, []))
        with pytest.raises(Stopped):
            compact_latest(lake)
    assert sorted(map(str, latest_now(lake).collect())) == want
    assert compact_latest(lake) and not compact_latest(lake)
    assert sorted(map(str, lake.matches_latest.read().collect())) == want == sorted(map(str, latest_now(lake).collect()))
    assert lake.touched_groups.read().count() == 3 and lake.latest_deltas.read().count() == 0
    table = lake.league_table_snapshot.read()
    assert {r.season_id for r in table.where("team_id = 1").collect()} == {11}  # as before
    refresh_models(spark, lake)
    assert_equal_to_full_recompute(lake)
    assert lake.touched_groups.read().count() == 0


def test_stream_compacts_by_size(spark, tmp_path):
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    days = _days(land)
    for _ in range(2):
        next(days)
    stream_bronze_ingest(spark, land, lake, str(tmp_path / "checkpoint"), latest=True, max_files_per_trigger=1, compact_bytes=1, compact_part=0.0)
    assert lake.latest_deltas.read().count() == 0 and lake.matches_latest.read().count() == 5
    run_daily(spark, land, lake)
    assert_equal_to_full_recompute(lake)


def test_place_index_finds_matches_without_reading_them(spark, tmp_path):
    """A batch opens the chunks of its ids and the groups it touches, nothing else."""
    land, lake = str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))
    far = 5 << 18
    put(land, data_key(run="0a"), {"matches": [match(1, season=11), match(far, home=3, away=4, comp="SA", season=21)]})
    run_daily(spark, land, lake)
    names = {t.name: lake.versions.current().groups(t.name) for t in lake.derived_tables()}
    assert len(names["silver/match_places"]) == 2
    put(land, data_key(day="2024-01-03", run="0b"), {"matches": [match(1, season=12)]})
    run_daily(spark, land, lake)
    after = {t.name: lake.versions.current().groups(t.name) for t in lake.derived_tables()}
    kept = lambda name: {g for g, run in names[name].items() if after[name].get(g) == run}
    assert kept("silver/match_places") == {"_chunk=v5"}
    assert kept("silver/matches_latest") == kept("gold/league_table_snapshot") == {"_competition=vSA/_season=v21"}
    places = lake.match_places.read_partitions([("v0",)])
    assert len(places.inputFiles()) == 1 and [r.season_place for r in places.collect()] == ["v12"]
    assert lake.raw_matches.read().where(F.col("dt").isNull()).count() == 0
