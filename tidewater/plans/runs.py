"""Daily and backfill runs: load -> silver merges -> gold refresh -> tests -> metrics.

Everything derived from bronze is versioned: a refresh writes the groups it
touches beside the ones in use and switches all tables at its end (see
``sources.versions``).  So a run stopped anywhere has changed nothing that
readers, or its own retry, can see: the retry starts from the version before and
takes up every load that is not published yet.

``matches_latest`` is partitioned by competition and season, which a batch is
local in, so a merge rewrites only those.  ``match_places`` finds the groups that
hold a batch's matches now.  The merge compares the snapshot order, so a late
or replayed batch can never overwrite a newer row: the batch path and the stream
path agree, and merging a load twice changes nothing.

A merge that gold does not follow at once (a stream's compaction) notes the
groups and teams it touched, before and after, in the journal
(``touched_groups``, ``touched_teams``), in the same version.  The next refresh
recomputes gold for the whole journal, besides what its own merge touched.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.keyed import latest_by_key
from tidewater.operators.quality import PROJECT_TESTS, report_of, run_tests, suite_state
from tidewater.operators.upsert import merge_upsert
from tidewater.plans import gold, silver
from tidewater.plans.lake import Lake
from tidewater.plans.loader import LOOK_BACK_DAYS, load_matches
from tidewater.plans.suite import full_state, gold_parts, gold_state, latest_parts, latest_state, update_state
from tidewater.session import configure
from tidewater.sources.tables import values_filter
from tidewater.sources.versions import Draft, VersionedTable


def upsert_keyed(table: VersionedTable, source: DataFrame, key: str) -> None:
    """merge_upsert of ``source`` into a table without partitions (a dimension), written whole beside the old one."""
    # set down first: the merge uses it for its keys and for its rows
    table.overwrite(merge_upsert(table.read(), source.select(*table.columns).checkpoint(eager=True), key))


def matches_latest_order() -> list[Column]:
    """W1 order on matches_latest rows (no array position once merged)."""
    return [F.col("loaded_at").desc_nulls_first(), F.col("last_updated").desc_nulls_first(),
            F.col("file_key").desc_nulls_first()]


def merged_rows(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Per key the first of (target row, batch row) in ``order``; on a full tie the batch row.

    NULL keys never match: rows without a key are all kept, and a load merged again brings equal ones.
    """
    both = target.withColumn("_from_batch", F.lit(0)).unionByName(batch.withColumn("_from_batch", F.lit(1)))
    best = latest_by_key(both.where(F.col(key).isNotNull()), [key], [*order, F.col("_from_batch").desc()])
    loose = both.where(F.col(key).isNull()).drop("_from_batch").distinct()
    return best.drop("_from_batch").unionByName(loose)


PLACE = ["competition_place", "season_place"]


def _places(lake: Lake, latest: DataFrame) -> DataFrame:
    """match_id and the group of each row."""
    return lake.matches_latest.placed(latest).select(
        "match_id", F.col("_competition").alias("competition_place"), F.col("_season").alias("season_place"))


def _teams_of(latest: DataFrame) -> DataFrame:
    return latest.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).where(F.col("team_id").isNotNull()).distinct()


def _team_places(latest: DataFrame) -> DataFrame:
    both = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return latest.select("competition_code", "season_id", both).where(F.col("team_id").isNotNull()).distinct()


@dataclass
class Touched:
    """What a merge has touched, before and after: groups, chunks of the place index, and teams."""

    groups: list[tuple]
    chunks: list[tuple]
    teams: DataFrame


def _set_down(lake: Lake, latest: DataFrame) -> DataFrame:
    """A batch in the columns of matches_latest, computed once."""
    return latest.select(*lake.matches_latest.columns).checkpoint(eager=True)


def merge_into(draft: Draft, lake: Lake, batch: DataFrame) -> Touched:
    """Merge one row per match, set down, into matches_latest and its place indexes.

    Reads and rewrites the groups the batch's rows go to and those that hold their matches now; of the
    place index only the chunks of the batch's ids.
    """
    keys = batch.select("match_id").where(F.col("match_id").isNotNull()).distinct()
    going = _places(lake, batch)
    chunks = lake.match_places.touched(going)
    index = draft.read_groups(lake.match_places, chunks).select(*lake.match_places.columns)
    held = index.join(keys, "match_id", "left_semi").select(*PLACE)
    # competitions and seasons of a batch: few
    groups = sorted(tuple(r) for r in held.unionByName(going.select(*PLACE)).distinct().collect())
    target = draft.read_groups(lake.matches_latest, groups).select(*lake.matches_latest.columns)
    teams = _teams_of(target.join(keys, "match_id", "left_semi")).unionByName(_teams_of(batch)).distinct()
    draft.replace(lake.matches_latest, merged_rows(target, batch, "match_id", matches_latest_order()), groups)
    now = draft.read_groups(lake.matches_latest, groups)
    places = _places(lake, now.join(keys, "match_id", "left_semi"))
    draft.together(lambda: draft.replace(lake.team_places, _team_places(now), groups),
                   lambda: draft.replace(lake.match_places, index.join(keys, "match_id", "left_anti").unionByName(places), chunks))
    return Touched(groups, chunks, teams)


def _note(draft: Draft, lake: Lake, touched: Touched) -> None:
    """Add to the journal, and keep the test state of matches_latest with it."""
    noted = lake.spark.createDataFrame(touched.groups, lake.touched_groups.schema)
    draft.together(
        lambda: draft.overwrite(lake.touched_teams, draft.read(lake.touched_teams).unionByName(touched.teams).distinct()),
        lambda: draft.overwrite(lake.touched_groups, draft.read(lake.touched_groups).unionByName(noted).distinct().coalesce(1)),
        lambda: update_state(draft, lake, latest_state(draft, lake, touched.groups, touched.chunks), latest_parts(touched.groups, touched.chunks)))


def merge_latest(lake: Lake, batch_latest: DataFrame) -> None:
    """``merge_into`` as a version of its own; gold follows at the next refresh, which finds the journal."""
    draft = lake.versions.begin()
    _note(draft, lake, merge_into(draft, lake, _set_down(lake, batch_latest)))
    draft.commit()


def _done(draft: Draft, lake: Lake, loads: DataFrame, published: bool) -> None:
    """Note that matches_latest, or gold as well, shows these loads."""
    rows = draft.read(lake.done_loads).unionByName(loads.withColumn("published", F.lit(published)).select(*lake.done_loads.columns))
    keys = [c for c in lake.done_loads.columns if c != "published"]
    draft.overwrite(lake.done_loads, rows.groupBy(*keys).agg(F.max("published").alias("published")).coalesce(1))


def _without(loads: DataFrame, done: DataFrame) -> DataFrame:
    return loads.join(done.select("load_id").distinct(), "load_id", "left_anti")


def unmerged_deltas(lake: Lake) -> DataFrame:
    """Latest rows of streamed batches that no version has merged."""
    deltas = lake.latest_deltas.read()
    return _without(deltas, lake.done_loads.read()).drop("load_id")


def latest_now(lake: Lake) -> DataFrame:
    """matches_latest with the streamed batches that wait for their merge (W1 order; the merge gives the same)."""
    base, deltas = lake.matches_latest.read(), unmerged_deltas(lake)
    both = base.unionByName(deltas)
    best = latest_by_key(both.where(F.col("match_id").isNotNull()), ["match_id"], matches_latest_order())
    return best.unionByName(both.where(F.col("match_id").isNull()).distinct())


def compact_latest(lake: Lake) -> bool:
    """Merge the streamed batches that wait into matches_latest; whether there were any."""
    draft = lake.versions.begin()
    waiting = _without(lake.latest_deltas.read().select("load_id").distinct(), draft.read(lake.done_loads))
    loads = lake.loads.read().distinct().join(waiting, "load_id", "left_semi").checkpoint(eager=True)
    if loads.isEmpty():
        return False
    rows = lake.latest_deltas.read().join(loads.select("load_id").distinct(), "load_id", "left_semi").drop("load_id")
    newest = latest_by_key(rows.where(F.col("match_id").isNotNull()), ["match_id"], matches_latest_order())
    _note(draft, lake, merge_into(draft, lake, _set_down(lake, newest.unionByName(rows.where(F.col("match_id").isNull()).distinct()))))
    _done(draft, lake, loads, published=False)
    draft.commit()
    # merged batches are no longer read; a stop before this line leaves them to the next compaction
    for (load,) in loads.select("load_id").distinct().collect():
        lake.latest_deltas.drop_partition((load,))
    return True


def pending_loads(lake: Lake) -> DataFrame:
    """Loads that gold does not show yet."""
    return _without(lake.loads.read().distinct(), lake.done_loads.read().where("published"))


def refresh_models(spark: SparkSession, lake: Lake, loaded_at: str | None = None) -> dict[str, DataFrame]:
    """Silver merges and gold refresh of every load that is not published yet, as one version.

    Raw rows are pruned by the landing days of the loads that are not merged.  Only what they, and merges before them
    that gold has not followed, can change is recomputed: the groups and teams of the journal.  If any derived table is
    missing, all are built from all raw rows.  ``loaded_at`` merges the rows of that load time alone, whether or
    not it is logged, and publishes the loads of that time alone.
    """
    draft = lake.versions.begin()
    pending = pending_loads(lake).checkpoint(eager=True)
    raw = lake.raw_matches.read()
    if not all(t.name in draft.state.tables for t in lake.derived_tables()):
        _build_all(draft, lake, raw)
    else:
        if loaded_at is not None:
            at = F.lit(loaded_at).cast("timestamp")
            pending = pending.where(F.col("loaded_at") == at)
            fresh = raw.where(F.col("loaded_at") == at)
        else:
            fresh = _raw_of(raw, _without(pending, draft.read(lake.done_loads)).select("loaded_at", "dt").distinct())
        noted = sorted(tuple(r) for r in draft.read(lake.touched_groups).select(*PLACE).collect())
        if loaded_at is None and not noted and pending.isEmpty():
            return models(lake)
        batch = _set_down(lake, silver.matches_latest(silver.flatten_matches(fresh, keep_pos=True)))
        # with the days of loads that a compaction has merged
        days = [tuple(r) for r in fresh.select("dt").unionByName(pending.select("dt")).distinct().collect()]
        touched = Touched([], [], draft.read(lake.touched_teams)) if batch.isEmpty() else merge_into(draft, lake, batch)
        _refresh_gold(draft, lake, raw, days, touched, noted)
    _done(draft, lake, pending, published=True)
    draft.commit()
    return models(lake)


def _raw_of(raw: DataFrame, wanted: DataFrame) -> DataFrame:
    """Raw rows of these loads: landing days prune the scan, load times decide."""
    days = [tuple(r) for r in wanted.select("dt").distinct().collect()]
    there = raw.where(values_filter(["dt"], days)) if days else raw.limit(0)
    on = there["loaded_at"].eqNullSafe(wanted["loaded_at"]) & there["dt"].eqNullSafe(wanted["dt"])
    return there.join(wanted, on, "left_semi")


def _store_latest(draft: Draft, lake: Lake, latest: DataFrame) -> DataFrame:
    """matches_latest and its place indexes, whole."""
    draft.overwrite(lake.matches_latest, latest)
    stored = draft.read(lake.matches_latest)
    draft.overwrite(lake.match_places, _places(lake, stored.where(F.col("match_id").isNotNull())))
    draft.overwrite(lake.team_places, _team_places(stored))
    return stored


def store_latest(lake: Lake, latest: DataFrame) -> None:
    """``latest`` as the whole of matches_latest, in a version of its own."""
    draft = lake.versions.begin()
    _store_latest(draft, lake, latest)
    draft.commit()


def _build_all(draft: Draft, lake: Lake, raw: DataFrame) -> None:
    latest = _store_latest(draft, lake, silver.matches_latest(silver.flatten_matches(raw, keep_pos=True)))
    draft.together(
        lambda: draft.overwrite(lake.teams, silver.teams(latest)),
        lambda: draft.overwrite(lake.team_form_last5, gold.team_form(latest, 5)),
        lambda: draft.overwrite(lake.league_table_snapshot, gold.league_table(latest)))
    for table in (lake.touched_groups, lake.touched_teams, lake.done_loads):
        draft.clear(table)
    draft.overwrite(lake.test_state, full_state(draft, lake, raw).coalesce(1))


def _refresh_gold(draft: Draft, lake: Lake, raw: DataFrame, days: list[tuple], touched: Touched, noted: list[tuple]) -> None:
    """Teams and marts of what a merge has touched and of everything in the journal, and the test state of what changed."""
    groups = sorted({*touched.groups, *noted})
    competitions = sorted({g[:1] for g in groups})
    teams = touched.teams.unionByName(draft.read(lake.touched_teams)).distinct()
    # a team is derived anew from the groups it plays in
    plays = draft.read(lake.team_places).join(teams, "team_id", "left_semi")
    grounds = [tuple(r) for r in plays.select("_competition", "_season").distinct().collect()]
    seen = silver.team_sides(draft.read_groups(lake.matches_latest, grounds)).join(teams, "team_id", "left_semi")
    derived = silver.teams_from_sides(seen).select(*lake.teams.columns).checkpoint(eager=True)  # for its keys and its rows
    # a team's form runs over all seasons of its competition
    of = {lake.team_form_last5.group(c) for c in competitions}
    seasons = {g for g in draft.state.groups(lake.matches_latest.name) if g.split("/")[0] in of}
    draft.together(
        lambda: draft.overwrite(lake.teams, merge_upsert(draft.read(lake.teams).select(*lake.teams.columns), derived, "team_id")),
        lambda: draft.replace(lake.league_table_snapshot, gold.league_table(draft.read_groups(lake.matches_latest, groups)), groups),
        lambda: draft.replace(lake.team_form_last5, gold.team_form(draft.read_named(lake.matches_latest, seasons), 5), competitions))
    changed = latest_state(draft, lake, touched.groups, touched.chunks).unionByName(gold_state(draft, lake, raw, days, groups, competitions))
    update_state(draft, lake, changed, latest_parts(touched.groups, touched.chunks) + gold_parts(days, groups, competitions))
    for table in (lake.touched_groups, lake.touched_teams):
        draft.clear(table)


def models(lake: Lake, view_columns: list[str] | None = None) -> dict[str, DataFrame]:
    """The tested models; ``view_columns`` limits what the v_matches view decodes."""
    raw = lake.raw_matches.read()
    return {
        "v_matches": silver.flatten_matches(raw, columns=view_columns),
        "matches_latest": lake.matches_latest.read(),
        "teams": lake.teams.read(),
        "team_form_last5": lake.team_form_last5.read(),
        "league_table_snapshot": lake.league_table_snapshot.read(),
    }


def run_metrics_row(spark: SparkSession, dag_id: str, run_id: str, execution_date: str | None,
                    loader: dict | None, run_sec: float | None, test_sec: float | None,
                    test_state: str | None) -> DataFrame:
    """The one PIPELINE_RUN_METRICS row of a run (created_at defaults to now)."""
    loader = loader or {}
    row = [(dag_id, run_id, execution_date, loader.get("prefix"), loader.get("files_discovered"),
            loader.get("files_to_load"), loader.get("data_files_loaded"), loader.get("manifests_loaded"),
            None if run_sec is None else float(run_sec), None if test_sec is None else float(test_sec), test_state)]
    df = spark.createDataFrame(row, "dag_id string, run_id string, execution_date string, loader_prefix string, "
                                    "files_discovered bigint, files_to_load bigint, data_files_loaded bigint, "
                                    "manifests_loaded bigint, run_sec double, test_sec double, dbt_test_state string")
    return df.select(
        "dag_id", "run_id", F.col("execution_date").cast("timestamp").alias("execution_date"), "loader_prefix",
        "files_discovered", "files_to_load", "data_files_loaded", "manifests_loaded",
        F.col("run_sec").cast("decimal(38,0)").alias("dbt_run_duration_sec"),
        F.col("test_sec").cast("decimal(38,0)").alias("dbt_test_duration_sec"),
        "dbt_test_state",
        F.localtimestamp().alias("created_at"),
    )


def suite_report(lake: Lake, full: bool = False) -> DataFrame:
    """The data tests' report: from the state kept by part, or (``full``) by scanning every model."""
    if not full and lake.test_state.exists():
        return report_of(lake.test_state.read(), PROJECT_TESTS)
    return run_tests(models(lake, [t.column for t in PROJECT_TESTS if t.model == "v_matches"]), PROJECT_TESTS)


UPSTREAM_FAILED = "upstream_failed"


class SuiteFailed(RuntimeError):
    """The data tests of a backfill run found faults."""


def run_daily(spark: SparkSession, landing: str, lake: Lake, endpoint: str = "matches",
              loaded_at: str | None = None, dag_id: str = "daily_pipeline", run_id: str | None = None,
              execution_date: str | None = None, on_empty: str = "zeros", strict: bool = True,
              look_back: int | None = LOOK_BACK_DAYS, full_tests: bool = False) -> dict:
    """scan -> pending -> bronze upsert -> silver merges -> gold -> tests -> metrics row.

    The metrics row is appended in ``finally``, like an always-run task; the
    test state is ``upstream_failed`` where the tests were never reached.
    ``strict=False`` sets malformed documents aside instead of stopping the run.
    ``look_back``: landing days listed before the last one seen (None: all).
    The tests are read off the state kept by part, unless ``full_tests`` scans every model.
    """
    configure(spark)
    run_id = run_id or uuid.uuid4().hex
    # one load time for the whole batch, fixed before anything is written
    loaded_at = loaded_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    loader = run_sec = test_sec = None
    test_state = UPSTREAM_FAILED
    try:
        loader = load_matches(spark, landing, lake, endpoint, loaded_at=loaded_at, on_empty=on_empty, strict=strict,
                              look_back=look_back)
        t = time.time()
        refresh_models(spark, lake)
        run_sec = time.time() - t
        t = time.time()
        test_state = "failed"  # unless the suite says otherwise
        test_state = suite_state(suite_report(lake, full_tests))
        test_sec = time.time() - t
    finally:
        lake.pipeline_run_metrics.append(
            run_metrics_row(spark, dag_id, run_id, execution_date, loader, run_sec, test_sec, test_state))
    lake.versions.expire(lake.derived_tables())
    return {"loader": loader, "run_sec": run_sec, "test_sec": test_sec, "test_state": test_state, "run_id": run_id}


def run_backfill(spark: SparkSession, landing: str, lake: Lake, loaded_at: str | None = None,
                 run_id: str | None = None, strict: bool = True, look_back: int | None = LOOK_BACK_DAYS) -> dict:
    """Backfill endpoint: the same job and metrics row; raises when nothing is landed, and
    when the data tests fail, since they are the run's last task."""
    out = run_daily(spark, landing, lake, "matches_backfill", loaded_at=loaded_at, dag_id="backfill_manual",
                    run_id=run_id, on_empty="error", strict=strict, look_back=look_back)
    if out["test_state"] == "failed":
        raise SuiteFailed(f"data tests failed in run {out['run_id']}")
    return out
