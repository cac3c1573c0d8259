"""State of the data tests by part of a model, brought up to date with the tables themselves.

Parts: landing days of v_matches, groups of matches_latest and the league table, competitions of the form
mart, the whole of teams; the uniqueness of match ids is kept by chunk of the place index, which has a row for
each stored row.  A refresh retracts the parts it has rewritten and adds what they hold now, so
documents that were replaced, and groups that came out empty, leave nothing behind, and no other part is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.quality import PROJECT_TESTS, state_rows, unique_state
from tidewater.plans import silver
from tidewater.plans.lake import Lake
from tidewater.sources.tables import values_filter
from tidewater.sources.versions import Draft

GROUP = ("_competition", "_season")


def _tests(model: str) -> list:
    return [t for t in PROJECT_TESTS if t.model == model]


def _part(*columns: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("n")) for c in columns])


def _name(values: tuple) -> str:
    return "/".join("n" if v is None else str(v) for v in values)


def _ids(chunk: str) -> str:
    return f"ids/{chunk}"


def _all(parts: list[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def latest_state(draft: Draft, lake: Lake, groups: list[tuple], chunks: list[tuple]) -> DataFrame:
    """matches_latest: these groups' rows, and these chunks' ids."""
    return _latest_state(draft.read_groups(lake.matches_latest, groups), draft.read_groups(lake.match_places, chunks))


def latest_parts(groups: list[tuple], chunks: list[tuple]) -> list[tuple[str, str]]:
    return [("matches_latest", _name(g)) for g in groups] + [("matches_latest", _ids(c)) for (c,) in chunks]


def _latest_state(latest: DataFrame, places: DataFrame) -> DataFrame:
    ids = unique_state(places, "matches_latest", F.concat(F.lit("ids/"), F.col("_chunk")), "match_id")
    return _all([state_rows(latest, "matches_latest", _part(*GROUP), _tests("matches_latest")), ids])


def gold_state(draft: Draft, lake: Lake, raw: DataFrame, days: list[tuple], groups: list[tuple], competitions: list[tuple]) -> DataFrame:
    """Everything else: v_matches of these landing days, teams, and the marts of these groups and competitions."""
    there = raw.where(values_filter(["dt"], days)) if days else raw.limit(0)
    return _gold_state(there, draft.read(lake.teams), draft.read_groups(lake.team_form_last5, competitions), draft.read_groups(lake.league_table_snapshot, groups))


def gold_parts(days: list[tuple], groups: list[tuple], competitions: list[tuple]) -> list[tuple[str, str]]:
    return ([("v_matches", _name(d)) for d in days] + [("teams", "all")] + [("team_form_last5", _name(c)) for c in competitions]
            + [("league_table_snapshot", _name(g)) for g in groups])


def _gold_state(raw: DataFrame, teams: DataFrame, form: DataFrame, table: DataFrame) -> DataFrame:
    view = silver.flatten_matches(raw, columns=[t.column for t in _tests("v_matches")])
    parts = [state_rows(view, "v_matches", _part("dt"), _tests("v_matches")),
             state_rows(teams, "teams", F.lit("all"), _tests("teams")),
             state_rows(form, "team_form_last5", _part("_competition"), _tests("team_form_last5")),
             state_rows(table, "league_table_snapshot", _part(*GROUP), _tests("league_table_snapshot"))]
    parts += [unique_state(teams, "teams", F.lit("all"), t.column) for t in _tests("teams") if t.kind == "unique"]
    return _all(parts)


def full_state(draft: Draft, lake: Lake, raw: DataFrame) -> DataFrame:
    """The state of every part."""
    latest = _latest_state(draft.read(lake.matches_latest), draft.read(lake.match_places))
    rest = _gold_state(raw, draft.read(lake.teams), draft.read(lake.team_form_last5), draft.read(lake.league_table_snapshot))
    return latest.unionByName(rest).select(*lake.test_state.columns)


def update_state(draft: Draft, lake: Lake, rows: DataFrame, parts: list[tuple[str, str]]) -> None:
    """Replace the state of these (model, part) by ``rows``."""
    old = draft.read(lake.test_state)
    if parts:
        old = old.join(lake.spark.createDataFrame(parts, "model string, part string"), ["model", "part"], "left_anti")
    draft.overwrite(lake.test_state, old.unionByName(rows.select(*lake.test_state.columns)).coalesce(1))
