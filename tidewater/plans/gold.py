"""Gold marts: per-team results, last-5 form, ranked league table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.keyed import rank_within, top_n_by_key
from tidewater.operators.unpivot import two_sided_unpivot

# --- fixed values: result coding of the marts ---
HOME_WIN, DRAW, AWAY_WIN = "HOME_TEAM", "DRAW", "AWAY_TEAM"
WIN_POINTS, DRAW_POINTS, LOSS_POINTS = 3, 1, 0
FINISHED = "FINISHED"
# --- end fixed values ---


# v_matches columns the marts read (pass to flatten_matches(columns=...) to decode only these)
GOLD_NEEDS = ["match_id", "last_updated", "utc_date", "status", "season_id", "competition_code_in_payload", "winner",
              "home_team_id", "home_team_name", "away_team_id", "away_team_name", "ft_home_goals", "ft_away_goals"]


def _side(gf: str, ga: str, win: str, loss: str) -> dict:
    winner = F.col("winner")
    return {
        "team_id": F.col(f"{gf}_team_id"),
        "team_name": F.col(f"{gf}_team_name"),
        "gf": F.col(f"ft_{gf}_goals"),
        "ga": F.col(f"ft_{ga}_goals"),
        # letter: unknown or NULL winner -> NULL
        "result": F.when(winner == win, "W").when(winner == DRAW, "D").when(winner == loss, "L"),
        # points: unknown winner -> 0 and no w/d/l
        "pts": F.when(winner == win, WIN_POINTS).when(winner == DRAW, DRAW_POINTS).otherwise(LOSS_POINTS),
        "w": F.when(winner == win, 1).otherwise(0),
        "d": F.when(winner == DRAW, 1).otherwise(0),
        "l": F.when(winner == loss, 1).otherwise(0),
    }


def team_results_long(latest: DataFrame) -> DataFrame:
    """One row per (finished match, side with a known team)."""
    finished = latest.where(F.col("status") == FINISHED).select(
        "match_id", "competition_code", "season_id", "utc_date", "winner",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "ft_home_goals", "ft_away_goals",
    )
    long = two_sided_unpivot(
        finished, ["match_id", "competition_code", "season_id", "utc_date"],
        {"home": _side("home", "away", HOME_WIN, AWAY_WIN), "away": _side("away", "home", AWAY_WIN, HOME_WIN)},
    )
    return long.where(F.col("team_id").isNotNull())


# Most recent first (an undated match counts as most recent); tie-break: later match.
def form_order() -> list:
    return [F.col("utc_date").desc_nulls_first(), F.col("match_id").desc_nulls_first()]


def team_form(latest: DataFrame, n: int = 5) -> DataFrame:
    """Last-n finished results per (competition, team), across seasons."""
    last = top_n_by_key(team_results_long(latest), ["competition_code", "team_id"], form_order(), n)
    res = F.col("result")
    suffix = f"_last{n}"
    return last.groupBy("competition_code", "team_id").agg(
        F.max("team_name").alias("team_name"),
        F.count(F.lit(1)).alias(f"games_played{suffix}"),
        F.sum(F.when(res == "W", 1).otherwise(0)).alias(f"wins{suffix}"),
        F.sum(F.when(res == "D", 1).otherwise(0)).alias(f"draws{suffix}"),
        F.sum(F.when(res == "L", 1).otherwise(0)).alias(f"losses{suffix}"),
        F.sum("gf").alias(f"goals_for{suffix}"),
        F.sum("ga").alias(f"goals_against{suffix}"),
        (F.sum("gf") - F.sum("ga")).alias(f"goal_diff{suffix}"),
        F.sum(F.when(res == "W", WIN_POINTS).when(res == "D", DRAW_POINTS).otherwise(0)).alias(f"points{suffix}"),
        F.max("utc_date").alias("last_match_utc"),
    )


# Points, goal difference, goals for (NULL first), then name; team_id makes it total.
def table_order() -> list:
    return [
        F.col("points").desc_nulls_first(),
        F.col("goal_diff").desc_nulls_first(),
        F.col("goals_for").desc_nulls_first(),
        F.col("team_name").asc_nulls_last(),
        F.col("team_id").asc_nulls_last(),
    ]


def league_table(latest: DataFrame) -> DataFrame:
    """Season-to-date standings per (competition, season) with a unique rank.

    Two aggregation levels keep the large input on hash aggregation: first per
    (group, team, name) with numeric buffers only, then per (group, team) over
    the few names of each team, where ``max(team_name)`` (a string buffer, so
    sort-based) sees one row per name instead of one per match side.
    """
    keys = ["competition_code", "season_id", "team_id"]
    per_name = team_results_long(latest).groupBy(*keys, "team_name").agg(
        F.count(F.lit(1)).alias("played"),
        F.sum("w").alias("wins"),
        F.sum("d").alias("draws"),
        F.sum("l").alias("losses"),
        F.sum("gf").alias("goals_for"),
        F.sum("ga").alias("goals_against"),
        F.sum("pts").alias("points"),
        F.max("utc_date").alias("as_of_utc"),
    )
    agg = per_name.groupBy(*keys).agg(
        F.max("team_name").alias("team_name"),
        F.sum("played").alias("played"),
        F.sum("wins").alias("wins"),
        F.sum("draws").alias("draws"),
        F.sum("losses").alias("losses"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        (F.sum("goals_for") - F.sum("goals_against")).alias("goal_diff"),
        F.sum("points").alias("points"),
        F.max("as_of_utc").alias("as_of_utc"),
    )
    return rank_within(agg, ["competition_code", "season_id"], table_order(), "rank")
