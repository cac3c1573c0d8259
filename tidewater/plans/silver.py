"""Silver models: flatten raw match documents, latest snapshot per match, teams.

Every function takes and returns a DataFrame, so the plan stays lazy and
Catalyst sees the whole chain (column pruning reaches the parquet scan of
the raw table; the variant decode happens once per array element).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.keyed import latest_by_key
from tidewater.operators.unpivot import two_sided_unpivot

NUM = "decimal(38,6)"  # JSON numbers are decoded exactly, then rounded to whole numbers

# --- fixed values: fields of a match document and columns of the models ---
# v_matches typed columns: output name -> (path inside one ``$.matches`` element, type).
# NUM fields are rounded to whole numbers like a scale-0 NUMBER cast.
MATCH_FIELDS = {
    "match_id": ("id", NUM),
    "utc_date": ("utcDate", "timestamp"),
    "status": ("status", "string"),
    "stage": ("stage", "string"),
    "match_group": ("group", "string"),
    "matchday": ("matchday", NUM),
    "last_updated": ("lastUpdated", "timestamp"),
    "competition_id": ("competition.id", NUM),
    "competition_code_in_payload": ("competition.code", "string"),
    "competition_name": ("competition.name", "string"),
    "competition_type": ("competition.type", "string"),
    "season_id": ("season.id", NUM),
    "season_start_date": ("season.startDate", "date"),
    "season_end_date": ("season.endDate", "date"),
    "season_current_matchday": ("season.currentMatchday", NUM),
    "home_team_id": ("homeTeam.id", NUM),
    "home_team_name": ("homeTeam.name", "string"),
    "home_team_short_name": ("homeTeam.shortName", "string"),
    "home_team_tla": ("homeTeam.tla", "string"),
    "home_team_crest": ("homeTeam.crest", "string"),
    "away_team_id": ("awayTeam.id", NUM),
    "away_team_name": ("awayTeam.name", "string"),
    "away_team_short_name": ("awayTeam.shortName", "string"),
    "away_team_tla": ("awayTeam.tla", "string"),
    "away_team_crest": ("awayTeam.crest", "string"),
    "winner": ("score.winner", "string"),
    "duration": ("score.duration", "string"),
    "ft_home_goals": ("score.fullTime.home", NUM),
    "ft_away_goals": ("score.fullTime.away", NUM),
    "ht_home_goals": ("score.halfTime.home", NUM),
    "ht_away_goals": ("score.halfTime.away", NUM),
}

LINEAGE = ["file_key", "competition_code", "date_from", "date_to", "run_id", "dt", "loaded_at"]
# --- end fixed values ---


def _struct_type(paths: list[tuple[str, str]]) -> str:
    """DDL of the nested struct holding exactly the given (dotted path, type) leaves."""
    tree: dict = {}
    for path, typ in paths:
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = typ

    def ddl(node: dict) -> str:
        return "struct<" + ", ".join(
            f"`{k}` {ddl(v) if isinstance(v, dict) else v}" for k, v in node.items()) + ">"
    return ddl(tree)


def flatten_matches(raw: DataFrame, keep_pos: bool = False, columns: list[str] | None = None) -> DataFrame:
    """v_matches: one typed row per element of ``payload:matches``.

    Inner lateral flatten: a document whose ``matches`` is missing, JSON
    null or empty contributes no row.  Each element is decoded once into a
    struct holding only the fields of ``columns`` (all by default): a
    consumer that needs a dozen fields does not pay for thirty-one.
    """
    wanted = [c for c in MATCH_FIELDS if columns is None or c in columns]
    src = raw.select(*LINEAGE, "payload")
    exploded = src.lateralJoin(
        src.sparkSession.tvf.variant_explode(F.variant_get(F.col("payload").outer(), "$.matches", "variant"))
    ).drop("payload", "key")
    m = F.variant_get(F.col("value"), "$", _struct_type([MATCH_FIELDS[c] for c in wanted]))
    s = exploded.select(*LINEAGE, "pos", m.alias("m"))
    cols = [F.col(c) for c in LINEAGE]
    for name in wanted:
        path, typ = MATCH_FIELDS[name]
        c = F.col("m")
        for part in path.split("."):
            c = c.getField(part)
        cols.append((F.round(c, 0).cast("bigint") if typ == NUM else c).alias(name))
    if keep_pos:
        cols.append(F.col("pos"))
    return s.select(*cols)


# --- fixed values: column order of matches_latest ---
MATCH_COLUMNS = [
    "match_id", "utc_date", "status", "stage", "match_group", "matchday", "last_updated",
    "competition_id", "competition_code", "competition_name", "competition_type",
    "season_id", "season_start_date", "season_end_date", "season_current_matchday",
    "home_team_id", "home_team_name", "home_team_short_name", "home_team_tla", "home_team_crest",
    "away_team_id", "away_team_name", "away_team_short_name", "away_team_tla", "away_team_crest",
    "winner", "duration", "ft_home_goals", "ft_away_goals", "ht_home_goals", "ht_away_goals",
    "file_key", "competition_code_from_run", "date_from", "date_to", "run_id", "dt", "loaded_at",
]
# --- end fixed values ---

# Last loaded wins, then the latest update; NULL sorts as the largest value.
# Tie-break (not in the model): the later file, then the later array position.
def latest_order() -> list:
    return [
        F.col("loaded_at").desc_nulls_first(),
        F.col("last_updated").desc_nulls_first(),
        F.col("file_key").desc_nulls_first(),
        F.col("pos").desc(),
    ]


def to_latest_shape(df: DataFrame) -> DataFrame:
    """Rename to the matches_latest layout (payload code wins the name);
    columns the input does not carry are left out."""
    source = {"competition_code": "competition_code_in_payload", "competition_code_from_run": "competition_code"}
    have = set(df.columns)
    return df.select(*[F.col(source.get(c, c)).alias(c) for c in MATCH_COLUMNS if source.get(c, c) in have])


# v_matches columns the downstream models read (besides the lineage columns)
LATEST_NEEDS = ["match_id", "last_updated"]
TEAMS_NEEDS = ["competition_code_in_payload", "season_id", "utc_date",
               *[f"{s}_team_{a}" for s in ("home", "away") for a in ("id", "name", "short_name", "tla", "crest")]]


def matches_latest(flat_with_pos: DataFrame) -> DataFrame:
    """One row per match_id: the snapshot loaded last (QUALIFY row_number() = 1)."""
    latest = latest_by_key(flat_with_pos, ["match_id"], latest_order())
    return to_latest_shape(latest)


TEAM_ATTRS = ["team_id", "name", "short_name", "tla", "crest"]


def team_sides(latest: DataFrame) -> DataFrame:
    """One row per (match, side) with the side's team attributes; NULL team ids dropped."""
    sides = {
        side: {
            "team_id": F.col(f"{side}_team_id"),
            "name": F.col(f"{side}_team_name"),
            "short_name": F.col(f"{side}_team_short_name"),
            "tla": F.col(f"{side}_team_tla"),
            "crest": F.col(f"{side}_team_crest"),
        }
        for side in ("home", "away")
    }
    base = latest.select("match_id", "competition_code", "season_id", "utc_date",
                         *[f"{s}_team_{a}" for s in ("home", "away")
                           for a in ("id", "name", "short_name", "tla", "crest")])
    long = two_sided_unpivot(base, ["match_id", "competition_code", "season_id", "utc_date"], sides)
    return long.where(F.col("team_id").isNotNull())


# Latest kickoff wins (NULL first); tie-break: the later match, home before away.
def team_order() -> list:
    return [F.col("utc_date").desc_nulls_first(), F.col("match_id").desc_nulls_first(), F.col("side").asc()]


def teams(latest: DataFrame, updated_at: F.Column | None = None) -> DataFrame:
    """Team dimension: each team's attributes as seen in its latest match."""
    return teams_from_sides(team_sides(latest), updated_at)


def teams_from_sides(sides: DataFrame, updated_at: F.Column | None = None) -> DataFrame:
    one = latest_by_key(sides, ["team_id"], team_order())
    return one.select(
        *TEAM_ATTRS, "competition_code", "season_id",
        F.col("utc_date").alias("last_seen_utc_date"),
        (updated_at if updated_at is not None else F.current_timestamp()).alias("updated_at"),
    )
