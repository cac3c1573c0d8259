"""Table locations and schemas of the lake (bronze / silver / gold / ops)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.sources.tables import Table, partition_value
from tidewater.sources.versions import Versions, VersionedTable

# --- fixed values: columns of the stored tables ---
RAW_MATCHES = ("file_key string, competition_code string, date_from date, date_to date, run_id string, "
               "dt date, payload variant, loaded_at timestamp")
RAW_MANIFESTS = "file_key string, endpoint string, run_id string, dt date, manifest variant"
RAW_COMPETITIONS = "file_key string, run_id string, dt date, payload variant"
LOAD_STATE = "file_key string, endpoint string"
STAGED = "file_key string, kind string, document variant"
QUARANTINE = "file_key string, kind string, loaded_at timestamp"
LOADS = "load_id string, loaded_at timestamp, dt date"
FRONTIER = "endpoint string, dt date, loaded_at timestamp"
RUN_METRICS = (
    "dag_id string, run_id string, execution_date timestamp, loader_prefix string, "
    "files_discovered bigint, files_to_load bigint, data_files_loaded bigint, manifests_loaded bigint, "
    "dbt_run_duration_sec decimal(38,0), dbt_test_duration_sec decimal(38,0), dbt_test_state string, "
    "created_at timestamp_ntz"
)
MATCHES_LATEST = (
    "match_id bigint, utc_date timestamp, status string, stage string, match_group string, matchday bigint, "
    "last_updated timestamp, competition_id bigint, competition_code string, competition_name string, "
    "competition_type string, season_id bigint, season_start_date date, season_end_date date, "
    "season_current_matchday bigint, home_team_id bigint, home_team_name string, home_team_short_name string, "
    "home_team_tla string, home_team_crest string, away_team_id bigint, away_team_name string, "
    "away_team_short_name string, away_team_tla string, away_team_crest string, winner string, duration string, "
    "ft_home_goals bigint, ft_away_goals bigint, ht_home_goals bigint, ht_away_goals bigint, file_key string, "
    "competition_code_from_run string, date_from date, date_to date, run_id string, dt date, loaded_at timestamp"
)
TEAMS = ("team_id bigint, name string, short_name string, tla string, crest string, competition_code string, "
         "season_id bigint, last_seen_utc_date timestamp, updated_at timestamp")
TEAM_FORM = ("competition_code string, team_id bigint, team_name string, games_played_last5 bigint, "
             "wins_last5 bigint, draws_last5 bigint, losses_last5 bigint, goals_for_last5 bigint, "
             "goals_against_last5 bigint, goal_diff_last5 bigint, points_last5 bigint, last_match_utc timestamp")
LEAGUE_TABLE = ("competition_code string, season_id bigint, team_id bigint, team_name string, played bigint, "
                "wins bigint, draws bigint, losses bigint, goals_for bigint, goals_against bigint, "
                "goal_diff bigint, points bigint, as_of_utc timestamp, rank bigint")
# --- end fixed values ---

# where a match is stored, and what the data tests found in each part of a model
MATCH_PLACES = "match_id bigint, competition_place string, season_place string"
TOUCHED_GROUPS = "competition_place string, season_place string"
TOUCHED_TEAMS = "team_id bigint"
TEAM_PLACES = "competition_code string, season_id bigint, team_id bigint"
TEST_STATE = "model string, part string, column_name string, test string, value string, failures bigint"

# match ids of one folder of the place index
PLACE_CHUNK = 1 << 18

COMPETITION = {"_competition": lambda: partition_value(F.col("competition_code"))}
SEASON = {"_season": lambda: partition_value(F.col("season_id"))}
# the landing day in the key: a manifest's own dt may change when it is replaced, its key does not
CHUNK = {"_chunk": lambda: partition_value(F.floor(F.col("match_id") / PLACE_CHUNK))}
LOAD = {"_load": lambda: F.col("load_id")}
KEY_DAY = {"_key_dt": lambda: partition_value(X.regex_group(F.col("file_key"), X.DT_RE))}


@dataclass
class Lake:
    spark: SparkSession
    root: str

    def _t(self, rel: str, schema: str, partition_by=None, derived=None, compact=False, documents=False) -> Table:
        return Table(self.spark, f"{self.root.rstrip('/')}/{rel}", schema, partition_by, derived, compact, documents)

    # bronze: raw documents keyed by file_key, partitioned by landing day
    @property
    def raw_matches(self) -> Table:
        return self._t("bronze/raw_matches", RAW_MATCHES, ["dt"], documents=True)

    @property
    def raw_manifests(self) -> Table:
        return self._t("bronze/raw_manifests", RAW_MANIFESTS, derived=KEY_DAY)

    @property
    def raw_competitions(self) -> Table:
        return self._t("bronze/raw_competitions", RAW_COMPETITIONS, ["dt"])

    def staged_documents(self, load_id: str) -> Table:
        """Parsed documents and manifests of a stream's epoch, until its rows are in their tables."""
        return self._t(f"bronze/staged_documents/{load_id}", STAGED, ["kind"], documents=True)

    @property
    def quarantine(self) -> Table:
        """Keys of documents that failed to parse in tolerant mode (payload kept NULL)."""
        return self._t("bronze/quarantine", QUARANTINE)

    @property
    def load_state(self) -> Table:
        return self._t("bronze/load_state", LOAD_STATE, ["endpoint"])

    # which landing days each load touched
    @property
    def loads(self) -> Table:
        return self._t("bronze/loads", LOADS)

    # the last landing day that a load of each endpoint has seen
    @property
    def landing_frontier(self) -> Table:
        return self._t("ops/landing_frontier", FRONTIER)

    # everything derived from bronze changes together
    @property
    def versions(self) -> Versions:
        return Versions(self.spark, f"{self.root.rstrip('/')}/ops/versions")

    def _v(self, rel: str, schema: str, derived=None, compact=False) -> VersionedTable:
        return VersionedTable(self.versions, rel, f"{self.root.rstrip('/')}/{rel}", schema, derived=derived, compact=compact)

    # silver / gold: partitioned by the groups they are computed over and a batch is local in
    @property
    def matches_latest(self) -> VersionedTable:
        return self._v("silver/matches_latest", MATCHES_LATEST, COMPETITION | SEASON, compact=True)

    @property
    def teams(self) -> VersionedTable:
        return self._v("silver/teams", TEAMS)

    @property
    def team_form_last5(self) -> VersionedTable:
        return self._v("gold/team_form_last5", TEAM_FORM, COMPETITION, compact=True)

    @property
    def league_table_snapshot(self) -> VersionedTable:
        return self._v("gold/league_table_snapshot", LEAGUE_TABLE, COMPETITION | SEASON, compact=True)

    # latest rows of streamed batches that are not merged into matches_latest yet, one folder a load
    @property
    def latest_deltas(self) -> Table:
        return self._t("silver/latest_deltas", f"{MATCHES_LATEST}, load_id string", derived=LOAD)

    # where each match and each team is, so that a batch finds the groups it touches without reading matches
    @property
    def match_places(self) -> VersionedTable:
        return self._v("silver/match_places", MATCH_PLACES, CHUNK, compact=True)

    @property
    def team_places(self) -> VersionedTable:
        return self._v("silver/team_places", TEAM_PLACES, COMPETITION | SEASON, compact=True)

    # the journal: what merges have touched, before and after, that gold does not show yet
    @property
    def touched_groups(self) -> VersionedTable:
        return self._v("ops/touched_groups", TOUCHED_GROUPS)

    @property
    def touched_teams(self) -> VersionedTable:
        return self._v("ops/touched_teams", TOUCHED_TEAMS)

    # loads whose rows are in matches_latest, and whether gold shows them, too
    @property
    def done_loads(self) -> VersionedTable:
        return self._v("ops/done_loads", f"{LOADS}, published boolean")

    # failures of the data tests by part of a model
    @property
    def test_state(self) -> VersionedTable:
        return self._v("ops/test_state", TEST_STATE)

    def derived_tables(self) -> list[VersionedTable]:
        return [self.matches_latest, self.teams, self.team_form_last5, self.league_table_snapshot, self.match_places, self.team_places,
                self.touched_groups, self.touched_teams, self.done_loads, self.test_state]

    # ops
    @property
    def pipeline_run_metrics(self) -> Table:
        return self._t("ops/pipeline_run_metrics", RUN_METRICS)
