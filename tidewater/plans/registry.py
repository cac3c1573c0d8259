"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (through the fixture
lake, which Spark derives from ``orders`` / ``region``, or ``events``
directly), so its work grows with the data.  Instants are returned as
wall-clock UTC ``timestamp_ntz`` so results compare across engines.

Scenario keys (a replay, "day 0 already loaded", a merge of day 2 into
days 0-1) select their batch by landing day; every one of them still
runs over the whole tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import exprs as X
from tidewater.operators.keyed import latest_by_key, top_n_by_key
from tidewater.operators.quality import PROJECT_TESTS, run_tests
from tidewater.operators.upsert import insert_if_absent, replace_by_key
from tidewater.operators.windows import assign_backfill_chunk, coverage_gaps, planned_chunks, rolling_window_filter
from tidewater.plans import gold, silver
from tidewater.plans.fixture_lake import FixtureLake, fixture_lake, fixture_root, load_time
from tidewater.plans.lake import Lake
from tidewater.plans.loader import (
    ENDPOINTS, flag_pending, load_matches, load_state_pending, loader_metrics, manifest_pairing, prefix_of,
    raw_competitions_rows, raw_manifest_rows, raw_matches_rows,
)
from tidewater.plans.manifests import (
    competitions_flatten, element_count, landing_pairs, landing_write, manifest_build, manifest_reconcile,
)
from tidewater.plans.runs import latest_now, merge_latest, refresh_models, run_metrics_row, store_latest, upsert_keyed
from tidewater.session import configure, scratch_dir
from tidewater.sources import landing as L
from tidewater.sources.fixture import documents, landing_rows, snapshots, write_objects
from tidewater.sources.versions import State, Versions
from tidewater.streaming.ingest import stream_bronze_ingest

MATCHES, BACKFILL = "matches", "matches_backfill"
DAY0, DAY1, DAY2 = "2024-01-01", "2024-01-02", "2024-01-03"
REPLAY_LOAD = "2024-01-04 02:00:00"
# --- fixed values: parameters of the events-based keys ---
EVENTS_AS_OF = "2024-01-15"
EVENTS_CODES = "click, view,,purchase "
BACKFILL_START, BACKFILL_END, BACKFILL_DAYS = "2024-01-03", "2024-01-27", 7
GAPS_START, GAPS_END, GAPS_DAYS = "2024-01-01", "2024-01-30", 2
# --- end fixed values ---
FETCHED = "T01:00:00+00:00"
STREAM_BATCHES = 4  # the stream keys size a micro-batch as this part of the landed bytes


def as_ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock; session tz is UTC)."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _fx(spark: SparkSession, sf_dir: str) -> FixtureLake:
    return fixture_lake(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fx(spark, sf_dir).lake.raw_matches.read()


def _latest_of(raw: DataFrame, needs: list[str] | None = None) -> DataFrame:
    """Latest snapshot per match; ``needs`` limits the decoded fields."""
    cols = None if needs is None else [*silver.LATEST_NEEDS, *needs]
    return silver.matches_latest(silver.flatten_matches(raw, keep_pos=True, columns=cols))


def _latest(spark: SparkSession, sf_dir: str, needs: list[str] | None = None) -> DataFrame:
    return _latest_of(_raw(spark, sf_dir), needs)


def _objects(spark: SparkSession, fx: FixtureLake) -> DataFrame:
    return L.object_classify(L.list_objects(spark, fx.landing, prefix_of(MATCHES)))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _scratch_lake(spark: SparkSession, tag: str) -> tuple[str, Lake]:
    root = scratch_dir(spark, "runs", f"{tag}-{uuid.uuid4().hex[:12]}")
    return root, Lake(spark, f"{root}/lake")


def _ledger_after_day0(fx: FixtureLake) -> DataFrame:
    """The load-state ledger as the first daily run left it."""
    led = fx.lake.load_state.read()
    return led.where(X.regex_group(F.col("file_key"), X.DT_RE) == DAY0)


def _raw_shape(df: DataFrame) -> DataFrame:
    return df.select("file_key", "competition_code", "date_from", "date_to", "run_id", "dt", "loaded_at",
                     element_count(F.col("payload")).alias("n_matches"))


# ---------------------------------------------------------------- landing / sources
def q_landing_scan(spark, sf_dir):
    """Whole-document read of every landed data object, elements per document."""
    fx = _fx(spark, sf_dir)
    docs = L.read_tree(spark, fx.landing, prefix_of(MATCHES)).where(X.is_data_key(F.col("file_key")))
    return docs.select("file_key", element_count(F.parse_json("text")).alias("n_matches"))


def q_object_classify(spark, sf_dir):
    """S3 P10: data / manifest objects per competition."""
    obj = L.key_parse(_objects(spark, _fx(spark, sf_dir)))
    return obj.groupBy("competition", "kind").agg(F.count(F.lit(1)).alias("n_objects"))


def q_key_parse(spark, sf_dir):
    """Key fields of every data and manifest object."""
    obj = L.key_parse(_objects(spark, _fx(spark, sf_dir)))
    return obj.select("file_key", "run_id", "dt", "competition", "date_from", "date_to")


def q_latest_object(spark, sf_dir):
    """Greatest data key in string order."""
    return L.latest_object(_objects(spark, _fx(spark, sf_dir)))


def q_competitions_flatten(spark, sf_dir):
    """Competitions documents flattened from RAW_COMPETITIONS."""
    return competitions_flatten(_fx(spark, sf_dir).lake.raw_competitions.read())


# what a landed document says of each match
_SAID = ("id bigint, utcDate string, status string, lastUpdated string, homeTeam struct<id bigint>, awayTeam struct<id bigint>, "
         "score struct<winner string, fullTime struct<home bigint, away bigint>>")


def _digest(matches):
    """md5 of a document's matches by id: time, state, teams and score, one line each."""
    def line(m):
        said = (m["id"], m["utcDate"], m["status"], m["lastUpdated"], m["homeTeam"]["id"], m["awayTeam"]["id"],
                m["score"]["winner"], m["score"]["fullTime"]["home"], m["score"]["fullTime"]["away"])
        return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in said])

    return F.md5(F.array_join(F.transform(F.array_sort(matches), line), "\n"))


def q_landing_write(spark, sf_dir):
    """Partitioned landing writer, read back per landing folder, what the documents say included."""
    root, _ = _scratch_lake(spark, "landing")
    docs = landing_rows(snapshots(spark.read.parquet(f"{sf_dir}/orders.parquet")))
    landing_write(docs, root)
    back = (spark.read.schema(f"matches array<struct<{_SAID}>>, endpoint string, competition string, dateFrom string, "
                              "dateTo string, dt string, run_id string")
            .json(root))
    return back.groupBy(F.col("competition"), F.col("dateFrom").alias("date_from"), F.col("dateTo").alias("date_to"),
                        "dt", "run_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(F.size("matches")).cast("bigint").alias("n_matches"),
        F.min(_digest(F.col("matches"))).alias("digest"))


def q_landing_pair_write(spark, sf_dir):
    """K1 K2: every document landed with its manifest, read back with what each says it holds; documents by digest, manifests word for word."""
    root, _ = _scratch_lake(spark, "pairs")
    fetched = F.concat(F.col("dt").cast("string"), F.lit(FETCHED))
    write_objects(landing_pairs(_raw(spark, sf_dir), fetched_at=fetched), root)
    docs = L.read_tree(spark, root, prefix_of(MATCHES)).withColumn("v", F.parse_json("text"))
    counted = F.variant_get(F.col("v"), "$.record_count", "bigint")
    is_manifest = X.is_manifest_key(F.col("file_key"))
    n = F.when(is_manifest, counted).otherwise(element_count(F.col("v")))
    return docs.select("file_key", n.alias("n_matches"), F.when(is_manifest, F.col("text")).alias("manifest"),
                       F.when(~is_manifest, _digest(F.variant_get(F.col("v"), "$.matches", f"array<struct<{_SAID}>>"))).alias("digest"))


def q_manifest_build(spark, sf_dir):
    """Manifest record of every raw data document, the JSON included."""
    return manifest_build(_raw(spark, sf_dir), fetched_at=F.concat(F.col("dt").cast("string"), F.lit(FETCHED)))


def q_manifest_pairing(spark, sf_dir):
    """Each data object with its expected manifest, found or not."""
    obj = _objects(spark, _fx(spark, sf_dir))
    data = obj.where(F.col("kind") == "data")
    man = obj.where(F.col("kind") == "manifest")
    return manifest_pairing(data, man).select(F.col("file_key").alias("data_key"), "manifest_key", "manifest_found")


def q_manifest_reconcile(spark, sf_dir):
    """T4: documents whose manifest record_count disagrees with the payload, or that have no manifest, and the reverse."""
    lake = _fx(spark, sf_dir).lake
    return manifest_reconcile(lake.raw_matches.read(), lake.raw_manifests.read(), unmatched=True)


# ---------------------------------------------------------------- bronze upserts / ledger
def q_raw_competitions_upsert(spark, sf_dir):
    """K3: replay every competitions document into RAW_COMPETITIONS."""
    fx = _fx(spark, sf_dir)
    batch = raw_competitions_rows(L.read_tree(spark, fx.landing, prefix_of("competitions")))
    out = replace_by_key(fx.lake.raw_competitions.read(), batch, "file_key")
    return out.select("file_key", "run_id", "dt", element_count(F.col("payload"), "$.competitions").alias("n_competitions"))


def q_raw_matches_upsert(spark, sf_dir):
    """Replay of every landed file with a new load time."""
    fx = _fx(spark, sf_dir)
    replay = _objects(spark, fx).where(F.col("kind") == "data")
    batch = raw_matches_rows(L.read_documents(spark, replay, kind=X.is_data_key), F.lit(REPLAY_LOAD))
    return as_ntz(_raw_shape(replace_by_key(fx.lake.raw_matches.read(), batch, "file_key")))


def q_raw_manifests_upsert(spark, sf_dir):
    """K5: replay of every manifest into RAW_MANIFESTS."""
    fx = _fx(spark, sf_dir)
    obj = _objects(spark, fx)
    batch = raw_manifest_rows(L.read_documents(spark, obj.where(F.col("kind") == "manifest"), kind=X.is_manifest_key), MATCHES)
    out = replace_by_key(fx.lake.raw_manifests.read(), batch, "file_key")
    return out.select("file_key", "endpoint", "run_id", "dt",
                      F.variant_get(F.col("manifest"), "$.record_count", "bigint").alias("record_count"))


def q_load_state_pending(spark, sf_dir):
    """Data objects not yet in the ledger after the first daily run."""
    fx = _fx(spark, sf_dir)
    data = _objects(spark, fx).where(F.col("kind") == "data")
    return load_state_pending(data, _ledger_after_day0(fx), MATCHES).select("file_key")


def q_load_state_mark(spark, sf_dir):
    """K6: insert-if-absent of every landed key into the day-0 ledger."""
    fx = _fx(spark, sf_dir)
    obj = _objects(spark, fx)
    data_ep, man_ep = ENDPOINTS[MATCHES]
    marks = obj.select("file_key", F.when(F.col("kind") == "data", data_ep).otherwise(man_ep).alias("endpoint"))
    target = _ledger_after_day0(fx)
    return target.unionByName(insert_if_absent(target, marks, "file_key"))


def q_loader_metrics(spark, sf_dir):
    """Loader counters of a run that finds day 0 already loaded."""
    fx = _fx(spark, sf_dir)
    obj = _objects(spark, fx)
    data = obj.where(F.col("kind") == "data")
    flagged = flag_pending(data, _ledger_after_day0(fx), obj.where(F.col("kind") == "manifest"), MATCHES)
    return loader_metrics(prefix_of(MATCHES), flagged)


# ---------------------------------------------------------------- silver / gold
def q_matches_flatten(spark, sf_dir):
    return as_ntz(silver.flatten_matches(_raw(spark, sf_dir)))


def q_matches_latest(spark, sf_dir):
    return as_ntz(_latest(spark, sf_dir))


def _merge_scenario(spark, sf_dir, needs: list[str] | None = None):
    """Latest snapshots of days 0-1 and of day 2; matches without a day-2 snapshot stay target-only.  ``needs``: as for ``_latest_of``."""
    raw = _raw(spark, sf_dir)
    before = _latest_of(raw.where(F.col("loaded_at") < F.lit(load_time(2)).cast("timestamp")), needs)
    return before, _latest_of(raw.where(F.col("loaded_at") == F.lit(load_time(2)).cast("timestamp")), needs)


def q_matches_latest_merge(spark, sf_dir):
    """K7: order-comparing merge of day 2 into the latest table of days 0-1."""
    target, source = _merge_scenario(spark, sf_dir)
    _, lake = _scratch_lake(spark, "merge")
    store_latest(lake, target)
    merge_latest(lake, source)
    return as_ntz(lake.matches_latest.read())


def q_teams_dim(spark, sf_dir):
    return as_ntz(silver.teams(_latest(spark, sf_dir, silver.TEAMS_NEEDS)).drop("updated_at"))


def q_teams_merge(spark, sf_dir):
    """K7 on teams: teams of days 0-1, then the teams seen in day 2."""
    target, source = _merge_scenario(spark, sf_dir, silver.TEAMS_NEEDS)
    _, lake = _scratch_lake(spark, "teams")
    upsert_keyed(lake.teams, silver.teams(target), "team_id")
    upsert_keyed(lake.teams, silver.teams(source), "team_id")
    return as_ntz(lake.teams.read().drop("updated_at"))


class _Stopped(Versions):
    """Versions of a run that is stopped when it has written everything but the switch."""

    def put(self, state: State) -> None:
        raise InterruptedError(state.number)


class _StoppedLake(Lake):
    @property
    def versions(self) -> Versions:
        return _Stopped(self.spark, super().versions.path)


_REFRESHED: dict[str, Lake] = {}


def _refreshed(spark, sf_dir) -> Lake:
    """A lake loaded and refreshed day by day by the production code.

    Day 1's run is stopped inside its refresh, with every table written and the switch
    not made; day 2's run has to catch up.
    """
    fx = _fx(spark, sf_dir)
    if fx.root not in _REFRESHED:
        _, lake = _scratch_lake(spark, "days")
        for day, dt in enumerate((DAY0, DAY1, DAY2)):
            load_matches(spark, fx.landing, lake, MATCHES, loaded_at=load_time(day), until_dt=dt)
            try:
                refresh_models(spark, _StoppedLake(spark, lake.root) if day == 1 else lake)
            except InterruptedError:
                pass
        _REFRESHED[fx.root] = lake
    return _REFRESHED[fx.root]


def q_daily_refresh_incremental(spark, sf_dir):
    """M2 K7: matches_latest after three daily runs, one of them interrupted."""
    return as_ntz(_refreshed(spark, sf_dir).matches_latest.read())


_BACKFILLED: dict[str, Lake] = {}


def _backfilled(spark, sf_dir) -> Lake:
    """A lake after one backfill run: every chunk landed under the backfill endpoint, then loaded and refreshed."""
    built = fixture_root(spark, sf_dir)  # this session's shared root and the content of the tables; its landing is not read here
    if built not in _BACKFILLED:
        root, lake = _scratch_lake(spark, "backfill")
        chunks = documents(snapshots(spark.read.parquet(f"{sf_dir}/orders.parquet")), BACKFILL)
        write_objects(chunks, f"{root}/landing")
        load_matches(spark, f"{root}/landing", lake, BACKFILL, loaded_at=REPLAY_LOAD, on_empty="error")
        refresh_models(spark, lake)
        _BACKFILLED[built] = lake
    return _BACKFILLED[built]


def q_backfill_load(spark, sf_dir):
    """RAW_MATCHES after a backfill run, with the ledger's name of each key."""
    lake = _backfilled(spark, sf_dir)
    return as_ntz(_raw_shape(lake.raw_matches.read())).join(lake.load_state.read(), "file_key", "left")


def q_backfill_latest(spark, sf_dir):
    """M2 after a backfill run: one load time, so the later update wins."""
    return as_ntz(_backfilled(spark, sf_dir).matches_latest.read())


def q_teams_stored(spark, sf_dir):
    """M3 K7: the stored team dimension after those runs."""
    return as_ntz(_refreshed(spark, sf_dir).teams.read().drop("updated_at"))


def q_team_form_stored(spark, sf_dir):
    """M4 K8: the stored form mart after those runs."""
    return as_ntz(_refreshed(spark, sf_dir).team_form_last5.read())


def q_league_table_stored(spark, sf_dir):
    """M5 K8: the stored league table after those runs."""
    return as_ntz(_refreshed(spark, sf_dir).league_table_snapshot.read())


def q_team_results_long(spark, sf_dir):
    return as_ntz(gold.team_results_long(_latest(spark, sf_dir, gold.GOLD_NEEDS)))


def q_team_form_last5(spark, sf_dir):
    return as_ntz(gold.team_form(_latest(spark, sf_dir, gold.GOLD_NEEDS), 5))


def q_league_table_snapshot(spark, sf_dir):
    return as_ntz(gold.league_table(_latest(spark, sf_dir, gold.GOLD_NEEDS)))


# ---------------------------------------------------------------- quality / ops
# snapshot columns that a model's tests or the models built on it read
_TEST_NEEDS = sorted({*silver.TEAMS_NEEDS, *gold.GOLD_NEEDS})


def _models(spark, sf_dir, tests) -> dict[str, DataFrame]:
    """The models these tests read, each decoding only the fields they need."""
    raw = _raw(spark, sf_dir)
    wanted = {t.model for t in tests}
    view = [t.column for t in tests if t.model == "v_matches"]
    out = {"v_matches": silver.flatten_matches(raw, columns=view)} if view else {}
    rest = wanted - {"v_matches"}
    if rest == {"matches_latest"}:
        return out | {"matches_latest": _latest_of(raw, [t.column for t in tests if t.model == "matches_latest"])}
    if rest:
        # several models derive from the latest snapshot: compute it once and cut the
        # lineage in the shared checkpoint folder (survives executor loss)
        latest = _latest_of(raw, _TEST_NEEDS).checkpoint(eager=True)
        built = {"matches_latest": lambda: latest, "teams": lambda: silver.teams(latest),
                 "team_form_last5": lambda: gold.team_form(latest, 5), "league_table_snapshot": lambda: gold.league_table(latest)}
        out |= {m: built[m]() for m in rest}
    return out


def _dq(spark, sf_dir, kind: str | None):
    tests = [t for t in PROJECT_TESTS if kind is None or t.kind == kind]
    report = run_tests(_models(spark, sf_dir, tests), tests)
    return report if kind is None else report.drop("state")


def q_dq_not_null(spark, sf_dir):
    return _dq(spark, sf_dir, "not_null")


def q_dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, "unique")


def q_dq_accepted_values(spark, sf_dir):
    return _dq(spark, sf_dir, "accepted_values")


def q_dq_report(spark, sf_dir):
    return _dq(spark, sf_dir, None)


def q_pipeline_run_metrics(spark, sf_dir):
    """Append this run's metrics row (table created if absent), read it back."""
    began = time.time()
    loader = q_loader_metrics(spark, sf_dir).collect()[0].asDict()
    loaded = time.time()
    report = q_dq_report(spark, sf_dir)
    failed = report.agg(F.count_if(F.col("state") == "fail").alias("n")).collect()[0]["n"]
    rid = uuid.uuid4().hex
    _, lake = _scratch_lake(spark, "metrics")
    row = run_metrics_row(spark, "daily_pipeline", rid, load_time(2), loader, loaded - began, time.time() - loaded,
                          "success" if failed == 0 else "failed")
    lake.pipeline_run_metrics.append(row)
    back = lake.pipeline_run_metrics.read().where(F.col("run_id") == rid)
    timed = (F.col("dbt_run_duration_sec") >= 0) & (F.col("dbt_test_duration_sec") >= 0) & F.col("created_at").isNotNull()
    return as_ntz(back.withColumn("timed", timed).drop("run_id", "dbt_run_duration_sec", "dbt_test_duration_sec", "created_at"))


# ---------------------------------------------------------------- date windows / events
def q_rolling_window_filter(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    return rolling_window_filter(ev, "ts", EVENTS_AS_OF, codes=EVENTS_CODES, code_col="event_type")


def q_backfill_chunk_assign(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    return assign_backfill_chunk(ev, "ts", BACKFILL_START, BACKFILL_END, BACKFILL_DAYS)


def q_backfill_coverage_gaps(spark, sf_dir):
    """Parts of planned 2-day chunks that no loaded window covers; windows of 2 and of 3 days are loaded."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    loaded = assign_backfill_chunk(ev.where(~odd), "ts", GAPS_START, GAPS_END, GAPS_DAYS).unionByName(
        assign_backfill_chunk(ev.where(odd), "ts", GAPS_START, GAPS_END, GAPS_DAYS + 1))
    planned = planned_chunks(ev.select("user_id").distinct(), GAPS_START, GAPS_END, GAPS_DAYS)
    return coverage_gaps(planned, loaded, ["user_id"], GAPS_START, GAPS_END)


def q_latest_event_per_user(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return latest_by_key(ev, ["user_id"], [F.col("ts").desc_nulls_first(), F.col("event_id").desc()])


def q_top5_events_per_user(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    top = top_n_by_key(ev, ["user_id"], [F.col("value").desc_nulls_first(), F.col("event_id").desc()], 5, "rn")
    return top.withColumn("rn", F.col("rn").cast("bigint"))


def q_events_props_extract(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "props")
    return ev.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


# ---------------------------------------------------------------- streaming
def _stream(spark, sf_dir, latest: bool) -> Lake:
    fx = _fx(spark, sf_dir)
    root, lake = _scratch_lake(spark, "stream")
    load_hour = F.concat(F.col("dt"), F.lit(" 02:00:00")).cast("timestamp")  # fixture: day d loads at 02:00
    landed = _objects(spark, fx).agg(F.sum("size").alias("n")).collect()[0]["n"] or 0
    stream_bronze_ingest(spark, fx.landing, lake, f"{root}/_checkpoint", loaded_at=load_hour,
                         max_bytes_per_trigger=int(landed) // STREAM_BATCHES + 1, latest=latest)
    return lake


def q_stream_bronze_ingest(spark, sf_dir):
    """File-stream pickup drained with AvailableNow into RAW_MATCHES."""
    return as_ntz(_raw_shape(_stream(spark, sf_dir, False).raw_matches.read()))


def q_stream_matches_latest(spark, sf_dir):
    """The latest deltas of the micro-batches, read with their base, equal the batch model."""
    return as_ntz(latest_now(_stream(spark, sf_dir, True)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "landing_scan": q_landing_scan,
    "object_classify": q_object_classify,
    "key_parse": q_key_parse,
    "latest_object": q_latest_object,
    "competitions_flatten": q_competitions_flatten,
    "landing_write": q_landing_write,
    "landing_pair_write": q_landing_pair_write,
    "manifest_build": q_manifest_build,
    "manifest_pairing": q_manifest_pairing,
    "manifest_reconcile": q_manifest_reconcile,
    "raw_competitions_upsert": q_raw_competitions_upsert,
    "raw_matches_upsert": q_raw_matches_upsert,
    "raw_manifests_upsert": q_raw_manifests_upsert,
    "load_state_pending": q_load_state_pending,
    "load_state_mark": q_load_state_mark,
    "loader_metrics": q_loader_metrics,
    "matches_flatten": q_matches_flatten,
    "matches_latest": q_matches_latest,
    "matches_latest_merge": q_matches_latest_merge,
    "daily_refresh_incremental": q_daily_refresh_incremental,
    "backfill_load": q_backfill_load,
    "backfill_latest": q_backfill_latest,
    "teams_stored": q_teams_stored,
    "team_form_stored": q_team_form_stored,
    "league_table_stored": q_league_table_stored,
    "teams_dim": q_teams_dim,
    "teams_merge": q_teams_merge,
    "team_results_long": q_team_results_long,
    "team_form_last5": q_team_form_last5,
    "league_table_snapshot": q_league_table_snapshot,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_report": q_dq_report,
    "pipeline_run_metrics": q_pipeline_run_metrics,
    "rolling_window_filter": q_rolling_window_filter,
    "backfill_chunk_assign": q_backfill_chunk_assign,
    "backfill_coverage_gaps": q_backfill_coverage_gaps,
    "latest_event_per_user": q_latest_event_per_user,
    "top5_events_per_user": q_top5_events_per_user,
    "events_props_extract": q_events_props_extract,
    "stream_bronze_ingest": q_stream_bronze_ingest,
    "stream_matches_latest": q_stream_matches_latest,
}


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _configured(v) for k, v in QUERIES.items()}
