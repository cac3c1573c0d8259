"""Declarative data tests: not_null, unique, accepted_values, and a report.

Failure counts follow the usual test-framework convention (the rows a
test query returns): ``not_null`` counts NULL rows, ``unique`` counts
non-NULL values that occur more than once, ``accepted_values`` counts
distinct non-NULL values outside the list (NULL passes, as in NOT IN).

All not-null and accepted-values tests of one model share a single
aggregate over one scan; each unique test is one hash aggregate whose
partial (map-side) step collapses repeated values before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = "model string, column_name string, test string, failures bigint, state string"


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str                      # not_null | unique | accepted_values
    values: tuple = field(default=())


def _rows(model: str, pairs: Sequence[tuple[str, str, F.Column]]) -> list[F.Column]:
    return [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(k).alias("test"),
                     agg.cast("bigint").alias("failures")) for c, k, agg in pairs]


def scan_tests(df: DataFrame, model: str, tests: Sequence[DataTest]) -> DataFrame | None:
    """not_null + accepted_values tests of one model in one aggregate."""
    pairs = []
    for t in tests:
        c = F.col(t.column)
        if t.kind == "not_null":
            pairs.append((t.column, t.kind, F.count_if(c.isNull())))
        elif t.kind == "accepted_values":
            bad = F.when(c.isNotNull() & ~c.isin(*t.values), c)
            pairs.append((t.column, t.kind, F.count_distinct(bad)))
    if not pairs:
        return None
    one = df.agg(F.array(*_rows(model, pairs)).alias("r"))
    return one.select(F.inline("r"))


def unique_test(df: DataFrame, model: str, column: str) -> DataFrame:
    c = F.col(column)
    dup = df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures")


def run_tests(models: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """One row per test: (model, column_name, test, failures, state)."""
    parts = []
    for model, df in models.items():
        mine = [t for t in tests if t.model == model]
        scanned = scan_tests(df, model, mine)
        if scanned is not None:
            parts.append(scanned)
        parts += [unique_test(df, model, t.column) for t in mine if t.kind == "unique"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("state", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


# Mergeable state: what each part of a model (a landing day, a group, an id range) contributes to its tests.
# Only parts with failures have rows.  Counts of parts add up; values outside a list are kept, since the same
# one may turn up in several parts; keys are counted in parts that no key is in two of.

def state_rows(df: DataFrame, model: str, part: F.Column, tests: Sequence[DataTest]) -> DataFrame | None:
    """not_null and accepted_values state of ``df`` by part, in one aggregate; None if it has no such test."""
    found = []
    for t in tests:
        c = F.col(t.column)
        if t.kind == "not_null":
            values = F.array(F.lit(None).cast("string"))
            failures = F.count_if(c.isNull())
        elif t.kind == "accepted_values":
            values = F.collect_set(F.when(~c.isin(*t.values), c).cast("string"))  # distinct values outside the list
            failures = F.lit(1)
        else:
            continue
        found.append(F.struct(F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test"), values.alias("values"), failures.cast("bigint").alias("failures")))
    if not found:
        return None
    by = df.groupBy(part.alias("part")).agg(F.array(*found).alias("t")).select("part", F.inline("t"))
    rows = by.select(F.lit(model).alias("model"), "part", "column_name", "test", F.explode("values").alias("value"), "failures")
    return rows.where("failures > 0")


def unique_state(df: DataFrame, model: str, part: F.Column, column: str) -> DataFrame:
    """unique state by part; every value of the column lies in one part."""
    c = F.col(column)
    dup = df.where(c.isNotNull()).groupBy(part.alias("part"), c).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.groupBy("part").agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), "part", F.lit(column).alias("column_name"), F.lit("unique").alias("test"),
        F.lit(None).cast("string").alias("value"), "failures")


def report_of(state: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """``run_tests``' report from the state of all parts."""
    keys = ["model", "column_name", "test"]
    merged = state.groupBy(*keys).agg(F.sum("failures").alias("added"), F.count_distinct("value").alias("values"))
    listed = state.sparkSession.createDataFrame([(t.model, t.column, t.kind) for t in tests], "model string, column_name string, test string")
    failures = F.coalesce(F.when(F.col("test") == "accepted_values", F.col("values")).otherwise(F.col("added")), F.lit(0))
    out = listed.join(merged, keys, "left").select(*keys, failures.cast("bigint").alias("failures"))
    return out.withColumn("state", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


# --- fixed values: the project's data tests ---
ACCEPTED_STATUSES = ("SCHEDULED", "TIMED", "IN_PLAY", "PAUSED", "FINISHED", "POSTPONED", "SUSPENDED", "CANCELLED")
PROJECT_TESTS = (
    DataTest("v_matches", "match_id", "not_null"),
    DataTest("matches_latest", "match_id", "not_null"),
    DataTest("matches_latest", "match_id", "unique"),
    DataTest("matches_latest", "utc_date", "not_null"),
    DataTest("matches_latest", "status", "not_null"),
    DataTest("matches_latest", "status", "accepted_values", ACCEPTED_STATUSES),
    DataTest("teams", "team_id", "not_null"),
    DataTest("teams", "team_id", "unique"),
    DataTest("teams", "name", "not_null"),
    DataTest("team_form_last5", "competition_code", "not_null"),
    DataTest("team_form_last5", "team_id", "not_null"),
    DataTest("team_form_last5", "games_played_last5", "not_null"),
    DataTest("league_table_snapshot", "competition_code", "not_null"),
    DataTest("league_table_snapshot", "season_id", "not_null"),
    DataTest("league_table_snapshot", "team_id", "not_null"),
    DataTest("league_table_snapshot", "points", "not_null"),
    DataTest("league_table_snapshot", "rank", "not_null"),
)
# --- end fixed values ---


def suite_state(report: DataFrame) -> str:
    """'success' when every test passes, else 'failed' (one small aggregate)."""
    failed = report.agg(F.count_if(F.col("state") == "fail").alias("n")).collect()[0]["n"]
    return "success" if failed == 0 else "failed"
