"""Generic operators on small frames: upserts, keyed ranking, windows, idempotence."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators.keyed import latest_by_key, rank_within, top_n_by_key
from tidewater.operators.upsert import insert_if_absent, merge_upsert, replace_by_key
from tidewater.operators.windows import assign_backfill_chunk, coverage_gaps, planned_chunks, rolling_window_filter
from tidewater.functions.exprs import split_codes, falsy_or


def test_merge_upsert_nulls_overwrite_and_target_only_kept(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, s string, v int")
    s = spark.createDataFrame([(2, None, None), (3, "c", 30), (None, "m", 1)], "k int, s string, v int")
    out = sorted(merge_upsert(t, s, "k").collect(), key=lambda r: (r.k is None, r.k or 0, r.s or ""))
    assert [tuple(r) for r in out] == [(1, "a", 10), (2, None, None), (3, "c", 30), (None, "m", 1), (None, "n", 0)]
    # applying the same source twice equals once (NULL keys excepted: they never match)
    once = merge_upsert(t, s, "k").where("k is not null")
    twice = merge_upsert(merge_upsert(t, s, "k"), s, "k").where("k is not null")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_replace_by_key_and_insert_if_absent(spark):
    t = spark.createDataFrame([("f1", 1), ("f2", 2)], "file_key string, n int")
    b = spark.createDataFrame([("f2", 9), ("f3", 3)], "file_key string, n int")
    assert sorted(tuple(r) for r in replace_by_key(t, b, "file_key").collect()) == [("f1", 1), ("f2", 9), ("f3", 3)]
    new = insert_if_absent(t, b.unionByName(b), "file_key")
    assert [tuple(r) for r in new.collect()] == [("f3", 3)]


def test_keyed_ranking(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1), (1, None, 2), (1, 7.0, 3), (2, 1.0, 4), (2, 1.0, 5)], "u int, v double, id int")
    order = [F.col("v").desc_nulls_first(), F.col("id").desc()]
    assert sorted((r.u, r.id) for r in latest_by_key(df, ["u"], order).collect()) == [(1, 2), (2, 5)]
    top = top_n_by_key(df, ["u"], order, 2, "rn").collect()
    assert sorted((r.u, r.id, r.rn) for r in top) == [(1, 2, 1), (1, 3, 2), (2, 4, 2), (2, 5, 1)]
    ranks = rank_within(df, ["u"], order).where("u = 1").orderBy("rank").collect()
    assert [r.id for r in ranks] == [2, 3, 1]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A key holding a third of all rows: the partial limit runs below the exchange,
    so each map task ships at most n rows of it; the answer stays exact."""
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("v")).repartition(8)
    top = top_n_by_key(df, ["k"], [F.col("v").desc()], 5, "rn")
    plan = top._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.find("Partial"), plan.rfind("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and partial > exchange > 0   # printed top-down: partial is below
    hot = sorted(r.v for r in top.where("k = 0").collect())
    assert hot == [n - 15, n - 12, n - 9, n - 6, n - 3]   # the five largest multiples of 3 below n


def test_split_codes_and_falsy_or(spark):
    r = spark.range(1).select(split_codes(F.lit(" PL, SA,,BL1 ,")).alias("c"),
                              falsy_or(F.lit(""), F.lit("x")).alias("a"),
                              falsy_or(F.lit(None).cast("string"), F.lit("y")).alias("b"),
                              falsy_or(F.lit("z"), F.lit("y")).alias("c2")).collect()[0]
    assert r.c == ["PL", "SA", "BL1"] and (r.a, r.b, r.c2) == ("x", "y", "z")


def test_backfill_chunks(spark):
    days = spark.createDataFrame([(d,) for d in range(0, 12)], "d int").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).cast("timestamp").alias("ts"))
    # remainder: 10 days in chunks of 4 -> [1-4] [5-8] [9-10]
    got = assign_backfill_chunk(days, "ts", "2024-01-01", "2024-01-10", 4).select("date_from", "date_to").distinct()
    spans = sorted((str(r.date_from), str(r.date_to)) for r in got.collect())
    assert spans == [("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-08"), ("2024-01-09", "2024-01-10")]
    # one-day range and exact multiple
    one = assign_backfill_chunk(days, "ts", "2024-01-03", "2024-01-03", 30).collect()
    assert len(one) == 1 and str(one[0].date_to) == "2024-01-03"
    exact = assign_backfill_chunk(days, "ts", "2024-01-01", "2024-01-08", 4).select("chunk_no").distinct().count()
    assert exact == 2
    for bad in [("2024-01-01", "2024-01-08", 0), ("2024-01-01", "2024-01-08", 61), ("2024-01-09", "2024-01-08", 3)]:
        with pytest.raises(ValueError):
            assign_backfill_chunk(days, "ts", *bad)
    keys = spark.createDataFrame([("PL",)], "competition string")
    plan = planned_chunks(keys, "2024-01-01", "2024-01-10", 4)
    loaded = spark.createDataFrame([("PL", "2024-01-05", "2024-01-08")], "competition string, date_from string, date_to string") \
        .select("competition", F.col("date_from").cast("date"), F.col("date_to").cast("date"))
    found = coverage_gaps(plan, loaded, ["competition"], "2024-01-01", "2024-01-10").collect()
    assert sorted(str(r.date_from) for r in found) == ["2024-01-01", "2024-01-09"]
    assert sorted((str(r.missing_from), str(r.missing_to)) for r in found) == [("2024-01-01", "2024-01-04"), ("2024-01-09", "2024-01-10")]


def test_coverage_of_windows_of_any_length(spark):
    """Overlapping, nested, adjacent, repeated and empty windows, against days held one by one."""
    import random
    from datetime import date, timedelta

    from tidewater.operators.windows import coverage_islands, uncovered

    rng, first = random.Random(5), date(2024, 1, 1)
    day = lambda k: first + timedelta(days=k)
    rows = [(rng.choice(["PL", "SA", "CL"]), day(a), day(a + rng.randint(-1, 6))) for a in (rng.randint(-9, 70) for _ in range(60))]
    loaded = spark.createDataFrame(rows + rows[:5], "competition string, date_from date, date_to date")
    keys = spark.createDataFrame([("PL",), ("SA",), ("XX",)], "competition string")
    held = {(c, lo + timedelta(days=k)) for c, lo, hi in rows for k in range((hi - lo).days + 1)}
    gaps = uncovered(keys, loaded, ["competition"], day(0), day(59)).collect()
    missing = [(r.competition, r.date_from + timedelta(days=k)) for r in gaps for k in range((r.date_to - r.date_from).days + 1)]
    assert sorted(missing) == sorted((c, day(k)) for c in ("PL", "SA", "XX") for k in range(60) if (c, day(k)) not in held)
    assert [(r.date_from, r.date_to) for r in gaps if r.competition == "XX"] == [(day(0), day(59))]
    for c, lo, hi in [tuple(r) for r in coverage_islands(loaded, ["competition"]).collect()]:
        assert all((c, lo + timedelta(days=k)) in held for k in range((hi - lo).days + 1))  # whole
        assert (c, lo - timedelta(days=1)) not in held and (c, hi + timedelta(days=1)) not in held  # and maximal


def test_rolling_window(spark):
    df = spark.createDataFrame([(d, c) for d in range(10, 25) for c in ("PL", "SA", "XX")], "d int, code string").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("d") - 1).cast("timestamp").alias("ts"), "code")
    out = rolling_window_filter(df, "ts", "2024-01-15", codes="PL, SA,", code_col="code")
    days = sorted({r.ts.day for r in out.collect()})
    assert days == list(range(14, 23)) and {r.code for r in out.collect()} == {"PL", "SA"}


def test_dimension_source_is_computed_once(spark, tmp_path):
    """A merge uses its source for the keys and for the rows; each row of it is computed once."""
    from tidewater.plans.lake import Lake
    from tidewater.plans.runs import upsert_keyed

    lake = Lake(spark, str(tmp_path / "lake"))
    times = spark.sparkContext.accumulator(0)

    def team(k):
        times.add(1)
        return (k, f"T{k}", None, None, None, "PL", 1, None, None)

    for _ in range(2):
        source = spark.createDataFrame(spark.sparkContext.range(0, 5, numSlices=1).map(team), lake.teams.schema)
        upsert_keyed(lake.teams, source, "team_id")
    assert times.value == 10
    assert sorted(r.team_id for r in lake.teams.read().collect()) == [0, 1, 2, 3, 4]


def test_teams_merge_decodes_what_teams_need(spark):
    from helpers import SF_SMALL
    from tidewater.plans import registry, silver

    for part in registry._merge_scenario(spark, SF_SMALL, silver.TEAMS_NEEDS):
        assert "home_team_crest" in part.columns and not {"winner", "ft_home_goals", "stage"} & {*part.columns}
