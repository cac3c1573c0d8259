"""Property tests: keyed upserts agree with a plain-Python model on random small tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators.keyed import latest_by_key
from tidewater.operators.upsert import insert_if_absent, merge_upsert

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(-3, 3)), max_size=8)
SCHEMA = "k int, v int"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(target=ROWS, source=ROWS)
def test_merge_upsert_matches_model(spark, target, source):
    source_keys = {k for k, _ in source if k is not None}
    want = [r for r in target if r[0] is None or r[0] not in source_keys] + list(source)
    got = merge_upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), "k")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(target=ROWS, batch=ROWS)
def test_insert_if_absent_is_idempotent(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    once = t.unionByName(insert_if_absent(t, b, "k"))
    twice = once.unionByName(insert_if_absent(once, b, "k"))
    # non-NULL keys: one new row per new key, and a second application adds nothing
    new_keys = {k for k, _ in batch if k is not None} - {k for k, _ in target if k is not None}
    assert once.where("k is not null").count() == len([r for r in target if r[0] is not None]) + len(new_keys)
    assert twice.where("k is not null").count() == once.where("k is not null").count()


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)),
                     max_size=10, unique_by=lambda r: r[2]))
def test_latest_by_key_nulls_first_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, id int")
    got = {r.k: r.id for r in latest_by_key(df, ["k"], [F.col("t").desc_nulls_first(), F.col("id").desc()]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        # NULL sorts as the largest value; ties broken by the larger id
        best = max(mine, key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[2]))
        want[k] = best[2]
    assert got == want
