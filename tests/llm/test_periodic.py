"""Periodic runs: the program against every lag tried in turn, the operator on awkward rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.llm.test_contracts import plain, same

DIGEST = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(blocks, st.sampled_from([4, 7, 12, 20]))
def test_every_run_is_found(parts, least):
    from tidewater.llm.periodic_runs import find_runs

    words = [w for block, n in parts for w in block * n]
    assert find_runs(np.array(words, np.int64), least) == brute.periodic(words, least)


def test_occurrences_are_looked_up_in_parts(monkeypatch):
    from tidewater.llm import periodic_runs

    words = ([0] * 30 + [1]) * 6 + list(range(2, 40)) * 4
    want = brute.periodic(words)
    monkeypatch.setattr(periodic_runs, "HELD", 7)
    assert periodic_runs.find_runs(np.array(words, np.int64)) == want


def test_a_word_said_over_and_over_takes_one_diagonal():
    from tidewater.llm.periodic_runs import find_runs

    assert find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def test_digest(docs, rows):
    from tidewater.llm.periodic_runs import op12_periodic_runs

    want = brute.periodic_digest(plain(rows))
    assert sum(w[1] > 0 for w in want) > 8
    same(op12_periodic_runs(docs), want, DIGEST)


@pytest.mark.parametrize("clash", ["periodic", "Periodic", "runs"])
def test_columns_stay(spark, clash):
    from tidewater.llm.periodic_runs import collapse_runs, found_column

    text = "x " + "a b c " * 6 + "y"
    docs = spark.createDataFrame([(1, text, "own"), (None, None, None), (1, text, "own"), (2, "", "own")], f"doc_id int, text string, {clash} string")
    done = collapse_runs(docs)
    assert done.columns == [*docs.columns, found_column(docs)]
    got = sorted(done.select("doc_id", "text", clash, f"{found_column(docs)}.runs", f"{found_column(docs)}.n_dropped").collect(), key=str)
    one = (1, "x a b c y", "own", [(1, 18, 3)], 15)
    assert [tuple(r) for r in got] == [one, one, (2, "", "own", [], 0), (None, None, None, [], 0)]


def test_empty_table(empty):
    from tidewater.llm.periodic_runs import op12_periodic_runs

    assert op12_periodic_runs(empty).count() == 0
