"""The cuckoo filter and the reversible line index."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import cuckoo
from tidewater.llm.line_dedup import LineIndex, dedup_lines


def keys(n, seed=0):
    rng = np.random.default_rng(seed)
    return rng.integers(-(2**63), 2**63, n), rng.integers(-(2**63), 2**63, n)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**6))
def test_filter_never_misses_a_key(n, seed):
    x, y = keys(n, seed)
    shared = (np.arange(n) % 3 == 0).astype(np.int64)
    table = cuckoo.empty(n)
    cuckoo.insert(table, x, y, shared)
    found = cuckoo.probe(table, x, y)
    assert (found[shared == 1] == cuckoo.SHARED).all() and (found >= cuckoo.SINGLE).all()
    assert (cuckoo.load(cuckoo.dump(table)) == table).all()


def test_filter_false_positives_and_removal():
    x, y = keys(50_000)
    table = cuckoo.empty(50_000)
    cuckoo.insert(table, x, y, np.zeros(50_000, np.int64))
    ox, oy = keys(50_000, 1)
    assert (cuckoo.probe(table, ox, oy) != cuckoo.ABSENT).mean() < 0.002
    cuckoo.remove(table, x[:20_000], y[:20_000], np.zeros(20_000, np.int64))
    assert (cuckoo.probe(table, x[20_000:], y[20_000:]) == cuckoo.SINGLE).all()
    assert (cuckoo.probe(table, x[:20_000], y[:20_000]) != cuckoo.ABSENT).mean() < 0.002
    cuckoo.remove(table, x[20_000:], y[20_000:], np.zeros(30_000, np.int64))
    assert not table.any()


def test_full_filter_says_so():
    x, y = keys(100)
    with pytest.raises(cuckoo.Full):
        cuckoo.insert(np.zeros((8, cuckoo.SLOTS), np.uint16), x, y, np.zeros(100, np.int64))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def state(index):
    # a filter that was full has been dealt to other shards: the entries are the same
    entries = sorted(e for r in index.filters.collect() for e in cuckoo.load(bytes(r["filter"])).reshape(-1).tolist() if e)
    return rows(index.postings, "id", "x", "y"), rows(index.refs, "x", "y", "n", "first_id", "last_id"), entries


def test_insert_and_delete_are_reversible(docs):
    # one row for each id, as an index of documents has it
    one = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg({"text": "max"}).toDF("doc_id", "text")
    some, more = one.where("doc_id % 3 <> 0"), one.where("doc_id % 3 = 0")
    first = LineIndex.build(some, keys_per_shard=20)
    assert first.shards > 3
    both = first.insert(more).insert(more)
    whole = LineIndex.build(one, keys_per_shard=20)
    assert state(both)[:2] == state(whole)[:2]
    assert rows(both.decisions(), "id", "x", "y") == rows(whole.decisions(), "id", "x", "y") != []
    back = both.delete(more.select("doc_id"))
    assert state(back) == state(first)
    # the first holders gone: their lines come back in the next document
    late = both.delete(some.select("doc_id"))
    assert rows(late.decisions(), "id", "x", "y") == rows(LineIndex.build(more).decisions(), "id", "x", "y")


def test_a_document_counts_once(spark):
    """Rows of one id, and a document that is inserted twice, are one holder."""
    line, other = "a line that is long enough", "another line that is long enough"
    docs = spark.createDataFrame([(1, line), (1, f"{line}\n{other}"), (2, f"{line}\n{line}"), (None, other), (None, other)], "doc_id bigint, text string")
    index = LineIndex.build(docs, parts=4)
    assert sorted(r["n"] for r in index.refs.collect()) == [2, 2]
    assert index.postings.count() == 4
    again = index.insert(docs.where("doc_id = 1"))
    assert state(again) == state(index)
    more = again.insert(spark.createDataFrame([(1, "a third line, long enough"), (3, line), (3, line)], docs.schema))
    assert sorted(r["n"] for r in more.refs.collect()) == [1, 2, 3]
    assert state(more.delete(spark.createDataFrame([(3,)], "doc_id bigint")))[1] != state(index)[1]
    assert rows(more.delete(spark.createDataFrame([(1,), (2,), (3,), (None,)], "doc_id bigint")).refs, "n") == []


def test_a_change_writes_the_parts_it_touches(spark, monkeypatch):
    from tidewater.llm import line_dedup

    docs = spark.range(400).selectExpr("id AS doc_id", "concat('line number ', id % 150, '\nshared by all of them') AS text")
    index = LineIndex.build(docs, keys_per_shard=10, parts=8)
    one = spark.createDataFrame([(1000, "line number 7\nwritten only here")], "doc_id bigint, text string")
    changed = index.insert(one)
    (old, stays), (_, written) = changed.posting_parts.pieces
    assert old is index.posting_parts.pieces[0][0] and len(stays) == 7 and len(written) == 1
    assert changed.ref_parts.pieces[0][0] is index.ref_parts.pieces[0][0] and len(changed.ref_parts.pieces[0][1]) >= 6
    assert changed.filter_parts.pieces[0][1] == changed.ref_parts.pieces[0][1]
    fresh = LineIndex.build(docs.unionByName(one), keys_per_shard=10)
    assert state(changed)[:2] == state(fresh)[:2]
    assert rows(changed.decisions(), "id", "x", "y") == rows(fresh.decisions(), "id", "x", "y")
    monkeypatch.setattr(line_dedup, "PIECES", 1)  # a change after which the parts are written together again
    back = changed.delete(one.select("doc_id"))
    assert len(back.posting_parts.pieces) == 1 and state(back) == state(index)


def test_a_shard_is_probed_in_as_many_tasks_as_it_needs(spark, monkeypatch):
    from tidewater.llm import line_dedup

    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 50)
    docs = spark.range(900).selectExpr("id AS doc_id", "concat('line number ', id % 150, '\nshared by all of them') AS text")
    index = LineIndex.build(docs, keys_per_shard=40)
    assert index.decisions().count() == 899 + 750


def test_columns_stay(docs):
    done = dedup_lines(docs)
    assert done.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    assert done.where("text IS NULL").count() == docs.where("text IS NULL").count()


def test_a_line_of_every_document(spark):
    line = "the same line in every document"
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('{line}\nown ', id) AS text").repartition(7)
    done = dedup_lines(docs)
    assert done.agg({"__n_dropped": "sum"}).first()[0] == 2999
    assert [r["doc_id"] for r in done.where("__n_dropped = 0").collect()] == [0]
