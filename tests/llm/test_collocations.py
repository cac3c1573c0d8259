"""Collocations against phrases counted one by one."""

import random

import pytest

from tests.llm import brute
from tests.llm.test_contracts import same

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def sayings():
    """Rows (doc_id, text, lang): few words, so that phrases of every length come back."""
    rng = random.Random(8)
    words = ["Ja", "nein", "vielleicht", "été", "x", "Ünd", "a b", "c d e", "so on and on", "nbsp\xa0word", "ǅ"]
    rows = []
    for k in range(160):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b", " \r\n "]) for _ in range(rng.randint(0, 60)))
        rows.append((k, text, rng.choice(["de", "de", "de", "en", None, "und", ""])))
    rows += [(500, None, "de"), (None, "ja nein. " * 40, None), rows[3], rows[3], (501, "", "xx"), (502, "la " * 300, "fr"), (503, "w " + "ein wort " * 200, "fr")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least", [30, 4])
def test_phrases(spark, sayings, least, monkeypatch):
    from tidewater.llm import collocations

    docs = spark.createDataFrame(sayings, "doc_id int, text string, lang string").repartition(3)
    want = brute.phrases([(lang, t) for _, t, lang in sayings], least)
    assert {len(w[2].split(" ")) for w in want} == {2, 3, 4} and len({w[0] for w in want}) > 2
    same(collocations.collocations(docs, least), want, COLUMNS)


def test_shards_and_the_report_do_not_change_counts(spark, sayings, monkeypatch):
    from tidewater.llm import collocations

    monkeypatch.setattr(collocations, "SHARD_WORDS", 50)
    docs = spark.createDataFrame(sayings, "doc_id int, text string, lang string").repartition(2)
    want = brute.phrases([(lang, t) for _, t, lang in sayings], 6, 10)
    assert max(w[1] for w in want) == 10
    same(collocations.collocations(docs, 6, top=10), want, COLUMNS)


def test_counts_by_slot(spark, sayings, monkeypatch):
    """Many parts, many shards and slots that phrases share: a sum by slot may only keep too much."""
    from tidewater.llm import collocations

    monkeypatch.setattr(collocations, "SHARD_WORDS", 50)
    monkeypatch.setattr(collocations, "PART_WORDS", 300)
    docs = spark.createDataFrame(sayings, "doc_id int, text string, lang string").repartition(3)
    want = brute.phrases([(lang, t) for _, t, lang in sayings], 6)
    for bits in (24, 3):
        monkeypatch.setattr(collocations, "SLOT_BITS", bits)
        same(collocations.collocations(docs, 6), want, COLUMNS)


def test_packed_counts():
    import numpy as np

    from tidewater.llm.collocations import _pack, _unpack

    keys = np.array([-(1 << 63) + 1, -5, -5, 0, 7, 255, 256, 1 << 62])
    n = np.array([1, 2, 300, 1, 1 << 40, 5, 0, 9])
    got = _unpack(_pack(keys, n, -n), 3)
    assert [c.tolist() for c in got] == [keys.tolist(), n.tolist(), (-n).tolist()]


def test_answers_follow_the_order_sent():
    import numpy as np
    import pyarrow as pa

    from tidewater.llm.collocations import _answered, _dealt, _meet, _send, _slots

    rng = np.random.default_rng(3)
    keys = [np.unique(rng.integers(-40, 40, (60, 2)), axis=0) for _ in range(5)]
    said = [rng.integers(1, 9, len(k)) for k in keys]
    want = {}
    for k, n in zip(keys, said, strict=True):
        for (x, y), m in zip(k.tolist(), n.tolist(), strict=True):
            want[x, y] = want.get((x, y), 0) + m
    sent = pa.Table.from_batches([_send(shard, k[:, 0], k[:, 1], n, 3) for shard, (k, n) in enumerate(zip(keys, said, strict=True))])
    met = [_meet(6)(sent.filter(pa.compute.equal(sent["part"], part))).to_pylist() for part in range(3)]
    met = [r for rows in met for r in rows]
    ids = {(r["x"], r["y"]): r["id"] for r in met if r["shard"] is None}
    assert {(r["x"], r["y"]): r["f"] for r in met if r["shard"] is None} == {k: f for k, f in want.items() if f >= 6}
    assert len(set(ids.values())) == len(ids) > 5
    owned = []
    for shard, k in enumerate(keys):
        order, cuts = _dealt(_slots(k[:, 0], k[:, 1], 3)[0], k[:, 0], k[:, 1])
        at, got, first = _answered(cuts, {r["part"]: r["body"] for r in met if r["shard"] == shard})
        held = [tuple(x) for x in k[order[at]].tolist()]
        assert dict(zip(held, got.tolist(), strict=True)) == {key: ids[key] for key in map(tuple, k.tolist()) if key in ids}
        owned += [key for key, mine in zip(held, first.tolist(), strict=True) if mine]
    assert sorted(owned) == sorted(ids)


def test_products_past_64_bits(spark):
    from pyspark.sql import functions as F

    from tidewater.llm.collocations import _score

    a, parts = 10**14 + 1, 2 * 10**14 + 7
    row = spark.range(1).select(_score(F.lit(a), F.lit(parts)).alias("s")).collect()[0]
    assert row.s == 2000000 * a // parts and 2000000 * a > 1 << 63


def test_op11_over_the_corpus(docs, rows):
    from tidewater.llm.collocations import op11_collocations

    want = brute.phrases([(r[2], r[1]) for r in rows])
    assert want
    same(op11_collocations(docs), want, COLUMNS)


def test_nothing_frequent_and_empty(spark, empty):
    from tidewater.llm.collocations import op11_collocations

    assert op11_collocations(empty).count() == 0
    assert op11_collocations(spark.createDataFrame([("a b", "en")], "text string, lang string")).count() == 0
