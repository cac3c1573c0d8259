"""Components, posting lists and links of SimHash."""

import random

from tidewater.llm import simhash
from tidewater.llm.components import components


def union(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    pairs += [(1000 + k, 1001 + k) for k in range(120)]  # a chain
    pairs += [(2000, 2001 + k) for k in range(300)] + [(5, 5), (1000, 1001)]  # a star, a loop, a repeated edge
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: r for x, r in union(pairs).items() if x != r}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_connect_what_two_bits_connect(spark, monkeypatch):
    rng = random.Random(2)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(200)} | {0, 3, 7}
    for _ in range(150):  # a crowd around one value, and pairs at one to three bits
        values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2]))))
        v = rng.getrandbits(64)
        values |= {v, v ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))}
    values = sorted(values)
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2]
    want = union([(signed(a), signed(b)) for a, b in near])
    classes = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    for bound in (1, 8, 64):  # all lists long, some, hardly any
        monkeypatch.setattr(simhash, "LIST_BOUND", bound)
        edges = [(r["a"], r["b"]) for r in simhash.links(classes).collect()]
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
        assert union(edges) == want


def test_position_sets_meet_every_pair():
    for i in range(8):
        for j in range(8):
            assert any(i not in s and j not in s for s in simhash.POSITION_SETS)


def test_one_document_of_each_group_stays(spark, docs):
    found = simhash.near_duplicates(docs)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted({r["component_id"] for r in found.collect() if r["component_id"] is not None})
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == want
