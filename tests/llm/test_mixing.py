"""Targets and sampling of the source mix."""

from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm import brute
from tidewater.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def sizes(rows):
    out = defaultdict(int)
    for r in rows:
        out[r["source"]] += r["size"]
    return dict(out)


def check(rows, slack):
    want = brute.targets(sizes(rows))
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes(rows)[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1.0, r["target"])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= slack + 0.5, (source, taken[source], target)


def test_awkward_rows(docs, rows):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    check(got, max(r["size"] for r in got))


def test_hot_source_comes_near_its_target(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "trim(repeat('word ', cast(1 + pmod(xxhash64(id), 40) AS int))) AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source"
    )
    got = mixing.mix_sources(docs).collect()
    check(got, 3)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    other = mixing.mix_sources(docs, seed=1).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) != sorted((r["doc_id"], r["taken"]) for r in other)


def test_stops_are_shared_again(spark):
    rows = [(k, "w " * 10, "a") for k in range(3)] + [(10 + k, "w " * 10, "b") for k in range(40)] + [(100 + k, "w " * 10, None) for k in range(60)] + [(500, "", "c"), (501, None, "d")]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, 10)
    assert {r["copies"] for r in got if r["source"] == "a"} == {3}
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)


def test_inclusion_follows_the_size(spark):
    """Chances of short and long documents: their odds differ by the root of their sizes' ratio, over many draws."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "trim(repeat('w ', CASE WHEN id % 3 = 0 THEN 36 ELSE 4 END)) AS text", "CASE WHEN id % 10 < 5 THEN 'a' ELSE 'b' END AS source")
    said = {r["doc_id"]: r["size"] for r in mixing.mix_sources(docs, weights=(1, 3)).collect()}
    taken, met = defaultdict(int), defaultdict(int)
    for seed in (1, 2, 3):
        rows = mixing.mix_sources(docs, weights=(1, 3), seed=seed).where("source = 'a'").collect()
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 4.5
        for r in rows:
            met[said[r["doc_id"]]] += 1
            taken[said[r["doc_id"]]] += r["copies"]
    odds = {size: (taken[size] / met[size]) / (1 - taken[size] / met[size]) for size in (4, 36)}
    assert 2.4 < odds[36] / odds[4] < 3.75  # (36 / 4) ** 0.5 = 3
    alike = mixing.mix_sources(docs, weights=(1, 3), power=0.0).where("source = 'a'").collect()
    shares = {size: sum(r["copies"] for r in alike if r["size"] == size) / sum(1 for r in alike if r["size"] == size) for size in (4, 36)}
    assert 0.8 < shares[36] / shares[4] < 1.25


def test_unequal_odds(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c d' AS text", "concat('s', id % 3) AS source", "CASE WHEN id % 2 = 0 THEN 8.0 ELSE 1.0 END AS o")
    got = mixing.mix_sources(docs, weights=(3, 1, 1), odds=F.col("o")).collect()
    extra = defaultdict(list)
    for r in got:
        if r["source"] == "s1":
            extra[r["doc_id"] % 2].append(r["copies"])
    assert sum(extra[0]) > 1.5 * sum(extra[1])


def test_drawn_rows(docs):
    copies = defaultdict(int)
    for r in mixing.mix_sources(docs).collect():
        copies[r["doc_id"], r["source"]] += r["copies"]
    drawn = mixing.draw_mix(docs)
    assert drawn.columns == [*docs.columns, "copy_no"]
    got = defaultdict(int)
    for r in drawn.collect():
        got[r["doc_id"], r["source"]] += 1
    assert dict(got) == {k: v for k, v in copies.items() if v}


def test_no_words_at_all(spark):
    got = mixing.mix_sources(spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
