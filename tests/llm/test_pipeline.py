"""The pipeline, stage by stage, against brute force; and the registered queries."""

import importlib
from collections import defaultdict

from tests.llm import brute
from tidewater.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    import corpus_pipeline

    rows = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    text = {i: r["text"] for i, r in rows.items()}
    kept = {w[0] for w in brute.quality(list(text.items())) if w[-1]}
    text = {i: b"\n".join(b).decode() for i, _, b in brute.kept_lines([(i, text[i]) for i in text if i in kept])}
    text = {i: text[i] for i, _, c in brute.near_copies(list(text.items())) if i == c}
    text = {i: text[i] for i, *_, bad in brute.benchmark(list(text.items()), items) if not bad}

    docs = table(spark, SF, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == text
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["text"] for r in got} <= set(text.values())
    size, taken, times = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t in text.items():
        size[rows[i]["source"]] += len(brute.WORD.findall(t.encode()))
    for r in got:
        taken[r["source"]] += len(brute.WORD.findall(r["text"].encode()))
        times[r["doc_id"]] = max(times[r["doc_id"]], r["copy_no"])
    most = max(len(t.split()) for t in text.values())
    for source, target in brute.targets(dict(size)).items():
        assert abs(taken[source] - target) <= most
    assert sum(times.values()) == len(got) and max(times.values()) <= 3


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
