"""Repeated byte strings against every window counted one by one."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.test_contracts import plain, same

DIGEST = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def digest(rows):
    found = brute.repeated_bytes([t for _, t in rows])
    return [(i, n, n - len(kept), len(spans), brute.sha(kept)) for (i, _), (n, spans, kept) in zip(rows, found, strict=True)]


def noise(rng, n, letters="abcdefghij klmnoé"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """Passages of 399, 400, 401 and more bytes, at every kind of border."""
    rng = random.Random(4)
    ascii_ = "abcdefghij klmno"
    texts = [noise(rng, rng.randint(300, 2500)) for _ in range(12)]
    for n in (399, 400, 401, 447, 530, 900):
        passage = noise(rng, n, ascii_)
        texts += [passage, noise(rng, 31) + passage, noise(rng, 777) + passage + noise(rng, 500), passage + noise(rng, 90)]
    long = noise(rng, 1500, ascii_)
    texts += [long, long, long[:700] + "#" + long[700:], long[200:1100], noise(rng, 60) + long[399:805] + noise(rng, 60) + long[900:1301]]
    texts += [noise(rng, 50) + long[k : k + 400 + k % 3] + noise(rng, 50) for k in range(0, 1000, 83)]
    texts += [long[300:900] + noise(rng, 20) + long[300:900]]  # inside one document
    texts += ["x" * 399, "x" * 400, "ab" * 700, "ba" * 450, "abc" * 134, ("y" * 450 + "z") * 4, "", None, "kurz", "é" * 350, "\n" * 402, "w " * 1500]
    rows = list(enumerate(texts))
    rows += [(3, "again " + long[500:950]), (None, texts[20]), (None, None), rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


def test_planted_passages(spark, planted):
    from tidewater.llm.suffix_dedup import op13_suffix_dedup

    want = digest(planted)
    assert sum(w[2] > 0 for w in want) > 30 and max(w[3] for w in want) > 1
    for parts in (1, 5):
        docs = spark.createDataFrame(planted, "doc_id int, text string").repartition(parts)
        same(op13_suffix_dedup(docs), want, DIGEST)


def test_many_shards(spark, planted, monkeypatch):
    from tidewater.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    docs = spark.createDataFrame(planted, "doc_id int, text string").repartition(2)
    same(suffix_dedup.op13_suffix_dedup(docs), digest(planted), DIGEST)


def test_op13_over_the_corpus(docs, rows):
    from tidewater.llm.suffix_dedup import op13_suffix_dedup

    same(op13_suffix_dedup(docs), digest(plain(rows)), DIGEST)


def test_columns_stay_and_spans_are_real(spark):
    from tidewater.llm.suffix_dedup import removal_column, remove_repeats

    rng = random.Random(2)
    passage = noise(rng, 450)
    texts = [noise(rng, 100) + passage, passage + noise(rng, 30), None]
    rows = [(k, t, "own", [k], 1.5, "p") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, repeats string, task array<int>, shard double, Docs string")
    done = remove_repeats(docs)
    name = removal_column(docs)
    assert name == "repeats_" and done.columns == [*docs.columns, name]
    got = {r["doc_id"]: r for r in done.collect()}
    for k, (n, spans, kept) in enumerate(brute.repeated_bytes(texts)):
        r = got[k]
        assert (r["repeats"], r["task"], r["shard"], r["Docs"], r["text"]) == ("own", [k], 1.5, "p", texts[k])
        assert (r[name]["n_bytes"], [tuple(s) for s in r[name]["spans"]], bytes(r[name]["kept"])) == (n, spans, kept)


def test_anchors_depend_on_the_bytes_around_them():
    from tidewater.llm.suffix_dedup import DEPTH, LENGTH, anchors

    rng = random.Random(6)
    for _ in range(40):
        string = noise(rng, 400, rng.choice(["ab", "a", "abcdefgh"])).encode()
        inside = []
        for _ in range(2):
            before = noise(rng, rng.randint(0, 300)).encode()
            places, firsts = anchors(before + string + noise(rng, rng.randint(0, 300)).encode())
            # those that windows inside the string have chosen
            ends = np.r_[firsts[1:], len(before) + 10**6] - 1
            ok = (ends >= len(before)) & (firsts <= len(before) + LENGTH - 16 - 96 + 1)
            inside.append((places[ok] - len(before)).tolist())
        assert inside[0] == inside[1] and len(inside[0]) > DEPTH


def test_long_texts_are_hashed_in_parts(monkeypatch):
    from tidewater.llm import suffix_dedup

    text = noise(random.Random(3), 20_000).encode()
    whole = [a.tolist() for a in suffix_dedup.anchors(text)]
    monkeypatch.setattr(suffix_dedup, "PART", 1000)
    assert [a.tolist() for a in suffix_dedup.anchors(text)] == whole


def test_empty_table(empty):
    from tidewater.llm.suffix_dedup import op13_suffix_dedup

    assert op13_suffix_dedup(empty).count() == 0
