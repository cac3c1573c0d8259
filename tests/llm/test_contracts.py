"""Every deterministic operator against its plain Python version, on rows with the awkward cases."""

import pytest

from tests.llm import brute, corpus


def plain(rows):
    return [(r[0], r[1]) for r in rows]


def same(df, want, columns):
    """Rows as a multiset; nulls last."""
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    want = sorted(want, key=key)
    assert [g for g, w in zip(got, want, strict=True) if g != w] == []


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    from tidewater.llm import token_counts

    path = token_counts.tokenizer_path()
    want = brute.tokens(plain(rows), Tokenizer.from_file(path))
    same(token_counts.op3_token_counts(docs), want, ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    # the same through the shuffled join alone
    same(token_counts.count_tokens(docs, path, head=1), [w[:3] for w in want], ["doc_id", "n_bytes", "n_tokens"])


def test_special_strings_in_texts(spark):
    from tokenizers import Tokenizer

    from tidewater.llm import token_counts

    texts = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> x", "don't we'll 123 4x5", "é ́e", "a\x1cb\x85c d", "<|endof text|>", "ﬁ ﷺ 🎉🎉 Ⅷ"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    want = brute.tokens(rows, Tokenizer.from_file(token_counts.tokenizer_path()))
    same(token_counts.op3_token_counts(docs), want, ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def test_substring_dedup(docs, rows):
    from tidewater.llm.substring_dedup import op4_substring_dedup

    want = brute.substrings(plain(rows))
    assert sum(w[2] > 0 for w in want) > 10
    same(op4_substring_dedup(docs), want, ["doc_id", "n_words", "n_removed", "kept_sha256"])


def test_cover_is_a_difference_cover():
    from tidewater.llm.substring_dedup import ANCHOR, COVER, PERIOD, WINDOW

    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))
    assert PERIOD - 1 + ANCHOR == WINDOW


def test_substring_meetings_do_not_depend_on_tasks(docs, rows):
    from tidewater.llm.substring_dedup import op4_substring_dedup

    want = brute.substrings(plain(rows))
    for parts in (1, 17):
        same(op4_substring_dedup(docs.repartition(parts)), want, ["doc_id", "n_words", "n_removed", "kept_sha256"])


def test_line_dedup(docs, rows):
    from tidewater.llm.line_dedup import op6_line_dedup

    want = brute.lines(plain(rows))
    assert sum(w[2] > 0 for w in want) > 5
    same(op6_line_dedup(docs), want, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def test_simhash(docs, rows):
    from tidewater.llm.simhash import op7_simhash_near_dedup

    same(op7_simhash_near_dedup(docs), brute.near_copies(plain(rows)), ["doc_id", "fingerprint", "component_id"])


def test_decontamination(docs, items, rows):
    from tidewater.llm.decontaminate import op8_decontaminate

    want = brute.benchmark(plain(rows), [(r[0], r[1]) for r in corpus.items(rows)])
    assert sum(w[2] > 0 for w in want) > 5 and {w[5] for w in want} == {True, False}
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same(op8_decontaminate(docs, items), want, columns)


def test_decontamination_in_blocks(docs, items, rows, monkeypatch):
    from tidewater.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 10)
    want = brute.benchmark(plain(rows), [(r[0], r[1]) for r in corpus.items(rows)])
    got = decontaminate.op8_decontaminate(docs, items)
    same(got, want, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def test_quality_rules(docs, rows):
    from tidewater.llm.quality_rules import op9_quality_rules, quality_filter

    want = brute.quality(plain(rows))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    same(op9_quality_rules(docs), want, columns)
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    same(kept, [(w[0],) for w in want if w[-1]], ["doc_id"])


def test_rule_order():
    from tidewater.llm.quality_rules import Rule, order_rules

    a, b, c = (Rule(n, None) for n in "abc")
    assert [r.name for r in order_rules([(a, 0.1, 1.0), (b, 0.1, 0.1), (c, 0.5, 1.0)])] == ["b", "c", "a"]


@pytest.mark.parametrize("op", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_empty_tables(spark, empty, op):
    from tidewater.llm import compression, decontaminate, line_dedup, mixing, quality_rules, simhash, substring_dedup, surrogates, token_counts, toxicity

    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    run = {
        "op1": lambda: surrogates.op1_pii_surrogates(empty),
        "op2": lambda: toxicity.op2_toxicity(empty, labels),
        "op3": lambda: token_counts.op3_token_counts(empty),
        "op4": lambda: substring_dedup.op4_substring_dedup(empty),
        "op5": lambda: compression.op5_compression_quality(empty, labels),
        "op6": lambda: line_dedup.op6_line_dedup(empty),
        "op7": lambda: simhash.op7_simhash_near_dedup(empty),
        "op8": lambda: decontaminate.op8_decontaminate(empty, items),
        "op9": lambda: quality_rules.op9_quality_rules(empty),
        "op10": lambda: mixing.op10_source_mix(empty),
    }
    assert run[op]().count() == 0


def test_empty_benchmark(spark, docs):
    from tidewater.llm.decontaminate import drop_contaminated, op8_decontaminate

    items = spark.createDataFrame([], "item_id bigint, text string")
    assert op8_decontaminate(docs, items).where("contaminated OR n_hit > 0").count() == 0
    assert drop_contaminated(docs, items).count() == docs.count()
