"""The pipeline's operators on clashing column names, repeated and null ids, and nothing at all."""

import pytest

PASSAGE = " ".join(f"wort{k}" for k in range(60))
LINE = "one line that many documents share"
CLASHES = ["__id", "__drops", "__n_lines", "__key", "__order", "__places", "__runs", "copy_no", "line_id", "bad_key", "near_id", "mix_key", "window_order", "id", "key", "fp", "n"]


@pytest.fixture(scope="module")
def awkward(spark):
    texts = [(1, f"{LINE}\n{PASSAGE}"), (2, f"{LINE}\n{PASSAGE}"), (2, "a clean other text " + " ".join(f"andere{k}" for k in range(40))),
             (None, f"{LINE}\n{PASSAGE}"), (None, "kept without an id " + " ".join(f"ohne{k}" for k in range(40))), (4, None), (4, None), (5, "")]
    rows = [(i, t, "en", "web", 0, *[f"own {k}" for k in range(len(CLASHES))]) for i, t in texts]
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {names}")


def own(docs, rows):
    """Every row still has its own values in the extra columns."""
    return all(r[c] == f"own {k}" for r in rows for k, c in enumerate(CLASHES))


def test_near_copies_go_by_id_and_text(awkward):
    from tidewater.llm.simhash import drop_near_duplicates

    rows = drop_near_duplicates(awkward).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:12]) for r in rows)
    # the clean text under id 2 stays, the null-id copy of document 1 goes, empty and null texts are one class
    assert kept == [(False, 1, LINE[:12]), (False, 2, "a clean othe"), (False, 4, ""), (True, 0, "kept without")]
    assert own(awkward, rows)


def test_lines_substrings_contamination_and_mix_keep_columns(spark, awkward):
    from tidewater.llm import decontaminate, line_dedup, mixing, substring_dedup

    items = spark.createDataFrame([(7, PASSAGE, "x"), (None, "andere1 andere2 andere3", "x")], "item_id bigint, text string, __key string")
    lines = line_dedup.dedup_lines(awkward).collect()
    assert own(awkward, lines) and len(lines) == 8
    assert sorted(LINE in (r.text or "") for r in lines) == [False] * 7 + [True]
    cut = substring_dedup.dedup_substrings(awkward).collect()
    assert own(awkward, cut) and sum("wort5 " in (r.text or "") for r in cut) == 1
    clean = decontaminate.drop_contaminated(awkward, items).collect()
    # an item without an id hits, too: 3 of 44 words are over one in twenty
    assert own(awkward, clean) and sorted((r.doc_id is None, r.doc_id or 0) for r in clean) == [(False, 4), (False, 4), (False, 5), (True, 0)]
    mixed = mixing.draw_mix(awkward)
    rows = mixed.collect()
    assert mixed.columns == [*awkward.columns, "copy_no_"] and own(awkward, rows) and rows


def test_items_without_an_id_hit_without_being_listed(spark):
    from tests.llm import brute
    from tidewater.llm.decontaminate import op8_decontaminate

    items = [(None, "alpha beta"), (3, "gamma"), (None, None)]
    rows = [(1, "alpha beta und mehr"), (2, "gamma alpha beta"), (3, "nichts")]
    got = op8_decontaminate(spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    want = brute.benchmark(rows, items)
    assert [(w[2], w[3], w[5]) for w in want] == [(2, 0, True), (3, 1, True), (0, 0, False)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_empty_documents_through_the_whole_pipeline(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "x y")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
