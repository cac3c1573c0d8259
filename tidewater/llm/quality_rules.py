"""Quality rules as a short-circuit cascade (DataFrame functions only).

A rule is a name and a boolean column that is true where it rejects.  The
cascade times every rule and counts its rejections on a sample, orders the
rules by rejection per cost, and evaluates them as one CASE expression:
Spark evaluates a later branch only for documents that no earlier rule
rejected.  The order never changes the verdict (a document is kept if no
rule rejects it), only the work.

All measures stay inside one document's row: no shuffle, no join.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE, let, scratch, text_of, words_of

#: Words of a window of ``repeat_words``.
REPEAT_WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
#: Documents (about) on which costs and rejections are estimated; they set the order of the rules, not a verdict.
SAMPLE_ROWS = 2000
SAMPLE_SEED = 7
#: Passes of a timed rule, and the least cost in seconds (below it, differences are those of the clock).
TIMED = 3
LEAST_COST = 1e-3


@dataclass(frozen=True)
class Rule:
    """``reject(text, words)``: true where the rule rejects the document."""

    name: str
    reject: Callable[[Column, Column], Column]


def repeat_words(words: Column, width: int = REPEAT_WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text.

    Equal windows have equal hashes, so a document whose window hashes are
    all distinct has none (one hash set).  The others sort (two independent
    hashes, place) once, keep the places whose neighbour has both hashes, and
    add up the words that each place adds beyond the place before.
    """
    n = F.size(words)
    places = F.sequence(F.lit(0), n - width)

    def at(i: Column) -> list[Column]:
        return [F.get(words, i + j) for j in range(width)]

    def covered(keyed: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return (a["x"] == b["x"]) & (a["y"] == b["y"])

        def twin(j: Column) -> Column:
            here = F.get(keyed, j)
            return F.coalesce(same(here, F.get(keyed, j - 1)), F.lit(False)) | F.coalesce(same(here, F.get(keyed, j + 1)), F.lit(False))

        twins = F.filter(F.sequence(F.lit(0), F.size(keyed) - 1), twin)
        found = F.array_sort(F.transform(twins, lambda j: F.get(keyed, j)["p"]))
        start = F.struct(F.lit(0).alias("sum"), F.lit(-width).alias("last"))
        return F.aggregate(
            found,
            start,
            lambda acc, p: F.struct((acc["sum"] + F.least(F.lit(width), p - acc["last"])).alias("sum"), p.alias("last")),
            lambda acc: acc["sum"],
        )

    def check(hashes: Column) -> Column:
        keyed = F.transform(
            places, lambda i: F.struct(F.get(hashes, i).alias("x"), F.xxhash64(F.lit(1), *at(i)).alias("y"), i.alias("p"))
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(keyed), covered)
        )

    hashes = F.transform(places, lambda i: F.xxhash64(*at(i)))
    return F.when(n < width + 1, F.lit(0)).otherwise(let(hashes, check))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


#: Production rules.  The first two are the base rules of the digest.
BASE_RULES = (
    Rule("too_few_words", lambda text, words: F.size(words) < 10),
    Rule("repeated_windows", lambda text, words: 100 * repeat_words(words) > 20 * F.size(words)),
)
MORE_RULES = (
    Rule("symbols", lambda text, words: 10 * symbols(text) > 3 * F.size(words)),
    Rule("long_words", lambda text, words: word_chars(words) > 60 * F.size(words)),
    Rule("repeated_lines", lambda text, words: 10 * repeated_lines(text) > 5 * F.size(F.split(text, "\n"))),
)
RULES = BASE_RULES + MORE_RULES


def estimate(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds) of every rule on a random sample of about ``sample_rows`` documents.

    A rule's cost is what its job takes beyond one that reads the same columns and judges nothing, each timed as
    the shortest of ``TIMED`` passes.
    """
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = scratch(docs.select(text_of().alias("t")).sample(fraction=share, seed=SAMPLE_SEED).withColumn("w", words_of(F.col("t"))), "rules-sample")

    def timed(hit: Column) -> tuple[float, float]:
        share, spent = 0.0, []
        for _ in range(TIMED):
            began = time.perf_counter()
            row = sample.agg(F.avg(F.coalesce(hit, F.lit(False)).cast("double")).alias("rejects")).first()
            spent.append(time.perf_counter() - began)
            share = float(row["rejects"] or 0.0)
        return share, min(spent)

    _, nothing = timed(F.length("t") + F.size("w") < 0)
    found = [(rule, *timed(rule.reject(F.col("t"), F.col("w")))) for rule in rules]
    return [(rule, rejects, max(0.0, spent - nothing)) for rule, rejects, spent in found]


def order_rules(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, the best first; ties by name."""
    return [r for r, _, _ in sorted(estimates, key=lambda x: (-x[1] / max(x[2], LEAST_COST), x[0].name))]


def cascade(text: Column, words: Column, rules: list[Rule]) -> Column:
    """Name of the first rule, in this order, that rejects; null where none does."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(F.coalesce(rule.reject(text, words), F.lit(False)), F.lit(rule.name)).otherwise(chain)
    return chain


def verdict(rules: list[Rule]) -> Column:
    """The cascade over column text; the words are split once, wherever the optimizer moves this."""
    return let(words_of(text_of()), lambda words: cascade(text_of(), words, rules))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` and ``rejected_by``: the rule that rejects the document, null if it is kept.

    ``rejected_by`` names the first rule in the estimated order, so where two
    rules reject a document a rerun may name the other one; whether it is
    null never changes.  Defined cases: a null or empty text has no words and
    falls to ``too_few_words``; repeated rows are judged alike; an empty table
    gives an empty result; extra columns stay (a column ``rejected_by`` is
    replaced).
    """
    return docs.withColumn("rejected_by", verdict(order_rules(estimate(docs, rules, sample_rows))))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents that no rule rejects, with their own columns."""
    return docs.where(verdict(order_rules(estimate(docs, rules, sample_rows))).isNull())


def op9_quality_rules(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, the base measures, base_failed and kept.

    The measures are wanted of every document, so they are evaluated once as
    columns and the cascade runs over them.
    """
    over = {
        "symbols": lambda text, words: 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "long_words": lambda text, words: F.col("word_chars") > 60 * F.col("n_words"),
        "repeated_lines": lambda text, words: 10 * F.col("n_dup_lines") > 5 * F.size(F.split(text, "\n")),
    }
    ordered = order_rules(estimate(docs, RULES))
    words = F.col("__words")
    measured = docs.select("doc_id", text_of().alias("__text")).withColumn("__words", words_of(F.col("__text")))
    measured = measured.select(
        "doc_id",
        "__text",
        words.alias("__words"),
        F.size(words).cast("bigint").alias("n_words"),
        word_chars(words).cast("bigint").alias("word_chars"),
        symbols(F.col("__text")).cast("bigint").alias("n_symbols"),
        repeated_lines(F.col("__text")).cast("bigint").alias("n_dup_lines"),
        repeat_words(words).cast("bigint").alias("n_repeat_words"),
    )
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rest = [Rule(r.name, over[r.name]) for r in ordered if r.name in over]
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & cascade(F.col("__text"), words, rest).isNull()).alias("kept"),
    )
