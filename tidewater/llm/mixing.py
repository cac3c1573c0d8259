"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Every source gets a target number of words.  A source whose target is r
times its size gives floor(r) certain whole copies of every document; the
rest of its target is filled by a sample without replacement that takes
documents in the order of

    (u / (1 - u)) / (odds of inclusion)

with u a keyed hash of the document, until the words asked for are taken.
The sample size is thus fixed (in words), the inclusion unequal: it follows
the odds p / (1 - p) of the source's share p still to be taken, times
(size / mean size of the source) ** ``POWER``, times the document's own
``odds`` if a column is given.  With a power of one half a source's sample is
neither mostly its fragments nor decided by its few longest texts.

Skew: no step gathers a source in one task.  Words are summed per source
(partial sums first) and per (source, slice of the order); whole slices are
taken from those sums, and only the one slice per source in which the target
falls is ranked document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import free_name, scratch, text_of, words_of

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20_240_501
#: Odds of inclusion grow with this power of a document's size in words (0: all alike).
POWER = 0.5
#: Slices of a source's order; a slice holds a source's rows / SLICES.
SLICES = 4096
#: Passes: the sample, then documents small enough for what is left.
PASSES = 3


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: source, source_size, n_texts (documents with words), target.

    Sources in code point order, null last, take ``weights`` in turn and
    share all words by weight.  A target stops at ``max_copies`` times the
    source's size; what it cannot take is shared again by weight among the
    others.  That ends at one level of words per unit of weight: with the
    sources in the order of size / weight, it is the level at the first
    source that stays below its stop when all before it are at theirs.
    The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_texts"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((turn - 1) % len(weights)).cast("int"))
    per = per.withColumn("turn", turn).withColumn("w", weight.cast("bigint"))
    per = per.withColumn("stop", F.col("source_size") * max_copies)
    order = Window.orderBy(F.col("source_size") / F.col("w"), "turn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    shared = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", rest.cast("double") / shared.cast("double"))
    below = F.when(F.col("stop") >= F.col("level") * F.col("w"), F.struct("source_size", "turn", "level"))
    first = F.first(below, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = first["level"] * F.col("w")
    return per.select(
        "source", "source_size", "n_texts", F.least(F.col("stop").cast("double"), share).alias("target")
    )


def _take(left: DataFrame, need: DataFrame) -> DataFrame:
    """Rows of ``left`` (k, source, size, q) taken in the order of q while their words fit ``need`` (source, words)."""
    left = left.join(need, left["source"].eqNullSafe(need["nsource"])).where(F.col("size") <= F.col("words")).drop("nsource")
    left = left.withColumn("slice", F.floor(F.col("q") / (F.col("q") + 1) * SLICES).cast("int"))
    sums = left.groupBy("source", "slice").agg(F.sum("size").alias("s"), F.max("words").alias("words"))
    run = F.sum("s").over(Window.partitionBy("source").orderBy("slice"))
    cut = (
        sums.withColumn("upto", run)
        .where(F.col("upto") > F.col("words"))
        .groupBy(F.col("source").alias("csource"))
        .agg(F.min(F.struct("slice", (F.col("upto") - F.col("s")).alias("before"))).alias("cut"))
    )
    cut = scratch(cut.coalesce(1), "cut")  # a row per source: its size is known when the join is planned
    left = left.join(cut, left["source"].eqNullSafe(cut["csource"]), "left").drop("csource")
    whole = left.where(F.col("cut").isNull() | (F.col("slice") < F.col("cut.slice")))
    ranked = left.where(F.col("slice") == F.col("cut.slice")).withColumn(
        "upto", F.col("cut.before") + F.sum("size").over(Window.partitionBy("source", "slice").orderBy("q", "k").rowsBetween(Window.unboundedPreceding, 0))
    )
    part = ranked.where(F.col("upto") <= F.col("words"))
    return whole.select("k", "source", "size").unionByName(part.select("k", "source", "size"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
    odds: Column | None = None,
    power: float = POWER,
) -> DataFrame:
    """Copies of every document for a mix with the targets of ``source_targets``.

    ``docs``: doc_id, text, source.  Returns per document: doc_id, size
    (words; null text 0), source, source_size, target, copies, taken
    (size * copies), row_key (a key of doc_id, text and source).

    Defined cases: an empty table gives an empty result; documents without
    words have size 0, copies floor(target / source_size) of their source (0
    if the source has no words) and take nothing; a null source is a source;
    rows that agree in doc_id, source and text share one draw, so they are
    taken together or not at all, each counted; a null doc_id is drawn by
    its text.  ``odds`` are positive relative odds of a document in its
    source (null or none: 1), on top of those by size.  Which copies are sampled is a
    draw: a document's chance p has the odds p / (1 - p) that its size and ``odds`` ask for.

    After the sample, what is left of a target is below the next document's
    size; two more passes take, in the same order, documents that still fit.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", "source", text_of())
    size = F.size(words_of(text_of())).cast("bigint")
    own = F.coalesce(odds, F.lit(1.0)) if odds is not None else F.lit(1.0)
    sized = scratch(docs.select("doc_id", "source", size.alias("size"), key.alias("k"), own.cast("double").alias("own")), "sized")
    targets = scratch(source_targets(sized, weights, max_copies).coalesce(1), "targets")

    nonzero = F.nullif(F.col("source_size"), F.lit(0))
    plan = targets.withColumn("whole", F.coalesce(F.floor(F.col("target") / nonzero), F.lit(0)).cast("bigint"))
    plan = plan.withColumn("need", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("bigint"))
    # inclusion probability of the sampled copy; odds are kept finite for p = 0 and 1
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("need") / nonzero))
    mean = F.col("source_size") / F.nullif(F.col("n_texts"), F.lit(0))
    plan = plan.withColumn("odds", p / (1 - p) / F.pow(mean, F.lit(power)))
    plan = plan.select(F.col("source").alias("psource"), "source_size", "target", "whole", "need", "odds")

    # one row per draw: identical rows count as one document of their summed size
    draws = sized.where("size > 0").groupBy("k", "source").agg(F.sum("size").alias("size"), F.max(F.col("own") * F.pow("size", F.lit(power))).alias("own"))
    u = (F.pmod(F.xxhash64(F.lit(seed + 1), "k"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    draws = draws.join(plan, draws["source"].eqNullSafe(plan["psource"])).where("need > 0")
    draws = scratch(draws.select("k", "source", "size", (u / (1 - u) / (F.col("odds") * F.col("own"))).alias("q")), "draws")

    need = scratch(plan.select(F.col("psource").alias("nsource"), F.col("need").alias("words")).coalesce(1), "need")
    taken, left = None, draws
    for _ in range(PASSES):
        got = scratch(_take(left, need), "taken")
        taken = got if taken is None else taken.unionByName(got)
        sums = got.groupBy(F.col("source").alias("gsource")).agg(F.sum("size").alias("got"))
        need = scratch(
            need.join(sums, need["nsource"].eqNullSafe(sums["gsource"]), "left")
            .select("nsource", (F.col("words") - F.coalesce("got", F.lit(0))).alias("words"))
            .where("words > 0")
            .coalesce(1),
            "need",
        )
        left = left.join(got.select("k"), "k", "left_anti")
    extra = taken.select("k", F.lit(1).alias("extra"))
    out = sized.join(plan, sized["source"].eqNullSafe(plan["psource"]), "left").join(extra, "k", "left")
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return out.select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        copies.cast("int").alias("copies"),
        (F.col("size") * copies).alias("taken"),
        F.col("k").alias("row_key"),
    )


def draw_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every column of ``docs``, one row per copy, and copy_no (1, 2, ...; copy_no_ if docs has that).

    Documents without a copy go.  The decisions come back to the texts by a
    join on the row key; identical rows share one decision.
    """
    seed = options.get("seed", SEED)
    key, copies, drawn = (free_name(docs, n) for n in ("mix_key", "mix_copies", "mix_drawn"))
    chosen = mix_sources(docs, **options).where("copies > 0").groupBy(F.col("row_key").alias(drawn)).agg(F.max("copies").alias(copies))
    keyed = docs.withColumn(key, F.xxhash64(F.lit(seed), "doc_id", "source", text_of()))
    joined = keyed.join(chosen, F.col(key) == F.col(drawn))
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(free_name(docs, "copy_no")))


def op10_source_mix(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, size, source_size, target, taken; and source, copies."""
    return mix_sources(docs).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )
