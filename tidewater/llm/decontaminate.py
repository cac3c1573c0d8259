"""Benchmark decontamination as a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into windows of ``WINDOW`` consecutive words
(an item with fewer words is one window).  A window is the set of its
shingles of ``SHINGLE`` words; a document contains the window only if it
contains all of them, so for containment of 1 the necessary prefix of a
window, with its shingles in the order of rarity, is its rarest shingle.

1. Count over all documents how often each benchmark shingle occurs (a
   global order of rarity).
2. Join the documents' shingles with the windows' prefix shingles.
3. Bounds: the window must lie inside the document when its shingle is laid
   on the document's (position), and fit with its length.
4. Verify: the document's words there equal the window's.

The documents are never shuffled for this: the benchmark side is broadcast in
blocks of at most ``BLOCK_WINDOWS`` windows (a fixed size each), and as many
blocks are run as the benchmark needs.  Only found occurrences are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import free_name, id_order, scratch, text_of

WINDOW = 13
SHINGLE = 3
#: Windows broadcast at once: about 300 bytes each.
BLOCK_WINDOWS = 100_000
#: Share of a document's words that must be hit: 1 in CONTAMINATED.
CONTAMINATED = 20
#: Runs of characters that belong to no word (ASCII other than letters and digits).
BREAK_RUN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def az_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def pieces(text: Column) -> Column:
    """Words as written; an empty first or last element where the text begins or ends between words."""
    return F.split(text, BREAK_RUN)


def count_words(parts: Column) -> Column:
    empty_end = (F.size(parts) > 1) & (F.element_at(parts, -1) == "")
    return F.size(parts) - (F.get(parts, F.lit(0)) == "").cast("int") - empty_end.cast("int")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: wid, content, words, len; items: wid, item).

    Items without a word have no window; rows of one item_id are one item.  The windows of items
    without an id hit like any other, and have no item.
    """
    words = F.filter(pieces(az_lower(text_of())), lambda x: x != "")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
    items = items.where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = items.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, window))).alias("words"))
    cut = cut.select("item", F.array_join("words", " ").alias("content"), "words")
    # the pair of independent hashes names a window's content
    cut = cut.withColumn("wid", F.struct(F.xxhash64("content").alias("x"), F.xxhash64(F.lit(1), "content").alias("y")))
    windows = cut.groupBy("wid").agg(F.first("content").alias("content"), F.first("words").alias("words"))
    windows = windows.withColumn("len", F.size("words"))
    return scratch(windows, "windows"), scratch(cut.where("item IS NOT NULL").select("wid", "item").distinct(), "items")


def _shingles(windows: DataFrame, width: int) -> DataFrame:
    """wid, h, off of every shingle; windows shorter than ``width`` words are one shingle of their own width."""
    def hashed(i: Column) -> Column:
        # lower() is coarser than A-Z lowering: equal words have equal hashes
        return F.struct(F.xxhash64(*[F.lower(F.get(F.col("words"), i + j)) for j in range(width)]).alias("h"), i.alias("off"))

    fits = F.col("len") >= width if width == SHINGLE else F.col("len") == width
    spans = F.transform(F.sequence(F.lit(0), F.col("len") - width), hashed)
    return windows.where(fits).select("wid", F.inline(spans))


def _document_shingles(docs: DataFrame, width: int) -> DataFrame:
    """h, pos, parts and the document's columns, a row for each position; stays in the map stage."""
    at = docs.select("*", F.posexplode("parts").alias("pos", "word"))
    rest = [F.lower(F.get(F.col("parts"), F.col("pos") + j)) for j in range(1, width)]
    return at.withColumn("h", F.xxhash64(F.lower("word"), *rest))


def _blocks(df: DataFrame, rows: int, per_block: int) -> list[DataFrame]:
    """``df`` cut by a hash of its wid into parts of about ``per_block`` rows at most."""
    n = max(1, -(-rows * 2 // per_block)) if rows > per_block else 1
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64("wid"), F.lit(n)) == k) for k in range(n)]


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Every occurrence of a window in a document: id, key, n_words, start, len, wid.

    ``docs``: columns id, text.  ``start`` counts the document's parts; ``key``
    tells texts under one id apart.
    """
    spark = docs.sparkSession
    rows = windows.count()
    widths = sorted({min(r["len"], SHINGLE) for r in windows.select("len").distinct().collect()})
    parted = docs.select("id", "text", pieces(F.col("text")).alias("parts"))
    found = []
    for width in widths:
        for block in _blocks(windows, rows, BLOCK_WINDOWS):
            shingles = scratch(_shingles(block, width), "shingles")
            distinct = shingles.select("h").distinct()
            seen = _document_shingles(parted, width).join(F.broadcast(distinct), "h").groupBy("h").agg(F.count("*").alias("n"))
            rare = shingles.join(seen, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            first = rare.groupBy("wid").agg(F.min(F.struct("n", "h", "off")).alias("p")).where("p.n > 0")
            prefix = scratch(
                first.join(block, "wid").select(F.col("p.h").alias("ph"), F.col("p.off").alias("off"), "wid", "content", "len"), "prefix"
            )
            start = F.col("pos") - F.col("off")
            hit = (
                _document_shingles(parted, width)
                .join(F.broadcast(prefix), F.col("h") == F.col("ph"))
                .where((start >= 0) & (start + F.col("len") <= F.size("parts")))
                .where(az_lower(F.array_join(F.slice("parts", start + 1, F.col("len")), " ")) == F.col("content"))
            )
            found.append(
                hit.select("id", F.xxhash64("text").alias("key"), count_words(F.col("parts")).alias("n_words"), start.alias("start"), "len", "wid")
            )
    if not found:
        empty = "id bigint, key bigint, n_words int, start int, len int, wid struct<x: bigint, y: bigint>"
        return spark.createDataFrame([], empty)
    return scratch(reduce(DataFrame.unionByName, found), "occurrences")


def hits(occ: DataFrame, items: DataFrame) -> DataFrame:
    """Per document with an occurrence: id, key, n_words, n_hit, n_items, item_ids (sorted strings)."""
    spans = occ.groupBy("id", "key", "n_words", "start").agg(F.max("len").alias("len"))
    before = Window.partitionBy("id", "key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max(F.col("start") + F.col("len")).over(before), F.lit(0))
    new = F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest("start", done))
    words = spans.withColumn("new", new).groupBy("id", "key", "n_words").agg(F.sum("new").alias("n_hit"))
    which = occ.select("id", "key", "wid").distinct().join(items, "wid").select("id", "key", "item").distinct()
    which = which.groupBy("id", "key").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    found = words.join(which, ["id", "key"], "left").withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
    return found.withColumn("n_items", F.size("item_ids"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (CONTAMINATED * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    Defined cases: a null or empty text has no words and is clean; an empty
    benchmark hits nothing; an item of fewer than ``window`` words is one
    window; items without words are left out; windows of items without item_id
    count for n_hit and contaminated, not for n_items; repeated rows get a row each; rows under one doc_id (null included) with different
    texts are judged apart; extra columns are ignored.
    """
    windows, items = benchmark_windows(benchmark, window)
    base = docs.select("doc_id", id_order().alias("id"), text_of().alias("text"))
    found = scratch(hits(occurrences(base, windows), items), "hits").drop("n_words")
    counted = base.select("doc_id", "id", F.xxhash64("text").alias("key"), pieces(F.col("text")).alias("parts"))
    counted = counted.select("doc_id", "id", "key", count_words(F.col("parts")).cast("bigint").alias("n_words"))
    out = counted.join(found, ["id", "key"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    windows, items = benchmark_windows(benchmark, window)
    base = docs.select(id_order().alias("id"), text_of().alias("text"))
    found = hits(occurrences(base, windows), items).where(contaminated(F.col("n_hit"), F.col("n_words")))
    id_, key = free_name(docs, "bad_id"), free_name(docs, "bad_key")
    bad = scratch(found.select(F.col("id").alias(id_), F.col("key").alias(key)), "contaminated")
    same = (id_order() == F.col(id_)) & (F.xxhash64(text_of()) == F.col(key))
    return docs.join(bad, same, "left_anti")


def op8_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )
