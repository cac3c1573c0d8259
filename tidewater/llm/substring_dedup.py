"""Substring dedup over difference-cover anchors.

Removes each word covered by a window of ``WINDOW`` words whose word sequence
also starts in a document of smaller doc_id.

``COVER`` is a difference cover modulo ``PERIOD``: for any two places i and j there is
a shift below PERIOD that brings both to cover places.  Anchors are runs of
``ANCHOR`` words starting at cover places of a document (6 of 31 places); since
PERIOD - 1 + ANCHOR = WINDOW, two equal windows share an aligned anchor inside them.

1. Anchor hashes meet by hash.  An anchor found in two documents is shared.
2. Extension: every window that contains a shared anchor of its document is
   hashed in full (128 bits), and windows meet by hash; one that also starts in
   a smaller doc_id is repeated.
3. Words covered by repeated windows go.

Skew: before each meeting a task combines what it has.  An anchor, a window or a
whole word sequence that a task holds in several documents is known to be shared
there; its places go on directly and one row stands for them in the meeting, so
a passage held by a third of all documents sends one row per task.  Whole
copies of a document's word sequence keep only their smallest doc_id in the
search; the others lose every word if they hold a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import free_name, scratch, text_of

WINDOW = 50
#: A perfect difference set: every shift modulo PERIOD is a difference of two of its places.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
#: Documents without an id are numbered from here.
NO_ID = 1 << 62
#: Rows a task combines before it passes them on.
HELD = 1 << 20

#: What a row of a meeting says.
MEET, KNOWN, DIRECT, COPY = 0, 1, 2, 3
_MEETING = ["x", "y", "id", "place", "run", "kind"]
MEETING = "x bigint, y bigint, id bigint, place int, run int, kind int"


def _spans(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by a space, and where each begins and ends in that."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return joined, np.concatenate([[0], ends[:-1] + 1]), ends


def cover_places(n: int) -> np.ndarray:
    """Cover places among 0 .. n-1."""
    places = np.arange(n)
    return places[np.isin(places % PERIOD, COVER)]


def _hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """128-bit hashes, as rows of two longs, of the runs of ``width`` words that start at ``places``."""
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(joined[a:b]) for a, b in zip(starts[places].tolist(), ends[places + (width - 1)].tolist(), strict=True)])
    return np.frombuffer(raw, dtype=np.int64).reshape(-1, 2)


def _batch(columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _MEETING)


def _mixed(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A spread key for rows that need not meet any other."""
    with np.errstate(over="ignore"):
        key = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + places.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return key.view(np.int64)


def _runs(group: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of runs of consecutive places in one group; the rows come in the order of both."""
    starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (places[1:] != places[:-1] + 1)])
    return starts, np.diff(np.r_[starts, len(group)])


def _meeting_rows(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray, smaller_only: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one meeting for what a task holds.

    ``smaller_only``: a place counts only if a smaller id has the hash too
    (windows); otherwise if any other id has it (anchors).
    """
    order = np.lexsort((places, ids, hashes[:, 1], hashes[:, 0]))
    h, i, p = hashes[order], ids[order], places[order]
    group = np.cumsum(np.r_[False, (h[1:] != h[:-1]).any(axis=1)])
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least, most = np.minimum.reduceat(i, starts), np.maximum.reduceat(i, starts)
    many = (least != most)[group]
    direct = many & (i != least[group]) if smaller_only else many
    rest = np.flatnonzero(~direct)
    if len(rest):
        # a word repeated over and over has one hash at many places in a row
        own = np.cumsum(np.r_[False, (group[rest][1:] != group[rest][:-1]) | (i[rest][1:] != i[rest][:-1])])
        first, length = _runs(own, p[rest])
        rest = rest[first]
        zeros = np.zeros(len(rest), np.int32)
        yield _batch([h[rest, 0], h[rest, 1] if smaller_only else zeros, i[rest], p[rest], length, zeros + MEET])
    if not smaller_only and many.any():  # one row stands for the places that go on directly
        k = np.flatnonzero(least != most)
        zeros = np.zeros(len(k), np.int32)
        yield _batch([h[starts[k], 0], zeros, least[k], zeros - 1, zeros, zeros + KNOWN])
    if direct.any():
        j = np.lexsort((p[direct], i[direct]))
        di, dp = i[direct][j], p[direct][j]
        new, length = _runs(di, dp)
        yield _batch([_mixed(di[new], dp[new]), np.zeros(len(new), np.int64), di[new], dp[new], length, np.full(len(new), DIRECT)])


class _Held:
    """Collects (hashes, ids, places) and gives their rows when they are many or at the end."""

    def __init__(self, smaller_only: bool):
        self.smaller_only, self.parts, self.rows = smaller_only, [], 0

    def add(self, hashes: np.ndarray, id_: int, places: np.ndarray) -> None:
        self.parts.append((hashes, np.full(len(places), id_, np.int64), places))
        self.rows += len(places)

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.rows >= least:
            columns = [np.concatenate([p[k] for p in self.parts]) for k in range(3)]
            self.parts, self.rows = [], 0
            yield from _meeting_rows(*columns, self.smaller_only)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text -> rows of the anchor meeting, and of the meeting of whole word sequences (place -1)."""
    held, whole = _Held(False), {}

    def copies() -> Iterator[pa.RecordBatch]:
        if whole:
            pair = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
            zeros = np.zeros(len(whole), np.int32)
            yield _batch([pair[:, 0], pair[:, 1], list(whole.values()), zeros - 1, zeros, zeros + COPY])
            whole.clear()

    for batch in batches:
        again = []
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            words = text.split()
            if len(words) < WINDOW:
                continue
            joined, starts, ends = _spans(words)
            key = xxhash.xxh3_128_digest(joined)
            first = whole.get(key)
            if first is not None and first <= id_:
                if first < id_:
                    again.append(id_)
                continue  # its anchors are held already
            if first is not None:
                again.append(first)
            whole[key] = id_  # also where the sequence was held under a larger id, which is a copy now
            places = cover_places(len(words) - ANCHOR + 1)
            held.add(_hashes(joined, starts, ends, places, ANCHOR), id_, places.astype(np.int32))
        if again:
            ids = np.array(again, np.int64)
            zeros = np.zeros(len(ids), np.int32)
            yield _batch([_mixed(ids, zeros), zeros, ids, zeros - 1, zeros, zeros + DIRECT])
        yield from held.flush(HELD)
        if len(whole) >= HELD // 8:
            yield from copies()
    yield from held.flush()
    yield from copies()


def _shared(meeting: DataFrame) -> DataFrame:
    """Places of shared anchors and copies: id, place, run (place -1: a copy of a smaller id's words)."""
    # three meetings that do not see one another: anchors, places known to be shared, whole sequences
    same = Window.partitionBy("x", "y", "apart")
    over = {"least": F.min("id").over(same), "most": F.max("id").over(same), "top": F.max("kind").over(same)}
    met = meeting.withColumn("apart", F.greatest("kind", F.lit(KNOWN))).withColumns(over)
    direct = F.col("kind") == DIRECT
    anchor = (F.col("kind") == MEET) & ((F.col("least") != F.col("most")) | (F.col("top") == KNOWN))
    copy = (F.col("kind") == COPY) & (F.col("id") > F.col("least"))
    return met.where(direct | anchor | copy).select("id", "place", "run")


def _windows(text_at: int):
    """mapInArrow function: ..., id, places, runs of shared anchors -> rows of the window meeting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(True)
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            ids, places, runs = (batch.column(batch.num_columns - k).to_pylist() for k in (3, 2, 1))
            for id_, text, at, lengths in zip(ids, texts, places, runs, strict=True):
                if min(at) < 0:
                    continue  # a copy: its smallest id is searched
                words = (text or b"").split()
                last = len(words) - WINDOW
                if last < 0:
                    continue
                anchors = np.unique(np.concatenate([np.arange(p, p + r) for p, r in zip(at, lengths, strict=True)]))
                step = np.zeros(last + 2, np.int32)
                np.add.at(step, np.clip(anchors - (WINDOW - ANCHOR), 0, last + 1), 1)
                np.add.at(step, np.minimum(anchors, last) + 1, -1)
                starts = np.flatnonzero(np.cumsum(step)[: last + 1] > 0)
                if len(starts):
                    held.add(_hashes(*_spans(words), starts, WINDOW), id_, starts.astype(np.int32))
            yield from held.flush(HELD)
        yield from held.flush()

    return run


def _repeated(meeting: DataFrame) -> DataFrame:
    """Repeated windows: id, place, run."""
    least = F.min("id").over(Window.partitionBy("x", "y", "apart"))
    met = meeting.withColumn("apart", F.col("kind") == DIRECT).withColumn("least", least)
    return met.where((F.col("kind") == DIRECT) | (F.col("id") > F.col("least"))).select("id", "place", "run")


def _per_document(rows: DataFrame) -> DataFrame:
    """id, places, runs: bounded by the document's own words."""
    return rows.groupBy(F.col("id").alias("__id")).agg(F.collect_list("place").alias("__places"), F.collect_list("run").alias("__runs"))


def _remove(columns: list[str], text_at: int):
    """mapInArrow function: the last two columns are a document's repeated windows (places, runs) or null."""

    def run(batches):
        for batch in batches:
            out = list(batch.columns[:-2])
            texts = out[text_at].cast(pa.binary()).to_pylist()
            places, runs = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            n_words, n_removed = [], []
            for k, text in enumerate(texts):
                words = (text or b"").split()
                n_words.append(len(words))
                gone = 0
                if places[k]:
                    if min(places[k]) < 0:
                        kept = [] if len(words) >= WINDOW else words
                    else:
                        step = np.zeros(len(words) + WINDOW + 1, np.int32)
                        at = np.array(places[k])
                        np.add.at(step, at.clip(max=len(words)), 1)
                        np.add.at(step, (at + np.array(runs[k]) + WINDOW - 1).clip(max=len(words)), -1)
                        keep = np.cumsum(step)[: len(words)] == 0
                        kept = [w for w, x in zip(words, keep.tolist(), strict=True) if x]
                    gone = len(words) - len(kept)
                    words = kept
                texts[k] = b" ".join(words) if text is not None else None
                n_removed.append(gone)
            out[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], columns)

    return run


def _order() -> Column:
    """The id; a document without one comes after all that have one, under a number made from its text."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID) + F.pmod(F.xxhash64(text_of()), F.lit(NO_ID)))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept words, joined by one space, as text, and __n_words, __n_removed.

    Windows are judged on the input.  Defined cases: a null text has no words
    and stays null; texts of fewer than ``WINDOW`` words keep every word; a
    window repeated only inside one document stays; rows of one doc_id are one
    document, so a repeated row removes nothing from the other (but places
    found in one row apply to every row of that id: ids are expected to be
    unique); documents without a doc_id come last, in the order of a hash of
    their text, and equal texts among them are one document; extra columns stay.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(_order().alias("id"), text_of().alias("text"))
    shared = scratch(_per_document(_shared(rows.mapInArrow(_anchors, MEETING))), "shared")
    # the texts are dealt out once by id: both joins read the same exchange (the filter, always
    # true, is what Spark would add for one of them only)
    order, id_, places, runs = (free_name(docs, n) for n in ("window_order", "window_id", "window_places", "window_runs"))
    names = {"__id": id_, "__places": places, "__runs": runs}
    dealt = docs.withColumn(order, _order()).where(f"{order} IS NOT NULL").repartition(parts, order)
    near = dealt.join(shared.withColumnsRenamed(names), F.col(order) == F.col(id_))
    near = near.select(*dealt.columns, places, runs)  # every column, or the exchanges differ
    copies = shared.where(F.array_min("__places") < 0).select(F.col("__id").alias("id"), F.lit(-1).alias("place"), F.lit(0).alias("run"))
    gone = _per_document(_repeated(near.mapInArrow(_windows(docs.columns.index("text")), MEETING)).unionByName(copies))
    joined = dealt.join(gone.withColumnsRenamed(names), F.col(order) == F.col(id_), "left").select(*docs.columns, places, runs)
    counts = [T.StructField(free_name(docs, c), T.LongType()) for c in ("__n_words", "__n_removed")]
    schema = T.StructType([*docs.schema.fields, *counts])
    return joined.mapInArrow(_remove([f.name for f in schema], docs.columns.index("text")), schema)


def op4_substring_dedup(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_words, n_removed, kept_sha256."""
    return dedup_substrings(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.sha2(text_of(), 256).alias("kept_sha256")
    )
