"""Periodic runs of words: an online sparse dynamic program over the diagonals of a document.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at
least ``MIN_LENGTH`` and at least 2 * q words that no neighbouring word extends with period q.

Words q apart that are equal lie on the diagonal of lag q.  The program reads a document once, word
by word: each earlier occurrence of what ends at the word prolongs the match of its lag by one, a lag
without one at this word ends there, and a match that is long enough is emitted as a run at once.

Sparse, without leaving anything out:

* A run of lag q needs at least max(q, MIN_LENGTH - q) matches in a row.  Lags are taken in classes
  [2^k, 2^(k+1)); an occurrence counts in a class if the last ``gram`` words are equal there, gram being
  what all lags of the class need.  Ordinary prose repeats few such grams.  Names of grams are exact
  (ranks of pairs of shorter names, not hashes).
* Where a gram comes back p <= gram words later, everything in between has period p, and the lags
  2p, 3p, ... inside that stretch match exactly as far as it goes: they have its ends and a period that
  is not smallest, so they are skipped, and a word said n times costs n, not n * n.

Work stays inside a document's row: no shuffle, no join.  A task holds one batch of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import free_name, let, text_of, words_of

MIN_LENGTH = 12
#: Words of a document whose earlier occurrences are looked up together.
HELD = 1 << 16

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("n_words", T.LongType()), T.StructField("n_dropped", T.LongType())])


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


class _Grams:
    """Names of all grams of a length, made from those of shorter ones."""

    def __init__(self, words: np.ndarray):
        self.n, self.known = len(words), {1: words}

    def of(self, length: int) -> np.ndarray:
        if length not in self.known:
            half = max(k for k in self.known if k < length)
            while 2 * half < length:
                self.known[2 * half] = _names(self.known[half][: self.n - 2 * half + 1], self.known[half][half:])
                half *= 2
            short, places = self.known[half], self.n - length + 1
            self.known[length] = _names(short[:places], short[length - half : length - half + places])
        return self.known[length]


def _may_repeat(words: np.ndarray, length: int) -> bool:
    """Whether any gram of this length comes twice (by hash, so never wrongly no)."""
    h = np.zeros(len(words) - length + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)].astype(np.uint64)
            h ^= h >> np.uint64(29)
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def _occurrences(names: np.ndarray, gram: int, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) of earlier occurrences low <= lag < high, in the order of places."""
    n = len(names)
    at = np.argsort(names, kind="stable")
    same = np.r_[False, names[at[1:]] == names[at[:-1]]]
    gap = np.where(same, np.r_[0, at[1:] - at[:-1]], 0)
    index = np.arange(n)
    first = np.maximum.accumulate(np.where(same, 0, index))  # of the gram's occurrences
    # where the present progression of equal gaps began: its members are one periodic stretch
    began = np.maximum.accumulate(np.where(gap != np.r_[0, gap[:-1]], index, 0))
    further = np.where(gap <= gram, began - 2, index - 2)
    near = same & (gap >= low) & (gap < high)
    far = same & (further >= first)
    far &= at - at[np.maximum(further, 0)] < high
    rank = np.empty(n, np.int64)
    rank[at] = index
    places = np.sort(at[near | far])
    for a in range(0, len(places), HELD):
        part = places[a : a + HELD]
        k = rank[part]
        found = [(part[near[k]], gap[k][near[k]])]
        part, k = part[far[k]], k[far[k]]
        back = further[k]
        while len(part):
            lag = part - at[back]
            found.append((part[lag >= low], lag[lag >= low]))
            back = back - 1
            on = (back >= first[k]) & (part - at[np.maximum(back, 0)] < high)
            part, k, back = part[on], k[on], back[on]
        j, lag = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((lag, j))
        yield j[order], lag[order]


def find_runs(words: np.ndarray, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbered words, by start, then period."""
    n = len(words)
    if n < least or not _may_repeat(words, -(-least // 2)):
        return []
    grams, found = _Grams(words), {}

    def emit(lag: int, matches: int, end: int) -> None:
        if matches >= lag and matches + lag >= least:
            ends = (end - matches - lag, end)
            if found.get(ends, lag) >= lag:  # with equal ends the smaller period is the run's
                found[ends] = lag

    low = 1
    while 2 * low <= n:
        high = 2 * low
        gram = low if 2 * low >= least else min(max(q, least - q) for q in range(low, high))
        if gram + low > n:
            break
        names = grams.of(gram)
        if 2 * gram >= least and int(names.max()) + 1 == len(names):
            if 2 * low >= least:
                break  # longer grams do not come back either
            low = high
            continue
        active, last = {}, -2
        for places, lags in _occurrences(names, gram, low, high):
            cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
            lags, ends = lags.tolist(), [*cuts[1:].tolist(), len(lags)]
            for j, a, b in zip(places[cuts].tolist(), cuts.tolist(), ends, strict=True):
                before = active if j == last + 1 else {}
                now = {q: before.get(q, gram - 1) + 1 for q in lags[a:b]}
                for q, m in active.items():
                    if j != last + 1 or q not in now:
                        emit(q, m, last + gram)
                active, last = now, j
        for q, m in active.items():
            emit(q, m, last + gram)
        low = high
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def _collapse(columns: list[str], text_at: int, least: int):
    """mapInArrow function: the documents with their collapsed text and what was found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            sizes, flat, n_words, n_dropped = [], [], [], []
            for k, text in enumerate(texts):
                words = (text or b"").split()
                runs = find_runs(_numbered(words), least)
                sizes.append(len(runs))
                flat.extend(runs)
                n_words.append(len(words))
                kept = words
                if runs:
                    keep = np.ones(len(words), bool)
                    for start, length, period in runs:
                        keep[start + period : start + length] = False
                    kept = [w for w, x in zip(words, keep.tolist(), strict=True) if x]
                n_dropped.append(len(words) - len(kept))
                texts[k] = None if text is None else b" ".join(kept)
            triples = np.array(flat, np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(triples[:, c]) for c in range(3)], RUN.names)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), runs)
            found = pa.StructArray.from_arrays([lists, pa.array(n_words, pa.int64()), pa.array(n_dropped, pa.int64())], FOUND.names)
            out = list(batch.columns)
            out[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*out, found], columns)

    return run


def found_column(docs: DataFrame) -> str:
    """Name of the column that ``collapse_runs`` adds."""
    return free_name(docs, "periodic")


def collapse_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``docs`` whose text has the words joined by one space that are in no run after its first period.

    Adds a struct (``periodic``, or that with underscores if docs has such a column): runs (array of
    start, length, period, by start, then period; all runs, those inside others too), n_words, n_dropped.

    Defined cases: a null text stays null and has no words and no runs; a text without a run becomes its
    words joined by one space; an empty table gives an empty one; repeated rows and rows without a doc_id
    are documents like any other, since each row is judged by itself; extra columns stay, whatever their names.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(found_column(docs), FOUND)])
    return docs.mapInArrow(_collapse(schema.names, docs.columns.index("text"), least), schema)


def _planted(docs: DataFrame) -> DataFrame:
    """The contract's input: one document in ten repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / F.lit(10)).cast("bigint")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        joined = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, place(i))), " ")
        return F.when(n > 0, joined).otherwise("")

    return docs.select("doc_id", F.when(h % 10 == 0, let(words_of(text_of()), repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    done = collapse_runs(_planted(docs))
    runs = F.col("periodic.runs")
    lines = F.array_join(F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    # the least of (-length, start, period)
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = done.select("doc_id", "text", F.size(runs).cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"))
    length = -F.col("best.less")
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"), "runs_sha256", F.sha2(text_of(), 256).alias("collapsed_sha256"),
    )
