"""Removal of repeated byte strings by merging the Burrows-Wheeler transforms of shards.

A string of ``LENGTH`` bytes that starts in two places is repeated, and every byte that one covers goes.

Texts are parsed into phrases at anchors: the place of the least of ``SPAN`` neighbouring hashes of
``GRAM`` bytes.  Whether a place is an anchor depends only on the bytes around it, so that equal strings
are parsed alike, and every string of LENGTH bytes holds ``DEPTH`` whole phrases that all its copies have.

1. Each shard (the documents of a task up to ``SHARD_BYTES``) sorts the suffixes of its phrase sequences
   once, by DEPTH phrases.  That order gives its transform: the phrase before each suffix, and where the
   suffix that starts with it stands.
2. The shards' transforms are merged by refining their interleave.  A block is the set of suffixes with
   a common prefix of h phrases, over all shards; in each shard it is one interval of the sorted order.  One
   step backward through the transforms turns the intervals of a block into those of the blocks that are
   one phrase longer.  Blocks of one suffix in all are finished and dropped; no suffix is sorted again and only
   intervals, one for each block and shard, are exchanged.  After DEPTH steps the blocks are the repeated
   intervals.
3. An anchor in a repeated interval stands for the windows (strings of LENGTH bytes) whose first anchor it is.
   The string under all these windows is its context.  A context found twice settles its windows at once.
   Where the bytes common to all its windows (its core) have several contexts, a passage begins or ends near by,
   and the windows there are compared one by one, a context found twice being represented once.

Hot groups: a block, a context or a window sends one row per shard, however many copies the shard holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import co_located, free_name, scratch, text_of

LENGTH = 400
GRAM = 16
SPAN = 96
#: Whole phrases that any string of LENGTH bytes shares with its copies.
DEPTH = (LENGTH - GRAM + 1) // SPAN - 1
#: Bytes that all windows of an anchor have in common, from the anchor on.
CORE = LENGTH - SPAN + 1
#: Bytes of text after which a task closes a shard (a longer text makes a longer one).
SHARD_BYTES = 8 << 20
SHARDS_PER_TASK = 1 << 11
#: Bytes whose hashes are compared together; a place takes the low bits beside a hash.
PART, PLACE_BITS = 1 << 26, 27

_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]

_BYTES = [T.StructField(c, T.BinaryType()) for c in ("anchors", "places", "firsts", "phrases", "order")]
INTERVALS = "block bigint, at bigint, n bigint"
CONTEXTS = "core bigint, x bigint, y bigint, at bigint, n bigint"
SPANS = "shard bigint, direct array<bigint>, edges array<bigint>"
WINDOWS = "x bigint, y bigint, at bigint, n bigint"
REMOVED = T.StructType([
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
])


def _hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on (GRAM is a power of two)."""
    with np.errstate(over="ignore"):
        h = (text.astype(np.uint64) + np.uint64(1)) * _ODD[0]
        h ^= h >> np.uint64(31)
        width, factor = 1, _ODD[1]
        while width < GRAM:
            h = h[:-width] * factor + h[width:]
            width, factor = 2 * width, factor * factor * np.uint64(3) | np.uint64(1)
        h *= _ODD[2]
        return h ^ (h >> np.uint64(29))


def _least(h: np.ndarray) -> np.ndarray:
    """Place of the least (first, if equal) of each SPAN neighbouring hashes."""
    m = h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < SPAN:
        m = np.minimum(m[: len(m) - (SPAN - width)], m[SPAN - width :])
    return (m & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a text, and for each the first window whose first anchor it is."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _hashes(np.frombuffer(text, np.uint8))
    least = np.concatenate([_least(h[a : a + PART + SPAN - 1]) + a for a in range(0, len(h) - SPAN + 1, PART)])
    firsts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return least[firsts], firsts


def _steps(values: list[np.ndarray]) -> bytes:
    """Rising numbers, at most SPAN apart, as bytes."""
    return b"".join(np.diff(v, prepend=0).astype(np.uint8).tobytes() for v in values)


def _binary(value: bytes) -> pa.Array:
    return pa.array([value], pa.binary())


def _shard(number: int, docs: list[pa.RecordBatch], text_at: int, names: list[str]) -> pa.RecordBatch:
    """One row: the documents, their anchors and phrases, and the order of the phrase suffixes."""
    table = pa.Table.from_batches(docs).combine_chunks()
    texts = [t or b"" for t in table.column(text_at).cast(pa.binary()).to_pylist()]
    places, firsts = map(list, zip(*map(anchors, texts), strict=True))
    digest = xxhash.xxh3_64_intdigest
    phrases = [np.array([digest(t[a:b]) for a, b in zip(p[:-1].tolist(), p[1:].tolist(), strict=True)], np.uint64) for t, p in zip(texts, places, strict=True)]
    counts = np.array([len(p) for p in places], np.int32)
    flat = np.concatenate(phrases)
    known, rank = np.unique(flat, return_inverse=True)
    # a document's last anchor starts no phrase: number 0, and no phrase of the next document follows
    seq = np.zeros(int(counts.sum()) + DEPTH, np.int64)
    starts = np.ones(int(counts.sum()), bool)
    starts[np.cumsum(counts)[counts > 0] - 1] = False
    seq[: len(starts)][starts] = rank + 1
    keys, alive = [seq[: len(starts)]], starts.copy()
    for k in range(1, DEPTH):
        alive = alive & np.r_[starts[k:], np.zeros(min(k, len(starts)), bool)] if len(starts) else alive
        keys.append(np.where(alive, seq[k : k + len(starts)], 0))
    order = np.lexsort(keys[::-1]).astype(np.int32) if len(starts) else np.zeros(0, np.int32)
    symbols = np.zeros(len(starts), np.uint64)
    symbols[starts] = flat
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    rows = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pa.StructArray.from_arrays(columns, names))
    found = [counts.tobytes(), _steps(places), _steps(firsts), symbols.tobytes(), order.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), rows, *map(_binary, found)], ["shard", "docs", *(f.name for f in _BYTES)])


def _shards(text_at: int, names: list[str]):
    """mapInArrow function: task and the documents' columns -> shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, shard, task = [], 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(0)[0].as_py()
            lengths = np.cumsum([len(t or b"") for t in batch.column(text_at + 1).cast(pa.binary()).to_pylist()])
            rows, done = batch.select(range(1, batch.num_columns)), 0
            while done < len(lengths):
                before = int(lengths[done - 1]) if done else 0
                end = min(int(np.searchsorted(lengths, before + SHARD_BYTES - size)) + 1, len(lengths))
                held.append(rows.slice(done, end - done))
                size += int(lengths[end - 1]) - before
                done = end
                if size >= SHARD_BYTES:
                    yield _shard(task * SHARDS_PER_TASK + shard, held, text_at, names)
                    held, size, shard = [], 0, shard + 1
        if held:
            yield _shard(task * SHARDS_PER_TASK + shard, held, text_at, names)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    """Rows with large values, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(c)[k] for c, name in enumerate(batch.schema.names)}


def _array(value: pa.Scalar, kind: type = np.int64) -> np.ndarray:
    """A binary value, or a list of longs (null: empty), as numbers."""
    if isinstance(value, pa.BinaryScalar):
        return np.frombuffer(value.as_buffer(), kind)
    return value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.zeros(0, kind)


def _first_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards -> the intervals of suffixes with a common first phrase."""
    for row in _rows(batches):
        symbols = _array(row["phrases"])[_array(row["order"], np.int32)]
        _, starts = _documents(row)
        begin = starts[_array(row["order"], np.int32)]
        low = np.flatnonzero(begin & np.r_[True, (symbols[1:] != symbols[:-1]) | ~begin[:-1]]) if len(symbols) else np.zeros(0, np.int64)
        ends = np.r_[low[1:], len(symbols)] if len(low) else low
        # suffixes that start no phrase come first in the order
        yield _intervals(symbols[low], row["shard"].as_py(), low, ends - low)


def _documents(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, np.ndarray]:
    """(document of each anchor, whether a phrase starts there)."""
    counts = _array(row["anchors"], np.int32)
    starts = np.ones(int(counts.sum()), bool)
    starts[np.cumsum(counts)[counts > 0] - 1] = False
    return np.repeat(np.arange(len(counts)), counts), starts


def _intervals(blocks: np.ndarray, shard: int, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array((shard << 32) | low.astype(np.int64)), pa.array(n, pa.int64())], ["block", "at", "n"])


def _members(low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval, place in the order) of every suffix of these intervals."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with the intervals of their blocks -> those of the blocks one phrase longer at the front."""
    for row in _rows(batches):
        order, symbols = _array(row["order"], np.int32), _array(row["phrases"], np.uint64)
        blocks, low, n = (_array(row[c]) for c in ("block", "low", "n"))
        document, _ = _documents(row)
        stands = np.empty(len(order), np.int64)
        stands[order] = np.arange(len(order))
        which, place = _members(low, n)
        before = order[place].astype(np.int64) - 1
        inside = (before >= 0) & (document[before] == document[before + 1])
        which, before = which[inside], before[inside]
        if not len(which):
            continue
        said, to = symbols[before], stands[before]
        by = np.lexsort((to, said, which))
        which, said, to = which[by], said[by], to[by]
        new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (said[1:] != said[:-1])])
        with np.errstate(over="ignore"):
            longer = (blocks[which[new]].view(np.uint64) ^ (said[new] * _ODD[0])) * _ODD[1]
            longer ^= longer >> np.uint64(31)
            longer *= _ODD[2]
        yield _intervals(longer.view(np.int64), row["shard"].as_py(), to[new], np.diff(np.r_[new, len(which)]))


def _texts(row: dict[str, pa.Scalar], text_at: int) -> list[bytes]:
    return [t or b"" for t in row["docs"].values.field(text_at).cast(pa.binary()).to_pylist()]


def _digests(strings: Iterator[bytes]) -> np.ndarray:
    """128-bit hashes as rows of two longs."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.int64).reshape(-1, 2)


class _Contexts:
    """The contexts of a shard's anchors in repeated intervals."""

    def __init__(self, row: dict[str, pa.Scalar], text_at: int):
        texts = _texts(row, text_at)
        order = _array(row["order"], np.int32)
        document, _ = _documents(row)
        counts = _array(row["anchors"], np.int32)
        which, place = _members(_array(row["low"]), _array(row["n"]))
        at = order[place].astype(np.int64)
        of = document[at]
        lengths = np.array([len(t) for t in texts], np.int64)
        places, firsts = (_absolute(_array(row[c], np.uint8), counts) for c in ("places", "firsts"))
        last = lengths - LENGTH
        # an anchor's windows end before those of the next one begin
        ends = np.where(np.r_[document[1:] == document[:-1], False], np.r_[firsts[1:], 0] - 1, last[document]) if len(document) else firsts
        low, high = firsts[at], np.minimum(ends[at], last[of])
        some = low <= high
        self.of, self.low, self.n = of[some], low[some], (high - low + 1)[some]
        blocks, at = _array(row["block"])[which[some]], places[at[some]]
        spans = list(zip(self.of.tolist(), self.low.tolist(), (self.low + self.n - 1 + LENGTH).tolist(), at.tolist(), strict=True))
        digest = xxhash.xxh3_64_intdigest
        core = np.array([digest(texts[d][p : p + CORE]) for d, _, _, p in spans], np.uint64)
        with np.errstate(over="ignore"):
            core = (core ^ (blocks.view(np.uint64) * _ODD[0])).view(np.int64)
        pair = _digests(texts[d][a:b] for d, a, b, _ in spans)
        by = np.lexsort((pair[:, 1], pair[:, 0], core))
        key = np.stack([core, pair[:, 0], pair[:, 1]], axis=1)[by]
        new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)] if len(key) else np.zeros(0, bool)
        #: number of each anchor's context, and the contexts with their first anchor and count
        self.number = np.empty(len(by), np.int64)
        self.number[by] = np.cumsum(new) - 1
        self.keys, self.first = key[new], by[new]
        self.count = np.bincount(self.number, minlength=len(self.keys))


def _absolute(steps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rising numbers of each document from their steps."""
    total = np.cumsum(steps, dtype=np.int64)
    begin = (np.cumsum(counts) - counts)[counts > 0]
    base = np.where(begin > 0, total[begin - 1], 0) if len(begin) else begin
    return total - np.repeat(base, counts[counts > 0])


def _contexts(text_at: int):
    """mapInArrow function: shards with their repeated intervals -> one row for each context of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = _Contexts(row, text_at)
            at = (row["shard"].as_py() << 32) | np.arange(len(found.keys), dtype=np.int64)
            columns = [*(np.ascontiguousarray(found.keys[:, k]) for k in range(3)), at, found.count]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["core", "x", "y", "at", "n"])

    return run


#: What becomes of a context: its windows are repeated; they are compared one by one; both, as the one that stands for its copies.
SETTLED, COMPARED, STANDS = 1, 2, 3


def _spans(text_at: int):
    """mapInArrow function: shards, their repeated intervals and what becomes of their contexts -> spans of
    windows, as document, first, number: those settled, and with a mark if repeated those to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = _Contexts(row, text_at)
            fate = np.zeros(len(found.keys), np.int64)
            fate[_array(row["context"])] = _array(row["fate"])
            settled = np.flatnonzero((fate & SETTLED)[found.number] > 0)
            compared = np.flatnonzero(fate & COMPARED)
            one = found.first[compared]
            direct = np.stack([found.of[settled], found.low[settled], found.n[settled]], axis=1)
            edges = np.stack([found.of[one], found.low[one], found.n[one], (fate[compared] & SETTLED) > 0], axis=1)
            lists = [pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.astype(np.int64).ravel())) for v in (direct, edges)]
            yield pa.RecordBatch.from_arrays([pa.array([row["shard"].as_py()], pa.int64()), *lists], ["shard", "direct", "edges"])

    return run


class _Windows:
    """The windows of a shard that are compared one by one."""

    def __init__(self, row: dict[str, pa.Scalar], texts: list[bytes]):
        edges = _array(row["edges"]).reshape(-1, 4)
        which, self.start = _members(edges[:, 1], edges[:, 2])
        self.of = edges[which, 0]
        pair = _digests(texts[d][x : x + LENGTH] for d, x in zip(self.of.tolist(), self.start.tolist(), strict=True))
        by = np.lexsort((pair[:, 1], pair[:, 0]))
        new = np.r_[True, (pair[by][1:] != pair[by][:-1]).any(axis=1)] if len(by) else np.zeros(0, bool)
        self.number = np.empty(len(by), np.int64)
        self.number[by] = np.cumsum(new) - 1
        self.pairs = pair[by][new]
        # a window that stands for its copies counts as two
        self.count = np.bincount(self.number, weights=1 + edges[which, 3], minlength=len(self.pairs)).astype(np.int64)


def _windows(text_at: int):
    """mapInArrow function: shards and their spans -> one row for each window to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = _Windows(row, _texts(row, text_at))
            for a in range(0, len(found.pairs), 1 << 16):
                part = slice(a, a + (1 << 16))
                at = (row["shard"].as_py() << 32) | np.arange(len(found.pairs), dtype=np.int64)[part]
                columns = [np.ascontiguousarray(found.pairs[part, 0]), np.ascontiguousarray(found.pairs[part, 1]), at, found.count[part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "y", "at", "n"])

    return run


def _remove(text_at: int, columns: list[str]):
    """mapInArrow function: shards, their spans and their repeated windows -> the documents and what was removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            texts = _texts(row, text_at)
            starts: dict[int, list[tuple[int, int]]] = {}
            for d, low, n in _array(row["direct"]).reshape(-1, 3).tolist():
                starts.setdefault(d, []).append((low, n))
            if row["edges"].is_valid and row["window"].is_valid:
                found = _Windows(row, texts)
                repeated = np.zeros(len(found.pairs), bool)
                repeated[_array(row["window"])] = True
                hit = repeated[found.number]
                for d, x in zip(found.of[hit].tolist(), found.start[hit].tolist(), strict=True):
                    starts.setdefault(d, []).append((x, 1))
            removed, sizes, spans, kept = [], [], [], []
            for d, text in enumerate(texts):
                runs, left = _cut(text, starts.get(d, []))
                removed.append(len(text) - len(left))
                sizes.append(len(runs))
                spans.extend(runs)
                kept.append(left)
            pairs = np.array(spans, np.int64).reshape(-1, 2)
            runs = pa.StructArray.from_arrays([pa.array(pairs[:, k]) for k in range(2)], ["start", "length"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), runs)
            counts = [pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64())]
            done = pa.StructArray.from_arrays([*counts, lists, pa.array(kept, pa.binary())], REMOVED.names)
            yield pa.RecordBatch.from_arrays([*row["docs"].values.flatten(), done], columns)

    return run


def _cut(text: bytes, starts: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs and the bytes left, from (first, number) of repeated windows."""
    runs: list[tuple[int, int]] = []
    for low, n in sorted(starts):
        end = low + n - 1 + LENGTH
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((low, end))
    left, done = [], 0
    for low, end in runs:
        left.append(text[done:low])
        done = end
    left.append(text[done:])
    return [(low, end - low) for low, end in runs], b"".join(left)


def _twice(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the groups with two members or more in all; a group has one row per shard."""
    return rows.withColumn("total", F.sum("n").over(Window.partitionBy(*keys))).where("total > 1")


def _by_shard(rows: DataFrame, **columns: str) -> DataFrame:
    """One row per shard (the upper half of ``at``) with these columns as arrays."""
    listed = rows.select(F.shiftrightunsigned("at", 32).alias("shard"), F.struct(*[F.expr(e).cast("bigint").alias(c) for c, e in columns.items()]).alias("row"))
    listed = listed.groupBy("shard").agg(F.collect_list("row").alias("rows"))
    return listed.select("shard", *[F.col(f"rows.{c}").alias(c) for c in columns])


_PLACE = "at & 4294967295"


def _fates(contexts: DataFrame) -> DataFrame:
    """at, fate of the contexts that matter: found twice, or one of several with their core."""
    same = Window.partitionBy("core", "x", "y")
    met = scratch(contexts.withColumn("total", F.sum("n").over(same)).withColumn("least", F.min("at").over(same)), "suffix-contexts")
    cores = met.groupBy("core").agg(F.min(F.struct("x", "y")).alias("one"), F.max(F.struct("x", "y")).alias("other"))
    several = cores.where("one <> other").select("core", F.lit(True).alias("several"))
    judged = met.join(several, "core", "left").select(
        "at", F.when(F.col("total") > 1, SETTLED).otherwise(0).alias("settled"), F.when(F.col("several") & ((F.col("total") == 1) | (F.col("at") == F.col("least"))), COMPARED).otherwise(0).alias("compared")
    )
    return judged.select("at", (F.col("settled") + F.col("compared")).alias("fate")).where("fate > 0")


def removal_column(docs: DataFrame) -> str:
    """Name of the column that ``remove_repeats`` adds."""
    return free_name(docs, "repeats")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct (``repeats``, or that with underscores if docs has such a column): n_bytes, n_removed,
    spans (maximal removed runs of bytes: start, length) and kept (the bytes left, which may cut a character).

    Defined cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing; a string repeated inside one
    document goes, too; repeated rows are documents of their own, so each removes the other; doc_id is not read, so
    null and repeated ids change nothing; an empty table gives an empty one; extra columns stay, whatever their names.
    """
    text_at, names = docs.columns.index("text"), docs.columns
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("docs", T.ArrayType(docs.schema)), *_BYTES])
    # the task's number goes before the columns; mapInArrow knows columns by place
    dealt = docs.select(F.spark_partition_id().alias(free_name(docs, "task")), *[docs[c] for c in names])
    shards = co_located(dealt.mapInArrow(_shards(text_at, names), schema), "shard", "suffixes", compression="zstd")
    order = shards.select("shard", *[f.name for f in _BYTES])
    alive = scratch(_twice(order.mapInArrow(_first_intervals, INTERVALS), "block").drop("total"), "suffix-blocks-1")
    for depth in range(2, DEPTH + 1):
        lists = _by_shard(alive, block="block", low=_PLACE, n="n")
        longer = order.join(lists, "shard").mapInArrow(_refine, INTERVALS)
        alive = scratch(_twice(longer, "block").drop("total"), f"suffix-blocks-{depth}")
    lists = _by_shard(alive, block="block", low=_PLACE, n="n")
    repeated = shards.join(lists, "shard")
    fates = _by_shard(_fates(repeated.mapInArrow(_contexts(text_at), CONTEXTS)), context=_PLACE, fate="fate")
    spans = co_located(repeated.join(fates, "shard").mapInArrow(_spans(text_at), SPANS), "shard", "spans")
    marked = shards.join(spans, "shard")
    again = _by_shard(_twice(marked.mapInArrow(_windows(text_at), WINDOWS), "x", "y"), window=_PLACE)
    found = spans.join(again, "shard", "left")
    last = shards.select("shard", "docs").join(found, "shard", "left")
    done = T.StructType([*docs.schema.fields, T.StructField(removal_column(docs), REMOVED)])
    return last.mapInArrow(_remove(text_at, done.names), done)


def op13_suffix_dedup(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    done = remove_repeats(docs.select("doc_id", text_of().alias("text")))
    return done.select(
        "doc_id", F.col("repeats.n_bytes").alias("n_bytes"), F.col("repeats.n_removed").alias("n_removed"),
        F.size("repeats.spans").cast("bigint").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )
