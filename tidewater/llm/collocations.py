"""Phrase collocations by relational mining (SETM), counts kept exact.

Texts fall into pieces at punctuation and line ends, pieces into words.  The occurrence relation of a
length holds (place, phrase), sorted by place; its rows are kept together in shards, each the texts of
one task up to ``SHARD_WORDS`` words, as one array whose index is the place and whose zeros part pieces
and stand where no frequent phrase starts.

For each length, from words to ``MAX_WORDS``:

1. Merge-join the relation with itself by piece and adjacent place: a phrase of k + 1 words starts where
   frequent phrases of k words start at neighbouring places.  Shards are sorted, so the join is a shift.
2. Group-count.  Shards count their own phrases.  Phrases of two words or more first go as counts by slot of a hash
   (under two bytes each); a slot's sum bounds the count of every phrase in it, so only phrases of slots that reach
   ``MIN_COUNT`` can be frequent.  Those, and all words, then go with their own keys and are summed exactly.
3. Semi-join: shards get an answer for each phrase they sent, frequent or not and under which id; the relation keeps
   the frequent ones and is written for the next length.

The relations are bucketed by shard, so that occurrences are never shuffled; what is shuffled is one entry for
each distinct phrase of a shard, however often the shard says it.  Entries are dealt by hash to parts of about
``PART_WORDS`` occurrences, whose number follows the corpus, and travel as one packed, sorted list for each shard and part;
answers follow the same order, so they carry no keys.  A phrase's id is its part and its rank among the part's frequent
phrases.  Words meet by a 128-bit hash of language and word.  Each phrase knows the counts of its
beginnings and ends, since every part of a frequent phrase is frequent.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import batches_of, co_located, scratch, text_of

MIN_COUNT = 30
MAX_WORDS = 4
#: Phrases reported for each language.
TOP = 2000
#: Words after which a task closes a shard (a longer text makes a longer one).
SHARD_WORDS = 2_000_000
#: Shards of one task.
SHARDS_PER_TASK = 1 << 11
#: Occurrences of a part of the slots (on average), and the slots of a part, as bits: eight for each of them.
PART_WORDS = 1 << 20
SLOT_BITS = 23
#: Bytes of shards that a Python worker holds at once, if not one shard has more.
SHARD_BYTES = 8 << 20
NO_LANG = "und"

_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Never a byte of a text.
_MARK = b"\xff"
_TO_MARKS = bytes.maketrans(_ENDS, _MARK * len(_ENDS))

SHARDS = "shard bigint, seq array<int>, words array<struct<lang: string, word: string, n: bigint>>"
RELATION = "shard bigint, seq array<int>, ids array<bigint>"
WORDS = RELATION + ", own array<struct<id: bigint, lang: string, word: string>>"
SENT = "part int, shard bigint, body binary"
#: An answer to a shard (shard, body), or a frequent phrase (id, x, y, f).
MET = "part int, shard bigint, body binary, id bigint, x bigint, y bigint, f bigint"


def _list_of(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """task, lang, text -> shards: the words of their texts as numbers (0 between pieces), and the words."""
    number, ids, held, shard = count(1), {}, [], 0

    def fresh() -> defaultdict:
        known = defaultdict(number.__next__)
        known[_MARK] = 0
        return known

    def close(task: int) -> pa.RecordBatch:
        seq = np.concatenate(held)
        n = np.bincount(seq)
        of = sorted((k, lang, word) for lang, known in ids.items() for word, k in known.items() if k)
        columns = [
            pa.array([lang for _, lang, _ in of], pa.string()),
            pa.array([word for _, _, word in of], pa.binary()).cast(pa.string()),
            pa.array(n[1:], pa.int64()),
        ]
        words = pa.StructArray.from_arrays(columns, ["lang", "word", "n"])
        words = pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), words)
        return pa.RecordBatch.from_arrays([pa.array([task * SHARDS_PER_TASK + shard], pa.int64()), _list_of(seq, pa.int32()), words], ["shard", "seq", "words"])

    task = size = 0
    for batch in batches:
        for task, lang, text in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()))), strict=True):
            tokens = text.lower().translate(_TO_MARKS).replace(_MARK, b" \xff ").split()
            tokens.append(_MARK)
            known = ids.get(lang)
            if known is None:
                known = ids[lang] = fresh()
            held.append(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))
            size += len(tokens)
            if size >= SHARD_WORDS:
                yield close(task)
                number, ids, held, size, shard = count(1), {}, [], 0, shard + 1
    if size:
        yield close(task)


def _numbers(batch: pa.RecordBatch, column: int, row: int) -> np.ndarray:
    return batch.column(column)[row].values.to_numpy(zero_copy_only=False)


def _by_part(batch: pa.RecordBatch, column: int, row: int) -> dict[int, bytes]:
    return {m["part"]: m["body"] for m in batch.column(column)[row].as_py()}


def _relation(shard: int, seq: np.ndarray, ids: np.ndarray, **more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "seq": _list_of(seq, pa.int32()), "ids": _list_of(ids, pa.int64()), **more})


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers, byte by byte and compressed; the first column, ascending, as steps."""
    rows = np.concatenate([np.diff(columns[0], prepend=0), *columns[1:]]).astype("<i8")
    return zstandard.compress(rows.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(packed: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    first, *rest = np.ascontiguousarray(planes.T).view("<i8").reshape(columns, -1)
    return [np.cumsum(first), *rest]


def _hash(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + y.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # every bit of x and y reaches every bit of h
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _dealt(part: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by part and keys (one: slots, of which equal ones may come in any order), and each part with its bounds in that order."""
    order = np.lexsort((*reversed(keys), part)) if len(keys) > 1 else np.argsort((part << SLOT_BITS) | keys[0])
    parts, first = np.unique(part[order], return_index=True)
    ends = np.append(first[1:], len(part))[: len(parts)]  # of no keys, no part
    return order, list(zip(parts.tolist(), first.tolist(), ends.tolist(), strict=True))


def _slots(x: np.ndarray, y: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, slot of the part) of keys, the same in every shard."""
    h = _hash(x, y)
    return ((h >> np.uint64(SLOT_BITS)) % np.uint64(parts)).astype(np.int64), (h & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _sent(shard: int, bodies: list[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, packed = zip(*bodies, strict=True) if bodies else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([shard] * len(parts), pa.int64()), pa.array(packed, pa.binary())], ["part", "shard", "body"])


def _send(shard: int, x: np.ndarray, y: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """The counts of a shard's keys for each part."""
    order, cuts = _dealt(_slots(x, y, parts)[0], x, y)
    x, y, n = x[order], y[order], n[order]
    return _sent(shard, [(part, _pack(x[i:j], y[i:j], n[i:j])) for part, i, j in cuts])


def _meet(least: int):
    """applyInArrow function: the keys of a part, shard by shard -> the frequent ones, and the answer to every shard."""

    def run(rows: pa.Table) -> pa.Table:
        part, shards = rows.column("part")[0].as_py(), rows.column("shard").to_numpy()
        lists = [_unpack(body, 3) for body in rows.column("body").to_pylist()]
        sizes = [len(x) for x, _, _ in lists]
        x, y, n = (np.concatenate(c) for c in zip(*lists, strict=True))
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(new)
        f = np.add.reduceat(n[order], first)
        owner = np.minimum.reduceat(np.repeat(shards, sizes)[order], first)
        frequent = np.flatnonzero(f >= least)
        rank = np.full(len(first), -1, np.int64)
        rank[frequent] = np.arange(len(frequent))
        group = np.empty(len(x), np.int64)
        group[order] = np.cumsum(new) - 1
        answers, end = [], 0
        for shard, size in zip(shards.tolist(), sizes, strict=True):
            own = group[end : end + size]
            ranks, end = rank[own], end + size
            hit = ranks >= 0
            answers.append(_answer(hit, owner[own[hit]] == shard, ranks[hit]))
        k, m = len(answers), len(frequent)
        columns = [
            pa.array([part] * (k + m), pa.int32()),
            pa.array([*shards.tolist(), *[None] * m], pa.int64()),
            pa.array([*answers, *[None] * m], pa.binary()),
            *(pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(c, pa.int64())]) for c in ((part << 32) | rank[frequent], x[first[frequent]], y[first[frequent]], f[frequent])),
        ]
        return pa.table(columns, ["part", "shard", "body", "id", "x", "y", "f"])

    return run


def _answer(hit: np.ndarray, own: np.ndarray, ranks: np.ndarray) -> bytes:
    """Which of a shard's keys are frequent; of those, which the shard is the first to hold, and their ranks."""
    return zstandard.compress(np.packbits(hit).tobytes() + np.packbits(own).tobytes() + np.diff(ranks, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _answered(cuts: list[tuple[int, int, int]], answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in the order sent, ids, whether the shard is the first) of a shard's frequent keys."""
    at, ids, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for part, i, j in cuts:
        raw = np.frombuffer(zstandard.decompress(answers[part]), np.uint8)
        bits = (j - i + 7) // 8
        hit = np.flatnonzero(np.unpackbits(raw[:bits], count=j - i))
        own = bits + (len(hit) + 7) // 8
        first.append(np.unpackbits(raw[bits:own], count=len(hit)).astype(bool))
        steps = np.ascontiguousarray(raw[own:].reshape(4, -1).T).view("<u4").reshape(-1)
        ids.append((part << 32) | np.cumsum(steps, dtype=np.int64))
        at.append(i + hit)
    return np.concatenate(at), np.concatenate(ids), np.concatenate(first)


def _word_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 128-bit hash of every (lang, word) of a shard."""
    langs, said = words.field(0).cast(pa.binary()).to_pylist(), words.field(1).cast(pa.binary()).to_pylist()
    raw = b"".join(xxhash.xxh3_128_digest(lang + _MARK + word) for lang, word in zip(langs, said, strict=True))
    pair = np.frombuffer(raw, np.int64).reshape(-1, 2)
    return pair[:, 0], pair[:, 1]


def _send_words(parts: int):
    """mapInArrow function: shard, words -> its words' counts for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                words = batch.column(1)[row].values
                yield _send(shard, *_word_keys(words), words.field(2).to_numpy(zero_copy_only=False), parts)

    return run


def _keep_words(parts: int):
    """mapInArrow function: shard, seq, words and the answers -> the relation of single words, and those it is the first to hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                seq, words = _numbers(batch, 1, row), batch.column(2)[row].values
                x, y = _word_keys(words)
                order, cuts = _dealt(_slots(x, y, parts)[0], x, y)
                place, ids, first = _answered(cuts, _by_part(batch, 3, row))
                place = order[place]
                compact = np.zeros(len(x) + 1, np.int32)
                compact[place + 1] = np.arange(1, len(place) + 1)
                mine = words.take(pa.array(place[first]))
                own = pa.StructArray.from_arrays([pa.array(ids[first]), mine.field(0), mine.field(1)], ["id", "lang", "word"])
                yield _relation(shard, compact[seq], ids, own=pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))

    return run


def _adjacent(seq: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, pairs) where phrases start at a place and at the next one."""
    at = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
    return at, seq[at].astype(np.int64) * (n + 1) + seq[at + 1]


def _parted(pairs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the two phrases of pairs."""
    a, b = np.divmod(pairs, len(ids) + 1)
    return ids[a - 1], ids[b - 1]


def _count_slots(parts: int):
    """mapInArrow function: a relation -> for each part, the counts of its slots in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                ids = _numbers(batch, 2, row)
                pairs, n = np.unique(_adjacent(_numbers(batch, 1, row), len(ids))[1], return_counts=True)
                part, slot = _slots(*_parted(pairs, ids), parts)
                order, cuts = _dealt(part, slot)
                slot, n = slot[order], n[order]
                yield _sent(shard, [(part, _pack(slot[i:j], n[i:j])) for part, i, j in cuts])

    return run


def _mark_slots(least: int):
    """applyInArrow function: the counts of a part, shard by shard -> for each shard, which of them are of slots with ``least``."""

    def run(rows: pa.Table) -> pa.Table:
        lists = [_unpack(body, 2) for body in rows.column("body").to_pylist()]
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for slots, n in lists:
            np.add.at(counts, slots, n)
        reach = counts >= least
        marks = [np.packbits(reach[slots]).tobytes() for slots, _ in lists]
        return pa.table([rows.column("part"), rows.column("shard"), pa.array(marks, pa.binary())], ["part", "shard", "body"])

    return run


def _possible(pairs: np.ndarray, ids: np.ndarray, parts: int, marks: dict[int, bytes]) -> np.ndarray:
    """Places of the pairs whose slots reach the count, ascending."""
    part, slot = _slots(*_parted(pairs, ids), parts)
    order, cuts = _dealt(part, slot)
    reach = [np.unpackbits(np.frombuffer(marks[part], np.uint8), count=j - i) for part, i, j in cuts]
    return np.sort(order[np.concatenate(reach).astype(bool)]) if reach else order


def _send_pairs(parts: int):
    """mapInArrow function: a relation and its marks -> its possible pairs' counts for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                ids = _numbers(batch, 2, row)
                pairs, n = np.unique(_adjacent(_numbers(batch, 1, row), len(ids))[1], return_counts=True)
                kept = _possible(pairs, ids, parts, _by_part(batch, 3, row))
                yield _send(shard, *_parted(pairs[kept], ids), n[kept], parts)

    return run


def _keep_pairs(parts: int):
    """mapInArrow function: a relation, its marks and the answers -> the relation of the longer phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                seq, ids = _numbers(batch, 1, row), _numbers(batch, 2, row)
                at, said = _adjacent(seq, len(ids))
                pairs = np.unique(said)
                pairs = pairs[_possible(pairs, ids, parts, _by_part(batch, 3, row))]
                a, b = _parted(pairs, ids)
                order, cuts = _dealt(_slots(a, b, parts)[0], a, b)
                place, new, _ = _answered(cuts, _by_part(batch, 4, row))
                place = order[place]
                up = np.argsort(place)
                kept, new = pairs[place[up]], new[up]
                longer = np.zeros(len(seq), np.int32)
                if len(kept):
                    number = np.minimum(np.searchsorted(kept, said), len(kept) - 1)
                    same = kept[number] == said
                    longer[at[same]] = number[same] + 1
                yield _relation(shard, longer, new)

    return run


def _by_shard(rows: DataFrame, name: str) -> DataFrame:
    """shard, ``name``: what every part has for the shard."""
    return rows.groupBy("shard").agg(F.collect_list(F.struct("part", "body")).alias(name))


def _met(sent: DataFrame, least: int, label: str) -> tuple[DataFrame, DataFrame]:
    """(frequent phrases: id, x, y, f; answers by shard)."""
    met = scratch(sent.groupBy("part").applyInArrow(_meet(least), MET), label)
    return met.where("shard IS NULL").select("id", "x", "y", "f"), _by_shard(met.where("shard IS NOT NULL"), "answers")


def _parts(occurrences: int | None) -> int:
    return 1 + (occurrences or 0) // PART_WORDS


def frequent_phrases(docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1, 2, ... words said ``least`` times or more, and the words of each language.

    The first are tables (lang, id, phrase, tail, f, begins, ends): tail is the last word, begins the counts of
    the first 1, 2, ... words, ends those of the last 1, 2, ...; longer phrases also have a, b, the ids of the phrases
    without the last and the first word.  Ids are of one length.  The second has (lang, n).
    """
    texts = docs.select(F.spark_partition_id().alias("task"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), text_of().alias("text"))
    shards = co_located(texts.mapInArrow(_shards, SHARDS), "shard", "words", "zstd")
    words = shards.select(F.explode("words").alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("n"))
    words = scratch(words, "words")
    with batches_of(docs.sparkSession, SHARD_BYTES):
        parts = _parts(words.agg(F.sum("n")).first()[0])
        phrases, answers = _met(shards.select("shard", "words").mapInArrow(_send_words(parts), SENT), least, "frequent-1")
        kept = shards.join(answers, "shard").select("shard", "seq", "words", "answers").mapInArrow(_keep_words(parts), WORDS)
        relation = co_located(kept, "shard", "relation_1", "zstd")
        empty = F.array().cast("array<bigint>")
        own = relation.select(F.explode("own").alias("w")).select("w.id", "w.lang", F.col("w.word").alias("phrase"))
        found = [scratch(own.join(phrases, "id").select("lang", "id", "phrase", F.col("phrase").alias("tail"), "f", empty.alias("begins"), empty.alias("ends")), "phrases-1")]
        for length in range(2, longest + 1):
            parts = _parts(phrases.agg(F.sum("f")).first()[0])
            marks = relation.select("shard", "seq", "ids").mapInArrow(_count_slots(parts), SENT).groupBy("part").applyInArrow(_mark_slots(least), SENT)
            marked = relation.select("shard", "seq", "ids").join(scratch(_by_shard(marks, "marks"), f"marks-{length}"), "shard")
            phrases, answers = _met(marked.mapInArrow(_send_pairs(parts), SENT), least, f"frequent-{length}")
            pairs = phrases.withColumnsRenamed({"x": "a", "y": "b"})
            found.append(scratch(_longer(pairs, found[-1]), f"phrases-{length}"))
            if length < longest:
                relation = co_located(marked.join(answers, "shard").mapInArrow(_keep_pairs(parts), RELATION), "shard", f"relation_{length}", "zstd")
    return found, words


def _longer(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases put together from their parts without the last and without the first word."""
    first = shorter.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"), F.concat("begins", F.array("f")).alias("begins"))
    rest = shorter.select(F.col("id").alias("b"), "tail", F.concat("ends", F.array("f")).alias("ends"))
    both = pairs.join(first, "a").join(rest, "b")
    return both.select("lang", "id", F.concat_ws(" ", "head", "tail").alias("phrase"), "tail", "f", "begins", "ends", "a", "b")


def _inside(found: list[DataFrame]) -> DataFrame:
    """length, id, most: the largest count of a longer phrase that contains this one (of two words or more)."""
    parts, links = None, []
    for length, phrases in enumerate(found, start=1):
        if length < 3:
            continue
        own = phrases.select("id", "f", F.lit(length - 1).alias("length"), F.explode(F.array("a", "b")).alias("part"))
        if parts is not None:  # parts of its parts
            inner = parts.select(F.col("id").alias("part"), F.col("length").alias("deep_length"), F.col("part").alias("deep"))
            deeper = own.join(inner, "part").select("id", "f", F.col("deep_length").alias("length"), F.col("deep").alias("part"))
            own = own.unionByName(deeper).distinct()
        parts = own
        links.append(own)
    if not links:
        return found[0].select(F.lit(0).alias("length"), "id", F.lit(0).cast("bigint").alias("most")).limit(0)
    rows = reduce(DataFrame.unionByName, links)
    return rows.groupBy("length", F.col("part").alias("id")).agg(F.max("f").alias("most"))


def _score(a: Column, parts: Column) -> Column:
    """floor(2000000 * a / parts) in whole numbers; the product may pass 64 bits."""
    product = a.cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    return F.call_function("div", product, parts.cast("decimal(20,0)"))


def collocations(docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language.

    A candidate is a phrase of 2 to ``longest`` words said a >= ``least`` times.  Cut in two it scores
    floor(2000000 * a / (l + r)) by the counts of its parts; the lowest cut counts (ties: the first part with
    fewer words).  Candidates go that lie inside a longer one said at least 80 % as often.

    Defined cases: a null text says nothing; a null lang is ``und``; repeated rows and rows without a doc_id count
    like any other; empty pieces and texts give no occurrence; an empty table gives no row; other columns are not read.
    """
    found, words = frequent_phrases(docs, least, longest)
    kept = None
    for length, phrases in enumerate(found[1:], start=2):
        l, r = (lambda k: F.get("begins", F.lit(k - 1))), (lambda k, m=length: F.get("ends", F.lit(m - k - 1)))
        cuts = [F.struct(_score(F.col("f"), l(k) + r(k)).alias("score"), F.lit(k).alias("k"), l(k).alias("l"), r(k).alias("r")) for k in range(1, length)]
        rows = phrases.select("lang", F.lit(length).alias("length"), "id", "phrase", "f", F.array_min(F.array(*cuts)).alias("cut"))
        kept = rows if kept is None else kept.unionByName(rows)
    kept = kept.join(_inside(found), ["length", "id"], "left").where(F.col("most").isNull() | (100 * F.col("most") < 80 * F.col("f")))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("f").desc(), F.col("phrase").asc())
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def op11_collocations(docs: DataFrame) -> DataFrame:
    """The 2000 best collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    return collocations(docs)
