"""Line dedup over documents, reversible: sharded cuckoo filters before exact reference counts.

State (``LineIndex``):

* ``postings``  id, x, y: one row for each document and line key in it;
* ``refs``      x, y, n, first_id, last_id: exact reference counts and holders;
* ``filters``   shard, filter: a cuckoo filter of every shard's keys, each
  entry marked if more than one document holds the key.

(x, y) is the 128-bit hash of a key.  Rows of one doc_id are one document: it has one posting for a key and counts
once.  The tables are kept in ``parts``, postings by id, references and filters by shard; a change reads and writes
only the parts it touches.  ``insert`` asks the filters which of a
batch's keys may be known; only those meet the reference counts.  ``delete``
counts the touched keys anew from the postings that stay.  Both bring the
filters up to date entry by entry, so inserting documents and deleting them
again gives the state before.  ``decisions`` asks the filters which lines may be
shared, and decides those by the exact counts.

A shard holds about ``KEYS_PER_SHARD`` keys, so the number of shards follows the
data and a filter has a fixed size.  A key held by very many documents is
combined before its count is shuffled; a shard's lines are probed in as many
tasks as their measured number asks for (``PROBE_ROWS`` each); the join that
decides them can be split.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import WHITE, free_name, id_order, scratch, text_of
from tidewater.llm.cuckoo import ABSENT, SHARED, SINGLE, SLOTS, Full, dump, empty, insert, load, probe, remove
from tidewater.session import scratch_dir

MIN_CODE_POINTS = 10
KEYS_PER_SHARD = 250_000
#: Lines of a shard that a task probes (on average).
PROBE_ROWS = 200_000
#: Parts of an index that is meant to be changed, and changes after which its parts are written together again.
PARTS = 64
PIECES = 16
_WHITE = WHITE.encode()


def _long_enough(key: bytes) -> bool:
    n = len(key)
    return n >= MIN_CODE_POINTS and (n >= 4 * MIN_CODE_POINTS or key.isascii() or len(key.decode()) >= MIN_CODE_POINTS)


def _digest(line: bytes) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short to count."""
    key = line.strip(_WHITE).lower()
    return xxhash.xxh3_128_digest(key) if _long_enough(key) else None


def _keys(batches):
    for batch in batches:
        ids, counts, raw = batch.column(0), [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            found = {d for d in map(_digest, set(text.split(b"\n"))) if d}
            counts.append(len(found))
            raw.extend(found)
        pair = np.frombuffer(b"".join(raw), dtype=np.int64).reshape(-1, 2)
        if len(pair):
            id_ = np.repeat(ids.to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([pa.array(id_), pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["id", "x", "y"])


def line_keys(docs: DataFrame) -> DataFrame:
    """id, x, y: the distinct line keys of every document; rows of one id are one document."""
    rows = docs.select(id_order().alias("id"), text_of().alias("text"))
    keys = scratch(rows.mapInArrow(_keys, "id bigint, x bigint, y bigint"), "line-keys")
    several = scratch(rows.groupBy("id").count().where("count > 1").select("id"), "line-several")
    if several.isEmpty():
        return keys
    return keys.join(several, "id", "left_anti").unionByName(keys.join(several, "id", "left_semi").distinct())


def _count(postings: DataFrame) -> DataFrame:
    return postings.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def _state(n: Column, first: Column, last: Column) -> Column:
    return F.when(n.isNull(), ABSENT).when(first == last, SINGLE).otherwise(SHARED).cast("int")


def _shard(shards: int) -> Column:
    return F.pmod(F.col("x"), F.lit(shards)).cast("int")


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    x, y, shared = (pdf[c].to_numpy() for c in ("x", "y", "shared"))
    table = empty(len(x))
    while True:
        try:
            insert(table, x, y, shared.astype(np.int64))
            break
        except Full:
            table = np.zeros((2 * len(table), SLOTS), dtype=np.uint16)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [dump(table)]})


def _change_filter(key, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter after its changes; null if it has become too full."""
    table = load(old["filter"].iloc[0]).copy() if len(old) else empty(max(1, len(changes)))
    x, y, was, now = (changes[c].to_numpy() for c in ("x", "y", "was", "now"))
    try:
        out, into = was != ABSENT, now != ABSENT
        remove(table, x[out], y[out], (was[out] == SHARED).astype(np.int64))
        insert(table, x[into], y[into], (now[into] == SHARED).astype(np.int64))
        raw = dump(table)
    except Full:
        raw = None
    return pd.DataFrame({"shard": [key[0]], "filter": [raw]})


def _filters(refs: DataFrame, shards: int) -> DataFrame:
    rows = refs.select(_shard(shards).alias("shard"), "x", "y", (F.col("first_id") != F.col("last_id")).alias("shared"))
    return rows.groupBy("shard").applyInPandas(_build_filter, "shard int, filter binary")


@dataclass(frozen=True)
class Parts:
    """A table in ``n`` parts by the column expression ``by``.

    It is held in pieces, each a written table (with its column ``part``, which is a folder) and the parts of it that
    still hold.  A change adds a piece with the parts it touches; the others stay where they are.
    """

    by: Column
    n: int
    pieces: tuple[tuple[DataFrame, frozenset[int]], ...]

    @staticmethod
    def of(df: DataFrame, by: Column, n: int, label: str) -> Parts:
        """``df`` in ``n`` parts; one part is taken as it is."""
        whole = frozenset(range(n))
        return Parts(by, n, ((df if n == 1 else _in_parts(df, by, n, label), whole),))

    def touched(self, rows: DataFrame) -> frozenset[int]:
        """The parts that these rows are in: ``n`` numbers at most."""
        if self.n == 1:
            return frozenset([0])
        return frozenset(r[0] for r in rows.select(F.pmod(self.by, F.lit(self.n)).cast("int")).distinct().collect())

    def read(self, parts: frozenset[int] | None = None) -> DataFrame:
        out = []
        for table, holds in self.pieces:
            wanted = holds if parts is None else holds & parts
            held = table.where(F.col("part").isin(sorted(wanted))).drop("part") if "part" in table.columns else table if wanted else table.limit(0)
            out.append(held)
        return reduce(DataFrame.unionByName, out)

    def replace(self, parts: frozenset[int], rows: DataFrame, label: str) -> Parts:
        """The table with ``rows`` as the content of ``parts``."""
        new = scratch(rows, label) if self.n == 1 else _in_parts(rows, self.by, self.n, label)
        held = tuple((table, holds - parts) for table, holds in self.pieces if holds - parts)
        out = Parts(self.by, self.n, (*held, (new, parts)))
        return Parts.of(out.read(), self.by, self.n, label) if len(out.pieces) > PIECES else out


def _in_parts(df: DataFrame, by: Column, n: int, label: str) -> DataFrame:
    """``df`` written in folders by part."""
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    rows = df.withColumn("part", F.pmod(by, F.lit(n)).cast("int"))
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _probe(batches):
    """Rows of a shard: its filter first, then the keys; gives the keys that may be present, with their state."""
    shard, table = None, None
    for batch in batches:
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(1).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((shards[1:] != shards[:-1]) | (tags[1:] == 0) | (tags[:-1] == 0)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if tags[a] == 0:
                shard, table = shards[a], load(batch.column(2)[a].as_py())
                continue
            if shard != shards[a]:  # a shard without any key
                continue
            part = batch.slice(a, b - a)
            x, y = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (4, 5))
            state = probe(table, x, y)
            may = np.flatnonzero(state)
            if len(may):
                rows = part.take(pa.array(may))
                yield pa.RecordBatch.from_arrays([rows.column(3), rows.column(4), rows.column(5), pa.array(state[may])], ["id", "x", "y", "state"])


@dataclass(frozen=True)
class LineIndex:
    posting_parts: Parts
    ref_parts: Parts
    filter_parts: Parts
    shards: int
    keys_per_shard: int = KEYS_PER_SHARD

    @staticmethod
    def build(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD, parts: int = 1) -> LineIndex:
        """The index of ``docs``, in ``parts`` parts (``PARTS`` for one that is meant to be changed)."""
        postings = line_keys(docs)
        refs = scratch(_count(postings), "line-refs")
        return LineIndex._of(Parts.of(postings, F.xxhash64("id"), parts, "line-postings"), refs, keys_per_shard, parts)

    @staticmethod
    def _of(postings: Parts, refs: DataFrame, keys_per_shard: int, parts: int) -> LineIndex:
        shards = max(1, -(-refs.count() // keys_per_shard))
        filters = scratch(_filters(refs, shards), "filters")
        return LineIndex(
            postings, Parts.of(refs, _shard(shards), parts, "line-refs"), Parts.of(filters, F.col("shard"), parts, "filters"), shards, keys_per_shard
        )

    @property
    def postings(self) -> DataFrame:
        return self.posting_parts.read()

    @property
    def refs(self) -> DataFrame:
        return self.ref_parts.read()

    @property
    def filters(self) -> DataFrame:
        return self.filter_parts.read()

    def probe(self, keys: DataFrame, filters: DataFrame | None = None) -> DataFrame:
        """Rows of ``keys`` (id, x, y) that may be in the index, with state SINGLE or SHARED."""
        filters = self.filters if filters is None else filters
        dealt = keys.select(_shard(self.shards).alias("shard"), "id", "x", "y")
        many = dealt.groupBy("shard").count().select("shard", F.ceil(F.col("count") / PROBE_ROWS).cast("int").alias("salts"))
        many = scratch(many.where("salts > 1"), "line-salts")  # only shards that take more than one task
        salts = F.coalesce("salts", F.lit(1))
        filters = filters.join(many, "shard", "left").select(
            "shard", F.lit(0).alias("tag"), "filter", F.lit(None).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"),
            F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        )
        rows = dealt.join(many, "shard", "left").select(
            "shard", F.lit(1).alias("tag"), F.lit(None).cast("binary").alias("filter"), "id", "x", "y", F.pmod(F.xxhash64("id", "y"), salts).cast("int").alias("salt")
        )
        dealt = filters.unionByName(rows).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "tag")
        return dealt.mapInArrow(_probe, "id bigint, x bigint, y bigint, state int")

    def decisions(self, keys: DataFrame | None = None) -> DataFrame:
        """id, x, y of the lines to drop: shared keys in documents other than the first holder."""
        may = self.probe(self.postings if keys is None else keys).where(F.col("state") == SHARED)
        held = self.refs.where("first_id < last_id").select("x", "y", "first_id")
        return may.join(held, ["x", "y"]).where("id > first_id").select("id", "x", "y")

    def _changed(self, postings: Parts, parts: frozenset[int], before: DataFrame, after: DataFrame) -> LineIndex:
        """Index with new postings; before, after: the touched keys' counts, all of these parts of the references."""
        kept = self.ref_parts.read(parts).join(before.select("x", "y"), ["x", "y"], "left_anti")
        refs = self.ref_parts.replace(parts, kept.unionByName(after), "line-refs")
        b = before.select("x", "y", _state(F.col("n"), F.col("first_id"), F.col("last_id")).alias("was"))
        a = after.select("x", "y", _state(F.col("n"), F.col("first_id"), F.col("last_id")).alias("now"))
        moved = b.join(a, ["x", "y"], "full").select(
            _shard(self.shards).alias("shard"), "x", "y", F.coalesce("was", F.lit(ABSENT)).alias("was"), F.coalesce("now", F.lit(ABSENT)).alias("now")
        )
        moved = moved.where("was <> now")
        # a part of the references is the same part of the filters: both follow the shard
        old = self.filter_parts.read(parts).groupBy("shard")
        changed = scratch(old.cogroup(moved.groupBy("shard")).applyInPandas(_change_filter, "shard int, filter binary"), "filters")
        if not changed.where("filter IS NULL").isEmpty():
            # a filter has no place left: deal the keys to more shards
            return LineIndex._of(postings, scratch(refs.read(), "line-refs"), self.keys_per_shard, self.ref_parts.n)
        return LineIndex(postings, refs, self.filter_parts.replace(parts, changed, "filters"), self.shards, self.keys_per_shard)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with these documents added.

        A document that the index has already gains the keys it had not; inserting it again changes nothing.
        """
        keys = scratch(line_keys(docs), "line-new")
        homes = self.posting_parts.touched(keys)
        held = self.posting_parts.read(homes)
        new = scratch(keys.join(held, ["id", "x", "y"], "left_anti"), "line-new")
        postings = self.posting_parts.replace(homes, held.unionByName(new), "line-postings")
        batch = scratch(_count(new), "line-batch")
        parts = self.ref_parts.touched(batch)
        known = self.probe(batch.select(F.lit(0).cast("bigint").alias("id"), "x", "y"), self.filter_parts.read(parts))
        known = scratch(known.select("x", "y"), "line-known")
        fresh = batch.join(known, ["x", "y"], "left_anti")
        before = scratch(self.ref_parts.read(parts).join(known, ["x", "y"], "left_semi"), "line-before")
        both = before.unionByName(batch.join(known, ["x", "y"], "left_semi"))
        merged = both.groupBy("x", "y").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
        return self._changed(postings, parts, before, scratch(merged.unionByName(fresh), "line-after"))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of these ids (column doc_id).

        Counts of the touched keys are made anew from the postings that stay, since a first or last holder may go.
        """
        gone = scratch(ids.select(id_order().alias("id")).distinct(), "line-gone")
        homes = self.posting_parts.touched(gone)
        held = self.posting_parts.read(homes)
        keys = scratch(held.join(gone, "id", "left_semi").select("x", "y").distinct(), "line-touched")
        postings = self.posting_parts.replace(homes, held.join(gone, "id", "left_anti"), "line-postings")
        parts = self.ref_parts.touched(keys)
        before = scratch(self.ref_parts.read(parts).join(keys, ["x", "y"], "left_semi"), "line-before")
        after = scratch(_count(postings.read().join(keys, ["x", "y"], "left_semi")), "line-after")
        return self._changed(postings, parts, before, after)


def _drop_lines(columns: list[str], text_at: int):
    """mapInArrow function: the last column holds a document's keys to drop as list<struct<x, y>> or null."""

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            pair = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(2)], axis=1).astype(np.int64)
            raw, ends = pair.tobytes(), np.cumsum(sizes)
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            lines, dropped = [], []
            for i, text in enumerate(texts):
                parts = (text or b"").split(b"\n")
                lines.append(len(parts))
                dropped.append(0)
                if sizes[i] and text is not None:
                    end = int(ends[i])
                    gone = {raw[16 * k : 16 * k + 16] for k in range(end - int(sizes[i]), end)}
                    kept = [x for x in parts if _digest(x) not in gone]
                    dropped[i] = len(parts) - len(kept)
                    texts[i] = b"\n".join(kept)
            out = [batch.column(k) for k in range(batch.num_columns - 1)]
            out[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], columns)

    return run


def dedup_lines(docs: DataFrame, index: LineIndex | None = None) -> DataFrame:
    """``docs`` without repeated lines, and __n_lines, __n_dropped (with underscores after them if docs has such columns).

    A line's key is the line stripped of ASCII white space at both ends with
    A-Z lower-cased.  A key of at least ``MIN_CODE_POINTS`` code points held by
    two documents or more keeps its lines only in the smallest doc_id.

    Defined cases: a null text stays null and counts one (empty) line; an
    empty text is one empty line; a document may lose all its lines (text '');
    rows of one doc_id are one document when holders are counted and lose the
    same keys, so a repeated row drops nothing by itself; null doc_ids are
    together the last document; a line repeated inside its document stays.
    """
    index = index or LineIndex.build(docs)
    id_, gone = free_name(docs, "line_id"), free_name(docs, "line_drops")
    drops = index.decisions().groupBy(F.col("id").alias(id_)).agg(F.collect_list(F.struct("x", "y")).alias(gone))
    joined = docs.join(drops, id_order() == F.col(id_), "left").select(*docs.columns, gone)
    counts = [T.StructField(free_name(docs, c), T.LongType()) for c in ("__n_lines", "__n_dropped")]
    schema = T.StructType([*docs.schema.fields, *counts])
    return joined.mapInArrow(_drop_lines(schema.names, docs.columns.index("text")), schema)


def op6_line_dedup(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(text_of(), 256).alias("kept_sha256")
    )
