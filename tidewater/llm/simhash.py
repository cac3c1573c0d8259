"""SimHash near-dedup through an inverted index on byte positions with count filtering.

A 64-bit fingerprint is 8 bytes, each at its position.  Fingerprints within
``MAX_BITS`` = 2 differing bits share at least 8 - 2 = 6 positional bytes.  The
index is keyed by sets of four byte positions: any two fingerprints sharing
six positional bytes agree on all four bytes of at least one of the six sets
in ``POSITION_SETS`` (the complements of those sets cover every pair of
positions).  Pairs that meet in a posting list have their shared positional
bytes tallied; those with six or more are retained and verified by bits.

Documents of equal fingerprints are one class; only classes are indexed.  A
posting list longer than ``LIST_BOUND`` is not paired up.  Its fingerprints are
linked exactly through the 65 values within one bit of each: two values are
within two bits if and only if those neighbourhoods meet, so a neighbourhood value
holds at most 65 fingerprints, all within two bits of one another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import LAST_ID, free_name, id_order, scratch, text_of
from tidewater.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
LIST_BOUND = 64
#: Four-byte position sets; what they leave out, four positions each, covers every pair of positions.
POSITION_SETS = (
    (4, 5, 6, 7),
    (2, 3, 6, 7),
    (2, 3, 4, 5),
    (0, 1, 6, 7),
    (0, 1, 4, 5),
    (0, 1, 2, 3),
)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    n = len(hashes)
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, BYTES)
    # bits are counted in slices, so that a very long text needs no array of 64 bytes a word
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        counts += np.unpackbits(rows[k : k + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints)], [*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, key (a hash of the text), fp (the fingerprint's bits as a signed long)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("key"), text_of().alias("text"))
    return rows.mapInArrow(_fingerprints(width), "doc_id bigint, key bigint, fp bigint")


def _byte(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally of positions at which two fingerprints have equal bytes."""
    tally = F.lit(0)
    for k in range(BYTES):
        tally = tally + (_byte(a, k) == _byte(b, k)).cast("int")
    return tally


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(255 << (8 * k) for k in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: edges that connect exactly the fingerprints (column fp, distinct) linked within ``max_bits`` bits.

    Pairs from ordinary posting lists are all verified pairs; long lists give,
    for every neighbourhood value, links to its smallest fingerprint.
    """
    if max_bits != MAX_BITS:
        raise ValueError("the position sets are made for two bits")
    keys = [F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("bytes")) for i, p in enumerate(POSITION_SETS)]
    postings = scratch(classes.select("fp", F.inline(F.array(*keys))), "postings")
    lists = postings.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    lists = scratch(lists, "lists")
    short = lists.where(F.col("n") <= LIST_BOUND).select("set", "bytes")
    mine = postings.join(short, ["set", "bytes"])
    pairs = mine.alias("l").join(mine.alias("r"), ["set", "bytes"]).where("l.fp < r.fp")
    pairs = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    pairs = pairs.where(shared_bytes(F.col("a"), F.col("b")) >= BYTES - max_bits)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()

    long = postings.join(lists.where(F.col("n") > LIST_BOUND).select("set", "bytes"), ["set", "bytes"]).select("fp").distinct()
    flips = [0, *(1 << k for k in range(63)), -(1 << 63)]
    near = long.select("fp", F.explode(F.transform(F.array(*[F.lit(v).cast("bigint") for v in flips]), lambda v: F.col("fp").bitwiseXOR(v))).alias("z"))
    met = near.groupBy("z").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, fp, component_id (the smallest doc_id that its fingerprint reaches by links).

    Defined cases: null, empty and wordless texts have fingerprint 0, linked
    like any other; a repeated row has its class's result; a null doc_id counts
    as the largest id, so a component has a null component_id only if all its
    ids are null; extra columns are ignored; an empty table gives no rows.
    """
    prints, labelled = _labelled(docs, width)
    smallest = labelled.groupBy("root").agg(F.min("first.id").alias("least"))
    named = labelled.join(smallest, "root").select("fp", F.nullif(F.col("least"), F.lit(LAST_ID)).alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _labelled(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprints; per distinct one: fp, first (the smallest id and key that have it), root of its component)."""
    prints = scratch(fingerprints(docs, width), "fingerprints")
    classes = scratch(prints.groupBy("fp").agg(F.min(F.struct(id_order().alias("id"), "key")).alias("first")), "classes")
    roots = components(links(classes))
    labelled = classes.join(roots, classes["fp"] == roots["vertex"], "left")
    return prints, scratch(labelled.select("fp", "first", F.coalesce("root", "fp").alias("root")), "labelled")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """One document of each component, the one of smallest doc_id (null last), with its own columns.

    A document is an id and a text: of texts under one id in a component the one with the smallest hash
    stays, those in other components are not touched, and documents without an id are told apart by their texts.
    Rows that agree in id and text come down to one.  Only the ids and hashes that go, or stand on several rows, are
    joined to the texts.
    """
    prints, labelled = _labelled(docs, width)
    kept = labelled.join(labelled.groupBy("root").agg(F.min("first").alias("kept")), "root").select("fp", "kept")
    found = prints.join(kept, "fp").withColumn("own", F.struct(id_order().alias("id"), "key"))
    id_, key = free_name(docs, "near_id"), free_name(docs, "near_key")
    marks = found.groupBy("own").agg(F.count("*").alias("n"), F.first("kept").alias("kept"))
    marks = scratch(marks.where("own <> kept OR n > 1").select(F.col("own.id").alias(id_), F.col("own.key").alias(key), (F.col("own") != F.col("kept")).alias("goes")), "marks")
    same = (id_order() == F.col(id_)) & (F.xxhash64(text_of()) == F.col(key))
    left = docs.join(marks.where("goes").select(id_, key), same, "left_anti")
    twice = marks.where("NOT goes").select(id_, key)
    if not twice.limit(1).count():
        return left
    # one row of each: the first of a task, then the first of those
    one = left.withColumns({id_: id_order(), key: F.xxhash64(text_of())}).join(twice.withColumnsRenamed({id_: f"{id_}_", key: f"{key}_"}), (F.col(id_) == F.col(f"{id_}_")) & (F.col(key) == F.col(f"{key}_")), "left_semi")
    return left.join(twice, same, "left_anti").unionByName(one.dropDuplicates([id_, key]).drop(id_, key))


def op7_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, fingerprint, component_id."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
