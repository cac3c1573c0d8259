"""Token counts of whole texts without token ids.

The tokenizer never joins pieces across white space, so the tokens of a text are
the sum of the tokens of its pre-tokens, here the runs between ASCII white
space.

1. Pre-tokens of all documents are counted (a task combines its own first);
   each distinct one is tokenized once.
2. Per-document frequencies meet those piece counts.  The pre-tokens found in
   most documents, ``HEAD`` at most, are broadcast (so the table is bounded) and summed
   where the documents are read; every other (document, pre-token, frequency)
   is joined by a shuffle, and the sums meet by document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch, text_of

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: Most pre-tokens whose piece counts every task holds.
HEAD = 300_000
#: Distinct pre-tokens a task combines before it passes them on.
HELD = 400_000
#: Pre-tokens tokenized at once.
ENCODED_TOGETHER = 4096


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> pre-token, documents that hold it; combined in the task."""
    seen: Counter = Counter()

    def rows() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["pre", "docs"])
        seen.clear()
        return batch

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            seen.update(set(text.split()))
            if len(seen) >= HELD:
                yield rows()
    if seen:
        yield rows()


def _pieces(path: str):
    """mapInArrow function: pre, docs -> pre, docs, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            pres = batch.column(0).cast(pa.string()).to_pylist()
            counts = []
            for k in range(0, len(pres), ENCODED_TOGETHER):
                encoded = tokenizer.encode_batch_fast(pres[k : k + ENCODED_TOGETHER], add_special_tokens=False)
                counts.extend(map(len, encoded))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int32())], ["pre", "docs", "n_tokens"])

    return run


def pre_tokens(docs: DataFrame, path: str | Callable[[], str]) -> DataFrame:
    """pre (binary), docs, n_tokens: every distinct pre-token of the corpus with its number of pieces."""
    counted = docs.select(text_of().alias("text")).mapInArrow(_distinct, "pre binary, docs bigint")
    counted = counted.groupBy("pre").agg(F.sum("docs").alias("docs"))
    return scratch(counted.mapInArrow(_pieces(path), "pre binary, docs bigint, n_tokens int"), "pre-tokens")


def _most_common(pieces: DataFrame, most: int) -> DataFrame:
    """pre, n_tokens of the most widespread pre-tokens, ``most`` at most.

    Cut at a power of 2 ** (1 / 8) in the number of documents: a histogram of a
    few hundred rows says which, so no task sorts or gathers the vocabulary.
    """
    step = F.floor(F.log2("docs") * 8).cast("int")
    total, cut = 0, None
    for row in sorted(pieces.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        cut = row["step"]
    return pieces.where(step >= cut if cut is not None else F.lit(False)).select("pre", "n_tokens")


def _frequencies(head):
    """mapInArrow function: doc_id, text -> uid, pre, n, and once per document doc_id, n_bytes, known (tokens of the head)."""
    names = ["uid", "pre", "n", "doc_id", "n_bytes", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = head.value
        # places in the input make a document's rows meet again: one stage numbers each document once
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            uids, pres, ns, ids, sizes, knowns = columns
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                uid += 1
                rest, known = Counter(), 0
                words = text.split()
                for word, count in zip(words, map(table.get, words), strict=True):
                    if count is None:
                        rest[word] += 1
                    else:
                        known += count
                # no pre-token holds a space, so the document's own row joins nothing
                uids.append(uid), pres.append(b" %d" % uid), ns.append(0)
                ids.append(id_), sizes.append(len(text)), knowns.append(known)
                k = len(rest)
                if k:
                    uids.extend([uid] * k), pres.extend(rest.keys()), ns.extend(rest.values())
                    none = [None] * k
                    ids.extend(none), sizes.extend(none), knowns.extend(none)
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def count_tokens(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens.

    Tokens are those the tokenizer file at ``path`` gives for the whole text
    without begin, end or added special tokens; strings of special tokens in a
    text count as the library's default has them.  The file must be at that
    path on every executor.

    Defined cases: a null text is empty; texts without a pre-token have 0
    tokens; repeated rows and null doc_ids give a row each; an empty table
    gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    pieces = pre_tokens(docs, path)
    common = _most_common(pieces, head).toArrow()
    table = dict(zip(common.column(0).to_pylist(), common.column(1).to_pylist(), strict=True))
    known = spark.sparkContext.broadcast(table)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    parts = rows.mapInArrow(_frequencies(known), "uid bigint, pre binary, n int, doc_id bigint, n_bytes bigint, known bigint")
    joined = parts.join(pieces.select("pre", "n_tokens"), "pre", "left")
    sums = joined.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        (F.max("known") + F.coalesce(F.sum(F.col("n").cast("bigint") * F.col("n_tokens")), F.lit(0))).alias("n_tokens"),
    )
    return sums.select("doc_id", "n_bytes", "n_tokens")


def op3_token_counts(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_bytes, n_tokens, over_limit."""
    counted = count_tokens(docs, tokenizer_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
