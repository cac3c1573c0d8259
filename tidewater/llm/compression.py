"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled
text.  A text is cut into blocks of ``BLOCK`` bytes, all of which are
compressed with both dictionaries; the difference of the two compressed sizes,
divided by the larger, says which kind of text it resembles.  A logistic
calibration on other labelled documents turns that difference into a
probability; it also sees the compressed share and the length, since a
difference means less in a short or a very repetitive text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of
from tidewater.llm.fitting import labelled_sample, logistic, probability, remainder

BLOCK = 4096
LEVEL = 3
#: Bounds of the fit: labelled documents, half of them for the dictionaries; blocks of text and bytes of each dictionary.
LABELLED_ROWS = 12_000
DICTIONARY_BLOCKS = 2000
DICTIONARY_BYTES = 112_640
HELD_OUT = (4, 2)
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    raw: tuple[bool, bool]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def _dictionary(blocks: list[bytes]) -> tuple[bytes, bool]:
    """Dictionary bytes, and whether they are plain content (too little text to train on)."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, k=256, d=8).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b"\n" * 8, True


def _compressor(content: bytes, raw: bool):
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO
    shared = zstandard.ZstdCompressionDict(content, dict_type=kind)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)


def _features(texts: list[bytes], good, bad) -> np.ndarray:
    """Rows of (normalised difference, compressed share, log of the length)."""
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        blocks = [text[k : k + BLOCK] for k in range(0, len(text), BLOCK)]
        g = sum(len(good.compress(b)) for b in blocks)
        b = sum(len(bad.compress(b)) for b in blocks)
        out[i] = (b - g) / max(b, g, 1), g / max(len(text), 1), np.log1p(len(text))
    return out


def _design(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The scaled features, their squares and products."""
    z = np.clip((features - mean) / scale, -6, 6)
    products = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i + 1)]
    return np.concatenate([z, np.stack(products, axis=1)], axis=1)


def _feature_rows(good: tuple, bad: tuple):
    def run(batches):
        with_good, with_bad = _compressor(*good), _compressor(*bad)
        for batch in batches:
            f = _features(batch.column(1).cast(pa.binary()).to_pylist(), with_good, with_bad)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(f[:, k]) for k in range(3))], ["label", "a", "b", "c"])

    return run


def fit(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = HELD_OUT, rows: int = LABELLED_ROWS) -> Model:
    """Dictionaries and calibration from at most ``rows`` labelled documents outside the held-out fold."""
    modulus, fold = held_out
    sample = labelled_sample(labels, "quality", remainder("doc_id", modulus) != fold, rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("__id"), text_of().alias("text")).join(F.broadcast(sample), "__id")
    # bounded: both joins keep the sampled ids only
    blocks = texts.where("__rank < 0.5").select("__label", "__id", F.encode("text", "UTF-8").alias("raw"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("raw"), F.lit(1)), F.lit(BLOCK))
    blocks = blocks.select("__label", "__id", "raw", F.explode(starts).alias("at"))
    blocks = blocks.select("__label", F.substring("raw", F.col("at"), F.lit(BLOCK)).alias("block"), F.xxhash64("__id", "at").alias("h"))
    found = {}
    for label in (0, 1):
        got = blocks.where(F.col("__label") == label).orderBy("h").limit(DICTIONARY_BLOCKS).select("block").toArrow()
        found[label] = _dictionary([bytes(b) for b in got.column(0).to_pylist()])
    calibration = texts.where("__rank >= 0.5").select(F.col("__label").alias("label"), "text")
    rows_ = calibration.mapInArrow(_feature_rows(found[1], found[0]), "label int, a double, b double, c double").toArrow()
    y = rows_.column(0).to_numpy().astype(float)
    f = np.stack([rows_.column(k).to_numpy() for k in (1, 2, 3)], axis=1).reshape(-1, 3)
    order = np.lexsort((f[:, 2], f[:, 1], f[:, 0], y))  # rows come in any order; sums should not
    f, y = f[order], y[order]
    mean = f.mean(axis=0) if len(f) else np.zeros(3)
    scale = np.maximum(f.std(axis=0), 1e-9) if len(f) else np.ones(3)
    (good, good_raw), (bad, bad_raw) = found[1], found[0]
    return Model(good, bad, (good_raw, bad_raw), mean, scale, logistic(_design(f, mean, scale), y))


def _scores(model):
    def run(batches):
        m = model.value
        good, bad = _compressor(m["good"], m["raw"][0]), _compressor(m["bad"], m["raw"][1])
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            f = _features(texts, good, bad)
            p = probability(m["weights"], _design(f, m["mean"], m["scale"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(f[:, 0])], ["doc_id", "score", "difference"])

    return run


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score (probability of label 1), difference (normalised; above 0: nearer to good text).

    Only the text enters a score.  Defined cases: a null text is scored as the
    empty text; an empty text has difference 0; without labels of both kinds
    every score is the constant of the fit; repeated rows get equal scores;
    an empty table gives no rows; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers need no class of ours
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_scores(sent), "doc_id bigint, score double, difference double")


def op5_compression_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, score, predicted."""
    modulus, fold = HELD_OUT
    scored = score_quality(docs, fit(docs, labels))
    held = F.coalesce(remainder("doc_id", modulus) == fold, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
