"""Toxic passages as maximum-scoring segments of token log-odds.

1. Terms are counted over all documents, and over labelled toxic and clean
   ones, once a document.  A term is a token or the first ``STEMS`` letters of
   one, since an insult's endings vary.  The log-odds of a term between the two
   kinds has an informative Dirichlet prior: ``PRIOR`` pseudo-counts shared out
   as the whole corpus uses the terms, so that rare terms stay near 0.
2. Terms whose log-odds are at least ``ODDS`` and stand enough standard errors
   above 0 score their log-odds, a token the most of its terms; every other token
   costs a small step, so chance segments end.  How many are enough (``Z_GRID``) is
   chosen by cross-validation among the rows that may be learnt from.
3. One linear scan (Ruzzo and Tompa) finds every maximal segment of a text.
4. Extreme-value calibration: segment scores of clean text follow
   P(best >= s) = 1 - exp(-K n e^(-L s)) in n tokens; L solves
   sum p(s) e^(L s) = 1 over clean tokens, K is its maximum likelihood on clean
   labelled documents.  A segment is significant below ``E_VALUE`` expected
   chance segments.  A document adds up -log E over its segments below
   one expected chance segment; a logistic fit makes that a probability.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch, text_of
from tidewater.llm.fitting import labelled_sample, logistic, probability, remainder

#: Bound of the fit: labelled documents.  Terms that score come from them alone, so it bounds the terms, too.
LABELLED_ROWS = 20_000
PRIOR = 5000.0
#: Standard errors above 0 at which a term may begin to score; the fit chooses by cross-validation.
Z_GRID = (1.6, 2.0, 2.4, 2.8, 3.2, 3.6)
FOLDS = 2
ODDS = 2.0
#: Letters of the stems counted beside whole tokens.
STEMS = (4, 5, 6)
#: Least step down for a token that scores nothing.
STEP = 0.02
E_VALUE = 0.01
HELD_OUT = (5, 0)
THRESHOLD = 0.5
#: Distinct terms a task combines before it passes them on; tokens whose terms or scores it remembers.
HELD = 400_000
#: ASCII letters lower-cased; other ASCII that is no digit, apostrophe or hyphen ends a token.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c in b"'-" else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def terms(token: bytes) -> list[bytes]:
    """The token and, marked, its stems."""
    letters = token.decode()
    return [token, *(b"^" + letters[:k].encode() for k in STEMS if len(letters) > k)]


class TokenScores(dict):
    """Score of a token (None if it scores nothing), the most of its terms; worked out once for each token met."""

    def __init__(self, known: dict[bytes, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: bytes) -> float | None:
        if len(self) >= HELD:
            self.clear()
        found = [self.known[t] for t in terms(token) if t in self.known]
        self[token] = value = max(found) if found else None
        return value


KINDS = [f"{kind}_{fold}" for fold in range(FOLDS) for kind in ("clean", "toxic")]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind (label + 2 * fold, or null), text -> token, n, and the documents of each kind; combined in the task."""
    every, kinds = Counter(), tuple(Counter() for _ in range(2 * FOLDS))

    def rows() -> pa.RecordBatch:
        names = list(every)
        columns = [[c[t] for t in names] for c in (every, *kinds)]
        for c in (every, *kinds):
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *(pa.array(c, pa.int64()) for c in columns)], ["token", "n", *KINDS])

    known: dict[bytes, list[bytes]] = {}
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            found = set()
            for token in set(tokens(text)):
                own = known.get(token)
                if own is None:
                    own = known[token] = terms(token)
                found.update(own)
            every.update(found)
            if label is not None:
                kinds[label].update(found)
            if len(known) >= HELD:
                known.clear()
            if len(every) >= HELD:
                yield rows()
    if every:
        yield rows()


@dataclass(frozen=True)
class Model:
    scores: dict[bytes, float]
    step: float
    lam: float
    k: float
    weights: np.ndarray


def segments(found: list[bytes], scores: TokenScores, step: float) -> list[tuple[int, int, float]]:
    """(start, end, score) of every maximal scoring segment, in linear time.

    Between scoring tokens the sum only falls, so the scan goes from one scoring
    token to the next.  ``links`` leads from a candidate to the nearest one
    before it whose sum to its left is smaller, which keeps the search linear.
    """
    out: list[tuple[int, int, float, float]] = []  # start, end, sum to the left, sum to the right
    links: list[int] = []
    total, last = 0.0, -1
    for at, value in enumerate(map(scores.__getitem__, found)):
        if value is None:
            continue
        total -= step * (at - last - 1)
        start, left = at, total
        total += value
        last, right = at, total
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= left:
                j = links[j]
            if j < 0 or out[j][3] >= right:
                break
            start, left = out[j][0], out[j][2]
            del out[j:], links[j:]
            j -= 1
        out.append((start, at + 1, left, right))
        links.append(j)
    return [(s, e, right - left) for s, e, left, right in out]


def evidence(found: list[tuple[int, int, float]], n: int, lam: float, k: float) -> float:
    """Sum of -log E over the segments expected less than once by chance in n tokens."""
    base = np.log(max(k * n, 1e-12))
    return float(sum(max(0.0, lam * s - base) for _, _, s in found))


def _segment_rows(scores, step: float):
    """mapInArrow function: label, text -> label, tokens, scores of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(scores.value)
        for batch in batches:
            sizes, lists = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = tokens(text)
                sizes.append(len(found))
                lists.append([s for _, _, s in segments(found, known, step)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(pa.float64()))], ["label", "n", "scores"])

    return run


def _lambda(values: np.ndarray, shares: np.ndarray, step: float) -> float:
    """The positive root of sum p e^(L s) = 1; the expected score is negative by choice of the step."""
    if not len(values):
        return 1.0

    def excess(lam: float) -> float:
        return float((shares * np.exp(np.minimum(lam * values, 700))).sum() + (1 - shares.sum()) * np.exp(-lam * step) - 1)

    low, high = 0.0, 1.0
    while excess(high) < 0:
        low, high = high, high * 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _judged(counted: DataFrame, sums: dict, folds: range | list[int]) -> pa.Table:
    """token, odds, z, share of the terms that may score, by the labelled documents of these folds (and no other)."""
    toxic, clean = (reduce(operator.add, [F.col(f"{kind}_{f}") for f in folds]) for kind in ("toxic", "clean"))
    all_toxic, all_clean = (sum(sums[f"{kind}_{f}"] for f in folds) for kind in ("toxic", "clean"))
    prior = F.col("n") * (PRIOR / max(sums["n"], 1))
    t, c = toxic + prior, clean + prior
    odds = F.log(t / (all_toxic + PRIOR - t)) - F.log(c / (all_clean + PRIOR - c))
    judged = counted.where(toxic > 0).withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / t + 1 / c))
    # the share of clean text a scoring token makes up, by the same prior
    judged = judged.where((F.col("z") >= min(Z_GRID)) & (F.col("odds") >= ODDS)).withColumn("share", c / (all_clean + PRIOR))
    return judged.select("token", "odds", "z", "share").toArrow().sort_by("token")


def _scoring(judged: pa.Table, z: float) -> tuple[dict[bytes, float], float, np.ndarray, np.ndarray]:
    """Scores of the terms from z on, the step down, and the terms' scores and shares."""
    kept = judged.filter(pc.greater_equal(judged["z"], z))
    values, shares = (kept[c].to_numpy() for c in ("odds", "share"))
    step = max(STEP, 2.0 * float((shares * values).sum()) / max(1e-9, 1 - float(shares.sum())))
    return dict(zip(kept["token"].to_pylist(), values.tolist(), strict=True)), step, values, shares


def _totals(models):
    """mapInArrow function: kind, text -> label, and for each threshold the segments' sum by the model of the other folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [[(TokenScores(scores), step) for scores, step in of] for of in models.value]
        for batch in batches:
            kinds, sums = batch.column(0).to_pylist(), []
            for kind, text in zip(kinds, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found = tokens(text)
                sums.append([sum(s for _, _, s in segments(found, scores, step)) for scores, step in known[kind // 2]])
            yield pa.RecordBatch.from_arrays([pa.array([k % 2 for k in kinds], pa.int32()), pa.array(sums, pa.list_(pa.float64()))], ["label", "sums"])

    return run


def _chosen_z(labelled: DataFrame, counted: DataFrame, sums: dict) -> float:
    """The threshold whose sums, by terms learnt without the document's own fold, tell the labels apart best.

    The measure is the log-loss of a logistic in the sum; of equal ones the highest threshold.
    """
    models = [[_scoring(judged, z)[:2] for z in Z_GRID] for judged in (_judged(counted, sums, [f for f in range(FOLDS) if f != own]) for own in range(FOLDS))]
    sent = labelled.sparkSession.sparkContext.broadcast(models)
    got = labelled.mapInArrow(_totals(sent), "label int, sums array<double>").toArrow()
    y = got["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return max(Z_GRID)
    x = np.log1p(np.array(got["sums"].to_pylist(), float))
    order = np.lexsort((*x.T, y))  # rows come in any order
    losses = []
    for k in range(len(Z_GRID)):
        p = np.clip(probability(logistic(x[order, k : k + 1], y[order]), x[order, k : k + 1]), 1e-12, 1 - 1e-12)
        losses.append(round(float(-(y[order] * np.log(p) + (1 - y[order]) * np.log(1 - p)).mean()), 9))
    return max(z for z, loss in zip(Z_GRID, losses, strict=True) if loss == min(losses))


def fit(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = HELD_OUT, rows: int = LABELLED_ROWS) -> Model:
    """Token scores from all documents and at most ``rows`` labelled ones outside the held-out fold."""
    spark = docs.sparkSession
    modulus, fold = held_out
    sample = labelled_sample(labels, "toxic", remainder("doc_id", modulus) != fold, rows)
    kind = (F.col("__label") + 2 * (F.col("__rank") * FOLDS).cast("int")).alias("kind")
    sample = sample.select("__id", "__label", kind)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("__id"), text_of().alias("text"))
    marked = texts.join(F.broadcast(sample), "__id", "left").select("kind", "text")
    counted = marked.mapInArrow(_counts, f"token binary, n bigint, {', '.join(f'{k} bigint' for k in KINDS)}")
    counted = scratch(counted.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n", *KINDS)]), "token-counts")
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *KINDS)]).first().asDict()
    z = _chosen_z(texts.join(F.broadcast(sample), "__id").select("kind", "text"), counted, sums)
    scores, step, values, shares = _scoring(_judged(counted, sums, range(FOLDS)), z)
    lam = _lambda(values, shares, step)

    sent = spark.sparkContext.broadcast(scores)
    labelled = texts.join(F.broadcast(sample), "__id").select(F.col("__label").alias("label"), "text")
    got = labelled.mapInArrow(_segment_rows(sent, step), "label int, n bigint, scores array<double>").toArrow()
    y = got.column(0).to_numpy().astype(float)
    n = got.column(1).to_numpy()
    found = [[(0, 0, s) for s in x] for x in got.column(2).to_pylist()]
    order = np.lexsort((n, [sum(s for _, _, s in x) for x in found], y)) if len(y) else []
    y, n, found = y[order], n[order], [found[i] for i in order]
    best_score = np.array([max((s for _, _, s in x), default=0.0) for x in found])
    clean = (y == 0) & (n > 0)
    mass = float((n[clean] * np.exp(-lam * best_score[clean])).sum())
    k = float(clean.sum()) / mass if mass else 1.0
    x = np.array([evidence(f, m, lam, k) for f, m in zip(found, n, strict=True)]).reshape(-1, 1)
    return Model(scores, step, lam, k, logistic(np.log1p(x), y))


def _score_rows(model):
    names = ["doc_id", "score", "evidence", "passages"]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        known = TokenScores(m["scores"])
        for batch in batches:
            sums, passages = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = tokens(text)
                found = segments(words, known, m["step"])
                sums.append(evidence(found, len(words), m["lam"], m["k"]))
                valued = [(a, b, s, float(m["k"] * len(words) * np.exp(-m["lam"] * s))) for a, b, s in found]
                passages.append([dict(zip(("start", "end", "score", "e_value"), v, strict=True)) for v in valued if v[3] <= E_VALUE])
            p = probability(m["weights"], np.log1p(np.array(sums, float)).reshape(-1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(sums, pa.float64()), pa.array(passages, pa.list_(span))], names)

    return run


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score, evidence, passages (start, end in tokens, score, e_value of each significant one).

    Only the text enters a score.  Defined cases: null and empty texts have no
    segment and evidence 0, so the lowest score; without labels of both kinds
    every score is the constant of the fit; repeated rows get equal scores; an
    empty table gives no rows; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers need no class of ours
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    spans = "array<struct<start: int, end: int, score: double, e_value: double>>"
    return rows.mapInArrow(_score_rows(sent), f"doc_id bigint, score double, evidence double, passages {spans}")


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, score, predicted; and n_passages."""
    modulus, fold = HELD_OUT
    scored = score_toxicity(docs, fit(docs, labels))
    held = F.coalesce(remainder("doc_id", modulus) == fold, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), F.size("passages").alias("n_passages"))
