"""Toxicity by maximum-scoring segments.

* Features of a word are the word itself and its first 4 to 7 characters, as 64-bit hashes.
* Log-odds with a Dirichlet prior: for each feature, the share of toxic and of clean training documents that
  hold it, smoothed by ``PRIOR`` pseudo-documents that hold it and as many that don't, dealt to the classes by
  their sizes; so the prior of a feature doesn't shrink as the sample grows, and a word of few toxic and no clean
  documents is sure at any size. A word scores the log-odds of its feature that is surest (largest log-odds over
  its standard error), nothing if none is ``SURE``. Counts and log-odds are DataFrame work; the ``FEATURES``
  surest features make the table that is broadcast.
* Each word then costs ``DRIFT``, and one pass (Ruzzo and Tompa) finds all maximal scoring segments.
* Extreme-value calibration: with the scores of clean training words, lambda solves E[exp(lambda s)] = 1,
  and K comes from the mean of the clean documents' best segments. A segment of score S in a text of n
  words has the normalised score lambda S - ln(K n) and the E-value exp(-that); segments with E-values up
  to ``E_VALUE`` are the significant passages. A document's evidence is the sum of its positive
  normalised scores, else the best one; a logistic curve, fitted on the training documents and weighted
  to the classes' true shares, makes the score.

Training uses labelled rows outside the held-out fold, at most ``SAMPLE`` documents of each class (those with
the smallest hash of their id), so its tables on the driver are bounded; it reads ids and texts alone.
Everything else runs over all documents, in place: no shuffle of texts, no key.

Defined results: null or empty texts have no segment and get the evidence of a zero score; null labels and
labels of unknown documents are ignored, of contradicting labels toxic counts; without any labelled document
of both classes every score is the share of toxic labels (0 without labels); repeated rows are scored one
by one; other columns pass through in ``row``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pvspark.llm.common import in_fold, materialise, small_batches
from pvspark.llm.words import slices, words

FEATURES = 200_000
PREFIXES = (4, 5, 6, 7)
PRIOR = 2.0
SURE = 1.5
DRIFT = 1.0
E_VALUE = 0.05
SAMPLE = 10_000
FOLDS, HELD_OUT = 4, 2
CUTOFF = 0.3
KNOWN_WORDS = 300_000
SLICE_ROWS, SLICE_CHARS = 1_000, 8_000_000
EULER = 0.5772156649015329
BIN = 0.02                     # width of the score histogram


def _hash(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x) >> 1                   # fits a long


def features(word: bytes) -> list[int]:
    text = word.decode("utf-8", "replace")
    return [_hash(word), *(_hash(text[:k].encode("utf-8", "replace") + b"*") for k in PREFIXES if len(text) > k)]


@dataclass
class Model:
    table: dict[int, tuple[float, float]] | None    # feature -> log-odds, sureness; None: no model
    share: float                   # of toxic labels
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    offset: float = 0.0


_UNKNOWN = (0.0, 0.0)


class Scorer:
    """Word scores with a bounded table of known words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def word(self, w: bytes) -> float:
        get = self.model.table.get
        s = max((get(f, _UNKNOWN) for f in features(w)), key=lambda x: abs(x[1]))[0]
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[w] = s
        return s

    def scores(self, ws: list[bytes]) -> np.ndarray:
        get, slow = self.known.get, self.word
        return np.array([s if (s := get(w)) is not None else slow(w) for w in ws], np.float64) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, stop, score) of all maximal scoring segments, in linear time.

    Only words with positive scores are visited; the sums between them come from the running total. Each open
    candidate knows the nearest one before it whose left sum is smaller, so that search never goes back
    over the same candidates twice.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    open_: list[list] = []         # [left sum, right sum, start, stop, index of the smaller left sum before]
    for i in up.tolist():
        left, right, start, stop = total[i], total[i + 1], i, i + 1
        j = len(open_) - 1
        while True:
            while j >= 0 and open_[j][0] >= left:
                j = open_[j][4]
            if j < 0 or open_[j][1] >= right:
                open_.append([left, right, start, stop, j])
                break
            left, start, before = open_[j][0], open_[j][2], open_[j][4]
            del open_[j:]
            j = before
    return [(c[2], c[3], float(c[1] - c[0])) for c in open_]


def evidence(segments, n_words: int, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """The document's evidence and its significant passages (start, stop, score, E-value)."""
    base = model.log_k + math.log(max(1, n_words))
    norm = [model.lam * s - base for _, _, s in segments]
    positive = sum(x for x in norm if x > 0)
    passages = [(a, b, s, math.exp(-x)) for (a, b, s), x in zip(segments, norm, strict=True)
                if x >= -math.log(E_VALUE)]
    return (positive if positive > 0 else max(norm, default=-base)), passages


def squash(e):
    return np.sign(e) * np.log1p(np.abs(e))


def probability(e: float, model: Model) -> float:
    z = model.slope * float(squash(e)) + model.offset
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


# ---- fitting -------------------------------------------------------------------------------------

def _sample(labels: DataFrame, held_out: bool) -> tuple[DataFrame, dict[int, int]]:
    """At most SAMPLE ids a class with their label, and the classes' true sizes."""
    rows = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if held_out:
        rows = rows.filter(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    rows = rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    picked = [r for c in (0, 1) for r in rows.filter(F.col("toxic") == c)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()]
    return labels.sparkSession.createDataFrame([(r.doc_id, r.toxic) for r in picked], "doc_id long, toxic int"), sizes


def _count(batches):
    """Documents of a stretch that hold a feature; feature -1 counts all of them."""
    known: dict[bytes, list[int]] = {}
    for part in slices(batches, SLICE_ROWS, 0, SLICE_CHARS):
        held: list[list[int]] = [[], []]
        docs = [0, 0]
        for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            mine: set[int] = set()
            for w in set(words(text)):
                f = known.get(w)
                if f is None:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    f = known[w] = features(w)
                mine.update(f)
            held[toxic] += mine
            docs[toxic] += 1
        for toxic in (0, 1):
            used, n = np.unique(np.array(held[toxic], np.int64), return_counts=True)
            n, zero = np.append(n, docs[toxic]), np.zeros(len(n) + 1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), *map(pa.array, (zero, n) if toxic else (n, zero))],
                                             ["feature", "clean", "toxic"])


def _table(counted: DataFrame) -> dict[int, tuple[float, float]] | None:
    whole = counted.filter("feature = -1").collect()
    if not whole or not whole[0].clean or not whole[0].toxic:
        return None
    n0, n1 = whole[0].clean, whole[0].toxic
    p0, p1 = PRIOR * n0 / (n0 + n1), PRIOR * n1 / (n0 + n1)
    a, b = F.col("toxic") + p1, F.col("clean") + p0
    odds = F.log(a / (n1 + 2 * p1 - a)) - F.log(b / (n0 + 2 * p0 - b))
    rows = (counted.filter("feature >= 0").select("feature", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
            .filter(F.abs("z") >= SURE).orderBy(F.abs("z").desc(), "feature").limit(FEATURES).collect())
    return {r.feature: (r.odds, r.z) for r in rows}


def _lambda(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1; scores fall on average, so there is just one."""
    p = weights / weights.sum()
    if (p * values).sum() >= 0 or not (values[weights > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * values, 700))).sum()) - 1
    while f(high) < 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if f(mid) > 0 else (mid, high)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, slightly ridged."""
    a = np.stack([x, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - 1e-3 * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, held_out: bool = True) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    sample, sizes = _sample(labels, held_out)
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    train = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
             .join(F.broadcast(sample), "doc_id").select("text", "toxic"))      # sample: at most 2 * SAMPLE rows
    counted = materialise(train.mapInArrow(_count, "feature long, clean long, toxic long").groupBy("feature")
                          .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-features")
    table = _table(counted)
    if table is None:
        return Model(None, share)
    model = Model(table, share)
    shared = spark.sparkContext.broadcast(model)

    def segment(batches):
        """Per training document its segments; per task a histogram of clean word scores (toxic = -1)."""
        scorer, bins = Scorer(shared.value), {}
        for part in slices(batches, SLICE_ROWS, 0, SLICE_CHARS):
            out = []
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                s = scorer.scores(words(text))
                out.append((toxic, len(s), [x[2] for x in maximal_segments(s)]))
                if not toxic:
                    for v, n in zip(*np.unique(np.round(s / BIN), return_counts=True), strict=True):
                        bins[v] = bins.get(v, 0) + int(n)
            yield _training_batch(out)
        yield _training_batch([(-1, n, [v * BIN]) for v, n in bins.items()])

    got = train.mapInArrow(segment, "toxic int, n long, s array<double>").collect()
    hist = [(r.s[0], r.n) for r in got if r.toxic < 0]
    rows = [r for r in got if r.toxic >= 0]
    if hist:
        model.lam = _lambda(np.array([v for v, _ in hist]), np.array([float(n) for _, n in hist]))
    best = [model.lam * max(r.s) - math.log(max(1, r.n)) for r in rows if not r.toxic and r.s]
    model.log_k = float(np.mean(best)) - EULER if best else 0.0
    e = np.array([evidence([(0, 0, s) for s in r.s], r.n, model)[0] for r in rows])
    y = np.array([r.toxic for r in rows], float)
    w = np.where(y == 1, sizes.get(1, 0) / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
    model.slope, model.offset = _logistic(squash(e), y, w)
    return model


def _training_batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.list_(pa.float64()))], ["toxic", "n", "s"])


# ---- scoring -------------------------------------------------------------------------------------

def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns, default all), score, evidence, passages (start and stop word,
    score, E-value): one row per document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"),
                        F.col(text_col).alias("text"))
    passage = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
                            T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())])
    schema = T.StructType([given.schema["row"], T.StructField("score", T.DoubleType()),
                           T.StructField("evidence", T.DoubleType()),
                           T.StructField("passages", T.ArrayType(passage))])
    arrow_passage = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()),
                                        ("e_value", pa.float64())]))

    def run(batches):
        m = shared.value
        scorer = Scorer(m)
        for part in slices(batches, SLICE_ROWS, 1, SLICE_CHARS):
            probs, evid, found = [], [], []
            for text in part.column(1).to_pylist():
                if m.table is None:
                    e, passages, p = 0.0, [], m.share
                else:
                    s = scorer.scores(words(text))
                    e, passages = evidence(maximal_segments(s), len(s), m)
                    p = probability(e, m)
                probs.append(p)
                evid.append(e)
                found.append([{"start": a, "stop": b, "score": x, "e_value": v} for a, b, x, v in passages])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(probs, pa.float64()), pa.array(evid, pa.float64()),
                 pa.array(found, arrow_passage)], ["row", "score", "evidence", "passages"])

    return given.mapInArrow(run, schema)
