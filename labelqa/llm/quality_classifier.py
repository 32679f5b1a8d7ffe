"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the rest of the training text
counts as unlabelled, good or bad. The class prior (the share of good text
among the unlabelled) is estimated from the scores of a plain positive-versus-
unlabelled model: the least ratio of unlabelled to positive documents above a
score. Then the non-negative unbiased risk

    prior * R(positive as good) + max(0, R(unlabelled as bad) - prior * R(positive as bad))

is minimised for a logistic model, by Newton steps that are cut short whenever the
second term would fall below zero.

Inputs of a score are counts of the text only: never its label, language,
source or id. All documents are measured in one pass of Arrow batches and
scored in Catalyst expressions. Prior and unlabelled risk are sums over all
unlabelled rows: each step is one Spark pass over the stored measures that
leaves 241 numbers (loss, gradient, second derivatives), whatever the input. Of
the positives the fit takes at most ``SAMPLE``, by hash of the id.

Defined cases: null text is the empty text and is scored like any other; a null
``doc_id`` is never trained on and not held out; repeated rows are scored
alike, and count as often as they come; where every training row has a label,
all training rows count as unlabelled, their labels unread; without positives
or training text the score is the prior of 0.5 for all; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_of
from .quality_rules import Facts

SAMPLE, CUT = 20_000, 0.7
FOLDS, HELD_OUT = 4, 2
DIGITS = b"0123456789"


def measured(text: str) -> list[float]:
    """Ratios of one text, all finite and small."""
    f = Facts(text)
    words, chars = max(1, f.n_words), max(1, len(text))
    letters = f.n_upper + f.n_lower
    ratio = [f.n_symbols / words, f.n_exclaims / words, f.n_upper / max(20, letters), f.n_dup_lines / max(4, f.n_lines), f.n_adjacent / words,
             f.n_repeat_words / max(20, words), (f.raw.count(b"|")) / words, (len(f.raw) - len(f.raw.translate(None, DIGITS))) / chars,
             (len(f.raw) - len(text)) / chars, len(set(f.words)) / max(20, words), f.raw.count(b",") / words, f.raw.count(b".") / words,
             f.n_lines / words, f.word_chars / words / 10]
    return [math.sqrt(min(x, 4.0)) for x in ratio]


def features(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array([measured(t or "") for t in texts.to_pylist()], pa.list_(pa.float32()))

    return measure(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Unlabelled:
    """All unlabelled rows, of which only sums are ever asked."""

    def __init__(self, rows: DataFrame, mean: np.ndarray, spread: np.ndarray):
        self.rows, self.mean, self.spread = rows, mean, spread
        self.count = rows.count()

    def sums(self, size: int, of) -> np.ndarray:
        """Sum of ``of(inputs)`` over all rows; the same however tasks finish."""
        mean, spread = self.mean, self.spread

        def part(batches):
            total = np.zeros(size)
            for batch in batches:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                total += of(inputs(flat.reshape(batch.num_rows, -1), mean, spread)) if batch.num_rows else 0
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total, pa.float64())], names=["k", "v"])

        got = self.rows.mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,12)")).alias("v")).collect()
        out = np.zeros(size)
        for r in got:
            out[r["k"]] = float(r["v"])
        return out

    def loss(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean logistic loss of taking every row as bad, its gradient and second derivatives."""
        n = len(w)
        total = self.sums(1 + n + n * n, lambda x: np.concatenate([[np.logaddexp(0, x @ w).sum()], x.T @ _sigmoid(x @ w), _curvature(x, w).ravel()]))
        return total[0] / self.count, total[1:n + 1] / self.count, total[n + 1:].reshape(n, n) / self.count

    def above(self, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Share of rows that score at least each (rising) cut."""
        place = self.sums(len(cuts) + 1, lambda x: np.bincount(np.searchsorted(cuts, x @ w, "right"), minlength=len(cuts) + 1).astype(np.float64))
        return place[::-1].cumsum()[::-1][1:] / self.count


def inputs(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Measures as inputs of the model, the last a constant."""
    return np.column_stack([np.clip((x - mean) / spread, -8, 8), np.ones(len(x))])


def _curvature(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = _sigmoid(x @ w)
    return x.T @ (x * (p * (1 - p))[:, None])


def _descend(size: int, risk, allowed=lambda second: True, passes: int = 40, decay: float = 1e-4) -> np.ndarray:
    """Newton steps; one that does not lower the risk or leads where it is not
    allowed is halved. ``risk(w)`` gives value, second term, gradient, second derivatives."""
    def at(w):
        value, second, gradient, curve = risk(w)
        return value + decay * (w @ w) / 2, second, gradient + decay * w, curve + decay * np.eye(size)

    w = np.zeros(size)
    value, _, gradient, curve = at(w)
    step, share = np.linalg.solve(curve, gradient), 1.0
    for _ in range(passes):
        if share * (gradient @ step) < 1e-9:
            break
        tried = at(w - share * step)
        if tried[0] <= value and allowed(tried[1]):
            w, (value, _, gradient, curve) = w - share * step, tried
            step, share = np.linalg.solve(curve, gradient), 1.0
        else:
            share /= 2
    return w


def fit_plain(pos: np.ndarray, unl: Unlabelled) -> np.ndarray:
    """Logistic model of positive against unlabelled, each of weight one half."""
    def risk(w):
        value, gradient, curve = unl.loss(w)
        p = _sigmoid(pos @ w)
        good = np.logaddexp(0, -(pos @ w)).mean()
        return (good + value) / 2, value, (pos.T @ (p - 1) / len(pos) + gradient) / 2, (_curvature(pos, w) / len(pos) + curve) / 2

    return _descend(pos.shape[1], risk)


def class_prior(pos: np.ndarray, unl: Unlabelled, w: np.ndarray, confidence: float = 0.05) -> float:
    """Least ratio of unlabelled to positive shares above a score; the margin
    keeps thin tails from deciding."""
    scores = np.sort(pos @ w)
    margin = sum(math.sqrt(math.log(4 / confidence) / (2 * n)) for n in (len(pos), unl.count))
    cuts = np.unique(np.quantile(scores, np.linspace(0.01, 0.99, 99)))
    p, u = 1 - np.searchsorted(scores, cuts, "left") / len(scores), unl.above(w, cuts)
    best = np.argmin((u + margin) / np.maximum(p, 1e-9))
    return float(np.clip(u[best] / p[best], 0.05, 0.99))


def nonnegative_risk(pos: np.ndarray, unl: Unlabelled, prior: float):
    """The unbiased risk under the logistic loss, where its second term is not negative."""
    def risk(w):
        value, gradient, curve = unl.loss(w)
        good, bad = np.logaddexp(0, -(pos @ w)).mean(), np.logaddexp(0, pos @ w).mean()
        second = value - prior * bad
        return prior * good + second, second, gradient - prior * pos.mean(0), curve     # the two losses of a positive differ by its score

    return risk


def fit_nonnegative(pos: np.ndarray, unl: Unlabelled, prior: float) -> np.ndarray:
    return _descend(pos.shape[1], nonnegative_risk(pos, unl, prior), allowed=lambda second: second >= 0)


def train(measures: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """``measures(doc_id, held_out, x)``; labels of held-out rows are not read."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("known_id")).agg(F.min("quality").alias("quality"))
    trained = measures.where(~F.col("held_out") & F.col("doc_id").isNotNull())
    rows = store(trained.join(known, F.col("doc_id") == F.col("known_id"), "left").select("doc_id", "x", "quality"), "trained")
    good = rows.where("quality = 1").select("x", F.xxhash64("doc_id").alias("at"))
    many = good.count()
    if many > 2 * sample:       # tasks send about one and a half times as many as are kept, not as many each
        near = good.where(F.col("at") < int(1.5 * sample / many * (1 << 64)) - (1 << 63))
        good = near if near.count() >= sample else good
    got = good.orderBy("at").limit(sample).toPandas()["x"]      # the fit's documented bound
    rest = rows.where("quality is null").select("x")
    rest = rest if not rest.isEmpty() else rows.select("x")
    if not len(got):
        return {"mean": [], "spread": [], "weights": [], "bias": 0.0, "prior": 0.5}
    pos = np.array(got.tolist(), np.float64)
    mean, spread = pos.mean(0), np.maximum(pos.std(0), 0.02)
    pos, unl = inputs(pos, mean, spread), Unlabelled(rest, mean, spread)
    prior = class_prior(pos, unl, fit_plain(pos, unl))
    w = fit_nonnegative(pos, unl, prior)
    return {"mean": mean.tolist(), "spread": spread.tolist(), "weights": w[:-1].tolist(), "bias": float(w[-1]), "prior": prior}


def score(x: Column, model: dict) -> Column:
    terms = [F.lit(w) * F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (x[k].cast("double") - m) / s))
             for k, (w, m, s) in enumerate(zip(model["weights"], model["mean"], model["spread"], strict=True))]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(model["bias"]))))


def classified(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), features(text_of()).alias("x"))
    rows = store(rows, "measures")
    model = train(rows, labels.select("doc_id", "quality"), sample)
    out = rows.select("doc_id", "held_out", score(F.col("x"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
