"""Quality classifier: Bradley-Terry scores learnt from preference pairs, cut at a score quantile."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.quality_rules import quality_rules
from strataflow.llm.shared import column, saved

#: Bounds of the fit: labelled rows that reach the driver, and preference pairs made from them.
MAX_LABELLED = 20_000
MAX_PAIRS = 200_000
CUT = 0.7

FEATURES = {
    "symbols": "ln(1 + 100.0 * n_symbols / greatest(n_words, 1))",
    "some_symbols": "least(1.0, 10.0 * n_symbols / greatest(n_words, 1))",
    "stop_words": "least(1.0, 5.0 * n_stop_words / greatest(n_words, 1))",
    "capitals": "1.0 * n_capitals / greatest(word_chars, 1)",
    "many_capitals": "least(1.0, 3.0 * n_capitals / greatest(word_chars, 1))",
    "repeats": "1.0 * n_repeat_words / greatest(n_words, 1)",
    "some_repeats": "least(1.0, 4.0 * n_repeat_words / greatest(n_words, 1))",
    "word_length": "least(1.0, abs(1.0 * word_chars / greatest(n_words, 1) - 5) / 5)",
    "repeated_lines": "1.0 * n_dup_lines / greatest(n_lines, 1)",
    "words": "ln(1.0 + n_words)",
    "few_words": "1.0 / (1 + n_words)",
}


class Ranking(NamedTuple):
    """``score = sigmoid(gain * (w . (x - mean) / scale - threshold) + logit(CUT))``"""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    gain: float


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the features of each whole text, all from built-in functions."""
    counts = quality_rules(docs, key, text)
    return counts.select("doc_id", *[F.expr(e).cast("double").alias(name) for name, e in FEATURES.items()])


def fit(x: np.ndarray, good: np.ndarray, often: np.ndarray | None = None, seed: int = 7, penalty: float = 1e-3, steps: int = 60) -> Ranking:
    """Weights from pairs (good, bad): logistic loss on feature differences, by Newton steps.

    ``often`` says how many equal rows each row stands for (one each, if not given). The threshold is the quantile of the scores with the fewest wrong labels. Without rows of both labels all
    weights are zero, and every score is CUT.
    """
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(x) or good.all() or not good.any():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    often = np.ones(len(x)) if often is None else often.astype(float)
    mean = np.average(x, axis=0, weights=often)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=often))
    scale = np.where(scale > 0, scale, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    pairs = min(MAX_PAIRS, 20 * len(x))
    better, worse = (rng.choice(np.nonzero(side)[0], pairs, p=often[side] / often[side].sum()) for side in (good, ~good))
    diff = z[better] - z[worse]
    w = np.zeros(width)
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))
        slope = penalty * w - diff.T @ lost / pairs
        curve = (diff * (lost * (1 - lost))[:, None]).T @ diff / pairs + penalty * np.eye(width)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    score = z @ w
    by = np.argsort(score, kind="stable")
    order = score[by]
    # Quantiles are tried between neighbouring scores; ties go to the middle of the best range.
    wrong = np.concatenate([[0], np.cumsum(np.where(good[by], often[by], -often[by]))])
    best = np.nonzero(wrong == wrong.min())[0]
    at = int(best[len(best) // 2])
    low, high = order[max(at - 1, 0)], order[min(at, len(order) - 1)]
    spread = np.sqrt(np.average((score - np.average(score, weights=often)) ** 2, weights=often))
    return Ranking(mean, scale, w, float((low + high) / 2), float(2 / spread) if spread > 0 else 1.0)


def score_column(ranking: Ranking) -> Column:
    """The score as one expression over the feature columns."""
    per = ranking.weights / ranking.scale
    raw = sum((F.col(name) * float(k) for name, k in zip(FEATURES, per)), F.lit(float(-per @ ranking.mean - ranking.threshold)))
    return 1 / (1 + F.exp(-(raw * ranking.gain + float(np.log(CUT / (1 - CUT))))))


def pair_ranking(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``held_out`` rows (crc32 of the id as text, modulo 4, is 2) never teach. Of the other labelled rows,
    equal ones counted together, at most ``MAX_LABELLED`` by hash reach the driver; all else is projected on the executors. Labels other than 0 and 1, NULL labels and NULL ids teach nothing; an id with both
    labels teaches both. NULL and empty texts are scored as texts without words. Repeated rows are
    scored alike, and without rows of both labels every score is CUT.
    """
    known = saved(features(docs, key, text), "features")
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    taught = labels.select(column(labels, "doc_id").alias("doc_id"), column(labels, "quality").alias("quality"))
    taught = taught.where("doc_id is not null and quality in (0, 1)").where(part != 2).distinct()
    rows = known.join(taught, "doc_id").groupBy("doc_id", "quality", *FEATURES).agg(F.count("*").alias("often"))
    rows = saved(rows.withColumn("place", F.xxhash64("doc_id", "quality", *FEATURES)), "taught")
    number = rows.count()
    if 16 * number > 17 * MAX_LABELLED:
        # By hash, before anything is sorted: what leaves the tasks is a sixteenth more than the bound at any size.
        rows = rows.where(F.col("place") < 2**64 * 17 * MAX_LABELLED // (16 * number) - 2**63)
    sample = rows.orderBy("place", "doc_id", "quality", *FEATURES).limit(MAX_LABELLED).toPandas()
    ranking = fit(sample[list(FEATURES)].to_numpy(float), sample["quality"].to_numpy() == 1, sample["often"].to_numpy())
    scored = known.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), score_column(ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
