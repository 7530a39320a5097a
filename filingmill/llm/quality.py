"""Quality classifier: Bradley-Terry ranking of documents from pairs of a better and a worse one.

The strength of a document is a weighted sum of features of its whole text. Weights maximise the
likelihood that the better document of each pair wins, that is, the logistic loss on the difference
of features. Strengths become scores by a logistic curve placed so that a quantile of the labelled
documents' strengths falls on the score threshold: by default the quantile at the share of documents
labelled 0, so that as many labelled documents fall below the threshold as are labelled so.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import small_batches

#: Labelled documents a model is fitted on at most: those with the least hash of doc_id.
MAX_LABELLED = 20_000
#: Pairs drawn for each document of the rarer label.
PAIRS_EACH = 24
THRESHOLD = 0.3

#: Byte classes: lower case, upper case, digits, space, line feed, sentence marks, dashes and quotes, other marks one by one.
_SINGLES = b"#$%&*+/<=>@\\^_`{|}~!?:;()[]"
_CLASS = np.zeros(256, dtype=np.int64)
for _b in range(256):
    _c = bytes([_b])
    if _c.islower():
        _CLASS[_b] = 0
    elif _c.isupper():
        _CLASS[_b] = 1
    elif _c.isdigit():
        _CLASS[_b] = 2
    elif _b >= 128:
        _CLASS[_b] = 3
    elif _c == b" ":
        _CLASS[_b] = 4
    elif _c == b"\n":
        _CLASS[_b] = 5
    elif _c in b".,":
        _CLASS[_b] = 6
    elif _c in b"-'\"":
        _CLASS[_b] = 7
    elif _c in b"!?":
        _CLASS[_b] = 8
    elif _c in b":;()[]":
        _CLASS[_b] = 9
    elif _c in b"|":
        _CLASS[_b] = 10
    else:
        _CLASS[_b] = 11
CLASSES = 12
_OTHER = [c for c in _SINGLES]
N_FEATURES = CLASSES + CLASSES * CLASSES + len(_OTHER) + 9


def features(text: str | None) -> np.ndarray:
    """Features of a whole text, independent of its order of magnitude in length."""
    raw = (text or "").encode()
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not raw:
        return out
    octets = np.frombuffer(raw, np.uint8)
    kinds = _CLASS[octets]
    out[:CLASSES] = np.sqrt(np.bincount(kinds, minlength=CLASSES) / len(raw))
    if len(raw) > 1:
        out[CLASSES : CLASSES + CLASSES**2] = np.sqrt(np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES**2) / len(raw))
    counts = np.bincount(octets, minlength=256)
    out[CLASSES + CLASSES**2 : CLASSES + CLASSES**2 + len(_OTHER)] = np.sqrt(counts[_OTHER] / len(raw))
    words = raw.split()
    lines = raw.split(b"\n")
    n = max(len(words), 1)
    odd = np.array([not (w[-1:].isalnum() or w[-1:] in b".,;:!?'\")" or w[-1] >= 128) for w in words]) if words else np.zeros(1)
    out[-9:] = (
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(lines)) / len(lines),
        min(len(raw) / n / 10, 3),
        np.log1p(len(words)) / 10,
        odd.mean(),
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n,
        1.0 if len(words) < 5 else 0.0,
    )
    return out


@dataclass(frozen=True)
class Model:
    """Weights over standardised features, and the logistic curve from strengths to scores."""

    mean: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = (x - self.mean) @ self.weights
        z = np.clip((strength - self.cut) * self.slope + np.log(self.threshold / (1 - self.threshold)), -30, 30)
        return 1 / (1 + np.exp(-z))


def quantile_cut(strength: np.ndarray, level: float) -> float:
    """The strength with a share ``level`` of all below it, midway between its neighbours; ties stay on one side."""
    ranked = np.sort(strength)
    k = min(max(round(level * len(ranked)), 0), len(ranked))
    if k in (0, len(ranked)):
        return float(ranked[0] - 1 if k == 0 else ranked[-1] + 1)
    return float((ranked[k - 1] + ranked[k]) / 2)


def fit(x: np.ndarray, label: np.ndarray, threshold: float = THRESHOLD, level: float | None = None, pairs_each: int = PAIRS_EACH, penalty: float = 1e-4, steps: int = 400, seed: int = 7) -> Model:
    """Fit from features and 0/1 labels; ``level`` is the quantile of the strengths that scores ``threshold``.

    With only one label all scores are equal and above the threshold.
    """
    n_features = x.shape[1] if x.ndim == 2 else N_FEATURES
    if not len(x) or label.min() == label.max():
        return Model(np.zeros(n_features), np.zeros(n_features), -1.0, 1.0, threshold)
    x = x.astype(np.float64)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    z = (x - mean) / spread
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    draw = np.random.default_rng(seed)
    many = pairs_each * min(len(good), len(bad))
    cover = lambda own: np.concatenate([draw.permutation(own) for _ in range(-(-many // len(own)))])[:many]
    better, worse = cover(good), cover(bad)
    w, m, v = np.zeros(n_features), np.zeros(n_features), np.zeros(n_features)
    for step in range(1, steps + 1):
        s = z @ w
        lose = 1 / (1 + np.exp(np.clip(s[better] - s[worse], -30, 30)))
        each = np.bincount(better, lose, len(z)) - np.bincount(worse, lose, len(z))
        gradient = -(each @ z) / many + penalty * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    strength = z @ w
    cut = quantile_cut(strength, float((label == 0).mean()) if level is None else level)
    return Model(mean, w / spread, cut, float(1 / (strength.std() + 1e-9) * 2), threshold)


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD, level: float | None = None) -> Model:
    """Fit on the labelled documents that aren't held out, at most ``max_labelled`` of them, one row for each doc_id.

    Ids whose labels disagree are left out; of documents with one id that of the least features counts.
    """
    small_batches(docs.sparkSession)
    known = labels.where(~held_out("doc_id") & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", _features_udf()("text").alias("x"))
    got = sorted(rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got]) if got else np.zeros((0, N_FEATURES))
    return fit(x, np.array([r["quality"] for r in got], dtype=np.int64), threshold, level)


def _features_udf():
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        bpe.release()
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    return packed


def score_column(model: Model, text: str | Column = "text") -> Column:
    """The score, 0 to 1, of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        bpe.release()
        return pd.Series(model.scores(np.array([features(t) for t in texts])) if len(texts) else [], dtype=float)

    return score(text)


def scored(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD, level: float | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text), by ``labels`` (doc_id, quality).

    doc_id is an integer. Null texts score as empty ones, whole texts of any length are scored; rows
    without a doc_id are held out; repeated rows are kept one to one; labels other than 0 and 1 are
    ignored; other columns are ignored; without labels of both kinds every document is accepted; an
    empty table stays empty.
    """
    small_batches(docs.sparkSession)
    model = train(docs, labels, max_labelled, threshold, level)
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), score_column(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD, level: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; nulls, repeats and empty tables as in ``scored``."""
    small_batches(docs.sparkSession)
    return docs.where(score_column(train(docs, labels, max_labelled, threshold, level)) >= threshold)
