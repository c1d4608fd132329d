"""Quality classifier (operator 7): positive-unlabelled learning.

Trusted positives are labelled good texts; everything else is unlabelled web text. The share
of good texts among the unlabelled (the class prior) is estimated first: the least ratio, over
score levels of a plain positive-against-unlabelled model, of unlabelled to positive texts
above a level. Then a logistic scorer over text statistics minimises the non-negative unbiased
risk: prior * R+(positives, 1) + max(0, R(unlabelled, 0) - prior * R(positives, 0)).

Labels of 0, languages, sources and ids are no inputs. The fit reads a bounded sample: at most
``sample`` positives and ``sample`` unlabelled rows, those of least hash; their
features are made in tasks, and only these come to the driver. Every text is scored whole in one pass without a shuffle. Null or empty texts score like a text without words; an
empty table gives an empty table; without positives every score is 0.5. Columns the operator
adds replace those of the same name; others pass through.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.byte_bpe import mapped
from ledgerline.llm.common import small_batches, text_bytes

#: Rows of either kind the fit may read.
SAMPLE = 6000


def _by_text(flag: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag)))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def features(column: pa.Array) -> np.ndarray:
    """Statistics of each text: shares of kinds of characters, of repeated words and lines, of
    words that are shouted, end in signs, or stand between bars, and lengths."""
    data, bounds = text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    plain = np.isin(data, np.frombuffer(b".,;:'\"-()", np.uint8))
    sign = (data > 32) & (data < 127) & ~upper & ~lower & ~digit & ~plain
    size = np.maximum(1.0, np.diff(bounds))
    letters = np.maximum(1.0, _by_text(upper | lower, bounds))
    out = [_by_text(upper, bounds) / letters] + [_by_text(f, bounds) / size for f in (digit, space, plain, sign, data >= 128, data == 10, data == 124)]
    more = []
    for text in column.to_pylist():
        words = (text or "").split()
        n = max(1, len(words))
        count = Counter(words)
        lines = (text or "").split("\n")
        again = sum(map(str.__eq__, words, words[1:]))
        more.append((len(count) / n, again / n, max(count.values(), default=0) / n, len(set(lines)) / len(lines), sum(map(len, words)) / n / 10,
                     sum(map(str.isupper, words)) / n, np.log1p(len(words)) / 10, len(set(zip(words, words[1:]))) / n))
    base = np.column_stack([*out, np.array(more, float).reshape(-1, 8)])
    return np.column_stack([base, np.sqrt(base), base**2])  # curved in each statistic


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, column: pa.Array) -> np.ndarray:
        z = np.clip((features(column) - self.mean) / self.scale, -8, 8) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, gradient, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam on (weights, bias); ``gradient`` of the two score vectors gives each row's slope."""
    w, m, v = (np.zeros(positive.shape[1] + 1) for _ in range(3))
    for k in range(1, steps + 1):
        gp, gu = gradient(positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1])
        g = np.append(gp @ positive + gu @ unlabelled + 1e-4 * w[:-1], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled rows, from scores of rows the model was not fitted on: the least
    upper-tail ratio over levels that at least a tenth of the positives reach, with its sampling error added."""
    levels = np.quantile(positive, np.linspace(0.02, 0.9, 45))
    p = np.array([(positive >= c).mean() for c in levels])
    u = np.array([(unlabelled >= c).mean() for c in levels])
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = np.argmin((u + slack) / p)
    return float(np.clip(u[best] / p[best], 0.05, 0.95))


def fit(positive: pa.Array, unlabelled: pa.Array, steps: int = 600) -> Scorer:
    """A scorer of texts of trusted positives and unlabelled texts."""
    return fit_features(features(positive), features(unlabelled), steps)


def fit_features(p: np.ndarray, u: np.ndarray, steps: int = 600) -> Scorer:
    """``fit`` on the texts' features."""
    if not len(p) or not len(u):
        d = features(pa.array([""])).shape[1]
        return Scorer(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.5)
    both = np.concatenate([p, u])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))

    def against(zp, zu):  # positives against unlabelled, both sides of equal mass
        return (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)

    # the prior from two halves, each scored by the other's model
    half = [_descend(p[k::2], u[k::2], against, steps // 2) if len(p) > 1 < len(u) else None for k in (0, 1)]
    if half[0] is None:
        prior = 0.5
    else:
        cross = lambda x: np.concatenate([x[1 - k::2] @ half[k][:-1] + half[k][-1] for k in (0, 1)])
        prior = class_prior(cross(p), cross(u))

    def risk(zp, zu):
        negative = np.log1p(np.exp(np.clip(zu, -30, 30))).mean() - prior * np.log1p(np.exp(np.clip(zp, -30, 30))).mean()
        up, down = prior * (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)
        back = prior * _sigmoid(zp) / len(zp)
        if negative < 0:  # the estimate went below what a risk can be: step back on this part alone
            return back, -down
        return up - back, down

    w = _descend(p, u, risk, steps)
    return Scorer(mean, scale, w[:-1], float(w[-1]), prior)


def sample(rows: DataFrame, doc_id: str, text: str, limit: int) -> np.ndarray:
    """Features of at most ``limit`` rows, those whose ids have the least hash. They are computed in tasks, so that
    what comes to the driver is bounded however long the texts are."""
    vectors = mapped(rows.select(F.xxhash64(doc_id).alias("h"), F.col(text).alias("text")), "text", "features", T.ArrayType(T.DoubleType()), _feature_lists).drop("text")
    found = vectors.orderBy("h", "features").limit(limit).toArrow().column("features").to_pylist()
    return np.array(found, float) if found else features(pa.array([], pa.string()))


def _feature_lists(column: pa.Array) -> pa.Array:
    x = features(column)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def train(docs: DataFrame, positives: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE) -> Scorer:
    """Fits on ``docs`` whose ids are in ``positives`` (column ``doc_id``) against the other rows of ``docs``."""
    small_batches(docs.sparkSession)
    ids = positives.select(F.col(doc_id)).distinct()
    near = F.xxhash64(doc_id)
    chosen = ids.orderBy(near).limit(sample_rows)
    good = docs.join(F.broadcast(chosen), doc_id, "left_semi")  # at most sample_rows ids
    # unlabelled: rows of least hash that are no positives; twice the sample holds enough of them or all
    rest = docs.select(doc_id).join(ids, doc_id, "left_anti").distinct().orderBy(near).limit(sample_rows)
    other = docs.join(F.broadcast(rest), doc_id, "left_semi")
    return fit_features(sample(good, doc_id, text, sample_rows), sample(other, doc_id, text, sample_rows))


def score(df: DataFrame, scorer: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` plus ``out``: each text's probability of being good."""
    return mapped(df, text, out, T.DoubleType(), lambda col: pa.array(scorer.score(col), pa.float64()))
