"""Quality classifier: a generalised additive model with pairwise interactions.

A document is described by about twenty numbers. Boosting goes round the
features in turn and fits a shallow tree to one binned feature at a time; all
trees of a feature add up to one lookup table over its bins. A few pairs of
features then get two-dimensional tables in the same way. A score is the sum of
the table entries of a document's bins.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import remainder, utf8, with_columns

FEATURES = (
    "log_words", "log_chars", "word_length", "log_lines", "words_per_line", "upper", "digits", "bang", "pipe", "symbols",
    "other_marks", "stops", "distinct", "top_word", "stuck", "dup_lines", "lines_ended", "capital_words", "one_char_words", "foreign",
)
#: At most this many labelled rows are used to fit; those with the smallest hash of their id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3


def features(text: bytes) -> list[float]:
    """The numbers of FEATURES for one text (UTF-8); an empty text gives zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lower, upper, digits = int(counts[97:123].sum()), int(counts[65:91].sum()), int(counts[48:58].sum())
    heads = int(counts[192:256].sum())  # bytes that begin a character beyond ASCII
    chars = len(text) - int(counts[128:192].sum())
    solid = chars - int(counts[32] + counts[9:14].sum())
    symbols = int(counts[[35, 36, 37, 38, 42, 60, 62]].sum())
    stops, bang, pipe = int(counts[46] + counts[44]), int(counts[33]), int(counts[124])
    marks = solid - lower - upper - digits - heads - symbols - stops - bang - pipe
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    tally = Counter(words)
    return [
        np.log1p(n), np.log1p(chars), solid / n, np.log1p(len(lines)), n / len(lines), upper / (lower + upper + 1), digits / solid,
        bang / solid, pipe / n, symbols / solid, marks / solid, stops / n, len(tally) / n**0.8, max(tally.values()) / n,
        sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines), sum(x[-1] in b".!?" for x in lines) / len(lines),
        sum(map(bytes.isupper, words)) / n, sum(len(w) == 1 for w in words) / n, heads / solid,
    ]


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the array column ``features``; a null text counts as empty."""

    def rows(batch: pa.RecordBatch):
        return [pa.array([features(t) for t in utf8(batch, text_col)], pa.list_(pa.float64()))]

    return with_columns(docs, [("features", T.ArrayType(T.DoubleType()))], rows)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``pairs`` maps two feature numbers to a table over their coarse bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, j], "right")]
        for (i, j), values in self.pairs.items():
            a = np.searchsorted(self.coarse[i], x[:, i], "right")
            total += values[a, np.searchsorted(self.coarse[j], x[:, j], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges at quantiles, distinct."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.empty(0)


def _leaf(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g / (h + l2)


def _gain(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / (h + l2)


def shallow_tree(g: np.ndarray, h: np.ndarray, l2: float, leaves: int = 3) -> np.ndarray:
    """Values over bins of the greedy tree with up to ``leaves`` leaves, from gradient and weight by bin."""
    spans, values = [(0, len(g))], np.empty(len(g))
    cg, ch = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    while len(spans) < leaves:
        best = (1e-9, None, 0)
        for span in spans:
            lo, hi = span
            if hi - lo < 2:
                continue
            cut = np.arange(lo + 1, hi)
            left = _gain(cg[cut] - cg[lo], ch[cut] - ch[lo], l2)
            right = _gain(cg[hi] - cg[cut], ch[hi] - ch[cut], l2)
            gain = left + right - _gain(cg[hi] - cg[lo], ch[hi] - ch[lo], l2)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], span, int(cut[k]))
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    for lo, hi in spans:
        values[lo:hi] = _leaf(cg[hi] - cg[lo], ch[hi] - ch[lo], l2)
    return values


def quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Best cut of each axis at once: gain and values of the four parts over a two-dimensional histogram."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b = g.shape
    if a < 2 or b < 2:
        return 0.0, np.zeros_like(g)
    ll_g, ll_h = cg[:-1, :-1], ch[:-1, :-1]
    top_g, top_h = cg[:-1, -1:], ch[:-1, -1:]
    side_g, side_h = cg[-1:, :-1], ch[-1:, :-1]
    parts = [(ll_g, ll_h), (top_g - ll_g, top_h - ll_h), (side_g - ll_g, side_h - ll_h),
             (cg[-1, -1] - top_g - side_g + ll_g, ch[-1, -1] - top_h - side_h + ll_h)]
    gain = sum(_gain(x, y, l2) for x, y in parts) - _gain(cg[-1, -1], ch[-1, -1], l2)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = np.empty_like(g)
    cell = [_leaf(x[i, j], y[i, j], l2) for x, y in parts]
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = cell
    return float(gain[i, j]), values


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 32, n_pairs: int = 6, l2: float = 2.0) -> AdditiveModel:
    """Fit on features (n, k) and labels 0/1.

    No rows give a model that scores 0.5; one class alone gives its smoothed share.
    """
    n, k = x.shape
    share = (float(y.sum()) + 0.5) / (n + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))), [_cuts(x[:, j], bins) for j in range(k)], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not n or y.min() == y.max():
        return model
    at = [np.searchsorted(model.edges[j], x[:, j], "right") for j in range(k)]
    total = np.full(n, model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(k):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * shallow_tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size), l2)
            model.tables[j] += step
            total += step[at[j]]
    model.coarse = [_cuts(x[:, j], 8) for j in range(k)]
    rough = [np.searchsorted(model.coarse[j], x[:, j], "right") for j in range(k)]

    def cells(i: int, j: int):
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        where = rough[i] * shape[1] + rough[j]
        g, h = slopes()
        size = shape[0] * shape[1]
        return where, np.bincount(where, g, size).reshape(shape), np.bincount(where, h, size).reshape(shape)

    ranked = sorted(((quadrants(*cells(i, j)[1:], l2)[0], i, j) for i, j in combinations(range(k), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in ranked[:n_pairs] if gain > 1e-6]
    for _ in range(rounds // 2):
        for i, j in chosen:
            where, g, h = cells(i, j)
            step = rate * quadrants(g, h, l2)[1]
            model.pairs[i, j] = model.pairs.get((i, j), 0) + step
            total += step.ravel()[where]
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, label: str = "quality", id_col: str = "doc_id") -> AdditiveModel:
    """Fit on labelled documents whose crc32(id) mod 5 is not 0.

    Of those at most ``train_rows``, by smallest hash of the id, which are
    spread evenly over the table; so the sample is the same at every run and its
    features (a few MB) may be collected. An id labelled twice counts once, with
    its larger label, and an id with several texts with the smallest of them; null
    labels and ids are left out.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (remainder(F.col(id_col), 5) != 0))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label).alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(train_rows)
    )
    rows = docs.select(F.col(id_col).alias("__id"), "text").join(F.broadcast(chosen), "__id")
    rows = rows.groupBy("__id", "__label").agg(F.min("text").alias("text"))
    got = with_features(rows).select("__id", "__label", "features").toPandas().sort_values("__id")
    x = np.array(got["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, got["__label"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> DataFrame:
    """Add ``score`` (likelihood of label 1) and ``predicted`` (1 from THRESHOLD up); other columns pass through.

    Only the text is looked at. Null and empty texts get the score of an all-zero row.
    """

    def rows(batch: pa.RecordBatch):
        x = np.array([features(t) for t in utf8(batch, text_col)], float)
        p = model.score(x)
        return [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]

    return with_columns(docs, [("score", T.DoubleType()), ("predicted", T.IntegerType())], rows)
