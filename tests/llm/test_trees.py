"""The quality model's trees and features against plain brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from weftline.llm import quality

L2 = 2.0


def gain(g, h):
    return g * g / (h + L2)


def brute_tree(g, h, leaves):
    """The greedy tree by trying every cut of every leaf."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        options = []
        for lo, hi in spans:
            for cut in range(lo + 1, hi):
                parts = ((lo, cut), (cut, hi))
                options.append((sum(gain(sum(g[a:b]), sum(h[a:b])) for a, b in parts) - gain(sum(g[lo:hi]), sum(h[lo:hi])), (lo, hi), parts))
        best = max(options, key=lambda o: o[0], default=None)
        if best is None or best[0] <= 1e-9:
            break
        spans = [s for s in spans if s != best[1]] + list(best[2])
    values = [0.0] * len(g)
    for lo, hi in spans:
        values[lo:hi] = [sum(g[lo:hi]) / (sum(h[lo:hi]) + L2)] * (hi - lo)
    return values


@pytest.mark.parametrize("leaves", [1, 2, 3, 5])
def test_shallow_trees(leaves):
    rng = np.random.default_rng(leaves)
    for _ in range(150):
        n = int(rng.integers(1, 12))
        g, h = rng.normal(size=n), rng.random(n)
        assert quality.shallow_tree(g, h, L2, leaves) == pytest.approx(brute_tree(g.tolist(), h.tolist(), leaves))


def test_quadrants():
    rng = np.random.default_rng(9)
    for _ in range(150):
        a, b = rng.integers(1, 6, 2)
        g, h = rng.normal(size=(a, b)), rng.random((a, b))
        found, values = quality.quadrants(g, h, L2)
        options = []
        for i in range(1, a):
            for j in range(1, b):
                parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, b)), (slice(i, a), slice(0, j)), (slice(i, a), slice(j, b))]
                options.append((sum(gain(g[p].sum(), h[p].sum()) for p in parts) - gain(g.sum(), h.sum()), parts))
        if not options:
            assert found == 0 and not values.any()
            continue
        best, parts = max(options, key=lambda o: o[0])
        want = np.empty_like(g)
        for p in parts:
            want[p] = g[p].sum() / (h[p].sum() + L2)
        assert found == pytest.approx(best) and values == pytest.approx(want)


def test_a_score_is_the_sum_of_its_bins():
    rng = np.random.default_rng(4)
    x = rng.random((300, 4))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(int), rounds=20, n_pairs=2)
    assert model.pairs
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        at = [sum(e <= v for e in edges) for v, edges in zip(row, model.edges, strict=True)]
        total = model.intercept + sum(t[i] for t, i in zip(model.tables, at, strict=True))
        for (i, j), table in model.pairs.items():
            total += table[sum(e <= row[i] for e in model.coarse[i]), sum(e <= row[j] for e in model.coarse[j])]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_features():
    rng = random.Random(2)
    pieces = ["the", "THE", "a", "1x", "é東", "ok.", "no!", "|", "#$", "x,", "Ü", "(b)", "\n", "\n\n", "\t"]
    for _ in range(200):
        text = " ".join(rng.choices(pieces, k=rng.randint(0, 40)))
        got = dict(zip(quality.FEATURES, quality.features(text.encode()), strict=True))
        words = text.split()
        if not words:
            assert not any(got.values())
            continue
        n, solid = len(words), sum(map(len, words))
        lines = [x for x in (y.strip() for y in text.split("\n")) if x]
        count = lambda pattern: len(re.findall(pattern, text))
        want = {
            "log_words": np.log1p(n), "log_chars": np.log1p(len(text)), "word_length": solid / n, "log_lines": np.log1p(len(lines)), "words_per_line": n / len(lines),
            "upper": count("[A-Z]") / (count("[A-Za-z]") + 1), "digits": count("[0-9]") / solid, "bang": count("!") / solid, "pipe": count(r"\|") / n,
            "symbols": count(r"[#$%&*<>]") / solid, "stops": count("[.,]") / n, "distinct": len(set(words)) / n**0.8, "top_word": max(Counter(words).values()) / n,
            "stuck": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, "dup_lines": 1 - len(set(lines)) / len(lines), "lines_ended": sum(x[-1] in ".!?" for x in lines) / len(lines),
            "one_char_words": sum(len(w.encode()) == 1 for w in words) / n, "foreign": count(r"[^\x00-\x7f]") / solid,
        }
        assert {k: got[k] for k in want} == pytest.approx(want)
