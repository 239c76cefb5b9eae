"""URL filters: list rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and a path prefix; the longest that fits decides. URLs
without a rule are judged by boosted trees over how the URL looks: lengths,
depth, digits, entropy, parameters, and how often its suffixes were bad among
the labelled URLs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import Written, with_columns

#: Fixed values: (rule, verdict); a rule is host/path-prefix.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Words of host names that published block lists sort under these headings.
BLOCK_LIST = {
    "advertising and tracking": "ad ads adserver adservice advert advertising affiliate banners clicks doubleclick popads popup pixel telemetry track tracker tracking",
    "gambling": "bet bets betting bingo blackjack casino casinos gamble gambling jackpot lottery poker roulette slots sportsbook",
    "drugs": "cialis levitra pharma pharmacy pill pills steroids tramadol viagra xanax",
    "adult": "adult cams erotic escort escorts nude porn porno sex xxx",
    "spam and fraud": "cheap crack cracked free giveaway keygen loans payday phishing prize replica scam spam spammer torrents warez winner",
}
#: Hosts whose crc32 modulo this is 0 are never labelled: the model's error is measured on them.
UNLABELLED = 3
#: At most this many labelled URLs are used to fit, those with the smallest hash.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "parameters", "digit_ratio", "host_digit_ratio",
    "hyphens", "longest_label", "entropy", "host_entropy", "vowel_ratio", "suffix_rate", "domain_rate", "has_fragment", "secure",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path of a URL; both empty for null or without "://"."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits (null if none): same host or a subdomain, and the path starts with the rule's.

    One CASE from the longest rule down; rules of equal length can't both fit
    with different hosts and prefixes of one URL, repeated ones count once.
    """
    best = F.lit(None).cast("string")
    for rule, _ in sorted(set(rules), key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        best = F.when(fits, F.lit(rule)).otherwise(best)
    return best


# -- features -------------------------------------------------------------------------------------


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    counts = np.unique(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), return_counts=True)[1]
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host and its last three."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -3)


@dataclass
class Rates:
    """(name, bad, n, bads, ns): URLs and bad ones by suffix and fold, over all labelled URLs; names without a dot apart, as they are few."""

    labels: Written
    domains: Written
    mean: float

    def join(self, df: DataFrame, host: Column, fold: Column | None = None) -> DataFrame:
        """Add RATES, the counts of each row's suffixes (without a fold's own); null where no labelled URL has the suffix.

        Tables are broadcast where they are small, else joined by suffix, where
        adaptive execution splits a hot suffix's rows.
        """
        last, domain = suffixes(host)
        out = df.withColumns({"__last": last, "__domain": domain})
        for name, side in (("last", self.labels), ("domain", self.domains)):
            named = side.df.select(F.col("name").alias(f"__{name}"), *(F.col(c).alias(f"__{name}_{c}") for c in ("bad", "n", "bads", "ns")))
            out = out.join(F.broadcast(named) if side.small() else named, f"__{name}", "left")
            if fold is not None:
                out = out.withColumns({f"__{name}_{c}": F.col(f"__{name}_{c}") - F.get(f"__{name}_{c}s", fold) for c in ("bad", "n")})
        # a host of one label is its own domain
        one = F.col("__domain") == F.col("__last")
        own = {f"__domain_{c}": F.when(one, F.col(f"__last_{c}")).otherwise(F.col(f"__domain_{c}")) for c in ("bad", "n")}
        return out.withColumns(own).select(*df.columns, *RATES)


#: Columns that Rates.join adds.
RATES = ["__last_bad", "__last_n", "__domain_bad", "__domain_n"]
#: A row is trained with the rates of the other folds.
FOLDS = 5


def fold_of(url: Column) -> Column:
    """Fold of a URL, another hash than the sample is drawn by."""
    return F.pmod(F.xxhash64(url, F.lit("fold")), F.lit(FOLDS)).cast("int")


def count_suffixes(labelled: DataFrame) -> Rates:
    """Rates of all labelled URLs (distinct urls with bad 0/1), counted in the tasks before the shuffle."""
    last, domain = suffixes(host_and_path(F.col("url"))[0])
    named = labelled.select(F.explode(F.array_distinct(F.array(last, domain))).alias("name"), "bad", fold_of(F.col("url")).alias("fold"))
    sums = [(F.sum(F.when(F.col("fold") == k, F.col("bad")).otherwise(0)), F.count(F.when(F.col("fold") == k, 1))) for k in range(FOLDS)]
    counted = named.groupBy("name").agg(
        F.sum("bad").cast("double").alias("bad"), F.count(F.lit(1)).cast("double").alias("n"),
        *(F.array(*c).cast("array<double>").alias(name) for name, c in zip(("bads", "ns"), zip(*sums, strict=True), strict=True)),
    )
    counted, dotted = Written(counted), F.col("name").contains(".")
    labels, domains = Written(counted.df.where(~dotted)), Written(counted.df.where(dotted))
    # every URL has one last label
    whole = labels.df.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    return Rates(labels, domains, whole["bad"] / whole["n"] if whole["n"] else 0.5)


def _split(url: str | None) -> tuple[str, str, str, str]:
    scheme, sep, rest = (url or "").partition("://")
    if not sep:
        return "", "", "", ""
    at = re.search("[/?#]", rest)
    host, tail = (rest[: at.start()], rest[at.start() :]) if at else (rest, "")
    body, mark, _ = tail.partition("#")
    path, _, query = body.partition("?")
    return scheme, re.sub("[A-Z]", lambda m: m[0].lower(), host), path, query + mark


def features(url: str | None, suffix_rate: float, domain_rate: float) -> list[float]:
    """FEATURES of a URL, given its suffixes' rates; null or without "://" gives zeros but for those."""
    scheme, host, path, query = _split(url)
    whole = f"{host}{path}{query}"
    labels = host.split(".") if host else []
    digits, host_digits = sum(map(str.isdigit, whole)), sum(map(str.isdigit, host))
    return [
        len(whole), len(host), len(path), len(query), sum(1 for x in path.split("/") if x), len(labels), query.count("="),
        digits / max(1, len(whole)), host_digits / max(1, len(host)), host.count("-"), max(map(len, labels), default=0),
        _entropy(whole), _entropy(host), sum(c in "aeiou" for c in host) / max(1, len(host)), suffix_rate, domain_rate,
        float("#" in query), float(scheme == "https"),
    ]


# -- boosted trees --------------------------------------------------------------------------------


@dataclass
class Forest:
    """Trees of fixed depth: at each inner node a feature and a cut, at each leaf a value."""

    base: float
    depth: int
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    value: np.ndarray  # (trees, leaves)
    rates: Rates | None

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rates: Rates | None, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> Forest:
    """Boost trees on histograms. No rows give 0.5 everywhere, one class its smoothed share.

    Of splits that gain the same, the one with the widest gap between the two
    sides is taken (as a share of the feature's range), and cuts lie in the middle.
    """
    n, k = x.shape
    share = (float(y.sum()) + 0.5) / (n + 1)
    inner, leaves = 2**depth - 1, 2**depth
    model = Forest(float(np.log(share / (1 - share))), depth, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), rates)
    if not n or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="higher")) for j in range(k)]
    binned = [np.searchsorted(edges[j], x[:, j], "right") for j in range(k)]
    below = [np.array([x[x[:, j] < e, j].max(initial=-np.inf) for e in edges[j]]) for j in range(k)]
    gaps = [(e - b) / max(np.ptp(x[:, j]), 1e-12) for j, (e, b) in enumerate(zip(edges, below, strict=True))]
    cuts = [np.where(np.isfinite(b), (e + b) / 2, e) for e, b in zip(edges, below, strict=True)]
    total = np.full(n, model.base)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, cut, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(leaves)
        node = np.zeros(n, int)
        for level in range(depth):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == at)
                best = (1e-9, 0.0, 0, np.inf)
                gs, hs = g[rows].sum(), h[rows].sum()
                for j in range(k):
                    if not len(rows) or not len(edges[j]):
                        continue
                    left_g = np.cumsum(np.bincount(binned[j][rows], g[rows], len(edges[j]) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(binned[j][rows], h[rows], len(edges[j]) + 1))[:-1]
                    gain = left_g**2 / (left_h + l2) + (gs - left_g) ** 2 / (hs - left_h + l2) - gs**2 / (hs + l2)
                    b = int(gain.argmax())
                    tie = abs(gain[b] - best[0]) <= 1e-9 * best[0]
                    if gain[b] > best[0] and not tie or tie and gaps[j][b] > best[1]:
                        best = (gain[b], gaps[j][b], j, cuts[j][b])
                feature[at], cut[at] = best[2], best[3]
                node[rows] = 2 * at + 1 + (x[rows, best[2]] >= best[3])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        total += value[leaf]
        made.append((feature, cut, value))
    model.feature, model.cut, model.value = (np.array(c) for c in zip(*made, strict=True))
    return model


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Forest:
    """Fit on labelled URLs (url, bad 0/1), at most ``train_rows`` distinct ones by smallest hash.

    Suffix rates are shares of bad URLs by last label and by last three labels,
    over all labelled URLs, drawn towards the overall share; only the trees are
    bounded. A row is trained with the rates of the other folds: without its own
    label alone, a suffix's rate would tell the label. Each row is seen a second
    time as one of an unknown domain, so that the trees learn what URLs look like
    and not domains alone. Null URLs and labels are left out; a URL labelled twice counts as
    bad if once bad.
    """
    chosen = Written(labelled.where("url is not null and bad is not null").groupBy("url").agg(F.max("bad").alias("bad"))).df
    rates = count_suffixes(chosen)
    sample = chosen.orderBy(F.xxhash64("url"), "url").limit(train_rows)
    url = F.col("url")
    got = rates.join(sample, host_and_path(url)[0], fold_of(url)).orderBy(F.xxhash64("url"), "url").toPandas()
    y = got["bad"].to_numpy(float)
    last, domain = (smoothed(got[f"__{c}_bad"].to_numpy(float), got[f"__{c}_n"].to_numpy(float), rates.mean) for c in ("last", "domain"))
    x = np.array([features(*row) for row in zip(got["url"], last, domain, strict=True)], float).reshape(-1, len(FEATURES))
    unseen = x.copy()
    unseen[:, FEATURES.index("domain_rate")] = rates.mean
    return fit(np.concatenate((x, unseen)), np.concatenate((y, y)), rates, l2=2.0)  # every row counts twice, so the penalty does too


def smoothed(bad: np.ndarray, n: np.ndarray, mean: float) -> np.ndarray:
    """Share of bad ones drawn towards the mean."""
    return (bad + 4 * mean) / (n + 4)


def unlabelled(host: Column) -> Column:
    """Whether a host is held out from labelling."""
    return F.crc32(host.cast("binary")) % UNLABELLED == 0


def listed_labels(pages: DataFrame, block_list: dict[str, str] = BLOCK_LIST, url_col: str = "url") -> DataFrame:
    """Labelled URLs (url, bad) of a table of pages: bad where a hyphen- or dot-cut word of the host is on the block list.

    Only a part of the hosts is labelled (see UNLABELLED); the others' URLs are
    judged by what the trees have learnt from these.
    """
    host, _ = host_and_path(F.col(url_col))
    words = sorted({w for line in block_list.values() for w in line.split()})
    bad = F.arrays_overlap(F.split(host, r"[.\-]"), F.array(*map(F.lit, words)))
    return pages.where(~unlabelled(host)).select(F.col(url_col).alias("url"), bad.cast("int").alias("bad"))


def judge(pages: DataFrame, model: Forest, rules: tuple[tuple[str, str], ...] = RULES, url_col: str = "url") -> DataFrame:
    """Add host, path, rule, score and verdict: the rule's verdict where one fits, else block from THRESHOLD up.

    Rows only meet the suffix rates of the model. A null URL has empty host and path and no rule. Of rules that fit
    the longest counts. Repeated rows each get their own result; a column that has the name of a result is replaced by it.
    """
    host, path = host_and_path(F.col(url_col))
    parted = pages.withColumns({"host": host, "path": path})
    mean, forest = model.rates.mean, replace(model, rates=None)

    def rows(batch: pa.RecordBatch):
        urls = batch.column(batch.schema.get_field_index(url_col)).to_pylist()
        last_bad, last_n, bad, n = (batch.column(batch.schema.get_field_index(c)).fill_null(0).to_numpy(zero_copy_only=False) for c in RATES)
        x = np.array([features(*row) for row in zip(urls, smoothed(last_bad, last_n, mean), smoothed(bad, n, mean), strict=True)], float)
        return [pa.array(forest.score(x))]

    rated = model.rates.join(parted, F.col("host"))
    ruled = with_columns(rated, [("score", T.DoubleType())], rows, keep=parted.columns).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    for rule, said in dict(rules).items():
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    return ruled.withColumn("verdict", verdict)
