"""License scans as an exact set-similarity join of text blocks with license notices.

A notice matches a block (so many consecutive words of a text, across its lines,
as notices are often hard-wrapped) that holds at least a share of its distinct
words. The notices' tokens are ordered by their frequency in the corpus, rarest
first; other words can't add to an overlap and aren't ordered. In a block that
reaches the share the notice's rarest token is one of its first few (prefix
filter). Around each place of such a token there must be enough distinct tokens
(length filter), and enough of them behind it in the order (positional filter,
with the token's position in the notice and in the block); only such places are
verified. The notices are a fixed small table, so their side of the join travels
to the tasks and the corpus is read in place.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import utf8, with_columns
from weftline.llm.license_texts import NOTICES

#: Phrases whose every place counts, with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
#: Share of a notice's distinct words that a block must hold.
CONTAINMENT = 0.8
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased (bytes.lower touches no others)."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Notice:
    label: str
    tokens: tuple[bytes, ...]  # distinct, rarest in the corpus first
    need: int
    span: int

    @property
    def prefix(self) -> tuple[bytes, ...]:
        return self.tokens[: len(self.tokens) - self.need + 1]


def prepare(notices: tuple[tuple[str, str], ...], frequency: dict[bytes, int], share: float = CONTAINMENT) -> list[Notice]:
    """Notices with their tokens in global order; unseen tokens are the rarest, ties go by the token."""
    out = []
    for label, text in notices:
        found = words(text.encode())
        tokens = sorted(set(found), key=lambda t: (frequency.get(t, 0), t))
        if tokens:
            out.append(Notice(label, tuple(tokens), math.ceil(share * len(tokens) - 1e-9), 2 * len(found)))
    return out


def token_frequency(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, text_col: str = "text") -> dict[bytes, int]:
    """Corpus frequency of the notices' own tokens, counted over all rows; as many entries as the notices have words."""
    wanted = frozenset(w for _, text in notices for w in words(text.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in utf8(batch, text_col):
                seen.update(filter(wanted.__contains__, words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    counted = docs.select(text_col).mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {bytes(r["token"]): r["n"] for r in counted.collect()}


@dataclass(frozen=True)
class Block:
    """A place where a notice matches: first and last word (from 0), and the share of the notice's distinct words there."""

    label: str
    first: int
    last: int
    share: float


def blocks_of(places: list[tuple[int, bytes]], notice: Notice) -> list[Block]:
    """Blocks of a notice, given the places (word position, token) of its tokens in order.

    Every window of ``span`` words that holds ``need`` of the tokens counts;
    windows that overlap are one block, with the best share among them.
    """
    held: Counter[bytes] = Counter()
    out: list[Block] = []
    start = 0
    for at, token in places:
        held[token] += 1
        while at - places[start][0] >= notice.span:
            gone = places[start][1]
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            start += 1
        if len(held) >= notice.need:
            first, share = places[start][0], len(held) / len(notice.tokens)
            if out and first <= out[-1].last:
                out[-1] = Block(notice.label, out[-1].first, at, max(share, out[-1].share))
            else:
                out.append(Block(notice.label, first, at, share))
    return out


class Scanner:
    """The notices' inverted prefix index and the phrases. ``met`` and ``rejected`` count what the filters see and turn away."""

    def __init__(self, notices: list[Notice], frequency: dict[bytes, int] | None = None):
        frequency = frequency or {}
        tokens = sorted({t for n in notices for t in n.tokens}, key=lambda t: (frequency.get(t, 0), t))
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.index: dict[bytes, list[tuple[int, Notice]]] = {}
        for notice in notices:
            for at, token in enumerate(notice.prefix):
                self.index.setdefault(token, []).append((at, notice))
        self.prefixes = frozenset(self.index)
        self.phrases = [(tuple(p.encode().split()), label) for p, label in PHRASES]
        self.met = self.short = self.rejected = 0

    def base(self, tokens: list[bytes]) -> tuple[list[int], set[str]]:
        """Start words of all places of the phrases, and their labels."""
        starts, labels = [], set()
        ends = [i for i, w in enumerate(tokens) if w == b"license"]
        for phrase, label in self.phrases:
            size = len(phrase)
            found = [i - size + 1 for i in ends if i >= size - 1 and tuple(tokens[i - size + 1 : i + 1]) == phrase]
            starts += found
            labels |= {label} if found else set()
        return starts, labels

    def blocks(self, tokens: list[bytes]) -> list[Block]:
        """Every block of the words that contains a notice, by notice and place."""
        if self.prefixes.isdisjoint(tokens):
            return []
        rank = self.rank
        places = [(i, w) for i, w in enumerate(tokens) if w in rank]
        words_at = np.array([i for i, _ in places])
        ranks = np.array([rank[w] for _, w in places])
        near: dict[str, tuple[Notice, list[tuple[int, int]]]] = {}
        for i, token in places:
            for at, notice in self.index.get(token, ()):
                # this may be the rarest token of a block: look at all words that a block around it can have
                self.met += 1
                lo, hi = np.searchsorted(words_at, (i - notice.span + 1, i + notice.span))
                around = np.unique(ranks[lo:hi])
                if len(around) < notice.need:
                    self.short += 1
                    continue
                behind = len(around) - 1 - int(np.searchsorted(around, rank[token]))
                if 1 + min(len(notice.tokens) - at - 1, behind) < notice.need:
                    self.rejected += 1
                    continue
                near.setdefault(notice.label, (notice, []))[1].append((int(lo), int(hi)))
        out: list[Block] = []
        for notice, spans in near.values():
            own = frozenset(notice.tokens)
            merged: list[list[int]] = []
            for lo, hi in spans:
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                out += blocks_of([p for p in places[lo:hi] if p[1] in own], notice)
        return sorted(out, key=lambda b: (b.label, b.first))


FIELDS = [
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
    ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()),
]
#: Every block found: label, first and last word, share of the notice's distinct words.
BLOCKS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("share", T.DoubleType())]))


def scan(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, share: float = CONTAINMENT, text_col: str = "text") -> DataFrame:
    """Add FIELDS and ``blocks`` to each row: places of the base phrases, labels of phrases and notices, a score, and the notices' blocks.

    The score is 1 where a base phrase stands, else the best share of a notice
    that matched, else 0. Null and empty texts have no words, no places (first
    and last are null), no blocks and empty labels. Repeated rows each get their own result; a column that has the
    name of a result is replaced by it. Of places where a notice matches equally well the first is its block.
    """
    frequency = token_frequency(docs, notices, text_col)
    prepared = prepare(notices, frequency, share)

    def rows(batch: pa.RecordBatch, scanner: Scanner):
        out: list[list] = [[] for _ in range(len(FIELDS) + 1)]
        for text in utf8(batch, text_col):
            tokens = words(text)
            starts, base = scanner.base(tokens) if b"license" in text.lower() else ([], set())
            more = scanner.blocks(tokens)
            score = 1.0 if base else max((b.share for b in more), default=0.0)
            values = (
                len(tokens), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | {b.label for b in more})), score,
                [{"label": b.label, "first": b.first, "last": b.last, "share": b.share} for b in more],
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
        block = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(block)]
        return [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]

    return with_columns(docs, [*FIELDS, ("blocks", BLOCKS)], rows, setup=lambda: Scanner(prepared, frequency))
