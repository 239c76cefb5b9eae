"""Benchmark decontamination: a BM25 index of the test items, asked with every training passage.

Items are cut into parts that fit a passage, so that a whole part always stands
inside one passage. Scores are BM25 of a part under the passage's words,
divided by the part's largest possible score; a passage retrieves every part at
or above a threshold, not a fixed number of them. Retrieval is block-max WAND:
postings are sorted by part and cut into blocks that know their largest impact;
lists whose maxima cannot reach the threshold together are never opened, and
blocks whose maxima cannot are skipped. What is retrieved is verified on the
words themselves: question and answer must both overlap.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import Written, texts

#: Words of a part at most, of a passage, and from one passage to the next.
PART, PASSAGE, STEP = 64, 128, 64
#: Share of a part's largest score at which it is retrieved, and of 5-word shingles that must be found again.
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.5, 5
K1, B = 1.2, 0.75
BLOCK = 16
#: An index over at most this much text is sent to the executors at once; a larger benchmark takes several passes.
INDEX_CHARS = 2_000_000
#: Part ranges and entries of the coarse table at most.
RANGES, COARSE_ENTRIES = 256, 16_000_000
_WORDS = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORDS.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's question and answer as words.

    The answer is what follows the last sentence or line end that leaves at
    least SHINGLE words on either side; without such an end an item is cut in
    the middle. Items of fewer than two shingles are all question.
    """
    whole = words(text)
    if len(whole) < 2 * SHINGLE:
        return whole, []
    for end in reversed([m.end() for m in re.finditer(r"[.?!]\s|\n", text)]):
        n = len(words(text[end:]))
        if SHINGLE <= n <= len(whole) - SHINGLE:
            return whole[:-n], whole[-n:]
    return whole[: len(whole) // 2], whole[len(whole) // 2 :]


def shingles(tokens: list[str]) -> set[tuple[str, ...]]:
    """Distinct shingles; fewer words than one make a single shorter one."""
    return set(zip(*(tokens[i:] for i in range(SHINGLE)))) if len(tokens) >= SHINGLE else ({tuple(tokens)} if tokens else set())  # noqa: B905


def parts_of(tokens: list[str]) -> list[list[str]]:
    """Even cuts of at most PART words."""
    n = -(-len(tokens) // PART)
    return [tokens[len(tokens) * i // n : len(tokens) * (i + 1) // n] for i in range(n)]


@dataclass
class Index:
    """Postings by term: parts in order, impacts as shares of a part's largest score, and block maxima."""

    terms: dict[str, int]
    postings: list[tuple[list[int], list[float], list[float]]]
    most: np.ndarray
    coarse: np.ndarray
    item_of: list[int]
    items: list[tuple[object, set, set]]

    def retrieve(self, query: list[int], threshold: float) -> dict[int, float]:
        """All parts whose score under these distinct terms is at least the threshold."""
        found: dict[int, float] = {}
        most, postings = self.most, self.postings
        lists = [[postings[t], 0, float(most[t])] for t in query]
        while True:
            lists = [x for x in lists if x[1] < len(x[0][0])]
            lists.sort(key=lambda x: x[0][0][x[1]])
            bound, pivot = 0.0, -1
            for k, (_, _, m) in enumerate(lists):
                bound += m
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            part = lists[pivot][0][0][lists[pivot][1]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][0][lists[pivot + 1][1]] == part:
                pivot += 1
            # the block of each list that would hold the part bounds its score more closely
            close, stop = 0.0, None
            for (parts, _, maxima), at, _ in lists[: pivot + 1]:
                p = bisect_left(parts, part, at)
                if p < len(parts):
                    block = p // BLOCK
                    close += maxima[block]
                    last = parts[min(len(parts), (block + 1) * BLOCK) - 1]
                    stop = last if stop is None else min(stop, last)
            if close < threshold:
                after = lists[pivot + 1][0][0][lists[pivot + 1][1]] if pivot + 1 < len(lists) else None
                jump = max(part, stop if stop is not None else part) + 1
                jump = max(part + 1, min(jump, after) if after is not None else jump)
                for x in lists[: pivot + 1]:
                    x[1] = bisect_left(x[0][0], jump, x[1])
                continue
            total = 0.0
            for x in lists[: pivot + 1]:
                (parts, impacts, _), at = x[0], bisect_left(x[0][0], part, x[1])
                if at < len(parts) and parts[at] == part:
                    total += impacts[at]
                    at += 1
                x[1] = at
            if total >= threshold:
                found[part] = total


def build_index(items: list[tuple[object, str]], df: dict[str, int], n_parts: int, mean_words: float) -> Index:
    """Index items (id, text); df, n_parts and mean_words are of the whole benchmark."""
    raw: dict[str, list[tuple[int, float]]] = {}
    item_of, kept = [], []
    for item, text in items:
        question, answer = question_and_answer(text)
        tokens = question + answer
        if not tokens:
            continue
        for part in parts_of(tokens):
            weights = {}
            for t in part:
                weights[t] = weights.get(t, 0) + 1
            for t, tf in weights.items():
                idf = math.log(1 + (n_parts - df[t] + 0.5) / (df[t] + 0.5))
                weights[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(part) / mean_words))
            total = sum(weights.values())
            for t, w in weights.items():
                raw.setdefault(t, []).append((len(item_of), w / total))
            item_of.append(len(kept))
        kept.append((item, shingles(question), shingles(answer)))
    terms = {t: i for i, t in enumerate(raw)}
    postings = [
        ([p for p, _ in x], [w for _, w in x], [max(w for _, w in x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)]) for x in raw.values()
    ]
    width = -(-len(item_of) // max(1, min(RANGES, COARSE_ENTRIES // max(1, len(terms)))))
    coarse = np.zeros((len(terms), -(-len(item_of) // max(1, width))), np.float32)
    for row, (found, impacts, _) in enumerate(postings):
        np.maximum.at(coarse[row], np.array(found) // width, impacts)
    return Index(terms, postings, np.array([max(x[1]) for x in postings], float), coarse, item_of, kept)


def overlap(have: set, want: set) -> float:
    return len(have & want) / len(want) if want else 1.0


def search(tokens: list[str], index: Index, threshold: float, least: float) -> list[tuple[object, float, float, float]]:
    """Items a document contains: (item, best score, question overlap, answer overlap).

    Passages start at every STEP words. The sum of a passage's list maxima
    bounds every score; only passages that it lets through are asked for.
    """
    n, get = len(tokens), index.terms.get
    ids = np.array([get(t, -1) for t in tokens], np.int64)
    bounds = np.where(ids >= 0, index.most[np.maximum(ids, 0)], 0.0) if len(index.most) else np.zeros(n)
    run = np.append(0.0, np.cumsum(bounds))
    starts = np.arange(0, max(1, n - PASSAGE + STEP), STEP)
    ends = np.minimum(starts + PASSAGE, n)
    best: dict[int, float] = {}
    for lo, hi in zip(starts, ends, strict=True):
        if run[hi] - run[lo] < threshold:
            continue
        query = np.unique(ids[lo:hi])
        query = query[query >= 0]
        if not len(query) or index.coarse[query].sum(0).max() < threshold - 1e-4:
            continue
        for part, score in index.retrieve(query.tolist(), threshold).items():
            item = index.item_of[part]
            best[item] = max(best.get(item, 0.0), score)
    if not best:
        return []
    have, out = shingles(tokens), []
    for item, score in best.items():
        name, question, answer = index.items[item]
        if any(len(s) < SHINGLE for s in question):  # shorter than a shingle: its words must stand together
            size = len(next(iter(question)))
            q = 1.0 if any(tuple(tokens[i : i + size]) in question for i in range(n)) else 0.0
        else:
            q = overlap(have, question)
        a = overlap(have, answer)
        if q >= least and a >= least:
            out.append((name, score, q, a))
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    least: float = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    index_chars: int = INDEX_CHARS,
) -> DataFrame:
    """(doc, item, score, question_overlap, answer_overlap) of every training document that holds a test item.

    Every passage of every document is a query. Items without words match
    nothing, null texts are empty, a repeated item is found as often as it is
    listed, and each row of ``docs`` answers for itself. The index is bounded by
    ``index_chars`` of item text; a larger benchmark is worked through in that
    many passes, with word statistics of all of it.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            *(T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap", "answer_overlap")),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, seen = [], []
            for text in texts(batch, "text"):
                for part in parts_of(sum(question_and_answer(text), [])) if words(text) else []:
                    sizes.append(len(part))
                    seen.append(list(set(part)))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(seen, pa.list_(pa.string()))], names=["size", "terms"])

    items = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    parts = Written(items.select("text").mapInArrow(cut, "size long, terms array<string>"))
    n_parts, mean_words = parts.df.agg(F.count(F.lit(1)), F.coalesce(F.avg("size"), F.lit(1.0))).first()
    df = parts.df.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-chars // index_chars))
    items = items.withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(passes)))

    def one_pass(k: int) -> DataFrame:
        rows = [(r["item"], r["text"]) for r in items.where(F.col("pass") == k).collect()]  # within index_chars
        own = docs.sparkSession.createDataFrame([(t,) for t in {t for _, x in rows for t in words(x)}], "term string")
        counts = {r["term"]: r["df"] for r in df.join(F.broadcast(own), "term").collect()}
        index = docs.sparkSession.sparkContext.broadcast(build_index(rows, counts, n_parts, mean_words))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = index.value
            for batch in batches:
                out = []
                for doc, text in zip(batch.column(0).to_pylist(), texts(batch, "__text"), strict=True):
                    out += [(doc, *hit) for hit in search(words(text), found, threshold, least)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=schema.names
                    )

        return docs.select(id_col, F.col(text_col).alias("__text")).mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in schema]
    out = one_pass(0)
    for k in range(1, passes):
        out = out.unionByName(one_pass(k))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without those that hold a test item; rows with a null id stay unless all their like hold one.

    The contaminated ids are few against the corpus; the anti-join broadcasts
    them when their table is small and shuffles otherwise.
    """
    hit = Written(contaminated(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("__hit")).distinct())
    side = F.broadcast(hit.df) if hit.small() else hit.df
    return docs.join(side, docs[id_col].eqNullSafe(side["__hit"]), "left_anti")
