"""SentencePiece encoding and decoding through a table of distinct chunks.

In a vocabulary where a whitespace marker stands only at the start of a piece,
no merge crosses from one marked word to the next. A text is therefore the
concatenation of its marked words' ids. The corpus's distinct marked words are
counted (in the tasks, then by aggregation), each of the frequent ones is
segmented once, and the table of their ids travels to the tasks, which put the
documents together from it by position. The table is bounded: it takes the most
frequent words, down to the count at which it is full. The many words that are
seen once or a few times are segmented by the worker that meets them and kept in
a bounded table of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import Written, texts, with_columns

MARK = "▁"
#: Longer chunks are segmented where they stand and not kept, so that a table entry is small.
KEPT_CHARS = 64
#: Entries of the corpus's table at most, and of a worker's own words; results don't depend on them.
TABLE_ENTRIES, OWN_ENTRIES = 100_000, 200_000
#: Characters of the texts whose chunks are held at once.
HELD_CHARS = 500_000
_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class ChunkTable:
    """Distinct marked words with their ids, and what they decode to where that isn't themselves.

    Starts from the corpus's table (chunk, ids, odd), to which a worker adds the
    other words that it meets.
    """

    def __init__(self, model_path: str, corpus: pa.Table | None = None, own_entries: int = OWN_ENTRIES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = self.model.get_piece_size()
        if any(re.search(f"[^{MARK}]{MARK}", self.model.id_to_piece(i)) for i in range(size)):
            raise ValueError("a piece of this vocabulary crosses a whitespace marker; chunks can't be segmented alone")
        self.anchor = self.model.encode("a")  # something before a chunk, so that its leading space is decoded too
        self.anchor_text = self.model.decode(self.anchor)
        self.corpus, self.own_entries = corpus, own_entries
        self.start()

    def start(self) -> None:
        self.ids: dict[str, str] = {}
        self.odd: dict[str, str] = {}
        if self.corpus is not None:
            chunks, ids, odd = (self.corpus.column(c).to_pylist() for c in ("chunk", "ids", "odd"))
            self.ids = dict(zip(chunks, ids, strict=True))
            self.odd = {c: o for c, o in zip(chunks, odd, strict=True) if o is not None}
        self.most = len(self.ids) + self.own_entries

    def segment(self, chunks: list[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Ids as text by chunk, and the decoded chunk where it differs from the chunk with its marks as spaces."""
        skip, text = len(self.anchor), len(self.anchor_text)
        plain = [c.replace(MARK, " ") for c in chunks]
        encoded = self.model.encode([f"a{p}" for p in plain], num_threads=1)
        decoded = self.model.decode(encoded, num_threads=1)
        ids = {c: str(e[skip:])[1:-1].replace(" ", "") for c, e in zip(chunks, encoded, strict=True)}
        return ids, {c: d[text:] for c, p, d in zip(chunks, plain, decoded, strict=True) if d[text:] != p}

    def learn(self, chunks: set[str]) -> None:
        """Segment those of the chunks that the table lacks."""
        new = [c for c in chunks if c not in self.ids]
        if len(self.ids) + len(new) > self.most:
            self.start()
            new = [c for c in chunks if c not in self.ids]
        if new:
            ids, odd = self.segment(new)
            self.ids.update(ids)
            self.odd.update(odd)

    def code(self, chunks: list[str]) -> tuple[str, str]:
        """A text's ids joined by commas and its decoded text, from its chunks by position."""
        found, odd = list(map(self.ids.get, chunks)), self.odd
        if None in found:  # chunks too long for the table
            ids, long_odd = self.segment([c for c, f in zip(chunks, found, strict=True) if f is None])
            found = [ids[c] if f is None else f for c, f in zip(chunks, found, strict=True)]
            odd = odd | long_odd
        if odd.keys().isdisjoint(chunks):
            decoded = "".join(chunks).replace(MARK, " ")
        else:
            decoded = "".join([odd[c] if c in odd else c.replace(MARK, " ") for c in chunks])
        return ",".join(found), decoded[1:]  # without the space that encoding puts before a text


#: The table of this Python worker by model and corpus: tasks that follow in a worker find what earlier ones segmented.
_TABLES: dict[tuple, ChunkTable] = {}


def worker_table(model_path: str, name: str, shared, own_entries: int) -> ChunkTable:
    key = (model_path, name, own_entries)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = ChunkTable(model_path, pa.ipc.open_stream(shared.value).read_all(), own_entries)
    return _TABLES[key]


def portions(items: list[str], most: int = HELD_CHARS) -> Iterator[list[str]]:
    """Texts in order, in lists of at most ``most`` characters or one text."""
    part, size = [], 0
    for item in items:
        if part and size + len(item) > most:
            yield part
            part, size = [], 0
        part.append(item)
        size += len(item)
    if part:
        yield part


def marked(text: str) -> list[str]:
    """A text's marked words: spaces as marks, one mark before the text, cut before each run of marks."""
    return _CHUNKS.findall(MARK + text.replace(" ", MARK)) if text else []


def chunk_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(chunk, n) over all rows, for chunks short enough for a table; counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["chunk", "n"])

        seen: Counter[str] = Counter()
        for batch in batches:
            for part in portions(texts(batch, text_col)):
                for text in part:
                    seen.update(marked(text))
                if len(seen) > 300_000:
                    yield out({c: n for c, n in seen.items() if len(c) <= KEPT_CHARS})
                    seen = Counter()
        yield out({c: n for c, n in seen.items() if len(c) <= KEPT_CHARS})

    return docs.select(text_col).mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def corpus_table(docs: DataFrame, model_path: str, text_col: str = "text", entries: int = TABLE_ENTRIES) -> pa.Table:
    """(chunk, ids, odd) of the corpus's most frequent chunks, each segmented once.

    Takes every chunk seen at least 2, 4, 8 ... times, the least of these for
    which there are at most ``entries``, so no more than that comes to the driver.
    """
    counts = Written(chunk_counts(docs, text_col).where("n > 1"))
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r["level"]: r["kinds"] for r in counts.df.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("kinds")).collect()}  # 63 rows at most
    least, total = 64, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > entries:
            break
        least = k

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or ChunkTable(model_path)
            chunks = batch.column(0).to_pylist()
            ids, odd = table.segment(chunks) if chunks else ({}, {})
            columns = [batch.column(0), pa.array([ids[c] for c in chunks], pa.string()), pa.array([odd.get(c) for c in chunks], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "odd"])

    found = counts.df.where(level >= least).select("chunk").mapInArrow(segmented, "chunk string, ids string, odd string").toArrow()
    counts.drop()
    return found


_NO_IDS = np.empty(0, np.int32)


def encode_decode(
    docs: DataFrame, model_path: str, text_col: str = "text", with_ids: bool = False, with_text: bool = False,
    entries: int = TABLE_ENTRIES, own_entries: int = OWN_ENTRIES,
) -> DataFrame:
    """Encode every text, decode the ids again, and give digests of both.

    Adds n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256
    (UTF-8); ``with_ids`` adds the array ``ids``, ``with_text`` the text
    ``decoded``. Null and empty texts have no ids and decode to the empty text.
    The model is read on each executor from ``model_path``. Makes the corpus's
    table at once, in a first scan.
    """
    made = corpus_table(docs, model_path, text_col, entries)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, made.schema) as writer:
        writer.write_table(made)
    shared, name = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] * with_ids + [("decoded", T.StringType())] * with_text

    def rows(batch: pa.RecordBatch, table: ChunkTable):
        out: list[list] = [[] for _ in fields]
        for part in portions(texts(batch, text_col)):
            cut = list(map(marked, part))
            table.learn({c for chunks in cut for c in chunks if len(c) <= KEPT_CHARS})
            for chunks in cut:
                ids, decoded = table.code(chunks)
                values = [ids.count(",") + bool(ids), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                values += [np.fromstring(ids, np.int32, sep=",") if ids else _NO_IDS] * with_ids + [decoded] * with_text
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * with_ids + [pa.string()] * with_text
        return [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]

    return with_columns(docs, fields, rows, setup=lambda: worker_table(model_path, name, shared, own_entries))
