"""Toxicity behind disguises: noisy-channel restoring of words, then scoring of the restored text.

A disguised word (``1d10t``, ``s.t.u.p.i.d``, ``l o s e r``, ``moooron``) is a
clean word seen through a channel that swaps letters for look-alikes, puts
separators between them and repeats them. The channel's readings of a token form
a character lattice; Viterbi decoding finds the reading with the best sum of
channel and character language model costs. The language model is counted over
the whole corpus. Restored words are scored with a lexicon of word beginnings
learnt from labelled documents.
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

from weftline.llm.common import Written, remainder, texts, with_columns

#: What a character may stand for besides itself.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
#: Characters that may be put between letters.
SEPARATORS = ".-_*~·' "
#: Costs in nats: keeping a look-alike as it is, reading it as a letter, dropping a separator, dropping a repeat.
KEEP, READ, DROP, MERGE = 2.0, 0.5, 0.2, 0.3
#: Letters the language model tells apart: a-z, the most frequent others of the corpus, and one for the rest.
ALPHABET = 48
ORDER = 4
#: Labelled rows at most, by smallest hash of the id.
TRAIN_ROWS = 20_000
#: A lexicon entry needs this many toxic documents, or this share of them; lengths of the word beginnings looked at.
SUPPORT, SUPPORT_SHARE, PREFIXES = 3, 0.004, (4, 5, 6)
#: Weight that a toxic document keeps each time a chosen entry explains it.
EXPLAINED = 0.5
THRESHOLD = 0.3
#: Letters put apart by any run of separators or white space.
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[0-9@$!|+])(?:[\s.,/\-_*~·]+(?:[^\W_]|[0-9@$!|+])){2,}(?![^\W_])")
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1")
_LONG_RUN = re.compile(r"(.)\1{3,}", re.S)
#: Characters that are in no disguise: words joined by them are read one by one.
_JOINT = re.compile("[^" + r"\w" + "".join(map(re.escape, (*LOOK_ALIKES, *SEPARATORS))) + "]+")
_GAP = re.compile(r"[\s.\-_*~·]{2,}")
_LEET = frozenset(LOOK_ALIKES)


def collapse(word: str) -> str:
    """Runs of more than three of a character as three: no word has more, and the channel merges the rest alike."""
    return _LONG_RUN.sub(r"\1\1\1", word)


# -- the language model ---------------------------------------------------------------------------


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all rows; plain lower-cased words, counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(map(collapse, seen)), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen: Counter[str] = Counter()
        for batch in batches:
            tokens: Counter[str] = Counter()
            for text in texts(batch, text_col):
                tokens.update(text.lower().split())
            for token, n in tokens.items():
                for word in (token,) if token.isalpha() else _PLAIN.findall(token):
                    seen[word] += n
            if len(seen) > 300_000:
                yield out(seen)
                seen = Counter()
        yield out(seen)

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Interpolated character n-grams over a fixed alphabet; 0 is the word edge, 1 any other character."""

    letters: dict[str, int]
    cost: np.ndarray  # (symbols,) * ORDER: minus log probability of the last given the first ORDER - 1

    def number(self, char: str) -> int:
        return self.letters.get(char, 1)


def fit_language_model(counts: DataFrame) -> LanguageModel:
    """From the whole corpus's word counts: letter frequencies, then n-gram counts by aggregation.

    Both tables are bounded by the alphabet, not by the corpus. An empty corpus
    gives a uniform model.
    """
    single = counts.select(F.explode(F.split("word", "")).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
    others = [r["c"] for r in single.where("length(c) = 1 and not c rlike '[a-z]'").orderBy(F.desc("n"), "c").limit(ALPHABET - 28).collect()]
    letters = {c: i + 2 for i, c in enumerate([*"abcdefghijklmnopqrstuvwxyz", *others])}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, weights = [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = [0] * (ORDER - 1) + [letters.get(c, 1) for c in word] + [0]
                for i in range(len(ids) - ORDER + 1):
                    code = 0
                    for x in ids[i : i + ORDER]:
                        code = code * ALPHABET + x
                    rows.append(code)
                    weights.append(n)
            kinds, where = np.unique(np.array(rows, np.int64), return_inverse=True)
            total = np.bincount(where, np.array(weights, float), len(kinds)) if len(kinds) else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(total, pa.float64())], names=["gram", "n"])

    merged = counts.select("word", "n").mapInArrow(grams, "gram long, n double").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    full = np.zeros(ALPHABET**ORDER)
    full[merged["gram"].to_numpy(np.int64)] = merged["n"].to_numpy(float)
    full = full.reshape((ALPHABET,) * ORDER)
    p = np.full(ALPHABET, 1 / ALPHABET)
    for order in range(1, ORDER + 1):  # each order leans on the one below by the weight of one count a kind
        own = full.sum(tuple(range(ORDER - order))) if order < ORDER else full
        seen = own.sum(-1, keepdims=True)
        kinds = np.maximum((own > 0).sum(-1, keepdims=True), 1)
        p = (own + kinds * p) / (seen + kinds)
    return LanguageModel(letters, -np.log(p).astype(np.float16))  # a few MB, as it travels to every executor


# -- the channel ----------------------------------------------------------------------------------


def suspicious(token: str) -> bool:
    """Whether a token (lower case, no spaces) has more than one reading: look-alikes, inner separators (also figures of other scripts) or runs."""
    if not _LEET.isdisjoint(token) or _RUN.search(token) is not None or any(c in token[1:-1] for c in SEPARATORS):
        return True
    return not token.isascii() and any(c.isalnum() and droppable(c) for c in token[1:-1])


def restore(token: str, model: LanguageModel, edges: bool = False) -> str:
    """The cheapest reading of a token in its lattice; with ``edges`` of several words, parted by spaces.

    States are the last ORDER - 1 letters read. At each character a path may
    keep it, read a look-alike as a letter, drop a separator (or a look-alike at
    the token's end, as in "idiot!!"), merge a letter that repeats the one
    before, or with ``edges`` end a word at a separator or white space. This is
    Viterbi decoding over all states reached: none is pruned. A state holds
    letters that the token's characters may stand for, so there are at most
    (letters of the token + 1) ** (ORDER - 1), in words some ten, and the work is
    linear in the length, as paths share their beginnings.
    """
    start = (0,) * (ORDER - 1)
    cost, letters = model.cost, model.letters
    paths: dict[tuple[int, ...], tuple[float, tuple | None]] = {start: (0.0, None)}  # state: cost, (path before, letter)
    last_letter = max((i for i, c in enumerate(token) if c.isalnum()), default=-1)
    for at, char in enumerate(token):
        readings = []
        if char in LOOK_ALIKES:
            readings += [(r, READ) for r in LOOK_ALIKES[char]]
            readings.append((char, KEEP) if char.isalnum() else (None, KEEP if at <= last_letter else DROP))
        elif char.isalpha():
            readings.append((char, 0.0))
        else:
            readings.append((None, DROP))
            if edges and (char in SEPARATORS or char.isspace()):
                readings.append((" ", 0.0))
        new: dict[tuple[int, ...], tuple[float, tuple | None]] = {}
        for state, (total, text) in paths.items():
            options = list(readings)
            if text and any(r == text[1] for r, _ in readings):
                options.append((None, MERGE))
            for reading, fee in options:
                if reading is None:
                    key, value = state, (total + fee, text)
                elif reading == " ":
                    key, value = start, (total + fee + float(cost[(*state, 0)]), (text, " "))
                else:
                    number = letters.get(reading, 1)
                    key = (*state[1:], number)
                    value = (total + fee + float(cost[(*state, number)]), (text, reading))
                if key not in new or value[0] < new[key][0]:
                    new[key] = value
        paths = new
    text = min(((total + float(cost[(*state, 0)]), text) for state, (total, text) in paths.items()), key=lambda x: x[0])[1]
    out = []
    while text:
        text, letter = text
        out.append(letter)
    return "".join(reversed(out))


class Restorer:
    """Restores the words of texts; each distinct suspicious token is decoded once a task."""

    #: Entries after which a task starts its table anew; results don't depend on it.
    KEPT = 200_000

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known: dict[str, tuple[str, ...]] = {}

    def decode(self, token: str) -> tuple[str, ...]:
        """Readings of a token or of spaced letters: the words in it as they stand, it as one word, and the words that it joins."""
        found = self.known.get(token)
        if found is None:
            short = collapse(token)
            out = _PLAIN.findall(short)
            out.append(restore(short, self.model))
            parts = [p for p in _JOINT.split(short) if p]
            for part in parts if len(parts) > 1 else ():
                if suspicious(part):
                    out += self.decode(part)
            if any(c in SEPARATORS or c.isspace() for c in short):
                out += restore(short, self.model, edges=True).split()
                for piece in _GAP.split(short) if _GAP.search(short) else ():
                    out.append(restore(piece, self.model))
            found = tuple(dict.fromkeys(out))
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[token] = found
        return found

    def words(self, text: str) -> set[str]:
        """Distinct words of a text as they stand and as restored."""
        low = text.lower()
        out: set[str] = set()
        for token in set(low.split()):
            core = core_of(token)
            if core.isalpha():
                out.add(core)
            out.update(self.decode(core) if suspicious(core) else _PLAIN.findall(core))
        for spaced in _SPACED.findall(low):
            out.update(self.decode(spaced))
        return out


def core_of(token: str) -> str:
    """A token without the punctuation around it; of letters alone it is itself."""
    return token if token.isalpha() else token.strip(".,;:?\"')(")


# -- the lexicon ----------------------------------------------------------------------------------


def entries(words: set[str]) -> set[str]:
    """Lexicon entries of words: the words themselves and their beginnings, marked with a star."""
    out = set(words)
    for size in PREFIXES:
        out.update(f"{w[:size]}*" for w in words if len(w) > size)
    return out


def entries_of(word: str) -> list[str]:
    """Lexicon entries of one word."""
    return [word, *(f"{word[:size]}*" for size in PREFIXES if len(word) > size)]


@dataclass
class Lexicon:
    """Chance that a document with an entry is toxic, for the entries that tell."""

    chance: dict[str, float]

    def score_entries(self, met: set[str]) -> float:
        """Chance that at least one of the entries met is right."""
        return 1.0 - math.prod(1.0 - self.chance[e] for e in sorted(met))

    def score(self, words: set[str]) -> float:
        return self.score_entries({e for e in entries(words) if e in self.chance})


#: Longer tokens are looked at by the gate's automaton, whose work is linear in the length; shorter ones by the same gate as a pattern.
SHORT_TOKEN = 32


def droppable(char: str) -> bool:
    """Whether a reading may leave a character out wherever it stands: what is no letter and no digit that may be one."""
    return not (char.isalpha() or (char.isalnum() and char in LOOK_ALIKES))


class Gate:
    """Whether some entry's letters stand in a token in their order, with nothing between that a reading must keep.

    Each letter of an entry is one or more characters that may stand for it,
    with any number of characters between that ``restore`` may drop. A token without such a place has no
    reading in the lexicon. ``search`` asks a pattern or, for long tokens, the
    same automaton bit by bit; both say the same.
    """

    def __init__(self, lexicon: Lexicon):
        looks: dict[str, str] = {}
        for char, letters in LOOK_ALIKES.items():
            for letter in letters:
                looks[letter] = looks.get(letter, "") + char
        words = sorted({re.sub(r"(.)\1+", r"\1", entry.removesuffix("*")) for entry in lexicon.chance} - {""})
        classes = [[x + looks.get(x, "") for x in word] for word in words]
        # of characters beyond ASCII that may be dropped, Python's classes know some as letters: see ``plain``
        self.pattern = re.compile("|".join("".join(f"[{re.escape(c)}][{re.escape(c)}\\W_]*" for c in word) for word in classes)) if words else None
        self.first = self.last = at = 0
        self.places: dict[str, int] = {}
        for word in classes:
            self.first |= 1 << at
            for c in word:
                for char in c:
                    self.places[char] = self.places.get(char, 0) | 1 << at
                at += 1
            self.last |= 1 << (at - 1)

    @staticmethod
    def plain(token: str) -> str:
        """The token with what may be dropped as full stops."""
        return token if token.isascii() else "".join("." if droppable(c) and c not in LOOK_ALIKES else c for c in token)

    def search(self, token: str) -> bool:
        if self.pattern is None:
            return False
        if len(token) <= SHORT_TOKEN:
            return self.pattern.search(self.plain(token)) is not None
        return self.walk(token)

    def walk(self, token: str) -> bool:
        """The automaton: a bit for each letter of each entry that has been read last at some place."""
        read = 0
        for char in token:
            here = self.places.get(char, 0)
            read = ((read << 1 | self.first) & here) | (read if droppable(char) else read & here)
            if read & self.last:
                return True
        return False


class Scorer:
    """Scores texts; what a distinct token adds to the entries met is looked up once a task."""

    KEPT = 500_000

    def __init__(self, model: LanguageModel, lexicon: Lexicon):
        self.restorer, self.lexicon, self.gate = Restorer(model), lexicon, Gate(lexicon)
        self.known: dict[str, tuple[str, ...]] = {}

    def may_hit(self, token: str) -> bool:
        return self.gate.search(token)

    def hits(self, words) -> tuple[str, ...]:
        chance = self.lexicon.chance
        return tuple({e for w in words for e in entries_of(w) if e in chance})

    def of_token(self, token: str) -> tuple[str, ...]:
        core = core_of(token)
        if not suspicious(core):
            return self.hits((core,) if core.isalpha() else _PLAIN.findall(core))
        return self.hits((core, *self.restorer.decode(core)) if core.isalpha() else self.restorer.decode(core)) if self.may_hit(core) else ()

    def score(self, text: str) -> float:
        low = text.lower()
        tokens = set(low.split())
        if len(self.known) > self.KEPT:
            self.known.clear()
        known, met = self.known, set()
        for token in tokens:
            found = known.get(token)
            if found is None:
                found = known[token] = self.of_token(token)
            if found:
                met.update(found)
        for spaced in _SPACED.findall(low):
            if self.may_hit(spaced):
                met.update(self.hits(self.restorer.decode(spaced)))
        return self.lexicon.score_entries(met)


def train(
    docs: DataFrame, labels: DataFrame, model: LanguageModel, train_rows: int = TRAIN_ROWS, label: str = "toxic", id_col: str = "doc_id"
) -> Lexicon:
    """Learn the lexicon from labelled documents whose crc32(id) mod 4 is not 2.

    At most ``train_rows`` of those, by smallest hash of the id. Entries are
    counted by distinct texts of each label (partly in the tasks, then by
    aggregation; a text is toxic if once labelled so). Candidates are all whose
    toxic share is a half or more one standard error below its smoothed estimate,
    but for those that could not be chosen even first. From them
    entries are chosen one after another by how much they explain of the toxic
    documents that the earlier ones leave, so that words which only come along
    with a toxic one, as in copies of a document, are not taken for its cause.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (remainder(F.col(id_col), 4) != 2))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label).alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(train_rows)
    )
    rows = docs.select(F.col(id_col).alias("__id"), "text").join(F.broadcast(chosen), "__id").select("text", F.col("__label").cast("int").alias("label"))
    rows = Written(rows.where("text is not null").groupBy("text").agg(F.max("label").alias("label")))
    n_toxic = rows.df.where("label > 0").count()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            words = [sorted(restorer.words(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), batch.column(1)], names=["words", "label"])

    worded = Written(rows.df.mapInArrow(read, "words array<string>, label int"))  # each labelled text is restored once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for words, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen[int(toxic > 0)].update(entries(set(words)))
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in seen)], names=["entry", "clean", "bad"]
        )

    counted = worded.df.mapInArrow(run, "entry string, clean long, bad long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    n, p = F.col("clean") + F.col("bad"), (F.col("bad") + 0.5) / (F.col("clean") + F.col("bad") + 1.0)
    sure = p - F.sqrt(p * (1 - p) / n)
    kept = counted.where(F.col("bad") >= SUPPORT).withColumn("chance", F.least(F.lit(0.99), sure)).where(F.col("chance") >= 0.5)
    # gains only fall as entries are chosen: what is under the least gain at first is so to the end
    kept = kept.where(F.col("bad") * F.col("chance") - F.col("clean") >= least_gain(n_toxic) - 1e-6)
    kept = kept.select("entry", "clean", "chance").orderBy(F.desc("chance"), F.desc("bad"), "entry").toPandas()
    chance = dict(zip(kept["entry"], kept["chance"].astype(float), strict=True))
    names = spark.sparkContext.broadcast({e: i for i, e in enumerate(chance)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.value
        for batch in batches:
            met = [[at[e] for e in entries(set(words)) if e in at] for words in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.list_(pa.int32()))], names=["met"])

    toxic = worded.df.where("label > 0").mapInArrow(meet, "met array<int>").toArrow().column("met").combine_chunks()
    for done in (rows, worded):
        done.drop()
    picked = cover(toxic, np.array(list(chance.values())), kept["clean"].to_numpy(float))
    return Lexicon({e: c for i, (e, c) in enumerate(chance.items()) if i in picked})


def least_gain(documents: int) -> float:
    """What an entry must explain of so many toxic documents to be chosen."""
    return max(SUPPORT, SUPPORT_SHARE * documents) * 0.5


def cover(documents: list[list[int]] | pa.ListArray, chance: np.ndarray, clean: np.ndarray) -> set[int]:
    """Entries that explain the toxic documents, greedily; documents list the candidates they hold, each once.

    ``clean`` counts the clean documents with each candidate; each takes as much
    from its gain as a toxic document that nothing explains yet adds. Only the
    (document, entry) pairs are kept, and a choice touches its own documents.
    """
    documents = documents if isinstance(documents, (pa.ListArray, pa.ChunkedArray)) else pa.array(documents, pa.list_(pa.int32()))
    documents = documents.combine_chunks() if isinstance(documents, pa.ChunkedArray) else documents
    entry = documents.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    ends = np.append(0, np.cumsum(documents.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
    holder = np.repeat(np.arange(len(documents)), np.diff(ends))
    by_entry = np.argsort(entry, kind="stable")
    bounds = np.searchsorted(entry[by_entry], np.arange(len(chance) + 1))
    weight, held = np.ones(len(documents)), np.diff(bounds).astype(float)
    least = least_gain(len(documents))
    picked: set[int] = set()
    while len(picked) < len(chance):
        gain = held * chance - clean
        gain[list(picked)] = 0
        best = int(gain.argmax())
        if gain[best] < least:
            break
        picked.add(best)
        for row in holder[by_entry[bounds[best] : bounds[best + 1]]]:
            held[entry[ends[row] : ends[row + 1]]] -= weight[row] * (1 - EXPLAINED)
            weight[row] *= EXPLAINED
    return picked


def score(docs: DataFrame, model: LanguageModel, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD up); other columns pass through.

    Null and empty texts have no words and score 0. Nothing but the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, lexicon))

    def rows(batch: pa.RecordBatch, scorer: Scorer):
        found = list(map(scorer.score, texts(batch, text_col)))
        return [pa.array(found, pa.float64()), pa.array([int(f >= THRESHOLD) for f in found], pa.int32())]

    return with_columns(docs, [("score", T.DoubleType()), ("predicted", T.IntegerType())], rows, setup=lambda: Scorer(*shared.value))
