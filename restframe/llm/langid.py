"""Language ID by bit-sliced Bloom filters of character n-grams.

An n-gram belongs to a language if it is frequent enough in the language's texts, and not much rarer
than in the language where it is most frequent. The Bloom filters of all languages lie side by side:
a position holds one bit for each language, so the positions of an n-gram, ANDed, name all languages
that contain it. A text is decided by a popcount for each language over its n-grams, less the false
positives that the filter's density leads to expect. Learning counts the n-grams of all texts in
Spark; the filter's size is bounded by the least frequency, whatever the size of the corpus.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, count, islice
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import extended, keep, query, returns_memory, table

#: Lengths of n-grams; words are padded on both sides.
ORDERS = (2, 3, 4)
#: Least share of a language's n-grams, and least ratio to the share where it is largest. With the
#: first, a language has at most 1 / LEAST_SHARE n-grams, which bounds the filter.
LEAST_SHARE = 1e-5
LEAST_RATIO = 0.25
#: Positions of the filter for each n-gram, rounded up to a power of two, and positions of one n-gram.
POSITIONS_PER_GRAM = 8
HASHES = 4
#: Languages in one word of a position.
PLANE = 62
UNKNOWN = "und"
#: Different words remembered in a task while counting, and in a worker while predicting.
WORDS = 500_000
#: Longer words are not remembered; their n-grams are made and counted in parts of ``PART`` starting places.
LONG_WORD = 256
PART = 1 << 16
#: Different n-grams of a language with long words held while counting, and characters of texts counted at once.
HELD_GRAMS = 2_000_000
HELD_CHARS = 64 << 20
#: Different n-grams whose languages a worker remembers, and words whose n-grams are numbered at once.
GRAMS = 200_000
NUMBERED_WORDS = 4096
#: Rows taken out of Arrow at once.
ROWS = 1024
#: Characters of the texts that are split into words at once.
PREDICT_CHARS = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
_SEED = 42  # that of Spark's xxhash64, so that the filter can be built there


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str) -> list[str]:
    """The n-grams of a word; none if no character of it is a letter."""
    if not word.isalpha() and not any(map(str.isalpha, word)):
        return []
    padded = f"_{word}_"
    made, runs = [], list(padded)
    for n in range(2, max(ORDERS) + 1):
        runs = list(map(add, runs, padded[n - 1 :]))
        if n in ORDERS:
            made += runs
    return made


def numbering() -> defaultdict[str, int]:
    """Gives every different n-gram asked for the next number."""
    return defaultdict(count().__next__)


def numbered(index: defaultdict[str, int], grams: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all n-grams, one after the other, and how many each list has; new ones get the next numbers."""
    sizes: list[int] = []

    def made() -> Iterator[list[str]]:
        for own in grams:
            sizes.append(len(own))
            yield own

    at = np.fromiter(map(index.__getitem__, chain.from_iterable(made())), np.int64)
    return at, np.array(sizes, np.int64)


def gram_parts(word: str) -> Iterator[list[str]]:
    """The n-grams of a word of any length, each once, a limited number at a time."""
    padded = f"_{word}_"
    for a in range(0, len(padded), PART):
        piece = padded[a : a + PART + max(ORDERS) - 1]
        yield [piece[i : i + n] for n in ORDERS for i in range(min(PART, len(piece) - n + 1))]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""

    @returns_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter[str]] = {}
        chars = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                whole = text.as_py()
                words.setdefault(lang.as_py(), Counter()).update(words_of(whole))
                chars += len(whole)
                if chars > HELD_CHARS or sum(map(len, words.values())) > WORDS:
                    yield from _summed(words)
                    words, chars = {}, 0
        yield from _summed(words)

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(words: dict[str, Counter[str]]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the n-grams of the words, a limited number of different ones at once."""
    for lang, counter in words.items():
        index, totals = numbering(), np.zeros(0, np.int64)
        short = [word for word in counter if len(word) <= LONG_WORD]
        for at in range(0, len(short), NUMBERED_WORDS):
            part = short[at : at + NUMBERED_WORDS]
            index, totals = _added(index, totals, map(grams_of, part), [counter[w] for w in part])
        for word in counter if len(short) < len(counter) else ():
            for grams in gram_parts(word) if len(word) > LONG_WORD else ():
                index, totals = _added(index, totals, [grams], [counter[word]])
                if len(index) > HELD_GRAMS:
                    yield _counts(lang, index, totals)
                    index, totals = numbering(), np.zeros(0, np.int64)
        yield _counts(lang, index, totals)


def _added(
    index: defaultdict[str, int], totals: np.ndarray, grams: Iterable[list[str]], times: list[int]
) -> tuple[defaultdict[str, int], np.ndarray]:
    """The totals by number, after each list of n-grams has occurred so many times."""
    at, sizes = numbered(index, grams)
    more = np.zeros(max(len(index), 1), np.int64)
    more[: len(totals)] = totals
    np.add.at(more, at, np.repeat(np.array(times, np.int64), sizes))
    return index, more


def _counts(lang: str, index: dict[str, int], totals: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(index), pa.string()), pa.array(list(index), pa.string()), pa.array(totals[: len(index)], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


@dataclass
class LanguageFilter:
    """``planes`` has a row for each position and a column for every ``PLANE`` languages."""

    langs: list[str]
    planes: np.ndarray
    false_positive: np.ndarray = field(init=False)
    memory: dict[str, int] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        bits = [(self.planes[:, i // PLANE] >> np.int64(i % PLANE)) & 1 for i in range(len(self.langs))]
        self.false_positive = np.array([b.mean() for b in bits]) ** HASHES
        self._forget()
        self._forget_grams()

    def _forget_grams(self) -> None:
        self.index, self.known = numbering(), np.zeros((0, self.planes.shape[1]), np.int64)

    def _known_masks(self, grams: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """``masks`` of all n-grams, one after the other, each different one looked up once; how many each list has."""
        at, sizes = numbered(self.index, grams)
        if len(self.index) > len(self.known):
            new = list(islice(self.index, len(self.known), None))
            self.known = np.concatenate([self.known, self.masks(new)])
        masks = self.known[at]
        if len(self.index) > GRAMS:
            self._forget_grams()
        return masks, sizes

    def _forget(self) -> None:
        self.memory, self.rows = {}, np.zeros((1024, len(self.langs) + 1), np.int64)

    def masks(self, grams: list[str]) -> np.ndarray:
        """For each n-gram the bitmask of all languages that contain it."""
        hashed = np.array([xxhash.xxh64_intdigest(g.encode(), _SEED) for g in grams], np.uint64)
        low, high = hashed & np.uint64(0xFFFFFFFF), (hashed >> np.uint64(32)) | np.uint64(1)
        out = np.full((len(grams), self.planes.shape[1]), -1, np.int64)
        for i in range(HASHES):
            out &= self.planes[((low + np.uint64(i) * high) % np.uint64(len(self.planes))).astype(np.int64)]
        return out

    def _remember(self, words: list[str]) -> None:
        """How many n-grams of each word every language contains, and how many there are."""
        masks, counts = self._known_masks(map(grams_of, words))
        rows = np.zeros((len(words), len(self.langs) + 1), np.int64)
        rows[:, -1] = counts
        some = np.flatnonzero(counts)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
            for i in range(len(self.langs)):
                rows[some, i] = np.add.reduceat((masks[:, i // PLANE] >> np.int64(i % PLANE)) & 1, starts)
        first = len(self.memory)
        self.memory.update(zip(words, range(first, first + len(words)), strict=True))
        while first + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[first : first + len(words)] = rows

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text and its share of the n-grams, without those expected by chance."""
        split = [words_of(text or "") for text in texts]
        every = set().union(*split)
        new = every.difference(self.memory)
        if len(self.memory) + len(new) > WORDS:
            self._forget()
            new = every
        # Long words are never remembered, so they are among the new ones.
        long = {word for word in new if len(word) > LONG_WORD}
        self._remember(list(new - long))
        more: list[list[str]] = [[]] * len(split)
        if long:
            more = [[word for word in words if word in long] for words in split]
            split = [[word for word in words if word not in long] for words in split]
        lengths = np.array([len(words) for words in split], np.int64)
        at = np.fromiter(map(self.memory.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        totals = np.zeros((len(split), len(self.langs) + 1), np.int64)
        some = np.flatnonzero(lengths)
        if len(some):
            totals[some] = np.add.reduceat(self.rows[at], (np.cumsum(lengths) - lengths)[some])
        return [self._decide(*row) for row in zip(totals, more, strict=True)]

    def _counted(self, word: str) -> np.ndarray:
        """How many n-grams of a long word every language contains, and how many there are."""
        row = np.zeros(len(self.langs) + 1, np.int64)
        for grams in gram_parts(word):
            masks = self.masks(grams)
            row[:-1] += [int(((masks[:, i // PLANE] >> np.int64(i % PLANE)) & 1).sum()) for i in range(len(self.langs))]
            row[-1] += len(grams)
        return row

    def _decide(self, total: np.ndarray, long: list[str]) -> tuple[str, float]:
        for word in long:
            total = total + self._counted(word)
        n = total[-1]
        if not n or not self.langs:
            return UNKNOWN, 0.0
        real = (total[:-1] - n * self.false_positive) / np.maximum(1 - self.false_positive, 1e-9) / n
        best = int(real.argmax())
        return self.langs[best], float(min(1.0, max(0.0, real[best])))


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang",
    least_share: float = LEAST_SHARE, least_ratio: float = LEAST_RATIO,
) -> LanguageFilter:
    """The filter of all languages of ``labelled``; rows without text or language say nothing.

    Every text counts in full. What comes to the driver is the filter: its positions that are set.
    """
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = keep(gram_counts(rows.where("lang is not null and text is not null")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    numbered = totals.withColumn("number", F.row_number().over(Window.orderBy("lang")) - 1)
    langs = [r.lang for r in numbered.orderBy("number").select("lang").collect()]
    shares = counts.join(numbered, "lang").withColumn("share", F.col("n") / F.col("total"))
    top = F.max("share").over(Window.partitionBy("gram"))
    chosen = keep(
        shares.where(F.col("share") >= least_share)
        .withColumn("top", top)
        .where(F.col("share") >= F.lit(least_ratio) * F.col("top"))
        .select("gram", "number"),
        "language-grams",
    )
    size = 1 << max(10, (POSITIONS_PER_GRAM * chosen.select("gram").distinct().count() - 1).bit_length())
    hashed = chosen.withColumn("h", F.xxhash64("gram"))
    low = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    high = F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1).cast("long"))
    places = F.array(*[F.pmod(low + F.lit(i).cast("long") * high, F.lit(size).cast("long")) for i in range(HASHES)])
    bit = F.expr(f"shiftleft(1L, cast(number % {PLANE} as int))")
    found = (
        hashed.select(F.explode(places).alias("position"), F.floor(F.col("number") / PLANE).alias("plane"), bit.alias("bit"))
        .groupBy("position", "plane")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    planes = np.zeros((size, max(1, -(-len(langs) // PLANE))), np.int64)
    planes[found["position"].to_numpy(), found["plane"].to_numpy()] = found["bits"].to_numpy()
    return LanguageFilter(langs, planes)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """Adds lang_pred and score, from the text alone; columns of these names are replaced.

    ``und`` and 0 where the text is null or has no letter, or nothing was learned. Else the language
    with the largest corrected popcount (ties: the first by name) and that as a share of the n-grams.
    """
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.planes))

    @returns_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = LanguageFilter(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made, texts, start, size = [], part.column(text).to_pylist(), 0, 0
                for i, whole in enumerate(texts):
                    size += len(whole or "")
                    if size >= PREDICT_CHARS or i + 1 == len(texts):
                        made += filters.predict(texts[start : i + 1])
                        start, size = i + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                    [*part.schema.names, "lang_pred", "score"],
                )

    return docs.mapInArrow(run, extended(docs, "lang_pred string, score double"))


def is_held_out(key: Column) -> Column:
    """A quarter of the keys, by CRC-32; a row without a key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % 4 == 2


#: A document stays if at least this share of its n-grams belongs to the language found.
LEAST_SCORE = 0.3


def keep_identified(docs: DataFrame, key: str = "doc_id", least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is known, with the columns they came with.

    Those without a letter go, and those of whose n-grams less than ``least_score`` belong to the
    best language. The filter is learned from the rows that are not held out.
    """
    model = learn(docs.where(~is_held_out(F.col(f"`{key}`"))))
    # Under names of their own, so that no column is replaced and the text goes to the workers once.
    names = docs.columns
    text = next(f"c{i}" for i, name in enumerate(names) if name.lower() == "text")
    found = identify(docs.toDF(*[f"c{i}" for i in range(len(names))]), model, text)
    found = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return found.drop("lang_pred", "score").toDF(*names)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = is_held_out(F.col("doc_id"))
    model = learn(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
