"""LM scoring by a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model predicts the class of the next token from the classes of the two before it: the context's
vectors, each through the matrix of its position, add up to a prediction, whose product with a
class's vector, plus a bias, is the class's score. The most frequent tokens are classes of their own;
other words form classes by their ending. A word's probability is that of its class times its share
of the class, so the probabilities of all known words and one unknown word for each ending add up
to one. Training is data-parallel: every task goes through all tokens of its documents from the same
start, and the parameters are averaged by number of tokens, once for each round. Scores are
normalised exactly: the logarithm of a context's sum over all classes comes from batched matrix
products over the contexts that occur.

Counts cover every training token. Only a bounded number of frequent words and the parameters are
sent to the executors; counts of all other words are joined in Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, release_memory, table

#: Words with their counts on every executor, and the least count of such a word.
FREQUENT, LEAST_COUNT = 200_000, 5
#: Classes in all; those of frequent and of rare words by ending take twice ``ENDINGS`` of them.
CLASSES = 512
ENDINGS = 54
DIM = 32
NOISE = 64
BATCH = 8192
ROUNDS = 2
RATE = 0.1
SEED = 7
#: Different words counted in a task before they are handed on; characters of texts split at once.
COUNTED = 500_000
CHARS = 1 << 21
#: Codes of tokens read at once.
CODES = 1 << 20
#: Tokens of a step whose noise is scored at once, so that the scores stay in the processor's cache.
SCORED = 1024


def tokens_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, words by ASCII white space, then the end."""
    return [*(text or "").encode().lower().split(), b""]


def ending(word: bytes) -> int:
    """The last letter a-z before punctuation, or none of them; and whether punctuation follows."""
    bare = word.rstrip(b".,;:!?")
    last = bare[-1] - 97 if bare and 97 <= bare[-1] <= 122 else 26
    return last * 2 + (len(bare) < len(word))


def batches_of(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """The tokens of the texts, of a limited number of characters at once."""
    held: list[list[bytes]] = []
    size = 0
    for value in column:
        text = value.as_py()
        held.append(tokens_of(text))
        size += len(text or "")
        if size >= CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, c): how often every token occurs; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for texts in batches_of(batch.column("text")):
                for tokens in texts:
                    counts.update(tokens)
                if len(counts) > COUNTED:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"]
    )


@dataclass
class Vocabulary:
    """Frequent words in descending order of count, and the counts of the classes of the others."""

    words: list[bytes]
    counts: np.ndarray
    rare_counts: np.ndarray
    classes: int = CLASSES

    def __post_init__(self) -> None:
        self.single = min(len(self.words), self.classes - 2 * ENDINGS)
        self.place = {word: i for i, word in enumerate(self.words)}
        shape = np.array([ending(w) for w in self.words[self.single :]], np.int64)
        self.word_class = np.concatenate([np.arange(self.single), self.single + shape]).astype(np.int64)
        self.first_rare = self.single + ENDINGS
        self.size = self.single + 2 * ENDINGS
        total = np.bincount(self.word_class, weights=self.counts, minlength=self.size).astype(np.float64)
        self.share = np.log10(self.counts / total[self.word_class]) if len(self.words) else np.zeros(0)
        total[self.first_rare :] += self.rare_counts
        #: Smoothed, so that no class is impossible.
        self.class_share = (total + 1) / (total.sum() + self.size)
        self.end = int(self.classes_of(self.codes([b""]))[0])

    def codes(self, tokens: list[bytes]) -> np.ndarray:
        """The place of a frequent word; of a rare one, below zero, its ending."""
        get = self.place.get
        found = [get(token) for token in tokens]
        return np.array([-1 - ending(t) if c is None else c for t, c in zip(tokens, found, strict=True)], np.int32)

    def classes_of(self, codes: np.ndarray) -> np.ndarray:
        known = codes >= 0
        out = self.first_rare - 1 - codes.astype(np.int64)
        out[known] = self.word_class[codes[known]]
        return out

    def contexts(self, classes: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The classes one and two before each token; before a document there are ends."""
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        one = np.concatenate([[self.end], classes[:-1]])
        one[starts] = self.end
        two = np.concatenate([[self.end], one[:-1]])
        two[starts] = self.end
        return one, two


class LogBilinear:
    """Parameters: context vectors, class vectors, a matrix for each position, biases."""

    def __init__(self, vocabulary: Vocabulary, dim: int = DIM, seed: int = SEED) -> None:
        rng, size = np.random.default_rng(seed), vocabulary.size
        self.parameters = [
            (rng.standard_normal((size, dim)) * 0.1).astype(np.float32),
            (rng.standard_normal((size, dim)) * 0.1).astype(np.float32),
            np.stack([np.eye(dim), np.eye(dim) / 2]).astype(np.float32),
            np.log(vocabulary.class_share).astype(np.float32),
        ]
        self.noise = vocabulary.class_share
        self.steps: list[np.ndarray] | None = None
        self.norms: np.ndarray | None = None

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for i, p in enumerate(self.parameters):
            self.parameters[i] = flat[at : at + p.size].astype(np.float32).reshape(p.shape)
            at += p.size
        return self

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """All context vectors through the matrix of each position: there are far fewer classes than tokens."""
        given, _, positions, _ = self.parameters
        return given @ positions[0], given @ positions[1]

    def train(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator) -> None:
        """One step of noise-contrastive estimation; the noise is drawn once for the whole batch."""
        given, classes, positions, bias = self.parameters
        if self.steps is None:
            self.steps = [np.full_like(p, 1e-3) for p in self.parameters]
        noise = rng.choice(len(self.noise), NOISE, p=self.noise)
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        near, far = self.moved()
        context = near.take(one, axis=0)
        context += far.take(two, axis=0)
        d_context = classes.take(target, axis=0)
        real = np.einsum("ij,ij->i", context, d_context) + (bias - log_noise)[target]
        # Gradients of the log-likelihood of telling the data from the noise.
        d_real = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        false, shift = classes[noise], bias[noise] - log_noise[noise]
        away = np.ascontiguousarray(-false.T)
        d_false = np.empty((len(target), NOISE), np.float32)
        for i in range(0, len(target), SCORED):
            part = d_false[i : i + SCORED]
            np.matmul(context[i : i + SCORED], away, out=part)
            part -= shift
            np.clip(part, -30, 30, out=part)
            np.exp(part, out=part)
            part += 1
            np.divide(-1, part, out=part)
        d_context *= d_real[:, None]
        d_context += d_false @ false
        scale = np.float32(1 / len(target))
        d_noise = d_false.T @ context
        context *= d_real[:, None]
        d_classes = _scattered(target, context, len(bias))
        np.add.at(d_classes, noise, d_noise)
        d_bias = np.bincount(target, weights=d_real, minlength=len(bias)).astype(np.float32)
        np.add.at(d_bias, noise, d_false.sum(axis=0))
        # Tokens with the same context class are added up before the matrices, which are linear.
        by_one, by_two = _scattered(one, d_context, len(bias)), _scattered(two, d_context, len(bias))
        d_given = by_one @ positions[0].T + by_two @ positions[1].T
        d_positions = np.stack([given.T @ by_one, given.T @ by_two])
        for p, s, g in zip(self.parameters, self.steps, (d_given, d_classes, d_positions, d_bias), strict=True):
            g *= scale
            s += g * g
            p += np.float32(RATE) * g / np.sqrt(s)

    def log10(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The normalised log10 probability of each class after its context."""
        _, classes, _, bias = self.parameters
        size = len(bias)
        near, far = self.moved()
        if self.norms is None:
            self.norms = np.full((size, size), np.nan)
        # All contexts with the same class two before at once, so that a norm depends on the parameters alone.
        for i in np.flatnonzero(np.bincount(two, minlength=size)):
            if np.isnan(self.norms[i, 0]):
                scores = ((near + far[i]) @ classes.T + bias).astype(np.float64)
                top = scores.max(axis=1)
                self.norms[i] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        score = bias[target]
        for i in range(0, len(target), BATCH):
            at = slice(i, i + BATCH)
            predicted = near.take(one[at], axis=0)
            predicted += far.take(two[at], axis=0)
            score[at] += np.einsum("ij,ij->i", predicted, classes.take(target[at], axis=0))
        return (score - self.norms[two, one]) / np.log(10)


def _scattered(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows that go to the same place."""
    # Numbers of 16 bits are sorted by counting.
    places = places.astype(np.uint16) if size <= 1 << 16 else places
    order = np.argsort(places, kind="stable")
    sorted_places = places[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_places[1:] != sorted_places[:-1]]))
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[sorted_places[starts]] = np.add.reduceat(rows.take(order, axis=0), starts)
    return out


def coded_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, list[int]]]:
    """The codes of a limited number of tokens at once, and how many of them belong to each row."""
    held: list[bytes] = []
    size = 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1])
        if size >= 4 * CODES:
            yield np.frombuffer(b"".join(held), np.int32), [len(row) // 4 for row in held]
            held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.int32), [len(row) // 4 for row in held]


def train_round(coded: DataFrame, vocabulary: Vocabulary, start: np.ndarray, number: int) -> np.ndarray:
    """The parameters after all tasks went through their rows (codes) from the same start, averaged."""
    sent = coded.sparkSession.sparkContext.broadcast((vocabulary, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        words, first = sent.value
        model, rng, seen = LogBilinear(words).load(first), np.random.default_rng([SEED, number]), 0
        for batch in batches:
            for codes, lengths in coded_groups(batch.column("codes")):
                classes = words.classes_of(codes)
                one, two = words.contexts(classes, lengths)
                order = rng.permutation(len(codes))
                for i in range(0, len(codes), BATCH):
                    part = order[i : i + BATCH]
                    model.train(classes[part], one[part], two[part], rng)
                seen += len(codes)
        if seen:
            yield _weighed(model.flat().astype(np.float64) * seen, seen)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(start)), 0
        for batch in batches:
            for sums, n in zip(batch.column("sums"), batch.column("n"), strict=True):
                total += np.frombuffer(sums.as_py())
                seen += n.as_py()
        if seen:
            yield _weighed(total, seen)

    shape = "sums binary, n long"
    parts = coded.select("codes").mapInArrow(run, shape).withColumn("task", F.spark_partition_id())
    # Two levels, so that no task adds up the parameters of all others.
    places = max(1, int(int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    parts = parts.repartition(places, "task").mapInArrow(add, shape)
    summed = parts.coalesce(1).mapInArrow(add, shape).collect()
    return np.frombuffer(summed[0].sums) / summed[0].n if summed else start


def _weighed(sums: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["sums", "n"])


def is_held_out(key: Column) -> Column:
    """A seventh of the keys, by CRC-32; a row without a key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % 7 == 2


def score_texts(docs: DataFrame, is_training: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score.

    The rows that fulfil ``is_training`` are learned from, all are scored. A null text is empty: its
    one token is the end. base_score is that of add-one smoothed frequencies, score that of the
    model; both are sums of log10 probabilities over the tokens. Without training rows nothing is
    known, all classes are alike and base_score is 0. Other columns are left out.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.coalesce(is_training, F.lit(False)).alias("learn")
    )
    training = rows.where("learn")
    counts = keep(token_counts(training), "token-counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    frequent = counts.where(F.col("c") >= LEAST_COUNT).orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    words, often = frequent["word"].to_pylist(), frequent["c"].to_numpy()
    is_frequent = F.col("c") >= LEAST_COUNT
    if len(words) == FREQUENT:
        least, last = F.lit(int(often[-1])), F.lit(words[-1])
        is_frequent = (F.col("c") > least) | ((F.col("c") == least) & (F.col("word") <= last))
    rare = keep(counts.where(~is_frequent).mapInArrow(_with_ending, "word binary, c long, ending int"), "rare-words")
    shares = _rare_shares(rare)
    vocabulary = Vocabulary(words, often.astype(np.float64), shares["n"])
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = rows.schema["key"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            start = 0
            for texts in batches_of(batch.column("text")):
                yield _coded(batch.slice(start, len(texts)), texts, sent.value)
                start += len(texts)

    # Each text becomes codes once; training and scoring read these. Every row is stored with a
    # number, to which the sums over its rare words come back.
    coded = keep(
        rows.mapInArrow(
            code,
            f"key {kind}, learn boolean, n_tokens long, codes binary, "
            "rare array<struct<word:binary,n:long,ending:int>>",
        ).withColumn("place", F.monotonically_increasing_id()),
        "codes",
    )
    flat = LogBilinear(vocabulary).flat()
    for number in range(rounds if whole.n else 0):
        flat = train_round(coded.where("learn"), vocabulary, flat, number)
    # The norms it has found stay with it for the later tasks of a worker (eight bytes for each context).
    trained = docs.sparkSession.sparkContext.broadcast(LogBilinear(vocabulary).load(flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        model = trained.value
        for batch in batches:
            start = 0
            for codes, lengths in coded_groups(batch.column("codes")):
                own = batch.slice(start, len(lengths)).select(["key", "place", "n_tokens"])
                yield _scored(own, codes, lengths, sent.value, model)
                start += len(lengths)

    scored = coded.select("key", "place", "n_tokens", "codes").mapInArrow(
        run, f"key {kind}, place long, n_tokens long, frequent long, log_counts double, log_model double"
    )
    found = (
        coded.select("place", F.explode("rare").alias("token"))
        .select("place", "token.word", "token.n", F.col("token.ending").alias("shape"))
        .join(rare.select("word", "c"), "word", "left")
    )

    def value(name: str) -> Column:
        return F.element_at(F.array(*[F.lit(float(x)) for x in shares[name]]), F.col("shape") + 1)

    log_share = F.when(F.col("c").isNull(), value("log_unknown")).otherwise(
        F.log10(F.col("c") - value("discount")) - value("log_n")
    )
    sums = found.groupBy("place").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("rare_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_counts"),
        F.sum(F.col("n") * log_share).alias("rare_model"),
    )
    nothing = F.lit(0.0)
    all_log = float(np.log10(whole.n + whole.v + 1))
    return scored.join(sums, "place", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("frequent") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(whole.n).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("rare_counts", nothing) - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("log_model") + F.coalesce("rare_model", nothing)).alias("score"),
    )


def _with_ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes = pa.array([ending(word) for word in batch.column("word").to_pylist()], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, shapes], ["word", "c", "ending"])


def _rare_shares(rare: DataFrame) -> dict[str, np.ndarray]:
    """For each ending: tokens of its rare words, and how their probability is shared (absolute discounting).

    A known word's share is (c - discount) / n; what the discounts leave is the unknown word's.
    """
    groups = rare.groupBy("ending").agg(
        F.sum("c").alias("n"), F.count("*").alias("types"), F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).collect()
    n, types, discount = np.zeros(ENDINGS), np.zeros(ENDINGS), np.full(ENDINGS, 0.5)
    for g in groups:
        n[g.ending], types[g.ending] = g.n, g.types
        discount[g.ending] = min(0.95, max(0.05, g.once / max(1, g.once + 2 * g.twice)))
    some = n > 0
    unknown = np.where(some, discount * types / np.maximum(n, 1), 1.0)
    return {"n": n, "discount": discount, "log_n": np.log10(np.maximum(n, 1)), "log_unknown": np.log10(unknown)}


def _coded(rows: pa.RecordBatch, texts: list[list[bytes]], words: Vocabulary) -> pa.RecordBatch:
    tokens, ends = [t for text in texts for t in text], np.cumsum([len(text) for text in texts])
    codes = words.codes(tokens)
    starts = ends - [len(text) for text in texts]
    missing = np.flatnonzero(codes < 0)
    rare: list[list[dict]] = []
    for a, b in zip(np.searchsorted(missing, starts), np.searchsorted(missing, ends), strict=True):
        counted = Counter(tokens[i] for i in missing[a:b].tolist())
        rare.append([{"word": w, "n": n, "ending": ending(w)} for w, n in counted.items()])
    struct = pa.struct([("word", pa.binary()), ("n", pa.int64()), ("ending", pa.int32())])
    return pa.RecordBatch.from_arrays(
        [
            rows.column("key"),
            rows.column("learn"),
            pa.array(ends - starts, pa.int64()),
            pa.array([codes[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            pa.array(rare, pa.list_(struct)),
        ],
        ["key", "learn", "n_tokens", "codes", "rare"],
    )


def _scored(
    rows: pa.RecordBatch, codes: np.ndarray, lengths: list[int], words: Vocabulary, model: LogBilinear
) -> pa.RecordBatch:
    classes, known = words.classes_of(codes), codes >= 0
    log_model = model.log10(classes, *words.contexts(classes, lengths))
    log_model[known] += words.share[codes[known]]
    log_counts = np.zeros(len(codes))
    log_counts[known] = np.log10(words.counts + 1)[codes[known]]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])  # every row has a token
    sums = [np.add.reduceat(values, starts) for values in (known.astype(np.int64), log_counts, log_model)]
    return pa.RecordBatch.from_arrays(
        [*rows.columns, *map(pa.array, sums)], [*rows.schema.names, "frequent", "log_counts", "log_model"]
    )


@query("op7_log_bilinear")
def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, ~is_held_out(F.col("doc_id")))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
