"""Byte-level BPE encoding and decoding of whole texts, long ones by overlapping chunks.

A text up to ``chunk_chars`` is encoded where it lies. A longer one is cut into chunks that overlap;
every chunk is pre-tokenised on its own, in parallel, from an arbitrary place. A match of the
splitting pattern depends on what follows its start alone, so where two neighbours have a boundary
at the same place, they agree from there on: they are stitched at the first such place of their
overlap. If they share none, a pre-token or white space covers the overlap; the two chunks then stay
together and are encoded as one piece. The pieces, which begin and end at true boundaries, are encoded in
parallel and put together in order. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import extended, query, returns_memory, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a chunk without its overlap, and of the overlap.
CHUNK_CHARS = 1 << 16
OVERLAP = 256
#: What decides on a match can lie this many characters beyond its end ('re, 've, 'll; white space: one).
LOOKAHEAD = 3
#: Characters handed to the encoder at once; the ids of a batch are built before the next.
BATCH_CHARS = 1 << 20


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def tokens(path: str) -> dict[int, bytes]:
    return {rank: piece for piece, rank in load_ranks(path).items()}


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def cut_chunks(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    """Chunks that start every ``chunk`` characters and reach ``overlap`` into the next."""
    for number, start in enumerate(range(0, max(1, len(text)), chunk)):
        yield number, text[start : start + chunk + overlap]


def overlap_bounds(text: str, chunk: int, overlap: int, pattern: str) -> tuple[list[int], list[int]]:
    """Boundaries in the overlaps with the chunk before and after, counted from the start of each overlap.

    Those after white space are left out: a piece that ends there would show the pattern the whole
    run of white space, where the text goes on with a character that the run's match looks at.
    """
    head, tail, trusted = [0], [], len(text) - LOOKAHEAD
    for match in splitter(pattern).finditer(text):
        end = match.end()
        if end > trusted:
            break
        if text[end - 1].isspace():
            continue
        if end < overlap:
            head.append(end)
        if end >= chunk:
            tail.append(end - chunk)
    return head, tail


def _ids(texts: list[str], code: tiktoken.Encoding) -> pa.Array:
    return pa.array([code.encode_ordinary(text) for text in texts], pa.list_(pa.int32()))


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in parts of a limited number of characters, with the texts (null: empty)."""
    texts: list[str] = []
    start = size = 0
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= BATCH_CHARS or i + 1 == batch.num_rows:
            yield batch.slice(start, i + 1 - start), texts
            texts, start, size = [], i + 1, 0


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """One row (key, ids array<int>) for each row of ``docs``.

    With ``decoded`` there is also a column bytes, as ``decode`` adds it; the ids of short texts are decoded
    by the worker that made them, so that a task needs one worker and not two.

    A null text counts as empty and has no ids; null and repeated keys are kept, a row for each;
    other columns are left out. ``path`` is the file of ranks on the driver and the workers.
    ``overlap`` must be more than the look-ahead of the pattern and less than ``chunk_chars``.
    """
    if not LOOKAHEAD < overlap < chunk_chars:
        raise ValueError("overlap must lie between the look-ahead and the size of a chunk")
    ranks = path or public_tokenizers.path(RANKS)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    @returns_memory
    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(ranks, pattern)
        token = tokens(ranks) if decoded else {}
        for batch in batches:
            for part, texts in _slices(batch, "text"):
                ids = _ids(texts, code)
                made = {"key": part.column("key"), "ids": ids} | ({"bytes": _bytes(ids, token)} if decoded else {})
                yield pa.RecordBatch.from_pydict(made)

    def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for i, value in enumerate(batch.column("text")):
                whole = value.as_py()
                digest = xxhash.xxh3_128_digest(whole.encode())
                for number, piece in cut_chunks(whole, chunk_chars, overlap):
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(i, 1), pa.array([digest], pa.binary()), pa.array([number], pa.int32()), pa.array([piece])],
                        ["key", "digest", "number", "text"],
                    )

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [overlap_bounds(t, chunk_chars, overlap, pattern) for t in batch.column("text").to_pylist()]
            bounds = [pa.array(side, pa.list_(pa.int32())) for side in zip(*ends, strict=True)] or [[], []]
            yield pa.RecordBatch.from_arrays([*batch.columns, *bounds], [*batch.schema.names, "head", "tail"])

    @returns_memory
    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(ranks, pattern)
        for batch in batches:
            for part, texts in _slices(batch, "piece"):
                kept = [part.column(name) for name in ("key", "digest", "copies", "first")]
                yield pa.RecordBatch.from_arrays([*kept, _ids(texts, code)], ["key", "digest", "copies", "first", "ids"])

    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = rows.where(~is_long).mapInArrow(encode_whole, f"key {key_type}, ids array<int>" + ", bytes binary" * decoded)
    chunks = (
        rows.where(is_long)
        .mapInArrow(chunks_of, f"key {key_type}, digest binary, number int, text string")
        # Repeated rows are encoded once. The shuffle also spreads the chunks of a long text.
        .groupBy("key", "digest", "number")
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
        .mapInArrow(
            pretokenise,
            f"key {key_type}, digest binary, number int, text string, copies long, head array<int>, tail array<int>",
        )
    )
    order = Window.partitionBy("key", "digest").orderBy("number")
    meeting = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    stitched = (
        # ``meet``: where in the overlap the chunk takes over from the one before; null: nowhere.
        chunks.withColumn("meet", F.when(F.col("number") == 0, 0).otherwise(meeting))
        .withColumn("next_meet", F.lead("meet").over(order))
        .withColumn("first", F.max(F.when(F.col("meet").isNotNull(), F.col("number"))).over(order))
        .withColumn("from", F.coalesce("meet", F.lit(0)))
        # Up to the place where the next one takes over, or to its start if it carries on.
        .withColumn("size", F.lit(chunk_chars) + F.coalesce("next_meet", F.lit(0)) - F.col("from"))
        .withColumn("part", F.expr("substring(text, `from` + 1, size)"))
    )
    pieces = (
        stitched.groupBy("key", "digest", "copies", "first")
        .agg(F.sort_array(F.collect_list(F.struct("number", "part"))).alias("parts"))
        .select("key", "digest", "copies", "first", F.array_join("parts.part", "").alias("piece"))
    )
    long = (
        pieces.mapInArrow(encode_pieces, f"key {key_type}, digest binary, copies long, first int, ids array<int>")
        .groupBy("key", "digest", "copies")
        .agg(F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("parts"))
        .select("key", F.flatten("parts.ids").alias("ids"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    long = long.drop("copy")
    return short.unionByName(decode(long, path=path) if decoded else long).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Adds ``bytes``, the bytes the ids stand for; null ids give null, an empty list empty bytes.

    A column ``bytes`` that is there already is replaced. An id without a token fails the job.
    """
    ranks = path or public_tokenizers.path(RANKS)
    encoded = encoded.drop("bytes")

    @returns_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens(ranks)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _bytes(batch.column(ids), token)], [*batch.schema.names, "bytes"])

    return encoded.mapInArrow(run, extended(encoded, "bytes binary"))


def _bytes(ids: pa.Array, token: dict[int, bytes]) -> pa.Array:
    found = token.__getitem__
    return pa.array([None if row is None else b"".join(map(found, row)) for row in _lists(ids)], pa.binary())


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    for row in column:
        yield None if not row.is_valid else row.values.to_numpy(zero_copy_only=False).tolist()


def described(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds n_tokens and the SHA-256 of the ids as text (decimal, by commas) and of the decoded bytes."""
    return _digested(decode(encoded, path=path))


def encoded_and_described(docs: DataFrame, **options) -> DataFrame:
    """``described`` of ``encode``."""
    return _digested(encode(docs, decoded=True, **options))


def _digested(decoded: DataFrame) -> DataFrame:
    return (
        decoded.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256))
        .withColumn("decoded_sha256", F.sha2(F.col("bytes"), 256))
        .drop("bytes")
    )


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, decoded, and described by digests."""
    return encoded_and_described(table(spark, sf_dir, "documents")).drop("ids")
