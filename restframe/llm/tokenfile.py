"""Token ids as Parquet list columns, in key order, for selective reads of ids or of metadata.

A token file is a folder of Parquet files. A row is a document: its key, ``n_tokens`` and ``ids``.
The rows are in ascending order of the key over all files (null last), so the minima and maxima that
Parquet keeps for each row group and page let a reader skip to the keys it wants, and the narrow
columns can be read without touching the ids. Size of row groups, size and rows of pages, and the
encoding of the ids (dictionary or delta) are options of the writer. The place of a document in the
whole sequence of ids, ``start``, is a running sum over the metadata, taken in two levels: sums of
the files, then rows within a file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from restframe.llm.base import query, table
from restframe.session import new_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Remembered encodings of a worker.
MEMORY = 800_000
#: Texts encoded at once.
ROWS = 256
#: Fixed value: the white space of Unicode. Runs without it, each with one space before it, never
#: share a pre-token of a byte-level pre-tokeniser, so they are encoded one by one and remembered.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: White space other than spaces and line feeds, and two of these in a row.
OTHER = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
DOUBLE = ("  ", "\n\n", " \n", "\n ")


def is_plain(text: str) -> bool:
    """Whether a text is words with single spaces and line feeds between them."""
    ends = text[:1] + text[-1:]
    return bool(ends) and not any(c in " \n" for c in ends) and not any(d in text for d in DOUBLE) and not OTHER.search(text)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """As the library loads it: strings of added tokens in a text are these tokens."""
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[str, ...]:
    return tuple(token.content for token in tokenizer(path).get_added_tokens_decoder().values() if token.content)


@lru_cache(maxsize=4)
def _memory(path: str, kind: str) -> dict[str, bytes]:
    return {}


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id stands for: a byte-level vocabulary spells a byte as one character."""
    spelled = tokenizer(path).get_vocab()
    sizes = np.zeros(max(spelled.values()) + 1, np.int64)
    sizes[list(spelled.values())] = [len(token) for token in spelled]
    return sizes


def encode_units(units: list[str], path: str) -> list[bytes]:
    """The ids of each unit as bytes of 32-bit integers.

    Words behind a space or a line feed are encoded in one text, other words behind a line feed that
    is put there, which never shares a pre-token with what follows. Where the ids of a unit end is
    told by the bytes they stand for.
    """
    code = tokenizer(path)
    plain = [unit for unit in units if not unit[-1].isspace()]
    pieces = [piece for unit in plain for piece in ((unit,) if unit[0] in " \n" else ("\n", unit))]
    made: dict[str, bytes] = {}
    if pieces:
        ids = np.array(code.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.cumsum(_token_bytes(path)[ids])
        stops = np.searchsorted(ends, np.cumsum([len(piece.encode()) for piece in pieces])) + 1
        starts = np.concatenate([[0], stops[:-1]])
        flat = ids.tobytes()
        made = {p: flat[4 * a : 4 * b] for p, a, b in zip(pieces, starts.tolist(), stops.tolist(), strict=True)}
    rest = [unit for unit in units if unit[-1].isspace()]
    for unit, found in zip(rest, code.encode_batch_fast(rest, add_special_tokens=False), strict=True):
        made[unit] = np.array(found.ids, np.int32).tobytes()
    return [made[unit] for unit in units]


def _looked_up(units: list[str], known: dict[str, bytes], path: str, spelled: Callable[[str], str]) -> list[bytes]:
    """The ids of each unit, from memory or made now from the text that ``spelled`` gives for it.

    What comes first is mostly what is frequent, so a full memory stays as it is, unless the texts
    have changed so much that a quarter of their units is missing.
    """
    found = list(map(known.get, units))
    missing = [i for i, ids in enumerate(found) if ids is None]
    if missing:
        new = list({units[i] for i in missing})
        made = dict(zip(new, encode_units(list(map(spelled, new)), path), strict=True))
        for i in missing:
            found[i] = made[units[i]]
        if len(known) + len(made) > MEMORY and 4 * len(missing) > len(units):
            known.clear()
        if len(known) + len(made) <= MEMORY:
            known.update(made)
    return found


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text as bytes of 32-bit integers; units that were met before are looked up.

    Nearly all texts are words behind single spaces and line feeds, which need no pattern to be cut:
    their units are words without the space, or with the line feed. The first word is given a line
    feed, whose id is taken off again. Texts that hold the string of an added token go to the tokenizer
    as a whole, as an added token may take in what stands beside it. All other texts are cut by ``UNIT``.
    """
    out: list[bytes] = [b""] * len(texts)
    added = added_tokens(path)
    # Units are encoded side by side, where an added token with a space in it could come about.
    cut = not any(c.isspace() for token in added for c in token)
    whole = [i for i, text in enumerate(texts) if not cut or any(token in text for token in added)]
    for i, found in zip(whole, tokenizer(path).encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
        out[i] = np.array(found.ids, np.int32).tobytes()
    rest = sorted(set(range(len(texts))) - set(whole))
    odd = [i for i in rest if not is_plain(texts[i])]
    usual = sorted(set(rest) - set(odd))
    split = [f"\n{texts[i]}".replace("\n", " \n").split(" ")[1:] for i in usual]
    words = list(chain.from_iterable(split))
    found = _looked_up(words, _memory(path, "words"), path, lambda word: word if word[0] == "\n" else f" {word}")
    end = 0
    for i, row in zip(usual, split, strict=True):
        start, end = end, end + len(row)
        out[i] = b"".join(found[start:end])[4:]
    split = [UNIT.findall(texts[i]) for i in odd]
    found = _looked_up(list(chain.from_iterable(split)), _memory(path, "units"), path, lambda unit: unit)
    end = 0
    for i, row in zip(odd, split, strict=True):
        start, end = end, end + len(row)
        out[i] = b"".join(found[start:end])
    return out


def _encode(path: str, end_id: int):
    end = np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [ids + end for ids in encode_texts([t or "" for t in part.column("text").to_pylist()], path)]
                counts = np.array([len(row) // 4 for row in rows])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(counts), ids], ["key", "n_tokens", "ids"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    encoding: str = "dictionary",
    files: int | None = None,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 1000,
) -> None:
    """Encode every text (null: empty), append ``end_id``, and write the rows in ascending key order.

    Repeated and null keys are kept, null last; rows of one key are in order of their text. Other
    columns are left out, whatever their names. An empty table makes a readable folder without rows.
    ``encoding`` is ``dictionary``, or ``delta`` for differences of neighbouring ids.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"no such encoding: {encoding}")
    where = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    number = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key").asc_nulls_last(), F.col("text").asc_nulls_first()]
    # The texts are ordered before they are encoded: they are shuffled once, and encoded once.
    ordered = rows.repartitionByRange(number, order[0]).sortWithinPartitions(*order)
    kind = rows.schema["key"].dataType.simpleString()
    (
        ordered.mapInArrow(_encode(where, end_id), f"key {kind}, n_tokens long, ids array<int>")
        .select("key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"), "n_tokens", "ids")
        .write.option("parquet.writer.version", "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """key, start and n_tokens of every document; the ids are not read."""
    rows = spark.read.parquet(path).select("key", "part", "place", "n_tokens")
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select(F.col("part"), F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_start"))
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return inside.join(parts, "part").select(
        "key", "place", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens"
    )


def read_tokens(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """key, place, n_tokens and ids; from ``low`` to ``high`` only, by the statistics of row groups and pages."""
    rows = spark.read.parquet(path).select("key", "place", "n_tokens", "ids")
    if low is not None:
        rows = rows.where(F.col("key") >= F.lit(low))
    return rows if high is None else rows.where(F.col("key") <= F.lit(high))


def crc32_of_ids(tokens: DataFrame) -> DataFrame:
    """key, place, n_tokens, and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("ids")
            sums = [zlib.crc32(row.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("key", "place", "n_tokens")), pa.array(np.array(sums, "int64"))],
                ["key", "place", "n_tokens", "ids_crc32"],
            )

    kind = tokens.schema["key"].dataType.simpleString()
    return tokens.mapInArrow(run, f"key {kind}, place long, n_tokens long, ids_crc32 long")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text written as a token file and described from what is read back."""
    path = new_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    # Start from the metadata, the sum from the ids; the place of a row is unique in a token file.
    starts = read_metadata(spark, path).select("place", "start")
    return (
        crc32_of_ids(read_tokens(spark, path))
        .join(starts, "place")
        .select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")
    )
