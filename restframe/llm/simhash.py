"""Near-duplicates by SimHash: a byte-position inverted index with count filtering.

A fingerprint has 64 bits, eight positional bytes. Two fingerprints that differ in at most three bits
differ in at most three bytes, so they share at least five of their positional bytes. The postings of
the index are kept for triples of positional bytes: of five positions out of eight, three lie in the
same half, so the four triples of each half reach every such pair, through lists that are 65,536 times
shorter than those of single bytes. For the candidates of a list the shared positional bytes are
tallied, pairs below the guaranteed five are left out, and the others are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restframe.llm.base import extended, keep, query, table
from restframe.llm.links import bucket_links, components

MAX_BITS = 3
SHINGLE = 3
SEED = 42
BYTES = 8
#: Of this many positions any three differing bytes leave three equal in one half.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text, unsigned: A-Z lower-cased, words by ASCII white space, shingles with repeats.

    A bit is 1 if it is set in more than half of the shingles' XXH64 hashes. Fewer words than a
    shingle has: the whole sequence is one shingle. No words: 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    counts = np.zeros(64, np.int64)
    step = 1 << 15
    for i in range(0, n, step):
        made = [
            xxhash.xxh64_digest(joined[a:b], seed) for a, b in zip(starts[i : i + step], stops[i : i + step], strict=True)
        ]
        bits = np.unpackbits(np.frombuffer(b"".join(made), np.uint8).reshape(-1, BYTES), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str, shingle: int, column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made.view(np.int64))], [*batch.schema.names, column])

    return docs.mapInArrow(run, extended(docs, f"{column} long"))


class FewBits:
    """Fingerprints that share the guaranteed number of positional bytes and differ in few bits."""

    def __init__(self, max_bits: int) -> None:
        self.max_bits = max_bits

    def items(self, batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("id").to_numpy().view(np.uint64)

    def to_many(self, items: np.ndarray, one: int, many: np.ndarray) -> np.ndarray:
        differing = items[many] ^ items[one]
        tally = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        found = tally >= BYTES - self.max_bits
        found[found] = np.bitwise_count(differing[found]) <= self.max_bits
        return found


def postings(prints: DataFrame) -> DataFrame:
    """(bucket, id): each fingerprint in the list of each of its triples of positional bytes."""
    def byte(position: int):
        return F.shiftrightunsigned("id", 8 * (BYTES - 1 - position)).bitwiseAND(F.lit(255).cast("long"))

    lists = [
        F.lit(number << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c) for number, (a, b, c) in enumerate(TRIPLES)
    ]
    return prints.select(F.explode(F.array(*lists)).alias("bucket"), "id")


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, component) for the distinct fingerprints (id long) that have a partner within ``max_bits``."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the index guarantees partners within three bits")
    return components(bucket_links(postings(prints), FewBits(max_bits)))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row for each row of ``docs``: key, fingerprint (16 hex digits) and component_id, the
    smallest key reachable by links.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated keys each keep
    their row. A null key counts only where its component has no other (component_id null). Other
    columns are left out. An empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    marked = keep(with_fingerprints(rows, "text", shingle, "id").select("key", "id"), "fingerprints")
    prints = marked.groupBy("id").agg(F.min("key").alias("least"))
    linked = fingerprint_components(prints.select("id"), max_bits)
    known = prints.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(least, "component").select("id", "component_id")
    return marked.join(named, "id").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents without near-duplicates, with the columns they came with: of each component the
    row with the smallest key (null last), of rows with that key the first as stored.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    marked = with_fingerprints(rows.select("row", "key", "text"), "text", shingle, "id").drop("text")
    # Stored with a number for each row, so that one of several equal rows can be named.
    marked = keep(marked.withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    return first_of_components(marked, fingerprint_components(marked.select("id").distinct()))


def first_of_components(marked: DataFrame, linked: DataFrame) -> DataFrame:
    """Of stored rows (row, key, id, place) and components of ids, the first row of each component."""
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "place")
    prints = marked.groupBy("id").agg(F.min(order).alias("first"))
    chosen = (
        prints.join(linked, "id", "left")
        .groupBy(F.coalesce("component", "id").alias("component"))
        .agg(F.min("first").alias("first"))
        .select("first.place")
    )
    return marked.join(chosen, "place", "left_semi").select("row.*")


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components at three bits or fewer."""
    return near_duplicates(table(spark, sf_dir, "documents"))
