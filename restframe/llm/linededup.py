"""Fuzzy line dedup by MinHash: signatures of character shingles, banding, exact Jaccard, union-find.

Lines are compared without case and with white space made single. Every different line of a batch of
documents gets a signature; lines whose signatures agree in a band are candidates, which are verified
by the exact Jaccard similarity of their shingle sets. Connected components of verified links are
found by Spark, and of each component, and of equal lines, the first occurrence stays.

A signature comes from one hash function with ``BINS`` bins that keep their least value
(one-permutation MinHash); an empty bin takes the value of another one, drawn by hash until one is
found that is not empty (optimal densification), so that short lines are not alike in neighbouring bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, release_memory, returns_memory, table
from restframe.llm.links import bucket_links, components
from restframe.operators.skew import salted_join

#: Characters of a shingle. One changed character breaks as many shingles, so that with five a line of 49
#: characters keeps a similarity of 0.8; unrelated lines are left to the bands and the exact comparison.
SHINGLE = 5
#: Similarity as a ratio of integers, so that the comparison is exact.
SIMILAR = (4, 5)
BINS, ROWS = 108, 6
#: 18 bands of 6 rows find a pair at similarity 0.8 with probability 0.996, at 0.9 with 0.999999, and one at 0.3
#: with 0.01 (16 bands of 5 rows: 0.04), so that few unrelated lines are compared.
BANDS = BINS // ROWS
#: Characters for which hashes are held at once.
SEGMENT = 1 << 20
#: Of them, those in work at once: their numbers stay in the processor's cache.
PIECE = 1 << 16
#: Candidates of one bucket compared in one piece of work.
BLOCK = 256
#: Ids of candidate lines that may be sent to all executors (a few dozen MB); above, they are joined by a shuffle.
SENT_IDS = 1_000_000
#: Shingles of the lines of a block that are held (8 bytes each) before they are made anew.
HELD_SHINGLES = 4_000_000
#: Lines remembered in a task, so that a common one is not written again and again.
SEEN = 200_000
#: Pairs of a band and a line that a cell holds on average, bounds of the bits that name a cell, parts of
#: 4,096 lines a task holds before it sends them, and pairs of one cell held in memory.
CELL_PAIRS = 1 << 15
MIN_CELL_BITS, MAX_CELL_BITS = 6, 24
SENT_PARTS = 8
HELD_PAIRS = 1 << 20
EMPTY = np.uint32(2**32 - 1)
#: Draws of another bin; a bin still empty then takes the first that is not.
DRAWS = 64


def normal(line: str) -> str:
    return " ".join(line.lower().split())


#: White space other than blanks and line feeds, as ``str.split`` has it.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def normal_lines(text: str) -> list[str]:
    """``normal`` of each line of a text; lines that are so already are not taken apart."""
    lower = text.lower()
    lines = lower.split("\n")
    if any(map(lower.__contains__, _OTHER_SPACE)):
        return [" ".join(line.split()) for line in lines]
    if "  " in lower or lower[:1] == " " or lower[-1:] == " " or " \n" in lower or "\n " in lower:
        return [" ".join(line.split()) if "  " in line or line[:1] == " " or line[-1:] == " " else line for line in lines]
    return lines


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalising mix of 64-bit values (multipliers of a well-known public one)."""
    x = x ^ (x >> np.uint64(33))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x *= np.uint64(factor)
        x ^= x >> np.uint64(33)
    return x


def _windows(codes: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of every run of ``size`` characters."""
    out = codes[: len(codes) - size + 1].copy()
    for i in range(1, size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[i : len(codes) - size + 1 + i]
    return out


def signatures(lines: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """A row of BINS values for each line; lines must have a shingle at least."""
    made = np.full((len(lines) + 1) * BINS, EMPTY)
    nowhere = len(lines) * BINS
    step = PIECE - shingle + 1
    parts = [(i, line[a : a + PIECE]) for i, line in enumerate(lines) for a in range(0, len(line) - shingle + 1, step)]
    at = 0
    while at < len(parts):
        upto, size = at, 0
        while upto < len(parts) and size < PIECE:
            size += len(parts[upto][1]) + 1
            upto += 1
        codes = np.frombuffer("\n".join(t for _, t in parts[at:upto]).encode("utf-32-le"), "<u4").astype(np.uint64)
        lengths = np.array([len(t) for _, t in parts[at:upto]])
        # The runs that reach into the next line, shingle of them after each line, go to a row behind the last one.
        own = np.repeat(np.array([i for i, _ in parts[at:upto]], np.int64) * BINS, lengths + 1)[: len(codes) - shingle + 1]
        ends = np.cumsum(lengths + 1)[:-1]
        for back in range(1, shingle + 1):
            own[ends - back] = nowhere
        x = _mixed(_windows(codes, shingle))
        least = x.astype(np.uint32)
        x >>= np.uint64(32)
        x *= np.uint64(BINS)
        x >>= np.uint64(32)
        own += x.view(np.int64)
        np.minimum.at(made, own, least)
        at = upto
    return _filled(made[:nowhere].reshape(-1, BINS))


#: The bin that each draw names for each bin.
_DRAWN = (
    _mixed(np.arange(BINS, dtype=np.uint64) * np.uint64(DRAWS) + np.arange(1, DRAWS + 1, dtype=np.uint64)[:, None]) % np.uint64(BINS)
).astype(np.int64)


def _filled(made: np.ndarray) -> np.ndarray:
    """Empty bins take the value of the bin drawn for them first that is not empty, alike in all lines."""
    flat = made.ravel()
    at = np.flatnonzero(flat == EMPTY)
    values = flat.copy()
    place = at % BINS
    for t in range(DRAWS):
        if not len(at):
            break
        lent = flat[at - place + _DRAWN[t][place]]
        values[at] = lent
        left = lent == EMPTY
        at, place = at[left], place[left]
    values[at] = made[at // BINS, (made[at // BINS] != EMPTY).argmax(axis=1)]
    return values.reshape(made.shape)


def band_keys(made: np.ndarray) -> np.ndarray:
    """One 64-bit key for each line and band."""
    rows = made.reshape(len(made), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for r in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return keys


def _line_id(line: str) -> int:
    made = xxhash.xxh3_64_intdigest(line.encode())
    return made - (1 << 64) if made >> 63 else made


class SimilarLines:
    """Lines whose sets of character shingles have the wanted Jaccard similarity."""

    def __init__(self, shingle: int, similar: tuple[int, int]) -> None:
        self.shingle, self.similar = shingle, similar

    def items(self, batch: pa.RecordBatch) -> ShingleSets:
        return ShingleSets(batch.column("line").to_pylist(), self.shingle)

    def to_many(self, items: ShingleSets, one: int, many: np.ndarray) -> np.ndarray:
        least, most = self.similar
        both, mine, its = items.shared(one, many)
        return both * most >= least * (mine + its - both)

    def weights(self, batch: pa.RecordBatch) -> np.ndarray:
        """The size of each item, for pieces of work of a limited size."""
        return np.asarray(pc.utf8_length(batch.column("line")).to_numpy(zero_copy_only=False), np.int64)

    def linked_pairs(self, batch: pa.RecordBatch) -> LinkedPairs | None:
        """Decides many pairs of a batch at once; None where its shingles are too many different numbers."""
        sets = joint_sets(batch.column("line").to_pylist(), self.shingle)
        return None if sets is None else LinkedPairs(*sets, self.similar)


class LinkedPairs:
    """``keys`` are line * span + shingle, sorted and different; ``starts`` is where each line's begin."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, span: int, similar: tuple[int, int]) -> None:
        self.keys, self.starts, self.span, self.similar = keys, starts, span, similar
        self.sizes = np.diff(starts)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        least, most = self.similar
        small = np.where(self.sizes[left] <= self.sizes[right], left, right)
        large = left + right - small
        out = np.zeros(len(left), bool)
        # Sets of too different sizes cannot be similar.
        open_ = np.flatnonzero(self.sizes[small] * most >= self.sizes[large] * least)
        for at in _pieces(self.sizes[small[open_]], PIECE):
            pairs = open_[at]
            a, b = small[pairs], large[pairs]
            counts = self.sizes[a]
            ends = np.cumsum(counts)
            own = np.arange(ends[-1]) - np.repeat(ends - counts - self.starts[a], counts)
            wanted = self.keys[own] + np.repeat((b - a) * self.span, counts)
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            both = np.add.reduceat((self.keys[place] == wanted).astype(np.int64), ends - counts)
            out[pairs] = both * most >= least * (counts + self.sizes[b] - both)
        return out


def _pieces(sizes: np.ndarray, most: int) -> list[slice]:
    """Slices of neighbours whose sizes add up to about ``most``."""
    if not len(sizes):
        return []
    turns = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), len(sizes)]
    return [slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False)]


def joint_sets(lines: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """The shingle sets of all lines as one sorted array, see ``LinkedPairs``.

    A shingle is a number to the base of the different characters, exact; ``None`` if that with the
    line's number does not fit 64 bits.
    """
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    present = np.zeros(int(codes.max()) + 1, bool)
    present[codes] = True
    base = int(present.sum())
    span = base**shingle
    if span * (len(lines) + 1) >= 2**63:
        return None
    digits = (np.cumsum(present) - 1)[codes]
    values = digits[: len(digits) - shingle + 1].copy()
    for k in range(1, shingle):
        values *= base
        values += digits[k : len(digits) - shingle + 1 + k]
    lengths = np.array([len(line) for line in lines])
    ends = np.cumsum(lengths)
    inside = np.ones(len(values), bool)
    for back in range(1, shingle):  # shingles that reach into the next line
        inside[ends[:-1] - back] = False
    counts = lengths - shingle + 1
    keys = np.sort(values[inside] + np.repeat(np.arange(len(lines), dtype=np.int64) * span, counts))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys, np.searchsorted(keys, np.arange(len(lines) + 1, dtype=np.int64) * span), span


class ShingleSets:
    """The sets of shingles of some lines, as exact numbers.

    A shingle is a number to the base of the different characters these lines have. Where that does
    not fit 64 bits, shingles are numbered as they come.
    """

    def __init__(self, lines: list[str], shingle: int) -> None:
        self.lines, self.shingle = lines, shingle
        alphabet = np.array(sorted(map(ord, set().union(*lines))), np.int64)
        self.base = max(2, len(alphabet))
        self.exact = self.base**shingle < 2**63
        if self.exact:
            self.digit = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
            self.digit[alphabet] = np.arange(len(alphabet))
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.sets: dict[int, np.ndarray] = {}
        self.held = 0

    def _of(self, i: int) -> np.ndarray:
        made = self.sets.get(i)
        if made is None:
            line, n = self.lines[i], self.shingle
            if self.exact:
                digits = self.digit[np.frombuffer(line.encode("utf-32-le"), "<u4")]
                values = digits[: len(digits) - n + 1]
                for k in range(1, n):
                    values = values * self.base + digits[k : len(digits) - n + 1 + k]
                made = np.unique(values)
            else:
                numbers = self.numbers
                made = np.array(sorted({numbers.setdefault(line[a : a + n], len(numbers)) for a in range(len(line) - n + 1)}), np.int64)
            self.sets[i] = made
            self.held += len(made)
        return made

    def shared(self, one: int, many: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
        """(shared shingles with each of many, size of one's set, sizes of theirs)."""
        if self.held > HELD_SHINGLES:
            self._forget()
        mine, its = self._of(one), [self._of(int(i)) for i in many]
        sizes = np.array([len(x) for x in its])
        every = np.concatenate(its)
        found = mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])  # no line is without a shingle
        return np.add.reduceat(found.astype(np.int64), starts), len(mine), sizes


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, ident (a hash of the text) and text: rows equal in the first two are copies of one document."""
    whole = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(whole).alias("ident"), whole.alias("text"))


def _line_table(rows: DataFrame, shingle: int) -> DataFrame:
    """One pass over the texts, kept: rows of documents (key, ident, n_lines, places, ids) and rows of
    lines (line_id, line), each line that has a shingle at least once."""

    @returns_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            start = 0
            for split in _groups(batch.column("text")):
                places = [[n for n, line in enumerate(lines) if line] for lines in split]
                ids = [[_line_id(line) for line in lines if line] for lines in split]
                texts = {i: line for own, lines in zip(ids, split, strict=True)
                         for i, line in zip(own, filter(None, lines), strict=True)
                         if len(line) >= shingle and i not in seen}
                if len(seen) > SEEN:
                    seen = set()
                seen |= texts.keys()
                documents = {
                    "key": batch.column("key").slice(start, len(split)),
                    "ident": batch.column("ident").slice(start, len(split)),
                    "n_lines": pa.array([len(lines) for lines in split], pa.int32()),
                    "places": pa.array(places, pa.list_(pa.int32())),
                    "ids": pa.array(ids, pa.list_(pa.int64())),
                }
                lines = {
                    "line_id": pa.array(list(texts), pa.int64()),
                    "line": pa.array(list(texts.values()), pa.string()),
                }
                start += len(split)
                for mine, others in ((documents, lines), (lines, documents)):
                    size = len(next(iter(mine.values())))
                    blank = {name: pa.nulls(size, column.type) for name, column in others.items()}
                    row = mine | blank
                    yield pa.RecordBatch.from_pydict({name: row[name] for name in [*documents, *lines]})

    kind = rows.schema["key"].dataType.simpleString()
    return keep(
        rows.mapInArrow(
            run,
            f"key {kind}, ident long, n_lines int, places array<int>, ids array<long>, "
            "line_id long, line string",
        ),
        "lines",
    )


#: The bytes that such white space begins with in UTF-8, above the control characters, and its first two bytes.
_ODD_LEADS = sorted({c.encode()[0] for c in _OTHER_SPACE if not c.isascii()})
_ODD_PAIRS = np.zeros(1 << 16, bool)
for _c in map(str.encode, _OTHER_SPACE):
    _ODD_PAIRS[int.from_bytes(_c[:2], "big") if _c[1:] else slice(_c[0] << 8, _c[0] + 1 << 8)] = True


def not_normal(column: pa.Array) -> np.ndarray:
    """Marks the texts with white space that ``normal`` changes, and some others; case aside, the rest is normal."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    marks = np.zeros(len(column), bool)
    filled = np.flatnonzero(np.diff(bounds))
    if not len(filled):
        return marks
    codes = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    blank, feed = codes == 32, codes == 10
    marks[filled] = blank[bounds[filled]] | blank[bounds[filled + 1] - 1]
    odd = (codes < 32) & ~feed
    for lead in _ODD_LEADS:
        odd |= codes == lead
    at = np.flatnonzero(odd)
    at = at[_ODD_PAIRS[codes[at].astype(np.int64) << 8 | codes[np.minimum(at + 1, len(codes) - 1)]]]
    gap = blank | feed
    beside = np.flatnonzero(gap[:-1] & gap[1:] & (blank[:-1] | blank[1:]))
    marks[np.searchsorted(bounds, np.concatenate([at, beside]), side="right") - 1] = True
    return marks


def _groups(column: pa.Array) -> Iterator[list[list[str]]]:
    """The normal lines of the texts, of a limited number of characters at once."""
    held: list[list[str]] = []
    size = 0
    for start in range(0, len(column), 64):
        some = column.slice(start, 64)
        for text, odd in zip(some.to_pylist(), not_normal(some).tolist(), strict=True):
            held.append(normal_lines(text or "") if odd else (text or "").lower().split("\n"))
            size += len(text or "")
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def _candidates(lines: DataFrame, shingle: int) -> DataFrame:
    """(bucket, id): lines that agree in a band; bands with the same lines make one bucket.

    Signatures are made here, so that they are shuffled and not stored as well. Nearly all bands are
    those of one line only, so they travel packed: the first bits of a band's key name its cell, and a
    task sends what it has for a cell as one row. The number of cells follows the number of lines, so a
    cell holds about ``CELL_PAIRS`` pairs whatever the size of the corpus.
    """
    pairs = lines.count() * BANDS
    bits = max(MIN_CELL_BITS, min(MAX_CELL_BITS, (pairs // CELL_PAIRS).bit_length()))

    @returns_memory
    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = band_keys(signatures(part.column("line").to_pylist(), shingle))
                held.append((keys.ravel(), np.repeat(part.column("line_id").to_numpy(), BANDS)))
                if len(held) >= SENT_PARTS:
                    yield packed(held, bits)
                    held = []
        if held:
            yield packed(held, bits)

    spread = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        lines.select("line_id", "line")
        .mapInArrow(banded, "cell int, pairs binary")
        .repartition(spread, "cell")
        .sortWithinPartitions("cell")
        .mapInArrow(sharing, "bucket long, id long")
        .distinct()
    )


#: What is left of a band's key in its cell, and the line.
PAIR = np.dtype([("band", "<u4"), ("id", "<i8")])


def packed(held: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """(cell, pairs): the pairs (band, id) of each cell, as bytes."""
    keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
    cells = (keys >> np.uint64(64 - bits)).astype(np.int32)
    order = np.argsort(cells.astype(np.uint16) if bits <= 16 else cells, kind="stable")  # numbers of 16 bits are sorted by their digits
    made = np.empty(len(keys), PAIR)
    made["band"], made["id"] = ((keys << np.uint64(bits)) >> np.uint64(32))[order], ids[order]
    cells = cells[order]
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    offsets = np.append(starts, len(cells)).astype(np.int64) * PAIR.itemsize
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(made.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(cells[starts]), rows.cast(pa.binary())], ["cell", "pairs"])


@returns_memory
def sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (cell, pairs), sorted by cell: the lines of bands with two or more, under a hash of the set of lines.

    Equal sets get equal names, so a group of lines that agree in many bands is one bucket. A cell with
    more than ``HELD_PAIRS`` pairs goes through in pieces, under its bands' own keys: what is held is one
    piece and one line for each different band, not the lines of a band, however many it has.
    """
    cell, held, size, known = None, [], 0, None
    for batch in batches:
        for this, pairs in zip(batch.column("cell").to_pylist(), batch.column("pairs"), strict=True):
            if this != cell:
                if held:
                    yield _shared(cell, held, known)[0]
                cell, held, size, known = this, [], 0, None
            part = np.frombuffer(pairs.as_buffer(), PAIR)
            held.append(part)
            size += len(part)
            if size > HELD_PAIRS:
                made, known = _shared(cell, held, known if known is not None else np.empty(0, PAIR))
                yield made
                held, size = [], 0
    if held:
        yield _shared(cell, held, known)[0]


def _shared(cell: int, held: list[np.ndarray], known: np.ndarray | None) -> tuple[pa.RecordBatch, np.ndarray | None]:
    """The buckets of some pairs of a cell. ``known``: one pair of each band that was there before, if there are more pieces."""
    pairs = np.concatenate([*held, known] if known is not None else held)
    # Band and place as one number: sorted several times as fast as places by their bands.
    order = (pairs["band"].astype(np.uint64) << np.uint64(32)) | np.arange(len(pairs), dtype=np.uint64)
    order.sort()
    band, place = order >> np.uint64(32), (order & np.uint64(2**32 - 1)).astype(np.int64)
    first = np.concatenate([[True], band[1:] != band[:-1]])
    if known is not None:
        known = pairs[place[first]]
    pairs = pairs[place[~(first & np.append(first[1:], True))]]
    pairs = pairs[np.lexsort((pairs["id"], pairs["band"]))]
    if len(pairs):
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs["band"][1:] != pairs["band"][:-1]) | (pairs["id"][1:] != pairs["id"][:-1])
        pairs = pairs[new]
    band, ids = pairs["band"].astype(np.uint64), np.ascontiguousarray(pairs["id"])
    if len(band):
        starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
        counts = np.diff([*starts, len(band)])
        if known is None:
            names = _mixed(np.add.reduceat(_mixed(ids.view(np.uint64)), starts))
        else:
            names = _mixed((np.uint64(cell) << np.uint64(32)) | band[starts])
        use = np.repeat(counts > 1, counts)
        band, ids = np.repeat(names, counts)[use], ids[use]
    return pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), pa.array(ids)], ["bucket", "id"]), known


def line_components(lines: DataFrame, shingle: int, similar: tuple[int, int]) -> DataFrame:
    """(id, component) for different lines that have a similar one; lines: (line_id, line)."""
    members = keep(_candidates(lines, shingle), "line-buckets")
    wanted = keep(members.select("id").distinct(), "line-wanted")
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    texts = lines.select(F.col("line_id").alias("id"), "line").join(wanted, "id", "left_semi")
    texts = keep(texts.groupBy("id").agg(F.first("line").alias("line")), "line-texts")
    return components(bucket_links(members, SimilarLines(shingle, similar), texts, BLOCK, at_once=True))


def removed_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """One row for each row of ``docs``: key, ident, copy, n_lines, n_filled (lines that are not blank) and
    removed (positions from 0, ascending).

    Lines are the parts of a text between line feeds. Lines that are blank are no duplicates; lines
    shorter than a shingle are duplicates only of equal ones. Of equal or linked lines the first
    stays, by key (null last), then by a hash of the text, then by position. A null text is empty.
    Rows with equal key and text are copies of one document: from the second copy on, every line
    that is not blank is removed. An empty table gives an empty one.
    """
    rows = _rows(docs, key, text)

    made = _line_table(rows, shingle)
    found = made.where("n_lines is not null").select("key", "ident", "n_lines", "places", "ids")
    numbered = found.withColumn("copy", F.row_number().over(Window.partitionBy("key", "ident").orderBy("n_lines")))
    copies = keep(numbered, "line-places")
    lines = (
        copies.where("copy = 1")
        .select("key", "ident", F.explode(F.arrays_zip("places", "ids")).alias("line"))
        .select("key", "ident", F.col("line.places").alias("place"), F.col("line.ids").alias("id"))
    )
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "ident", "place")
    linked = line_components(made.where("line_id is not null"), shingle, similar)
    # Only lines that occur twice or have a similar one matter from here on.
    known = lines.groupBy("id").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    known = keep(known.join(linked, "id", "left").where("n > 1 or component is not null"), "line-firsts")
    similar_ones = known.where("component is not null")
    best = similar_ones.groupBy("component").agg(F.min("first").alias("best"))
    again = known.where("component is null").select("id", F.col("first").alias("best"))
    again = again.unionByName(similar_ones.join(best, "component").select("id", "best"))
    # A line that a large share of the documents has is one id; its rows are spread.
    gone = (
        salted_join(lines, again, ["id"], counts=known)
        .where(order != F.col("best"))
        .groupBy(F.col("key").alias("k"), F.col("ident").alias("i"))
        .agg(F.sort_array(F.collect_list("place")).alias("gone"))
    )
    none = F.array().cast("array<int>")
    return copies.join(gone, F.col("key").eqNullSafe(F.col("k")) & (F.col("ident") == F.col("i")), "left").select(
        "key",
        "ident",
        "copy",
        "n_lines",
        F.size("places").alias("n_filled"),
        F.when(F.col("copy") > 1, F.col("places")).otherwise(F.coalesce("gone", none)).alias("removed"),
    )


def without_lines(text: str | None, removed: list[int] | np.ndarray | None) -> str | None:
    if text is None or removed is None or not len(removed):
        return text
    out = set(map(int, removed))
    return "\n".join(line for n, line in enumerate(text.split("\n")) if n not in out)


def deduplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with repeated lines taken out of their texts, with the columns they came with.

    A document that loses lines and has nothing but blank lines left goes; one that had none to
    begin with (null, empty, blank) stays as it is. Which lines go: see ``removed_lines``.
    """
    marks = removed_lines(docs, key, text, **options).where("copy = 1")
    whole = F.col(f"`{text}`")
    # Plain equality of these three, so that one exchange of the texts serves the window and the join.
    same = ["no_key", "some_key", "ident"]

    def matched(key: Column) -> list[Column]:
        return [key.isNull().alias("no_key"), F.coalesce(key.cast("string"), F.lit("")).alias("some_key")]

    marks = marks.select(*matched(F.col("key")), "ident", "n_filled", "removed").where(
        (F.size("removed") > 0) | (F.col("n_filled") > 0)
    )
    rows = docs.select(*matched(F.col(f"`{key}`")), F.xxhash64(whole).alias("ident"), F.struct("*").alias("row"))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        release_memory()
        for texts, removed in batches:
            yield pd.Series([without_lines(*pair) for pair in zip(texts, removed, strict=True)], dtype=object)
        texts = removed = None
        release_memory()

    # Lines that are not blank go from the first copy as marked, from the others all.
    n_gone = F.coalesce(F.when(F.col("copy") > 1, F.col("n_filled")).otherwise(F.size("removed")), F.lit(0))
    kept = rows.join(marks, same, "left").withColumn("n_gone", n_gone).where("n_gone = 0 or n_gone < n_filled")
    text_left = F.when(F.col("n_gone") > 0, cut(F.col(f"row.`{text}`"), "removed")).otherwise(F.col(f"row.`{text}`"))
    return kept.select(F.col("row").withField(f"`{text}`", text_left).alias("row")).select("row.*")


@query("op3_fuzzy_lines")
def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents: which ones go. Positions count from 0."""
    found = removed_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_lines", F.size("removed").alias("n_removed"), "removed")
