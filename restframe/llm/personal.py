"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts their score.

A kind of data has a pattern that proposes spans, a test that confirms them (the Luhn sum of a card,
the remainder by 97 of an account number, the parts of an address, the count of digits), a score a
confirmed span starts from, and words that raise the score where they stand near it. A span counts if
its score reaches the least of its kind. The four base kinds (email, ip, card, phone) are explicit in
themselves and always count; the others look like ordinary numbers, so most need a word beside them.

Every document is judged by itself in one pass without a shuffle. All patterns take time in
proportion to the text, whatever it holds: runs of one character class are read once, not again from
each of their characters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from restframe.llm.base import extended, query, table

Span = tuple[int, int]

#: Characters on either side of a span that are searched for context words.
NEAR = 48
#: What a context word adds to a score.
RAISE = 0.4
#: Rows taken out of Arrow at once.
ROWS = 256

# The patterns of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
GROUPED_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PLUS_NUMBER = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Patterns of the other kinds.
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SOCIAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_NUMBER = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[ /.-][0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9.-])")
_DIGIT = re.compile(r"[0-9]")
_WORDS = re.compile(r"[^\W\d_]+")


def emails(text: str) -> Iterator[Span]:
    """Leftmost addresses: a local part reaches back from its @ as far as its characters go.

    It cannot reach over the match before, nor over another @. So every character is looked at a
    bounded number of times, while a pattern that starts with the local part would try each start.
    """
    free = 0
    for found in DOMAIN.finditer(text):
        at = start = found.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            free = found.end()
            yield start, free


def matches(pattern: re.Pattern[str]) -> Callable[[str], Iterator[Span]]:
    def propose(text: str) -> Iterator[Span]:
        return (m.span() for m in pattern.finditer(text))

    return propose


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    """Every second digit from the right, doubled, as the sum of its own digits; divisible by ten."""
    plain, doubled = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, plain)) + sum(sum(divmod(2 * int(d), 10)) for d in doubled)) % 10 == 0


def mod_97(account: str) -> bool:
    """The first four characters at the end, letters as 10 to 35: the number leaves 1 when divided by 97."""
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def is_address(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    return len(text) <= 37 and 16 <= len(d := digits_of(text)) <= 19 and luhn(d)


def _is_short_card(text: str) -> bool:
    return len(text) <= 29 and 13 <= len(d := digits_of(text)) <= 15 and d[0] in "3456" and luhn(d)


def _is_social(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _counts_digits(least: int, most: int) -> Callable[[str], bool]:
    return lambda text: least <= sum("0" <= c <= "9" for c in text) <= most


@dataclass(frozen=True)
class Kind:
    """``near`` holds lower-case words; ``least`` is the score at which a confirmed span counts."""

    name: str
    propose: Callable[[str], Iterable[Span]]
    confirm: Callable[[str], bool]
    prior: float
    least: float = 0.0
    near: frozenset[str] = field(default_factory=frozenset)

    def score(self, text: str, start: int, end: int) -> float:
        around = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()
        return round(min(1.0, self.prior + RAISE * (not self.near.isdisjoint(_WORDS.findall(around)))), 3)


_CALL = frozenset("phone telephone tel call mobile cell fax telefon handy anruf mobil teléfono móvil llamar téléphone portable appeler".split())
_CARD = frozenset("card credit debit visa mastercard amex payment karte kreditkarte tarjeta carte".split())
_BANK = frozenset("iban account bank konto bankverbindung cuenta banco compte banque".split())
_SOCIAL = frozenset("ssn social security".split())
_HOST = frozenset("ip address host server login adresse dirección".split())
_MAIL = frozenset("mail email contact write kontakt correo courriel".split())

BASE = (
    Kind("email", emails, lambda text: True, 0.6, near=_MAIL),
    Kind("ip", matches(FOUR_PARTS), is_address, 0.5, near=_HOST),
    Kind("card", matches(GROUPED_DIGITS), _is_card, 0.6, near=_CARD),
    Kind("phone", matches(PLUS_NUMBER), _counts_digits(8, 15), 0.6, near=_CALL),
)
#: Added to the base kinds, in this order; a span that overlaps one before it gives way.
ADDED = (
    Kind("iban", matches(ACCOUNT), mod_97, 0.6, 0.6, _BANK),
    Kind("short_card", matches(GROUPED_DIGITS), _is_short_card, 0.3, 0.6, _CARD),
    Kind("ssn", matches(SOCIAL), _is_social, 0.3, 0.6, _SOCIAL),
    Kind("local_phone", matches(LOCAL_NUMBER), _counts_digits(7, 12), 0.2, 0.6, _CALL),
)


def find_spans(text: str, base: tuple[Kind, ...] = BASE, added: tuple[Kind, ...] = ADDED) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind and place, in characters, the end exclusive.

    A proposed span that is not confirmed is dropped and its characters are not tried again for that
    kind. Spans of the base kinds may overlap those of another kind.
    """
    has_digit = _DIGIT.search(text) is not None
    found = []
    for kind in base:
        if "@" in text if kind.propose is emails else has_digit:
            found += [
                (kind.name, a, b, kind.score(text, a, b)) for a, b in kind.propose(text) if kind.confirm(text[a:b])
            ]
    if not has_digit:
        return found
    for kind in added:
        taken = sorted((a, b) for _, a, b, _ in found)
        at = 0  # proposals come in order, so one walk over what is taken is enough
        for a, b in kind.propose(text):
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if (at == len(taken) or taken[at][0] >= b) and kind.confirm(text[a:b]):
                if (score := kind.score(text, a, b)) >= kind.least:
                    found.append((kind.name, a, b, score))
    return found


def masked_text(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Each span as its kind in brackets; spans that overlap become one, named after the first."""
    parts, at, end = [], 0, 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = end = max(end, b)
    return "".join(parts) + text[at:]


SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            yield rows, rows.column(column).to_pylist()


def with_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """Each row as it came, with the spans of its whole text in the column ``into``.

    A null or empty text has no spans. Rows are judged one by one: repeated rows get the same spans,
    a null key or other null columns change nothing, an empty table gives an empty one. A column that
    already has the name ``into`` gives way; if that is the text's own, the text gives way.
    """
    columns = [c for c in docs.columns if c != into]
    rows = docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in columns if c != text])
    schema = extended(rows, f"`{into}` {SPANS}")
    place = rows.columns.index(text)
    keep_text = into != text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, place):
            made = pa.array([[] if t is None else [_named(s) for s in find_spans(t)] for t in texts], _ARROW_SPANS)
            passed = list(zip(part.schema.names, part.columns, strict=True))[0 if keep_text else 1 :]
            yield pa.RecordBatch.from_arrays([c for _, c in passed] + [made], [n for n, _ in passed] + [into])

    if not keep_text:
        schema = StructType(schema.fields[1:])
    return rows.mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in [*columns, into]])


def _named(span: tuple[str, int, int, float]) -> dict[str, object]:
    return dict(zip(("kind", "start", "end", "score"), span, strict=True))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span of their text replaced by its kind, as ``[EMAIL]``; null stays null."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, place):
            made = [None if t is None else masked_text(t, find_spans(t)) for t in texts]
            yield part.set_column(place, part.schema.field(place), pa.array(made, part.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def of_kinds(spans: Column, *names: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*names))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of all documents."""
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    counts = [F.size(of_kinds(spans, k.name)).cast("long").alias(f"n_{k.name}") for k in BASE]
    base = of_kinds(spans, *[k.name for k in BASE])
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )
