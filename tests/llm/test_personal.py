"""Personal data against the patterns as they are written down, tried from every start."""

import hashlib
import random
import re

import pytest

from restframe.llm import personal

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in p.finditer(text or "") if passes(k, m.group())]


def base_of(spans):
    return [s[:3] for s in spans if s[0] in BASE]


def with_check_digit(digits):
    return next(digits + c for c in "0123456789" if personal.luhn(digits + c))


CASES = [
    "write to a.b+c@mail-1.example.com. or @b.c@d.ef, a@b.c_d@e.f a@b a@@b.c ä@b.cd",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3 1.2.3 1.2.3. 9.9.9.9é",
    f"card {with_check_digit('411111111111111')} {with_check_digit('4111111111111112')[:4]} 4111 1111 1111 1111 4111-1111--1111",
    "+1 (017) 555-7713 ++49 30 1234567. +1 2 +12345678901234567 +1(((((((9 + 4 +3 .",
    "\U0001f600 x@y.zz \U0001f600 +44 20 7946 0958 日本語 8.8.8.8",
    "", " ", "1", "@", "+", "٣.٣.٣.٣",
]


@pytest.mark.parametrize("text", CASES)
def test_base_kinds_of_written_cases(text):
    assert base_of(personal.find_spans(text)) == brute(text)


def test_base_kinds_of_random_texts():
    rng = random.Random(5)
    for alphabet in ("1.2 -", "a@.b1", "+1 ()-.", "a1@.+- 4é", "0123456789 -", "25.0"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert base_of(personal.find_spans(text)) == brute(text), text


def test_time_in_proportion_to_the_text():
    n = 300_000
    for text in ("a" * n, "a" * n + "@", "@" * n, "1" * n, "1 " * (n // 2), "1." * (n // 2), "+" * n, "+1" + " " * n, "a@a" * (n // 3),
                 "A1" * (n // 2), "GB11" + "A" * n, "(1" * (n // 2), "1-" * (n // 2)):
        personal.find_spans(text)


def test_checksums():
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.mod_97("GB82 WEST 1234 5698 7654 32") and personal.mod_97("DE89370400440532013000")
    assert not personal.mod_97("GB82WEST12345698765433")


def kinds(text):
    return [(s[0], text[s[1] : s[2]]) for s in personal.find_spans(text)]


def test_added_kinds_and_context():
    assert kinds("Konto DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("DE89 3704 0044 0532 0130 01") == []
    amex = with_check_digit("37828224631000")
    assert kinds(f"credit card: {amex}") == [("short_card", amex)] and kinds(f"order {amex}") == []
    assert kinds("her SSN is 536-22-8726") == [("ssn", "536-22-8726")] and kinds("part 536-22-8726") == []
    assert kinds("call 030 123 4567 now") == [("local_phone", "030 123 4567")] and kinds("030 123 4567") == []
    # A word farther away than NEAR characters does not count, nor one inside a longer word.
    assert kinds("call" + " x" * personal.NEAR + " 030 123 4567") == [] and kinds("recalling 030 123 4567") == []
    # The base span stays, what overlaps it gives way.
    assert kinds("call +1 (017) 555-7713") == [("phone", "+1 (017) 555-7713")]
    near, far = (personal.find_spans(t)[0][3] for t in ("visa 4111111111111111", "4111111111111111"))
    assert near > far


ROWS = [
    (1, "mail a@b.cd, host 1.2.3.4", "x", "en"), (1, "mail a@b.cd, host 1.2.3.4", "x", "en"), (2, None, None, None),
    (None, "+1 (017) 555-7713", "y", None), (3, "", "z", "en"), (4, "x y " * 800_000 + " q@r.st", "w", "de"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string")


def test_rows_keep_their_columns(spark):
    got = personal.with_spans(frame(spark, ROWS)).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "kind", "spans"}
    have = sorted((str(r.doc_id), r.kind or "", str(r.text), [(s.kind, s.start, s.end) for s in r.spans]) for r in got)
    assert have == sorted((str(k), kind or "", str(t), brute(t)) for k, t, _, kind in ROWS)
    into = personal.with_spans(frame(spark, ROWS), into="found")
    assert into.columns == ["doc_id", "text", "spans", "kind", "found"] and into.count() == len(ROWS)
    assert personal.with_spans(frame(spark, ROWS), into="text").columns == ["doc_id", "spans", "kind", "text"]
    assert personal.with_spans(frame(spark, [])).collect() == []


def test_masked(spark):
    got = {r.doc_id: r for r in personal.masked(frame(spark, ROWS)).collect()}
    assert got[1].text == "mail [EMAIL], host [IP]" and got[1].spans == "x" and got[None].text == "[PHONE]"
    assert got[2].text is None and got[3].text == "" and got[4].text.endswith("y  [EMAIL]")
    assert personal.masked_text("abcdef", [("p", 1, 4, 1.0), ("q", 2, 5, 1.0)]) == "a[P]f"


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in personal.op11_personal_data(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        want = brute(doc.text)
        row, text = got[doc.doc_id], ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w[0] == k for w in want) for k in BASE]
        assert row.spans.startswith(text)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got.values())


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    out = personal.op11_personal_data(spark, str(tmp_path))
    assert out.collect() == []
    assert dict(out.dtypes)["n_email"] == "bigint"
