import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import Groups

from restframe.llm import linededup, links

SCHEMA = "doc_id long, text string, id string, ident int, removed int, row int"


def brute(rows, shingle=linededup.SHINGLE):
    """Removed positions of each different (key, text), and of its copies."""
    where = {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for n, line in enumerate((text or "").split("\n")):
            line = linededup.normal(line)
            if line:
                where.setdefault(line, []).append((key, text, n))
    lines = sorted(where)
    sets = [frozenset(t[i : i + shingle] for i in range(len(t) - shingle + 1)) for t in lines]
    groups = Groups(range(len(lines)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    seen, gone = set(), {row: [] for row in rows}
    order = [(k is None, k or 0, n, k, t, i) for i, line in enumerate(lines) for k, t, n in where[line]]
    for _, _, n, key, text, i in sorted(order, key=lambda x: x[:3]):
        root = groups.find(i)
        if root in seen:
            gone[key, text].append(n)
        seen.add(root)
    return {row: sorted(places) for row, places in gone.items()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)

    def line():
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 40)))

    pool, rows = [line() for _ in range(60)], []
    for i in range(60):
        lines = [line() for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 4)):
            one = rng.choice(pool)
            at = rng.randrange(len(one))
            lines.append(one if rng.random() < 0.4 else (one[:at] + "Q" + one[at + 1 :]).upper())
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, "short"), (104, "Short \nx\nx"), (None, pool[0] + "\nnew in null")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def test_removed_lines(spark, rows):
    got = linededup.removed_lines(frame(spark, rows)).collect()
    want = {key: places for (key, _), places in brute(rows).items()}
    assert {r.key: list(r.removed) for r in got} == want
    assert {r.key: r.n_lines for r in got} == {k: (t or "").count("\n") + 1 for k, t in rows}
    assert sum(map(len, want.values())) > 50


def test_texts_without_them(spark, rows):
    out = linededup.deduplicate_lines(frame(spark, rows))
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    want = {}
    for (key, text), places in brute(rows).items():
        left = linededup.without_lines(text, places)
        if not places or left.strip():
            want[key] = left
    assert {r.doc_id: r.text for r in out.collect()} == want


def test_copies_of_a_document(spark):
    rows = [(1, "one line of some length\n\nand another of some length")] * 3 + [(1, "quite different words in this")]
    got = sorted((r.n_lines, list(r.removed)) for r in linededup.removed_lines(frame(spark, rows)).collect())
    assert got == [(1, []), (3, []), (3, [0, 2]), (3, [0, 2])]
    kept = linededup.deduplicate_lines(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted({t for _, t in rows})


def test_signatures_of_long_lines_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(6)
    lines = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (8, 9, 100, 5000)]
    whole = linededup.signatures(lines)
    monkeypatch.setattr(linededup, "SEGMENT", 64)
    assert (linededup.signatures(lines) == whole).all()


@pytest.mark.parametrize("held", [5, 1 << 20])
def test_buckets_of_packed_bands(monkeypatch, held):
    """Bands with two or more lines, whether a cell is held whole or goes through in pieces."""
    monkeypatch.setattr(linededup, "HELD_PAIRS", held)
    keys = [1 << 60, 2 << 60, 2 << 60, (2 << 60) + (1 << 40)] + [7 << 60] * 40 + [9 << 60] * 3 + [(7 << 60) + (1 << 50)]
    ids = [5, 1, 2, 1, *range(100, 140), 3, 4, 4, 9]
    sent = [linededup.packed([(np.array(keys[i : i + 4], np.uint64), np.array(ids[i : i + 4]))], 6) for i in range(0, len(keys), 4)]
    rows = pa.Table.from_batches(sent).sort_by("cell").to_batches(max_chunksize=3)
    out = pa.Table.from_batches(list(linededup.sharing(iter(rows)))).to_pandas().drop_duplicates()
    assert sorted(map(sorted, out.groupby("bucket").id.apply(list))) == [[1, 2], [3, 4], [*range(100, 140)]]


@pytest.mark.parametrize("together", [1, 300, 1 << 20])
def test_small_buckets_compared_together(monkeypatch, together):
    monkeypatch.setattr(links, "TOGETHER", together)
    rng, near = random.Random(3), linededup.SimilarLines(5, (4, 5))
    rows, want, number = [], set(), 0
    for bucket in range(80):
        base = "".join(rng.choice("abcdef é日\U0001f600") for _ in range(rng.randrange(5, 70)))
        own = []
        for _ in range(rng.choice([1, 2, 2, 3, 3, 4, 9])):
            at = rng.randrange(len(base))
            text = base if rng.random() < 0.3 else base[:at] + rng.choice("xyz") + base[at + 1 :] if rng.random() < 0.7 else base[::-1]
            own.append((number, {text[i : i + 5] for i in range(len(text) - 4)}))
            rows.append((bucket, number, text))
            number += 1
        groups = Groups([i for i, _ in own])
        for i, a in own:
            for j, b in own:
                if i < j and 5 * len(a & b) >= 4 * len(a | b):
                    groups.join(i, j)
        want |= {(i, groups.find(i)) for i, _ in own}
    table = pa.table({"bucket": [r[0] for r in rows], "id": [r[1] for r in rows], "line": [r[2] for r in rows]})
    edges = pa.Table.from_batches(list(links._within_buckets(near, iter(table.to_batches(max_chunksize=7))))).to_pandas()
    found = Groups(range(number))
    for u, v in zip(edges.u, edges.v, strict=True):
        found.join(int(u), int(v))
    assert {(i, found.find(i)) for i in range(number)} == want


def test_shingles_of_many_characters_are_exact():
    """More different characters than fit numbers of 64 bits."""
    lines = ["".join(chr(0x4E00 + (i * 7919 + j * 31) % 20000) for j in range(300)) for i in range(80)]
    assert linededup.joint_sets(lines, 5) is None
    sets = linededup.ShingleSets(lines, 5)
    for many in ([1, 2], [5, 79]):
        got = sets.shared(0, np.array(many))[0].tolist()
        assert got == [len({lines[0][i : i + 5] for i in range(296)} & {lines[m][i : i + 5] for i in range(296)}) for m in many]


def test_blank_by_any_white_space(spark):
    rows = [(1, "a line that is long enough\n\u3000"), (2, "\u3000\na line that is long enough"), (3, "a line that is long enough\n  \u00a0"), (4, "\u3000")]
    kept = linededup.deduplicate_lines(frame(spark, rows)).collect()
    assert {r.doc_id: r.text for r in kept} == {1: rows[0][1], 4: "\u3000"}


def test_one_changed_character_in_lines_of_sixty(spark):
    rng, rows = random.Random(8), []
    for i in range(60):
        line = "".join(rng.choice("abcdefghij klmnop") for _ in range(62)).strip("ab ").ljust(60, "x")
        at = rng.randrange(6, len(line) - 6)
        rows += [(i, line), (1000 + i, line[:at] + "Q" + line[at + 1 :])]
    got = {r.key: list(r.removed) for r in linededup.removed_lines(frame(spark, rows)).collect()}
    assert got == {key: [0] if key >= 1000 else [] for key, _ in rows}


def test_no_rows(spark):
    assert linededup.removed_lines(frame(spark, [])).collect() == []
    assert linededup.deduplicate_lines(frame(spark, [])).collect() == []


def test_signatures_hold_few_characters_at_once(monkeypatch):
    lines = [f"line number {i} of some others " * (1 + i % 40) for i in range(400)] + ["abcdef" * 40_000]
    sizes, windows = [], linededup._windows
    monkeypatch.setattr(linededup, "_windows", lambda codes, size: sizes.append(len(codes)) or windows(codes, size))
    made = linededup.signatures(lines)
    assert max(sizes) <= 3 << 16
    assert (made == np.concatenate([linededup.signatures([line]) for line in lines])).all()


def test_normal_lines_of_any_white_space():
    odd = ["", " ", "a\n", " a\nb ", "A  b\nc", "a \nb", "a\n b", "a\r\nb", "é x  \ny", "日　本\nz"]
    odd += [f"x{chr(c)}y\nz {chr(c)}" for c in range(0x3100)]
    for text in odd:
        assert linededup.normal_lines(text) == [linededup.normal(line) for line in text.lower().split("\n")]


def test_runs_are_compared_together():
    """As many decisions as the longest bucket has items, not some for each bucket; links that connect what is linked."""
    rng, asked = random.Random(5), []
    sizes = np.array([rng.choice([1, 2, 3, 5, 9]) for _ in range(300)])
    kind = np.array([rng.randrange(3) for _ in range(sizes.sum())])

    def decide(left, right):
        asked.append(len(left))
        return kind[left] == kind[right]

    left, right = links._stepped(sizes, decide)
    assert len(asked) <= 8
    bucket = np.repeat(np.arange(300), sizes)
    groups = Groups(range(len(kind)))
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        assert bucket[a] == bucket[b] and kind[a] == kind[b]
        groups.join(a, b)
    named = {}
    for i, key in enumerate(zip(bucket.tolist(), kind.tolist(), strict=True)):
        assert groups.find(named.setdefault(key, i)) == groups.find(i)


def test_pairs_of_several_buckets_are_compared_once():
    """Lines that several buckets share are prepared once for a piece of work, and no pair is decided twice."""
    rng, prepared, asked = random.Random(9), [], []
    texts = ["".join(rng.choice("abcdef ") for _ in range(40)) for _ in range(12)]
    texts += [t[:20] + "x" + t[21:] for t in texts]
    buckets = [sorted(rng.sample(range(len(texts)), rng.choice([2, 3, 5]))) for _ in range(200)]
    rows = sorted({(own[0], bucket, i) for bucket, own in enumerate(buckets) for i in own})

    class Near(linededup.SimilarLines):
        def linked_pairs(self, batch):
            decide = super().linked_pairs(batch)
            prepared.append(batch.column("id").to_pylist())

            def noted(left, right):
                asked.extend(map(frozenset, zip(left.tolist(), right.tolist(), strict=True)))
                return decide(left, right)

            return noted

    table = pa.table({"lead": [r[0] for r in rows], "bucket": [r[1] for r in rows], "id": [r[2] for r in rows], "line": [texts[r[2]] for r in rows]})
    edges = pa.Table.from_batches(list(links._within_buckets(Near(5, (3, 5)), iter(table.to_batches(max_chunksize=50))))).to_pandas()
    assert len(prepared) == 1 and len(prepared[0]) == len(set(prepared[0]))
    assert len(asked) == len(set(asked))
    want = {(a, b) for own in buckets for a in own for b in own if b == a + 12}
    assert {(min(e), max(e)) for e in zip(edges.u.tolist(), edges.v.tolist(), strict=True)} == want and want


def test_lines_that_occur_once_are_not_kept(spark, rows, monkeypatch):
    kept, keep = {}, linededup.keep

    def noted(df, label):
        kept[label] = keep(df, label)
        return kept[label]

    monkeypatch.setattr(linededup, "keep", noted)
    linededup.removed_lines(frame(spark, rows)).collect()
    known = kept["line-firsts"].collect()
    assert known and all(r.n > 1 or r.component is not None for r in known)


def test_texts_with_lines_that_are_not_normal_are_marked():
    rng = random.Random(2)
    odd = ["", None, " ", "a\n", " a\nb ", "A  b\nc", "a \nb", "a\n b", "a\r\nb", "é x  \ny", "日　本\nz", "“quoted” – dash"]
    odd += [f"x{chr(c)}y\nz {chr(c)}" for c in range(0x3100)]
    odd += ["".join(rng.choice(" \n\tabéx　") for _ in range(rng.randrange(6))) for _ in range(500)]
    rng.shuffle(odd)
    for column in (pa.array(odd), pa.array(odd, pa.large_string()).slice(3, 700), pa.array([None, ""], pa.string())):
        texts = [text or "" for text in column.to_pylist()]
        changed = [any(linededup.normal(line) != line for line in text.lower().split("\n")) for text in texts]
        marked = linededup.not_normal(column).tolist()
        assert all(m for m, c in zip(marked, changed, strict=True) if c)
        assert [own for some in linededup._groups(column) for own in some] == [[linededup.normal(line) for line in text.lower().split("\n")] for text in texts]
    assert not linededup.not_normal(pa.array(["Plain «text», é, two\n\nlines of it", None, "", "\n"])).any()
