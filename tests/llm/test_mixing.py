from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from restframe.llm import mixing
from restframe.session import shared_dir

SCHEMA = "doc_id long, text string, source string, size string, h int, row int"


def plan(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return mixing.mix(docs, mixing.count_words(F.col("text"))).collect()


def test_words_by_ascii_space(one):
    assert one(mixing.count_words(F.col("t")), t="a\tb  c\u00a0d\n") == 3
    assert one(mixing.count_words(F.lit(None).cast("string"))) == 0


def shared(sizes, weights):
    """Targets by sharing the excess again and again."""
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while True:
        rest = total - sum(target.values())
        unit = rest / sum(weights[s] for s in open_) if open_ else 0
        over = {s for s in open_ if unit * weights[s] > 3 * sizes[s]}
        if not over:
            return target | {s: unit * weights[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over


def test_targets_and_budget(spark):
    rows = []
    for s, (source, n) in enumerate([("a", 300), ("b", 4), ("c", 120), ("B", 2), (None, 60), ("\U0001f600", 10)]):
        rows += [(1000 * s + i, "w " * (1 + i % 7), source, "x", i, i) for i in range(n)]
    rows += [(None, None, "a", None, None, None), (5, "", None, None, None, None), rows[3], rows[3]]
    got = plan(spark, rows)
    assert len(got) == len(rows)
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        source = r.row.source
        sizes[source] += r.size
        taken[source] += r.size * r.copies
        targets[source] = r.target
        assert 0 <= r.copies <= 3 and r.size == len((r.row.text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = shared(dict(sizes), {s: 1 + i % 3 for i, s in enumerate(order)})
    for s in sizes:
        assert abs(targets[s] - want[s]) < 1e-6
        assert abs(taken[s] - want[s]) <= 7 + 1
    assert sum(sizes.values()) - 7 <= sum(taken.values()) <= sum(sizes.values())
    again = plan(spark, rows)
    assert Counter((r.row, r.copies) for r in got) == Counter((r.row, r.copies) for r in again)


def test_stage_keeps_columns_and_repeats(spark):
    docs = spark.createDataFrame([(i, "a b", s, "k", 1, 2) for s, n in (("x", 30), ("y", 2)) for i in range(n)], SCHEMA)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = defaultdict(Counter)
    for r in out.collect():
        copies[r.source][r.doc_id] += 1
    # y wants two thirds of 64 words and has 4.
    assert set(copies["y"].values()) == {3} and len(copies["x"]) == 26


def test_empty_and_wordless(spark):
    assert plan(spark, []) == []
    assert [(r.size, r.target) for r in plan(spark, [(1, None, "a", None, None, None)])] == [(0, 0.0)]


def test_rows_with_one_place_are_parted(spark):
    # 40 equal rows of one key and 40 of none: the budget ends among them.
    rows = [(1, "a b c", "x", "k", 1, 2)] * 40 + [(None, "d e", "x", "k", 1, 2)] * 40 + [(9, "f", "y", "k", 1, 2)]
    got = plan(spark, rows)
    assert len(got) == len(rows)
    taken = sum(r.size * r.copies for r in got)
    assert sum(r.size for r in got) - 3 <= taken <= sum(r.size for r in got)
    copies = Counter((r.row.doc_id, r.copies) for r in got)
    assert {k for _, k in copies} <= {0, 1, 2, 3} and len({k for d, k in copies if d in (1, None)}) > 1
    docs = spark.createDataFrame(rows, SCHEMA)
    assert mixing.mixed(docs).count() == sum(r.copies for r in got)


def test_texts_are_not_written_nor_shuffled(spark):
    folder = Path(shared_dir(spark)) / "restframe"
    before = set(folder.glob("mix-*"))
    rows = [(i, f"word {i}", "ab"[i % 2], "k", 1, 2) for i in range(50)]
    out = mixing.mixed(spark.createDataFrame(rows, SCHEMA))
    written = set(folder.glob("mix-*")) - before
    assert written and not any({"row", "text"} & set(spark.read.parquet(str(f)).columns) for f in written)
    plan_text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan_text and "hashpartitioning" not in plan_text
