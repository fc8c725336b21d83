import random
import weakref

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from restframe.llm import base, bpe

PARTS = ["ab", "é", " ", "  ", "\n", "'re", "'s", "12", "!?", "日本", " the", " ", "z" * 40, " " * 30, "'" * 30, "\x1c", "😀"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [None, "", "a b  c\n\n d's we're 'rest ''re", "x" * 1000, " " * 700 + "y" + "\n" * 600, "'" * 333 + "re the " * 50]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 200))) for _ in range(30)]
    rows = list(enumerate(texts))
    return [*rows, rows[7], rows[7], (None, texts[3]), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("key", F.lit("k"))


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (200, 40), (1 << 16, 256)])
def test_chunks_equal_whole_texts(spark, rows, chunk, overlap):
    code = bpe.encoder(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    got = bpe.encode(frame(spark, rows), chunk_chars=chunk, overlap=overlap).collect()
    want = [(i is None, i or 0, code.encode_ordinary(t or "")) for i, t in rows]
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in got) == sorted(want)


def test_round_trip(spark, rows):
    out = bpe.decode(bpe.encode(frame(spark, rows), chunk_chars=64, overlap=16)).collect()
    assert sorted(bytes(r.bytes) for r in out) == sorted((t or "").encode() for _, t in rows)


def test_stitches_are_true_boundaries():
    rng, pattern = random.Random(1), public_tokenizers.PATTERN
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(20, 60)))
        true = {0} | {m.end() for m in bpe.splitter(pattern).finditer(text)}
        sides = [bpe.overlap_bounds(c, 64, 16, pattern) for _, c in bpe.cut_chunks(text, 64, 16)]
        for i in range(1, len(sides)):
            common = set(sides[i][0]) & set(sides[i - 1][1])
            assert not common or min(common) + 64 * i in true


def test_no_rows_and_bad_options(spark):
    assert bpe.described(bpe.encode(frame(spark, []))).collect() == []
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode(frame(spark, []), chunk_chars=10, overlap=10)


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.bytes for r in bpe.decode(rows).collect()} == {1: None, 2: b""}


def test_bytes_made_with_the_ids(spark, rows):
    """As ``decode`` gives them, with one Python stage for short texts and not two."""
    docs = frame(spark, rows)
    made = bpe.encode(docs, chunk_chars=64, overlap=16, decoded=True)
    one_by_one = bpe.decode(bpe.encode(docs, chunk_chars=64, overlap=16))
    assert made.columns == one_by_one.columns
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.ids)
    assert sorted(made.collect(), key=key) == sorted(one_by_one.collect(), key=key)
    plan = bpe.encoded_and_described(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("MapInArrow")


def test_memory_is_given_back_when_a_task_ends(monkeypatch):
    seen = []
    monkeypatch.setattr(base, "release_memory", lambda: seen.append(alive()))

    class Held:
        pass

    @base.returns_memory
    def run(batches):
        held = Held()
        refs.append(weakref.ref(held))
        for batch in batches:
            yield batch

    refs = []
    alive = lambda: sum(ref() is not None for ref in refs)
    assert list(run(iter([1, 2]))) == [1, 2]
    assert len(refs) == 1 and seen == [0, 0]
