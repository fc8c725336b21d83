import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from restframe.llm import langid
from restframe.session import ship

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score int, row int"
SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "xe", "wo"], "cc": ["ñe", "çu", "ßa"]}


@pytest.fixture(scope="module")
def rows():
    rng, rows = random.Random(8), []
    for i in range(300):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text.title() if i % 5 else text.upper(), lang))
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 34 ² !?", "cc"), (903, "kalomi " * 30000, None), (None, "zuxe wozu", "bb"), (904, "日本語", "aa")]
    return [*rows, rows[0], rows[0]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def brute(rows):
    """The same decision by exact sets, without a filter and its false positives."""
    counts = {}
    for key, text, lang in rows:
        if text is not None and lang is not None and not (key is not None and zlib.crc32(str(key).encode()) % 4 == 2):
            own = counts.setdefault(lang, Counter())
            own.update(g for w in langid.words_of(text) for g in langid.grams_of(w))
    shares = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = {}
    for own in shares.values():
        for g, share in own.items():
            top[g] = max(top.get(g, 0), share)
    sets = {lang: {g for g, s in own.items() if s >= langid.LEAST_SHARE and s >= langid.LEAST_RATIO * top[g]} for lang, own in shares.items()}
    out = []
    for key, text, _ in rows:
        grams = [g for w in langid.words_of(text or "") for g in langid.grams_of(w)]
        hits = {lang: sum(g in own for g in grams) for lang, own in sorted(sets.items())}
        best = max(hits, key=hits.get) if grams else langid.UNKNOWN
        out.append((key, best, hits.get(best, 0) / max(1, len(grams))))
    return out


def test_predictions(spark, rows):
    docs = frame(spark, rows)
    model = langid.learn(docs.where(~langid.is_held_out(docs.doc_id)))
    out = langid.identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "row", "lang_pred", "score"]
    got, want = out.collect(), brute(rows)
    assert Counter((r.doc_id, r.lang_pred) for r in got) == Counter((k, p) for k, p, _ in want)
    scores = {k: s for k, _, s in want}
    assert all(abs(r.score - scores[r.doc_id]) < 0.05 for r in got)
    assert all(r.lang_pred == r.lang for r in got if r.doc_id is not None and r.doc_id < 900)


def test_filter_returns_all_languages():
    rng = np.random.default_rng(0)
    grams = [f"g{i}" for i in range(400)]
    inside = rng.random((400, 130)) < 0.3
    model = langid.LanguageFilter([f"l{i:03}" for i in range(130)], np.zeros((8192, 3), np.int64))
    ones = langid.LanguageFilter(model.langs, np.full((8192, 3), -1, np.int64))
    assert (ones.masks(grams) == -1).all() and (model.masks(grams) == 0).all()
    for g, gram in enumerate(grams):
        h = langid.xxhash.xxh64_intdigest(gram.encode(), 42)
        for i in range(langid.HASHES):
            at = ((h & 0xFFFFFFFF) + i * (h >> 32 | 1)) % 8192
            for lang in np.flatnonzero(inside[g]):
                model.planes[at, lang // langid.PLANE] |= np.int64(1 << int(lang % langid.PLANE))
    masks = model.masks(grams)
    found = np.array([(masks[:, i // langid.PLANE] >> np.int64(i % langid.PLANE)) & 1 for i in range(130)]).T.astype(bool)
    assert found[inside].all() and found[~inside].mean() < 0.02


def test_stage(spark, rows):
    ship(spark)
    out = langid.keep_identified(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "row"]
    assert Counter(r.doc_id for r in out.collect()) == Counter(k for k, p, s in brute(rows) if p != "und" and s >= langid.LEAST_SCORE)


def test_nothing_learned_and_no_rows(spark):
    docs = frame(spark, [(1, "kalo", None), (2, None, "aa")])
    out = langid.identify(docs, langid.learn(docs))
    assert [(r.lang_pred, r.score) for r in out.collect()] == [("und", 0.0)] * 2
    assert langid.keep_identified(frame(spark, [])).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    got = langid.op10_language_id(spark, sf_dir).where("held_out")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = [r.lang == r.lang_pred for r in got.join(docs, "doc_id").where("lang is not null").collect()]
    assert len(right) > 20 and np.mean(right) > 0.95


@pytest.mark.parametrize("size", [3, 7, 1 << 16])
def test_long_words_in_parts_have_each_ngram_once(monkeypatch, size):
    monkeypatch.setattr(langid, "PART", size)
    for word in ("ab", "abcdefghijklmnop", "漢字かな" * 50):
        assert Counter(g for part in langid.gram_parts(word) for g in part) == Counter(langid.grams_of(word))


def test_long_words_count_as_short_ones(spark, monkeypatch):
    rows = [(i, ("kalomi" if i % 2 else "zuxewo") * (100 + i), "aa" if i % 2 else "bb", "x", 1, 2) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = langid.identify(docs, langid.learn(docs)).select("doc_id", "lang_pred", "score").collect()
    counts = {(r.lang, r.gram): r.n for r in langid.gram_counts(docs.select("lang", "text")).collect()}
    monkeypatch.setattr(langid, "LONG_WORD", 10**9)
    assert Counter(map(tuple, whole)) == Counter(map(tuple, langid.identify(docs, langid.learn(docs)).select("doc_id", "lang_pred", "score").collect()))
    assert counts == {(r.lang, r.gram): r.n for r in langid.gram_counts(docs.select("lang", "text")).collect()}


def test_ngrams_of_one_word_are_held_in_parts(monkeypatch):
    """A text of a million letters without a space: no more n-grams at once than a part has."""
    monkeypatch.setattr(langid, "PART", 1 << 12)
    most, masks = [], langid.LanguageFilter.masks
    monkeypatch.setattr(langid.LanguageFilter, "masks", lambda self, grams: most.append(len(grams)) or masks(self, grams))
    model = langid.LanguageFilter(["aa", "bb"], np.full((1024, 1), 1, np.int64))
    assert model.predict(["漢字かな交じり文" * 25_000])[0][0] == "aa"
    assert max(most) <= 3 << 12 and not model.memory and sum(most) > 590_000


def test_each_different_gram_is_hashed_once(monkeypatch):
    asked = []
    whole = langid.LanguageFilter.masks
    monkeypatch.setattr(langid.LanguageFilter, "masks", lambda self, grams: asked.extend(grams) or whole(self, grams))
    planes = np.random.default_rng(1).integers(0, 4, (1 << 12, 1))
    texts = ["banana bandana", "ananas anna", None, "123", "banana ananas", "a" * 600 + " anna"]
    split = langid.LanguageFilter(["x", "y"], planes)
    alone = [split.predict([t])[0] for t in texts[:5]]
    assert len(asked) == len(set(asked))
    assert langid.LanguageFilter(["x", "y"], planes).predict(texts)[:5] == alone


def test_words_counted_are_bounded_within_a_batch(monkeypatch, spark):
    """However many rows a batch has, the words held while counting stay few; the counts are those of all texts."""
    monkeypatch.setattr(langid, "WORDS", 20)
    held, summed = [], langid._summed
    monkeypatch.setattr(langid, "_summed", lambda words: held.append(sum(map(len, words.values()))) or summed(words))
    texts = [f"{chr(97 + i % 26) * 2}{chr(97 + i // 26) * 3} same" for i in range(400)]

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.parts = list(run(iter([pa.RecordBatch.from_pydict({"lang": ["aa"] * 400, "text": texts})])))
            raise StopIteration

    rows = Rows()
    with pytest.raises(StopIteration):
        langid.gram_counts(rows)
    assert max(held) <= 24
    got, want = Counter(), Counter(g for text in texts for word in langid.words_of(text) for g in langid.grams_of(word))
    for part in rows.parts:
        got.update(dict(zip(part.column("gram").to_pylist(), part.column("n").to_pylist(), strict=True)))
    assert got == want


def test_texts_go_to_the_workers_once(spark, rows):
    """The rows kept have their columns, whatever their names, and no second copy of the text travels with them."""
    ship(spark)
    kept = langid.keep_identified(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score", "row"]
    assert {(r.lang_pred, r.score, r.row) for r in kept.collect()} == {("x", 1, 2)}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(" not in plan
