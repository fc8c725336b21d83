"""The corpus pipeline against brute force, and the queries against their SQL."""

from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, normal
from restframe.llm import langid, linededup, mixing
from restframe.llm.queries import ORACLES, QUERIES
from restframe.session import keep
from helpers import Groups
from test_langid import brute as languages
from test_linededup import brute as line_places
from test_neardocs import jaccard, shingles

WORDS = "kalomi zuxewo ñeçu lorem vista garden paper stone river cloud".split()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rows = []
    for i in range(80):
        words = [WORDS[(i * 7 + j * (3 + i % 5)) % 10] + str(i * j % 17 or "") for j in range(12 + i % 9)]
        rows.append((i, " ".join(words) + ("\nsame last line for many" if i % 4 == 0 else ""), "en", f"s{i % 3}", 0))
    rows += [(100 + i, rows[i][1].replace("stone", "stones", 1), "en", "s9", 0) for i in range(10)]
    rows += [(200, None, "en", None, None), (201, "123", None, "s1", 3), rows[3]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    return str(path)


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, small))
        outputs.append(docs)
    assert all(out.columns == columns for out in outputs[:-1])

    found = languages([(r.doc_id, r.text, r.lang) for r in rows])
    kept = [r for r, (_, lang, score) in zip(rows, found, strict=True) if lang != "und" and score >= langid.LEAST_SCORE]
    assert Counter(outputs[0].collect()) == Counter(kept)

    gone, texts = line_places([(r.doc_id, r.text) for r in kept]), {}
    for (key, text), places in gone.items():
        left = linededup.without_lines(text, places)
        if not places or left.strip():
            texts[key] = left
    lines = outputs[1].collect()
    assert {r.doc_id: r.text for r in lines} == texts and len(lines) == len(texts)
    assert all(r.n_chars == len(r.text) for r in lines)

    sets = {key: shingles(text) for key, text in texts.items()}
    groups = Groups(sets)
    for a in sets:
        for b in sets:
            if jaccard(sets[a], sets[b]) >= 0.8:
                groups.join(a, b)
    assert sorted(r.doc_id for r in outputs[2].collect()) == sorted({groups.find(k) for k in sets})

    plan = mixing.mix(outputs[2], mixing.count_words(outputs[2].text)).collect()
    want = Counter({r.row.doc_id: r.copies for r in plan if r.copies})
    assert Counter(r.doc_id for r in outputs[3].collect()) == want
    assert Counter(r.doc_id for r in outputs[4].collect()) == want
    assert Counter(map(tuple, corpus_pipeline.run(spark, small).select("doc_id", "ids_sha256").collect())) == Counter(
        map(tuple, outputs[4].select("doc_id", "ids_sha256").collect())
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, ""))
        assert docs.isEmpty()


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    got = QUERIES[name](spark, sf_dir).toPandas()
    cursor = con.execute(ORACLES[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_every_row(spark, sf_dir, name):
    table, key = {"op1_": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}.get(name[:4], ("documents", "doc_id"))
    got = QUERIES[name](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if name.startswith("op12_"):
        got = got.where("component = 1")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in rows.select(key).collect())
