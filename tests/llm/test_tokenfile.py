import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from restframe.llm import tokenfile

PARTS = ["ab", "é", " ", "  ", "\n", "'re", "12", "!?", "日本", " the", "\r\n", "\x1c", "\x85", "z" * 40, "'", "\t", "😀", "²", "<|endoftext|>"]


def plain():
    code = Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))
    return lambda text: code.encode(text or "", add_special_tokens=False).ids


def test_remembered_units_equal_whole_texts():
    rng, encode = random.Random(5), plain()
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    made = tokenfile.encode_texts(texts, public_tokenizers.path(tokenfile.VOCABULARY))
    assert [np.frombuffer(ids, np.int32).tolist() for ids in made] == [encode(text) for text in texts]


def test_added_tokens_are_what_the_library_makes_of_them():
    path = public_tokenizers.path(tokenfile.VOCABULARY)
    names, encode = tokenfile.added_tokens(path), plain()
    assert names
    texts = [t for n in names for t in (n, f"a{n}b", f" {n} ", f"x\n{n}\n{n}{n} y", n[:-1], f"{n[:4]} {n[4:]}", "word " * 3000 + n)]
    made = [np.frombuffer(ids, np.int32).tolist() for ids in tokenfile.encode_texts(texts, path)]
    assert made == [encode(text) for text in texts]
    assert made[1] == [64, 50256, 65]


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(tokenfile, "MEMORY", 3)
    made = tokenfile.encode_texts(["a b c d e", "a b f"], public_tokenizers.path(tokenfile.VOCABULARY))
    assert [np.frombuffer(ids, np.int32).tolist() for ids in made] == [plain()(t) for t in ("a b c d e", "a b f")]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files(spark, tmp_path, encoding):
    texts = {9: "the end", 3: None, 5: "", 7: "a " * 5000, 4: "Été"}
    rows = [*texts.items(), (7, texts[7]), (None, "last"), (4, "other")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, place int")
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(docs, path, encoding=encoding, files=3, page_rows=2)
    encode, start = plain(), 0
    meta = sorted(tokenfile.read_metadata(spark, path).collect(), key=lambda r: r.place)
    assert [r.key for r in meta] == [3, 4, 4, 5, 7, 7, 9, None]
    sums = {r.place: r for r in tokenfile.crc32_of_ids(tokenfile.read_tokens(spark, path)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for (_, text), row in zip(order, meta, strict=True):
        ids = [*encode(text), 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert sums[row.place].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = tokenfile.read_tokens(spark, path, low=4, high=5)
    assert sorted(r.key for r in some.collect()) == [4, 4, 5]
    files = [pq.ParquetFile(f) for f in (tmp_path / "tokens").glob("*.parquet")]
    chunks = [f.metadata.row_group(0).column(4) for f in files if f.metadata.num_rows]
    assert {c.path_in_schema for c in chunks} == {"ids.list.element"}
    wanted = {"dictionary": "RLE_DICTIONARY", "delta": "DELTA_BINARY_PACKED"}[encoding]
    # A writer gives up on a dictionary that saves nothing, as in the files of one short text.
    assert any(wanted in c.encodings or "PLAIN_DICTIONARY" in c.encodings for c in chunks)
    assert all(c.has_offset_index and c.has_column_index for c in chunks)


def test_no_rows_and_bad_encoding(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokenfile.write_tokens(docs, str(tmp_path / "none"))
    assert tokenfile.read_metadata(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError, match="encoding"):
        tokenfile.write_tokens(docs, str(tmp_path / "bad"), encoding="gzip")
