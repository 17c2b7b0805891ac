"""Token tables: ids against the tokenizer, order, ranges, and what the files hold."""

import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lonja.llm import queries, token_files

SCHEMA = "doc_id bigint, text string, lang string, ids string, part string"
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["one", "Zwei", "três", "cuatro,", "5", "!", "don't", "  ", "\n", "\t", "😀", "<|endoftext|>"]
    made = [(i * 3, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(200)]
    made += [(None, "no id"), (None, None), (7, None), (8, ""), (9, " \t\r\n"), (10, "x" * 100_000)]
    made += [(11, " ".join(rng.choices(words, k=60_000)))] + [(12, "again and again")] * 30
    return [(d, t, "en" if i % 2 else None, "clash", "clash") for i, (d, t) in enumerate(made)]


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def write(spark, rows, **more):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return token_files.write_token_table(docs, FILE, metadata=("lang", "ids"), **more)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_round_trip(spark, rows, tokenizer, encoding, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TEXT_BYTES", 60_000)
    folder = write(spark, rows, encoding=encoding)
    found = token_files.read_token_table(spark, folder).orderBy("start").collect()
    assert sorted((r.row.doc_id is not None, r.row.doc_id or 0) for r in found) == [
        (r.row.doc_id is not None, r.row.doc_id or 0) for r in found
    ]
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
    expected = sorted((str(d), encoded(tokenizer, t), str(lang)) for d, t, lang, *_ in rows)
    assert sorted((str(r.row.doc_id), list(r.ids), str(r.row.lang)) for r in found) == expected
    assert all(r.n_tokens == len(r.ids) for r in found)
    files = list(Path(folder, "data").glob("*.parquet"))
    assert len(files) > 5
    wanted = {"dictionary": "PLAIN_DICTIONARY", "delta": "DELTA_BINARY_PACKED"}[encoding]
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = map(group.column, range(group.num_columns))
        (ids,) = (c for c in columns if c.path_in_schema.startswith("ids.list"))
        assert ids.has_offset_index and ids.has_column_index and wanted in ids.encodings


def test_row_groups_and_pages_have_the_set_size(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(100)), None, "", "") for i in range(3000)]
    folder = write(spark, rows, row_group_bytes=200_000, page_bytes=20_000, page_rows=100)
    (file,) = Path(folder, "data").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 1
    assert all(meta.row_group(i).num_rows < 3000 for i in range(meta.num_row_groups))


def test_ranges_of_ids(spark, rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TEXT_BYTES", 60_000)
    folder = write(spark, rows)
    table = token_files.read_token_table(spark, folder).orderBy("start").collect()
    whole = [x for r in table for x in r.ids]
    for first, count in ((0, 1), (5, 300), (len(whole) - 3, 50), (len(whole) // 2, 70_000), (len(whole), 9)):
        cut = token_files.read_ids(spark, folder, first, count).orderBy("start").collect()
        assert [x for r in cut for x in r.ids] == whole[first : first + count]
        assert all(len(r.ids) == r.n_tokens for r in cut)
        assert not cut or cut[0].start == first


def test_counts_are_read_without_ids(spark, rows):
    folder = write(spark, rows)
    found = token_files.read_token_table(spark, folder).where("row.doc_id = 12").select("n_tokens")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters" in plan and "EqualTo(row.doc_id,12)" in plan


def test_query(spark, tokenizer, tmp_path):
    rows = [(3, "b c"), (1, None), (2, "ends with a space "), (5, ""), (4, "  starts with two")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op12_token_files"](spark, str(tmp_path))
    expected, start = [], 0
    for doc_id, text in sorted(rows):
        ids = np.array(encoded(tokenizer, text), dtype="<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == expected


def test_no_documents(spark):
    folder = write(spark, [])
    assert token_files.read_token_table(spark, folder).count() == 0
    assert token_files.read_ids(spark, folder, 0, 10).count() == 0


def test_pieces_are_encoded_like_whole_texts(tokenizer):
    rng = random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t", "é", "ß", " x", "<|endoftext|>", "'s", "12", ".", ",", "?!", "½", "e\u0301", "_", "😀", "\x1c", "　", " b"]
    encoder = token_files.Encoder(FILE)
    for _ in range(2000):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3)]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)


def test_forgotten_pieces_are_encoded_again(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "_MEMORY", 1000)
    encoder = token_files.Encoder(FILE)
    for i in range(50):
        text = f"some words {i} and {i * 7} more words"
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids


def test_marks_do_not_make_a_known_word_new(tokenizer, monkeypatch):
    encoder = token_files.Encoder(FILE)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    encoder.encode([" ".join(words)])
    asked, ids = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: asked.append(text) or ids(text))
    text = " ".join(w + m for w in words for m in ("###", "%", "...", "$$$", ""))
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids
    assert sum(map(len, asked)) < 100


def test_pieces_of_one_hash_are_told_apart(tokenizer, monkeypatch):
    hashes = lambda codes, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3)
    monkeypatch.setattr(token_files, "range_hashes", hashes)
    encoder = token_files.Encoder(FILE)
    for text in ("one two six, ten four  five\n\nseven", "ten one! two six four nine", "a  b cc ddd eee. fff"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids


def test_long_text_is_encoded_in_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "_GROUP", 50)
    encoder = token_files.Encoder(FILE)
    text = "some words, more  words\nand a new line " * 40
    found = encoder.encode(["", text, "x" * 200, text[:60]])
    expected = [tokenizer.encode(t).ids for t in ("", text, "x" * 200, text[:60])]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected
