"""Stages that drop rows: ids may be missing or repeated, every row is judged by itself."""

from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from lonja.llm import decontamination, near_dedup, token_counts

SCHEMA = "doc_id bigint, text string"


def kept_rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_one_row_of_each_component(spark):
    a, b, c, d, e = (words(x) for x in "abcde")
    rows = [(1, a), (1, a), (2, a + " more")]
    rows += [(None, b)] * 3
    rows += [(None, c), (7, c), (9, c)]
    # One id with two texts, one of them a duplicate.
    rows += [(3, d), (8, d), (8, e)]
    rows += [(None, ""), (None, ""), (4, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_row", F.lit("x")).repartition(3)
    found = near_dedup.one_of_each(docs)
    assert found.columns == docs.columns
    expected = [(1, a), (None, b), (7, c), (3, d), (8, e), (None, ""), (None, ""), (4, None)]
    assert kept_rows(found) == Counter(expected)


def test_rows_are_cleaned_one_by_one(spark):
    dirty, clean, other = words("a", 30), words("b", 30), words("c", 30)
    rows = [(None, dirty), (None, clean), (None, None), (None, clean), (5, dirty), (5, other)]
    rows += [(6, clean), (6, clean), (7, dirty), (7, dirty)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("k1", F.lit(1)).repartition(3)
    items = spark.createDataFrame([(1, " ".join(dirty.split()[5:20]))], "item_id bigint, text string")
    found = decontamination.clean_documents(docs, items)
    assert found.columns == docs.columns
    assert kept_rows(found) == Counter(r for r in rows if r[1] != dirty)


def test_rows_of_one_id_fill_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FILE_TEXT_BYTES", 4000)
    rows = [(None, words("a", 20))] * 300 + [(None, words(f"b{i}x", 20)) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    folder = token_counts.write_token_files(docs)
    sizes = [p.stat().st_size for p in Path(folder).glob("part-*")]
    assert sum(sizes) == 600 * 21 * 2 and max(sizes) < 4000
    assert token_counts.documents_in(spark, folder).where("n_tokens = 20").count() == 600


def test_blocks_are_read_without_the_whole_file(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(b"\1\0\2\0\0\0" * 500)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        found = token_counts.documents_in(spark, str(tmp_path), block_bytes=64)
        assert Counter(r.n_tokens for r in found.collect()) == {2: 500}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_blocks_of_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    (tmp_path / "part-0").write_bytes(b"\1\0\2\0\0\0" * 500)

    def nowhere(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([False] * batch.num_rows)], ["reached"])

    monkeypatch.setattr(token_counts, "_reach", nowhere)
    found = token_counts.documents_in(spark, str(tmp_path), block_bytes=64)
    assert Counter(r.n_tokens for r in found.collect()) == {2: 500}
