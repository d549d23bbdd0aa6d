"""Texts that have no key of the other side stay where they were read."""

import pytest
from pyspark.sql import functions as F

from moraflow.llm import line_dedup, shingle_join, texts


@pytest.fixture
def shuffled_joins(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("bits", [64, 1 << 23])
def test_split_by_filter_loses_no_key(spark, monkeypatch, bits):
    monkeypatch.setattr(texts, "FILTER_BITS", bits)
    rows = spark.range(1000).select(F.col("id").alias("_id"), (F.col("id") % 7).alias("_th"), F.lit("t").alias("_text"))
    keys = rows.filter("_id % 40 = 0").select("_id", "_th").unionByName(spark.createDataFrame([(5, 6)], "_id long, _th long"))
    some, none = texts.split_by_filter(rows, keys, ["_id", "_th"])
    assert some.columns == none.columns == rows.columns
    kept, rest = ({r["_id"] for r in part.collect()} for part in (some, none))
    assert kept | rest == set(range(1000)) and not kept & rest and kept >= set(range(0, 1000, 40))
    assert bits == 64 or len(kept) < 50
    assert [part.count() for part in texts.split_by_filter(rows, keys.limit(0), ["_id", "_th"])] == [0, 1000]


def _places(out, gone):
    """In how many partitions the rows of each input file are, for files without any of the documents `gone`."""
    rows = {(r["lang"], r["place"]) for r in out.select("doc_id", "lang", F.spark_partition_id().alias("place")).collect() if r["doc_id"] not in gone}
    return {sum(lang == other for other, _ in rows) for lang, _ in rows}


def test_only_texts_that_change_are_shuffled(spark, tmp_path, shuffled_joins):
    line = "a line of more than forty characters that many documents hold"
    rows = [(i, f"{line if i < 8 else ''}\n" + " ".join(f"w{i}x{k}" for k in range(30)), f"p{i % 3}") for i in range(90)]
    rows += [(200 + i, rows[50][1], "p0") for i in range(5)]
    path = str(tmp_path / "docs")
    for part in range(3):
        here = [r for r in rows if r[2] == f"p{part}"]
        spark.createDataFrame(here, "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(path)
    docs = spark.read.parquet(path)
    lines = line_dedup.without_repeats(docs)
    assert {r["doc_id"] for r in lines.filter(F.col("text").contains(line)).select("doc_id").collect()} == {7}
    assert lines.count() == 95 and _places(lines, [*range(8), 50, *range(200, 205)]) == {1}
    one = shingle_join.one_of_each(docs)
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == set(range(90))
    assert _places(one, [200 + i for i in range(5)]) == {1}


def test_a_repeated_id_without_words_stays_with_its_other_text(spark):
    copy = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, copy), (2, copy), (2, ""), (3, copy)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in shingle_join.one_of_each(docs).collect()) == [1, 2, 2]
