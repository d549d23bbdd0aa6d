"""Sharding, vector codes and the Merkle manifest against plain versions."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from moraflow.llm import merkle, numbering, sharding, vector_codes
from tests.llm import plain
from tests.llm.conftest import found


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 97, 1000])
def test_permutation_is_one_to_one_and_inverted(spark, n):
    walk = sharding.longest_walk(spark, n)
    there = spark.range(n).withColumn("place", F.expr(sharding.permuted("id", n, walk)))
    back = there.withColumn("back", F.expr(sharding.permuted("place", n, walk, inverse=True))).collect()
    assert sorted(r["place"] for r in back) == list(range(n)) and all(r["id"] == r["back"] for r in back)


def test_numbers_follow_the_order(spark):
    rows = [(k % 3 if k % 7 else None, k * 37 % 101) for k in range(300)]
    got = numbering.numbered(spark.createDataFrame(rows, "g long, x long"), ["g", "x"], ("g",)).collect()
    for g in {r[0] for r in rows}:
        here = sorted((r["_no"], r["x"]) for r in got if r["g"] == g)
        assert [n for n, _ in here] == list(range(len(here))) and [x for _, x in here] == sorted(x for h, x in rows if h == g)
        assert {r["_of"] for r in got if r["g"] == g} == {len(here)}


def shards_hold(rows, frame):
    got = sharding.report(frame).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((str(i), len((t or "").encode()) + 16, crc(t)) for i, t in rows)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    numbers = {(r["shard"], r["slot"]): r["row_no"] for r in got}
    asked = frame.sparkSession.createDataFrame([*numbers, (0, 10_000), (40, 0)], "shard int, slot long")
    assert {(r["shard"], r["slot"]): r["row_no"] for r in sharding.rows_at(asked, len(rows)).collect()} == {**numbers, (0, 10_000): None, (40, 0): None}
    return got


def test_shards(odd, odd_rows, repeated, empty, documents):
    shards_hold(odd_rows, odd)
    shards_hold([tuple(r) for r in repeated.select("doc_id", "text").collect()], repeated)
    by_rows = sorted(map(tuple, shards_hold([tuple(r) for r in documents.select("doc_id", "text").collect()], documents)))
    assert by_rows == sorted(map(tuple, sharding.report(documents.repartition(7, "text")).collect()))
    assert sharding.report(empty).count() == 0


def test_written_shards(spark, odd, odd_rows, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "shards"))
    stored = spark.read.parquet(str(tmp_path / "shards")).select("shard", "slot", "row.doc_id", "row.text")
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.report(odd).collect()}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in stored.collect()} == place
    assert dict(stored.select("doc_id", "text").collect()) == dict(odd_rows)


VECTORS = "vec_id long, embedding array<float>, label int, _id string, code int, v long"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS).repartition(3)


def test_vector_codes(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in np.float32(rng.normal(size=48))], (k % 5) or None) for k in range(150)]
    rows += [(200 + k, rows[3][1], 1) for k in range(60)]  # copies: most rows share one code
    rows += [(rows[5][0], rows[9][1], 2), (None, rows[7][1], 3), (-4, [-0.0] * 48, None)]
    rows += [(900, None, 1), (901, [], 1), (902, [None] * 48, 1), (903, [float("nan")] * 48, None), (904, [float("inf")] * 48, 1)]
    assert sorted(map(str, found_any(vector_codes.report(vectors(spark, rows))))) == sorted(map(str, plain.product_codes(rows)))
    few = rows[:5]  # fewer rows than entries
    assert found(vector_codes.report(vectors(spark, few))) == sorted(plain.product_codes(few))
    assert vector_codes.report(vectors(spark, rows).limit(0)).count() == 0
    assert vector_codes.report(vectors(spark, rows[-5:])).count() == 0


def found_any(df):
    return [tuple(r) for r in df.collect()]


def test_vectors_without_codes_raise(spark):
    for bad in ([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], [(1, [0.5] * 20, 1)], [(1, [1e20] * 16, 1)]):
        with pytest.raises(Exception, match="components|component is beyond"):
            vector_codes.report(vectors(spark, bad)).count()


def test_laesa_prunes_without_loss():
    rng = np.random.default_rng(8)
    points, entries = rng.integers(-300, 300, (2000, 4)), rng.integers(-300, 300, (64, 4))
    entries[40] = entries[7]  # a tie
    pivots = vector_codes.far_apart(entries, 4)
    at, away, evaluated = vector_codes.nearest(points, vector_codes.apart(points, pivots), entries, pivots)
    every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()
    assert evaluated < 0.5 * every.size


def test_restored_vectors_have_the_reported_error(spark):
    rng = np.random.default_rng(9)
    frame = vectors(spark, [(k, [float(c) for c in np.float32(rng.normal(size=32))], 1) for k in range(90)])
    codes, book = vector_codes.compressed(frame)
    back = {r["_id"]: (r["v"], r["error"]) for r in vector_codes.restored(codes, book).collect()}
    for r in frame.collect():
        whole = np.floor(256 * np.array(r["embedding"], np.float64)).astype(np.int64)
        assert int(((whole - np.array(back[r["vec_id"]][0])) ** 2).sum()) == back[r["vec_id"]][1]


def as_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def same(got, expected):
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_manifest(spark, odd, repeated, empty, documents):
    for frame in (odd, repeated, documents):
        same(found_any(merkle.report(frame)), plain.manifest(as_rows(frame)))
    assert merkle.report(empty).count() == 0


def test_manifest_of_several_tiers(spark):
    """Groups of 1, 8, 9, 513 and 1,500 rows, a null group, and more groups than a run holds."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 513, "é": 1500, None: 70, "": 2, "Z": 3, "-": 1, "日": 2}
    rows = [(1000 * k + j, None if j % 4 else "s", g, j if j % 3 else None, f"Text {j}" if j % 5 else None) for k, (g, n) in enumerate(sizes.items()) for j in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    same(found_any(merkle.report(frame)), plain.manifest(rows))


def test_versions_share_untouched_nodes(spark, odd):
    """A version has one copy a level; where the text is unchanged the copies are the original nodes."""
    for r in merkle.versions(merkle.leaves(odd)).collect():
        assert r["copies"][-1] == r["root"] if r["copies"][0] == r["leaf"] else r["copies"][-1] != r["root"]
