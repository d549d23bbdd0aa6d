"""Operators against plain versions: hand-made odd rows and the smallest driver tables."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from moraflow.llm import bpe, decontamination, line_dedup, metric_topk, pii, secrets, shingle_join, suffix_dedup, toxicity, window_dedup, window_runs
from tests.compare import connect, difference
from tests.llm import plain
from tests.llm.conftest import found, pairs

REPORTS = {
    "suffix": suffix_dedup.report, "window": window_dedup.report, "shingle": shingle_join.report, "pii": pii.find, "secrets": secrets.scan,
    "line": line_dedup.report, "bpe": lambda d: bpe.encode_and_decode(d, public_tokenizers.path("byte_bpe_50k.json")),
}


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup(odd, documents, odd_rows, monkeypatch, hot):
    monkeypatch.setattr(window_runs, "HOT", hot)
    assert found(suffix_dedup.report(odd)) == sorted(plain.suffix_dedup(odd_rows))
    if hot == 1:
        assert found(suffix_dedup.report(documents)) == sorted(plain.suffix_dedup(pairs(documents)))


def test_suffix_dedup_keeps_the_first(odd, odd_rows):
    kept = {r["_id"]: r for r in suffix_dedup.dedup(odd, keep_first=True).select("_id", "n_removed", "n_bytes").collect()}
    assert kept[7]["n_removed"] == 0 and kept[8]["n_removed"] == kept[8]["n_bytes"]


def test_previous_factors():
    text = np.frombuffer(b"abcdefghij" * 3 + b"zz", np.uint8)
    earlier, later = suffix_dedup.previous_factors(text, np.arange(len(text) - 9), 10)
    strings = [bytes(text[k : k + 10]) for k in range(len(text) - 9)]
    assert earlier.tolist() == [s in strings[:k] for k, s in enumerate(strings)]
    assert later.tolist() == [s in strings[k + 1 :] for k, s in enumerate(strings)]


@pytest.mark.parametrize("hot", [1000, 1])
def test_window_dedup(odd, odd_rows, monkeypatch, hot):
    monkeypatch.setattr(window_runs, "HOT", hot)
    assert found(window_dedup.report(odd)) == sorted(plain.window_dedup(odd_rows))


def test_shingle_join(odd, odd_rows):
    assert found(shingle_join.report(odd)) == sorted(plain.shingle_groups(odd_rows))


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    b = np.concatenate([a[40:], rng.integers(0, 1 << 63, 25, dtype=np.uint64)])
    differ = sum(int(x ^ y & (2**64 - 1)).bit_count() for x, y in zip(shingle_join.parity(a).view(np.uint64).tolist(), shingle_join.parity(b).view(np.uint64).tolist()))
    assert 0 < differ <= 65


def test_pii(odd, odd_rows, documents):
    for frame, rows in ((odd, odd_rows), (documents, pairs(documents))):
        expected = []
        for i, t in rows:
            s = plain.pii(t)
            expected.append((i, *[sum(x[1] == k for x in s) for k in range(4)], plain.sha(plain.listing(s, pii.BASE_KINDS).encode())))
        assert [r[:6] for r in found(pii.find(frame))] == sorted(expected)
    spans = dict((r[0], r[6]) for r in found(pii.find(odd)))
    assert any("account:" in s and "url:" in s for s in spans.values())


def test_secrets(odd, odd_rows, documents):
    for frame, rows in ((odd, odd_rows), (documents, pairs(documents))):
        expected = []
        for i, t in rows:
            s = plain.secrets(t)
            expected.append((i, *[sum(x[1] == k for x in s) for k in range(3)], plain.sha(plain.listing(s, secrets.BASE).encode())))
        assert [r[:5] for r in found(secrets.scan(frame))] == sorted(expected)
    spans = {t: r[5] for r, (i, t) in zip(found(secrets.scan(odd)), odd_rows)}
    linked = next(s for t, s in spans.items() if t and t.startswith("user = admin"))
    alone = next(s for t, s in spans.items() if t and t.startswith("password=tiny12"))
    assert [x.split(":")[0] for x in linked.split(",")][:3] == ["user", "weak", "endpoint"] and alone == ""


def test_line_dedup(odd, odd_rows, documents):
    assert found(line_dedup.report(odd)) == sorted(plain.line_dedup(odd_rows))
    assert found(line_dedup.report(documents)) == sorted(plain.line_dedup(pairs(documents)))


def test_line_bitmaps_of_long_documents(spark):
    """Lines that go stand in far words of a bitmap, with words between that lose none, and in runs of the same line."""
    common = "a line that many documents hold, long enough to count"
    rows = [(k, common) for k in range(6)]
    rows.append((6, "\n".join(common if k in (0, 64, 700, 5000) else f"line {k} of its own, which no other document has" for k in range(5200))))
    rows += [(7, "\n".join([common] * 3000)), (8, "\n".join([common, "short"] * 130)), (9, common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(line_dedup.report(docs)) == sorted(plain.line_dedup(rows))
    keyed = docs.selectExpr("doc_id as _id", "xxhash64(text) as _th", "text as _text")
    sizes = {r._id: (r.n_dropped, len(r.keep)) for r in line_dedup.keep_bitmaps(keyed).collect()}
    assert sizes[6] == (4, 79) and sizes[7] == (3000, 47) and sizes[8] == (130, 5) and 9 not in sizes


def test_first_lines_are_streamed_from_sorted_ranges(spark):
    """The secondary sort stays in the plan, and the window takes the ranges as they are."""
    lines = spark.createDataFrame([(1, 2, k % 7, 3, k) for k in range(100)], "h1 long, h2 long, _id long, _th long, pos int")
    first = line_dedup.first_occurrences(lines)
    assert found(first.select("_id", "pos")) == [(k, k) for k in range(7)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "hashpartitioning" not in plan
    assert "pos#" in plan.split("Sort [", 1)[1].split("]", 1)[0]


def test_bpe_equals_the_library(odd, odd_rows, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for frame, rows in ((odd, odd_rows), (documents, pairs(documents))):
        expected = []
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            back = library.decode(ids, skip_special_tokens=False)
            expected.append((i, len(ids), plain.sha(",".join(map(str, ids)).encode()), plain.sha(back.encode())))
        assert found(REPORTS["bpe"](frame)) == sorted(expected)


def test_top_k(spark, sf_dir):
    odd = [(k, [float((k * j) % 7) - 3.3 for j in range(1, 5)]) for k in range(120)]
    odd += [(200, None), (250, []), (300, [1.0, None, 1.0, 1.0]), (350, [float("nan")] * 4), (400, [float("inf")] * 4), (450, [0.5, 0.5]), (401, [0.1, 0.9])]
    odd += [(500 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(200)]  # copies: ties go to the smaller id
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    assert found(metric_topk.report(frame)) == sorted(plain.top_products(odd))
    assert metric_topk.report(frame.limit(0)).count() == 0


def test_decontamination(spark, documents, sf_dir, monkeypatch):
    items = [(1, "If Ann has 12 apples and 30 km to walk, how many hours does Ann need in all?"), (2, None), (3, "short item"), (4, "If Ann has 12 apples and 30 km to walk, how many hours does Ann need in all?")]
    docs = [
        (1, "Before. If Bob has 7 apples and 41 miles to walk, how many hours does Bob need in all? After"),
        (2, "If Bob has 7 apples and 41 miles to walk, how many hours does Eve need in all?"),
        (3, "Quite another text about apples and walks, with no question in it at all, long enough to be cut."),
        (4, None), (5, ""), (1, "Before. If Bob has 7 apples and 41 miles to walk, how many hours does Bob need in all? After"),
    ]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r[:2] for r in found(decontamination.report(frame, bench))}
    assert got == {(1, 1), (1, 4)}
    assert decontamination.clean(frame, bench).count() == 4
    # the driver's tables: items stand whole or by more than half of their windows
    table = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    real = {r[:2] for r in found(decontamination.report(documents, table))}
    import re

    words = re.compile(r"[^\W_]+")
    held = {i: " " + " ".join(words.findall((t or "").lower())) + " " for i, t in pairs(documents)}
    whole = {(d, r["item_id"]) for r in table.collect() for d, t in held.items() if " " + " ".join(words.findall(r["text"].lower())) + " " in t}
    assert whole <= real
    assert real == plain.held_items(pairs(documents), [(r["item_id"], r["text"]) for r in table.collect()])
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert {r[:2] for r in found(decontamination.report(documents, table))} == real


def test_decontamination_of_short_passages_at_any_offset(spark):
    bench = spark.createDataFrame([(1, "seven green birds sing quite loudly")], "item_id long, text string")
    docs = [(k, "word " * k + "seven green birds sing quite loudly " + "end " * 9) for k in range(9)] + [(50, "seven green birds sing very loudly")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r[0] for r in found(decontamination.report(frame, bench))} == set(range(9))


def test_decontamination_holds_no_text_per_window(spark, monkeypatch):
    """Rows of windows that had all tokens of their text would take 50 GB here; a benchmark above the limit is not broadcast."""
    question = "If Bob has 7 apples and 41 miles to walk, how many hours does Bob need in all?"
    long_ = " ".join(f"w{k % 991} {k}" for k in range(20_000)) + " so " + question
    frame = spark.createDataFrame([(1, long_), (2, "some " + question), (3, "quite another text of more than six words")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, question) for k in range(50)] + [(90, question.replace("hours", "days"))], "item_id long, text string")
    expected = {(d, i) for d in (1, 2) for i in [*range(50), 90]}
    assert {r[:2] for r in found(decontamination.report(frame, bench))} == expected
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    report = decontamination.report(frame, bench)
    assert {r[:2] for r in found(report)} == expected and "SortMergeJoin [h#" in report._jdf.queryExecution().toString()
    assert [r.doc_id for r in decontamination.clean(frame, bench).collect()] == [3]


def test_long_runs_of_one_kind(spark, empty):
    long_ = [c * 1_000_000 for c in ("-", " ", ",", "7", "A", "1,", "Aa ", "#")] + ["0" * 5000 + ".1.1.1", "+" + "1" * 5000, "iban " + "1" * 5000]
    question = "how many red apples does she need in all"
    frame = spark.createDataFrame([(k, t + " " + question) for k, t in enumerate(long_)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, question)], "item_id long, text string")
    assert {r[0] for r in found(decontamination.report(frame, bench))} == set(range(len(long_)))
    assert decontamination.report(empty, bench).count() == decontamination.report(frame, bench.limit(0)).count() == 0
    got = {r["doc_id"]: r["spans"] for r in pii.find(frame).collect()}
    assert got[8] == "ip:0:5006" and len(got) == len(long_)


def test_toxicity_held_out_accuracy(spark):
    rng = np.random.default_rng(3)
    plain_words = [a + b for a in ("ka", "lo", "mi", "ter", "un") for b in ("", "ra", "sen", "dol", "vi")]
    slurs = ["blargfist", "snotwump", "grubface"]
    rows, labels = [], []
    for i in range(900):
        w = [plain_words[k] for k in rng.integers(0, len(plain_words), 80)]
        toxic = i % 4 == 0
        if toxic:
            for k in rng.integers(0, 80, 3):
                w[k] = slurs[int(rng.integers(0, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (5, rows[5][1]), (None, "kara lo")]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(5000, 1), (None, 0), (7, None)], "doc_id long, toxic int")
    got = toxicity.report(docs, lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["predicted"], dict(labels)[r["doc_id"]]) for r in got if r["held_out"]]
    assert len(held) > 200 and np.mean([p == y for p, y in held]) > 0.97
    assert toxicity.report(docs, lab.limit(0)).filter("predicted = 1").count() == 0


@pytest.mark.parametrize("name", REPORTS)
def test_empty_and_repeated_rows(name, empty, repeated):
    assert REPORTS[name](empty).count() == 0
    assert REPORTS[name](repeated).count() == repeated.count()
    ids = [r[0] for r in REPORTS[name](repeated).select("doc_id").collect()]
    assert sorted(ids, key=str) == sorted((r[0] for r in repeated.select("doc_id").collect()), key=str)


def test_repeated_ids_are_one_vertex(repeated):
    roots = {(r["doc_id"], r["component_id"]) for r in shingle_join.report(repeated).filter("doc_id = 13").collect()}
    assert len(roots) == 1


@pytest.mark.parametrize("name", ["op3_metric_topk", "op4_window_dedup", "op5_shingle_join", "op10_line_dedup", "op12_vector_codes"])
def test_registered_queries_match_their_oracle(spark, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None


def test_stages_keep_columns_and_clean_rows(spark, sf_dir, odd, odd_rows):
    import corpus_pipeline

    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        if name == "toxicity":
            assert out.count() <= docs.count()
            continue
        if name == "line_dedup":
            texts = {r["doc_id"]: plain.sha((r["text"] or "").encode()) for r in out.collect()}
            assert texts == {i: s for i, _, _, s in plain.line_dedup(odd_rows)}
            continue
        if name == "shingle_join":
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, n, root in plain.shingle_groups(odd_rows) if i == root)
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.filter(F.col("n_tokens") >= 0).count() > 100


def test_toxicity_window_sample_is_the_least_by_hash_without_shuffled_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    texts = [(i, f"copied words of document {i % 9} " * (3 + i % 5) if i % 2 else f"own words {i * 7919} of {i} " * 8) for i in range(400)]
    rows = spark.createDataFrame(texts, "_id long, _text string")
    labelled = spark.createDataFrame([(i, int(i % 4 == 1)) for i in range(300)], "_id long, toxic int")
    learnt = {r["_id"] for r in rows.filter(toxicity.learnt(0)).select("_id").collect()}
    assert toxicity.likely_windows(rows, labelled).keys() == {0, 1}
    for kind in (0, 1):
        every = {w for i, t in texts if i in learnt and i < 300 and (i % 4 == 1) == bool(kind) for w in toxicity.windows(t.encode())}
        ordered = spark.createDataFrame([(bytearray(w),) for w in every], "w binary").orderBy(F.xxhash64("w"), "w").collect()
        for likely in (1, 200, 10**6):  # too few windows are let in at first by the last
            assert toxicity.window_sample(rows, labelled, kind, likely) == [bytes(r["w"]) for r in ordered[:40]]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = toxicity.class_windows(rows, labelled, 1, 0.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    cut, scan = plan.split("MapInArrow", 1)[0], plan.split("MapInArrow", 1)[1].split("Scan", 1)[0]
    assert "SortMergeJoin" in cut and "Exchange" in cut and "Exchange" not in scan
