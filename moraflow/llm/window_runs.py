"""Repeated fixed-length windows over all documents: what window and suffix deduplication share.

Windows travel as runs that share a content-chosen mark (`hashing.cuts`), one row for several windows. A mark that occurs
once in the corpus cannot hold a repeated window, so its run goes no further. Equal runs are combined; only runs whose
mark also stands in a different run are looked at closely: up to HOT runs of a mark by the caller; those of marks with
more are cut again, by several marks at once, and combined again, level by level with more marks. A window that holds a
change which no other copy has shares all of many marks with no other, so of a passage with changes in each copy few
windows remain, and these are counted one by one. Both ways are exact. Every step is a combined aggregation or a join of
raw rows with one row for each key, which adaptive execution can split, so no group meets in one task.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.llm.hashing import Units, cuts, mix, prefix_sums, sliding
from moraflow.llm.texts import pieces, written

KEY = ["_id", "_th"]
HOT = 1000  # different runs of a mark that may meet in one task
RUN = "h long, s long, _id long, _th long, start int, n int"


def runs(docs: DataFrame, width: int, mark: int, words: bool) -> DataFrame:
    """Every run of windows of `keyed` rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = cuts(Units([t.encode() for t in batch.column("_text").to_pylist()], words), width, mark)
            text = pa.array(found["text"])
            for k in range(0, len(text), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found["h"][part]), pa.array(found["s"][part]),
                        batch.column("_id").take(text[part]), batch.column("_th").take(text[part]),
                        pa.array(found["start"][part].astype(np.int32)), pa.array(found["n"][part].astype(np.int32)),
                    ],
                    names=["h", "s", *KEY, "start", "n"],
                )

    return docs.select(*KEY, "_text").mapInArrow(cut, RUN)


def repeated(docs: DataFrame, width: int, mark: int, words: bool) -> DataFrame:
    """The runs whose mark occurs more than once."""
    every = written(runs(docs, width, mark, words), "runs")
    twice = every.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    return written(every.join(twice, "h"), "repeated-runs")


def distinct_runs(occurrences: DataFrame) -> DataFrame:
    """One row for each content: h, s, n, copies, and its first place."""
    return occurrences.groupBy("h", "s").agg(
        F.count("*").alias("copies"), F.min(F.struct(*KEY, "start")).alias("place"), F.first("n").alias("n")
    )


def unclear(distinct: DataFrame) -> DataFrame:
    """Those whose mark also stands in another content, with the number of contents of that mark."""
    marks = distinct.groupBy("h").agg(F.count("*").alias("contents")).filter("contents > 1")
    return distinct.join(marks, "h").select("h", "s", "copies", "place.*", "n", "contents")


def fetched(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The documents in which a run of `asked` has its first place, each with the list of them."""
    lists = asked.groupBy(*KEY).agg(F.collect_list(F.struct("h", "start", "n", "copies")).alias("asked"))
    return docs.join(lists, KEY)


def finer(with_lists: DataFrame, width: int, mark: int, words: bool, marks: int) -> DataFrame:
    """The listed runs, cut by `marks` marks: (h, s, _id, _th, start, n)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            runs = []
            for row, (text, asked) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("asked").to_pylist())):
                units = text.encode().split() if words else text.encode()
                for r in asked:
                    part = units[r["start"] : r["start"] + r["n"] + width - 1]
                    runs.append((row, r["start"], b" ".join(part) if words else part))
                    if len(runs) >= 2048:
                        yield _finer(batch, runs, width, mark, words, marks)
                        runs = []
            if runs:
                yield _finer(batch, runs, width, mark, words, marks)

    return with_lists.mapInArrow(cut, RUN)


def _finer(batch: pa.RecordBatch, runs: list[tuple], width: int, mark: int, words: bool, marks: int) -> pa.RecordBatch:
    found = cuts(Units([r[2] for r in runs], words), width, mark, marks)
    row, begin = np.array([r[0] for r in runs])[found["text"]], np.array([r[1] for r in runs])[found["text"]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(found["h"]), pa.array(found["s"]), batch.column("_id").take(pa.array(row)), batch.column("_th").take(pa.array(row)),
            pa.array((begin + found["start"]).astype(np.int32)), pa.array(found["n"].astype(np.int32)),
        ],
        names=["h", "s", *KEY, "start", "n"],
    )


def copies_of(occurrences: DataFrame, distinct: DataFrame, keep_first: bool) -> DataFrame:
    """(_id, _th, start, n) of the runs whose content also stands elsewhere, or earlier."""
    twice = distinct.filter("copies > 1")
    if keep_first:
        found = occurrences.join(twice.select("h", "s", "place"), ["h", "s"]).filter(F.struct(*KEY, "start") > F.col("place"))
    else:
        found = occurrences.join(twice.select("h", "s"), ["h", "s"])
    return found.select(*KEY, "start", "n")


def repeats(
    docs: DataFrame, width: int, mark: int, words: bool, keep_first: bool, levels: tuple[int, ...]
) -> tuple[DataFrame, DataFrame]:
    """Ranges of windows (_id, _th, start, n) known to repeat, and the runs left to the caller, at most HOT of a mark.

    `levels` holds the number of marks of each finer cut of the runs of hot marks.
    """
    occurrences = repeated(docs, width, mark, words)
    distinct = distinct_runs(occurrences)
    asked = unclear(distinct)
    known, left = copies_of(occurrences, distinct, keep_first), asked.filter(F.col("contents") > HOT)
    for marks in levels:
        fine = written(finer(fetched(docs, left), width, mark, words, marks), "finer-runs")
        distinct = distinct_runs(fine)
        known, left = known.unionByName(copies_of(fine, distinct, keep_first)), unclear(distinct)
    edges = counted_windows(docs, left, width, words, keep_first)
    return known.unionByName(edges), asked.filter(F.col("contents") <= HOT)


def counted_windows(docs: DataFrame, asked: DataFrame, width: int, words: bool, keep_first: bool) -> DataFrame:
    """(_id, _th, start, n): windows of the asked runs whose hash is counted more than once."""
    places = windows(fetched(docs, asked), width, words)
    at = F.struct(*KEY, "pos")
    first = places.groupBy("h", "w").agg(F.min(at).alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    found = places.join(first, ["h", "w"])
    if keep_first:
        found = found.filter(at > F.col("first"))
    return found.select(*KEY, F.col("pos").alias("start"), F.lit(1).alias("n"))


def windows(with_lists: DataFrame, width: int, words: bool) -> DataFrame:
    """(h, w, copies, _id, _th, pos) of every window of the listed runs; w is the Rabin-Karp hash of the window."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            units = Units([t.encode() for t in batch.column("_text").to_pylist()], words)
            every = mix(sliding(prefix_sums(units.values), width)).view(np.int64)
            lists = batch.column("asked")
            row, flat = lists.value_parent_indices(), lists.flatten()
            h, start, n, copies = (flat.field(k).to_numpy() for k in range(4))
            row = row.to_numpy()
            for k in range(0, len(row), 4096):
                part = slice(k, k + 4096)
                m = n[part]
                offset = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
                pos = np.repeat(start[part], m) + offset
                text = np.repeat(row[part], m)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(h[part], m)), pa.array(every[units.bounds[text] + pos]), pa.array(np.repeat(copies[part], m)),
                        batch.column("_id").take(pa.array(text)), batch.column("_th").take(pa.array(text)), pa.array(pos.astype(np.int32)),
                    ],
                    names=["h", "w", "copies", *KEY, "pos"],
                )

    return with_lists.mapInArrow(hashed, "h long, w long, copies long, _id long, _th long, pos int")


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every document with the list `ranges` of (start, n) windows that repeat, null if none does."""
    lists = ranges.groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    return docs.join(lists, KEY, "left")


def covered(ranges: list[dict] | None, size: int, width: int) -> np.ndarray:
    """Mask of the units that the windows of `ranges` cover."""
    change = np.zeros(size + 1, np.int64)
    if ranges:
        start = np.array([r["start"] for r in ranges])
        end = np.minimum(start + np.array([r["n"] for r in ranges]) + width - 1, size)
        np.add.at(change, start, 1)
        np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0
