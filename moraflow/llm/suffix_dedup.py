"""Substring deduplication by bytes over longest-previous-factor arrays.

A suffix matters only where its first `length` bytes also start elsewhere. Runs of such places are found by their marks
(`window_runs`), equal runs are combined, and every mark that stands in different runs gets its own piece of the suffix
array: the texts of its runs, laid one after the other in document order. In suffix order, ties beyond `length` bytes
stay in order of position, so the previous smaller position of a suffix is its neighbour in a run of common prefixes of
at least `length`; that gives an earlier match (longest previous factor), and the mirrored array gives later ones.

A mark with more than window_runs.HOT different runs is not gathered in one task: its runs are cut finer, combined
again, and the windows still unclear are counted by hash in Spark, which splits and combines them, with the same answer.

keep_first=True removes later copies and keeps the first; keep_first=False removes every copy.

Defined cases: a null or empty text has no bytes; matches never cross documents; texts shorter than `length` stay whole;
rows that repeat id and text are separate places of equal strings (all go with keep_first=False, neither is later with
keep_first=True); a null id comes first.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.llm import window_runs as W
from moraflow.llm.texts import keyed, pieces, public_id

LENGTH, MARK = 200, 24
LEVELS = (8, 24)  # marks of the finer cuts
GATHER = 1 << 20  # bytes of text in one suffix array, unless a single mark has more


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def suffix_order(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """`starts` in order of the `length` bytes that follow, ties by position, and whether each ties with the one before.

    Ranks of ever longer prefixes by doubling, from 8 bytes on; a prefix of `length` bytes is two that overlap.
    """
    assert length >= 8
    padded = np.concatenate([text, np.zeros(length, np.uint8)]).astype(np.uint64)
    n, done = len(text), 8
    key = np.zeros(n + length - 7, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + len(key)]
    rank = ranks(key)
    while done < length:
        step = min(done, length - done)
        here = rank[: len(rank) - step]
        rank = ranks(here * (int(rank.max()) + 1) + rank[step:])
        done += step
    order = np.argsort(rank[starts], kind="stable")
    sorted_rank = rank[starts][order]
    return order, np.concatenate([[False], sorted_rank[1:] == sorted_rank[:-1]])


def previous_factors(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start (ascending): whether `length` bytes match at an earlier start, and at a later one."""
    order, ties = suffix_order(text, starts, length)
    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order] = ties
    later[order] = np.concatenate([ties[1:], [False]])
    return earlier, later


def run_texts(with_lists: DataFrame, length: int) -> DataFrame:
    """(h, copies, _id, _th, start, n, bytes) of the listed runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for row in batch.select([*W.KEY, "_text", "asked"]).to_pylist():
                text = row["_text"].encode()
                for r in row["asked"]:
                    out.append((r["h"], r["copies"], row["_id"], row["_th"], r["start"], r["n"], text[r["start"] : r["start"] + r["n"] + length - 1]))
            for k in range(0, len(out), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out[k : k + 8192]), TEXTS)], schema=TEXTS)

    return with_lists.mapInArrow(cut, "h long, copies long, _id long, _th long, start int, n int, bytes binary")


TEXTS = pa.schema(
    [("h", pa.int64()), ("copies", pa.int64()), ("_id", pa.int64()), ("_th", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary())]
)
FOUND = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def matched(rows: list[dict], length: int, keep_first: bool) -> pa.RecordBatch:
    """Ranges of matched windows in the rows of whole marks, which come in order of mark and place."""
    n = np.array([r["n"] for r in rows])
    size = n + length - 1
    base = np.cumsum(size) - size
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    row = np.repeat(np.arange(len(rows)), n)
    earlier, later = previous_factors(np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8), base[row] + offset, length)
    hit = earlier if keep_first else earlier | later
    new_run = offset == 0  # ranges end with their run
    begin = np.flatnonzero(hit & (new_run | ~np.concatenate([[False], hit[:-1]])))
    stop = np.flatnonzero(hit & np.concatenate([new_run[1:] | ~hit[1:], [True]]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i]["_id"] for i in row[begin]], pa.int64()), pa.array([rows[i]["_th"] for i in row[begin]], pa.int64()),
            pa.array([rows[i]["start"] + o for i, o in zip(row[begin], offset[begin].tolist())], pa.int32()),
            pa.array((stop - begin + 1).astype(np.int32)),
        ],
        schema=FOUND,
    )


def in_suffix_order(texts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(_id, _th, start, n) of the windows that match within their mark; at most window_runs.HOT rows have one mark."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= GATHER and row["h"] != held[-1]["h"]:
                    yield matched(held, length, keep_first)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield matched(held, length, keep_first)

    dealt = texts.repartition("h").sortWithinPartitions("h", "_id", "_th", "start")
    return dealt.mapInArrow(gather, "_id long, _th long, start int, n int")


def repeated_windows(docs: DataFrame, length: int = LENGTH, mark: int = MARK, keep_first: bool = False) -> DataFrame:
    """(_id, _th, start, n): windows of `keyed` rows that also start elsewhere, or earlier."""
    known, asked = W.repeats(docs, length, mark, words=False, keep_first=keep_first, levels=LEVELS)
    found = in_suffix_order(run_texts(W.fetched(docs, asked), length), length, keep_first)
    return known.unionByName(found)


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, mark: int = MARK, keep_first: bool = True
) -> DataFrame:
    """(_id, n_bytes, n_removed, n_spans, kept) for every row; kept holds the remaining bytes."""
    rows = keyed(docs, id_col, text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for row in batch.select(["_id", "_text", "ranges"]).to_pylist():
                text = row["_text"].encode()
                if row["ranges"]:
                    gone = W.covered(row["ranges"], len(text), length)
                    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    out.append((row["_id"], len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
                else:
                    out.append((row["_id"], len(text), 0, 0, text))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), KEPT)], schema=KEPT)

    return W.with_ranges(rows, repeated_windows(rows, length, mark, keep_first)).mapInArrow(
        apply, "_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


KEPT = pa.schema([("_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def report(docs: DataFrame) -> DataFrame:
    """All copies go, the first as well."""
    return dedup(docs, keep_first=False).select(
        public_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
