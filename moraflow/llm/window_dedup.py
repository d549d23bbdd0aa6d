"""Substring deduplication by words: Rabin-Karp hashes of every window of `width` words, counted in Spark.

A window goes where its words also start earlier (smaller id, or the same document at an earlier word); the words that
such windows cover merge into maximal removal intervals. `window_runs` says how windows travel.

Defined cases: a null or empty text has no words; a text shorter than a window keeps all; windows are judged on the
input; rows that repeat an id with another text are ordered by the hash of the text; rows that repeat id and text are
one place, so neither is a later copy of the other; a null id comes first.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.llm import window_runs as W
from moraflow.llm.texts import keyed, pieces, public_id

WIDTH, MARK = 20, 8
LEVELS = (8,)  # marks of the finer cuts


def later_windows(docs: DataFrame, width: int = WIDTH, mark: int = MARK) -> DataFrame:
    """(_id, _th, start, n): windows of `keyed` rows whose words also start earlier."""
    known, asked = W.repeats(docs, width, mark, words=True, keep_first=True, levels=LEVELS)
    return known.unionByName(W.counted_windows(docs, asked, width, words=True, keep_first=True))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, mark: int = MARK) -> DataFrame:
    """(_id, n_words, n_removed, kept, intervals) for every row; intervals are maximal (first word, end word) pairs."""
    rows = keyed(docs, id_col, text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for row in batch.select(["_id", "_text", "ranges"]).to_pylist():
                words = row["_text"].encode().split()
                gone = W.covered(row["ranges"], len(words), width)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if row["ranges"] else b" ".join(words)
                edges = W.np.flatnonzero(W.np.diff(gone.astype("i1"), prepend=0, append=0)).reshape(-1, 2).tolist()
                out.append({"_id": row["_id"], "n_words": len(words), "n_removed": int(gone.sum()), "kept": kept.decode(), "intervals": edges})
            yield pa.RecordBatch.from_pylist(out, schema=TARGET)

    return W.with_ranges(rows, later_windows(rows, width, mark)).mapInArrow(
        apply, "_id long, n_words long, n_removed long, kept string, intervals array<array<int>>"
    )


TARGET = pa.schema(
    [("_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("intervals", pa.list_(pa.list_(pa.int32())))]
)


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs).select(public_id().alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
