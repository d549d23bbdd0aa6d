"""Vectors compressed to short codes by product quantisation, nearest entries found with LAESA pivots.

A vector of integers (scaled components, all floors going down) is cut into PARTS consecutive parts; each part position
has a codebook of at most ENTRIES entries. The codebook starts as the parts of the rows with the smallest ids; a round
assigns every part to its nearest entry and moves each used entry to the floored mean of its parts.

Nearest entries are found by LAESA: the distances of every part to PIVOTS fixed points of its position are computed once
and written beside the vector. In a round only the distances between pivots and entries are new; for a part x and an entry
e, |d(x, p) - d(e, p)| never exceeds d(x, e), so the greatest of these differences is a lower bound. Entries are tried in
the order of their bounds, by exact integer distances, until the next bound exceeds the best distance found.

A round reads the written table once; a task adds up its parts before anything is shuffled, so at most PARTS * ENTRIES
rows leave it, whatever vector or label is frequent. The codebooks, PARTS * ENTRIES entries, are all the driver holds.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; null ids are coded but
come last in the choice of first entries; rows that repeat an id are rows of their own, in order of their vectors; fewer
rows than entries make shorter codebooks; ties go to the lower entry; an empty table gives an empty result. Vectors of
different lengths, a length that PARTS does not divide, and scaled components beyond LIMIT raise an error, as codes or
exact distances would not be defined. Other columns do not matter.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.llm.texts import written

PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
LIMIT = 1 << 26  # squared distances of parts of up to 512 components stay exact in 64 bits
SLACK = 1e-6  # relative, for distances kept in single precision; evaluated distances are exact


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(_id, _label, v array<int>) of the vectors that take part."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(F.coalesce(fine, F.lit(False)))
    beyond = F.raise_error(F.lit(f"a scaled component is beyond {LIMIT}")).cast("int")
    whole = F.transform(x, lambda e: F.when(F.abs(e * scale) < LIMIT, F.floor(e * scale).cast("int")).otherwise(beyond))
    return rows.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"), whole.alias("v"))


def cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width) integers of a column of vectors."""
    lengths = pc.unique(pc.list_value_length(column)).to_pylist()
    if lengths not in ([], [parts * width]):
        raise ValueError(f"vectors of {lengths} components where all should have {parts * width}")
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), parts, width)


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """At most `count` different points, each the farthest from those before it."""
    chosen = [0]
    away = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def apart(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """(points, others) distances in single precision."""
    out = np.empty((len(points), len(others)), np.float32)
    for k, other in enumerate(others):
        out[:, k] = np.sqrt(((points - other) ** 2).sum(axis=1))
    return out


def nearest(points: np.ndarray, known: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each point, its squared distance, and how many distances were evaluated.

    `known` are the distances of the points to the pivots.
    """
    to = apart(entries, pivots)
    low = np.zeros((len(points), len(entries)), np.float32)
    for k in range(len(pivots)):
        np.maximum(low, np.abs(known[:, k, None] - to[:, k]), out=low)
    low -= SLACK * (known.max(axis=1)[:, None] + to.max(axis=1))
    order = low.argsort(axis=1)
    best, at = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int64)
    rows, evaluated = np.arange(len(points)), 0
    for k in range(len(entries)):
        entry = order[rows, k]
        open_ = low[rows, entry] <= np.sqrt(best[rows]) * (1 + SLACK)
        rows, entry = rows[open_], entry[open_]
        if not len(rows):
            break
        evaluated += len(rows)
        found = ((points[rows] - entries[entry]) ** 2).sum(axis=1)
        better = (found < best[rows]) | ((found == best[rows]) & (entry < at[rows]))
        best[rows[better]], at[rows[better]] = found[better], entry[better]
    return at, best, evaluated


def with_pivots(rows: DataFrame, pivots: list[np.ndarray], width: int) -> DataFrame:
    """The rows with `known`, the distances of each part to the pivots of its position, part by part; written once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = cut(batch.column("v"), len(pivots), width)
            known = np.concatenate([apart(points[:, p], pivots[p]) for p in range(len(pivots))], axis=1)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * known.shape[1])
            column = pa.ListArray.from_arrays(offsets, pa.array(known.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "known"])

    schema = f"_id long, _label {rows.schema['_label'].dataType.simpleString()}, v array<int>, known array<float>"
    return written(rows.mapInArrow(measure, schema), "vector-pivots")


def assigned(batch: pa.RecordBatch, book: np.ndarray, pivots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, entry of each part, squared distance of each part) of a batch of `with_pivots`."""
    points = cut(batch.column("v"), *book.shape[::2])
    known = batch.column("known").flatten().to_numpy().reshape(len(batch), -1)
    at, apart_ = np.empty(points.shape[:2], np.int64), np.empty(points.shape[:2], np.int64)
    start = 0
    for p, fixed in enumerate(pivots):
        at[:, p], apart_[:, p], _ = nearest(points[:, p], known[:, start : start + len(fixed)], book[p], fixed)
        start += len(fixed)
    return points, at, apart_


def moved(rows: DataFrame, book: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    """The codebooks (parts, entries, width) after a round."""
    parts, entries, width = book.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            points, at, _ = assigned(batch, book, pivots)
            for p in range(parts):
                np.add.at(sums[p], at[:, p], points[:, p])
                counts[p] += np.bincount(at[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["p", "e", "n", "s"]
        )

    shares = rows.select("v", "known").mapInArrow(add_up, "p int, e int, n long, s array<long>")
    totals = shares.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[k]) for k in range(width))).alias("s"))
    out = book.copy()
    for r in totals.collect():  # at most PARTS * ENTRIES rows
        out[r["p"], r["e"]] = [s // r["n"] for s in r["s"]]
    return out


def coded(rows: DataFrame, book: np.ndarray, pivots: list[np.ndarray]) -> DataFrame:
    """(_id, _label, code, error): a byte for each part, and the squared distances added up; written once."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, at, away = assigned(batch, book, pivots)
            codes = pa.array([row.tobytes() for row in at.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), codes, pa.array(away.sum(axis=1))], names=["_id", "_label", "code", "error"])

    schema = f"_id long, _label {rows.schema['_label'].dataType.simpleString()}, code binary, error long"
    return written(rows.mapInArrow(code, schema), "vector-codes")


def compressed(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 256,
) -> tuple[DataFrame, np.ndarray] | None:
    """(_id, _label, code, error) of the vectors that take part, and the codebooks; None if there are none."""
    if not 0 < entries <= 256:
        raise ValueError("a code holds a byte for each part")
    rows = whole_vectors(vectors, id_col, vector_col, label_col, scale)
    first = rows.select("_id", "v").orderBy(F.col("_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    lengths = {len(r["v"]) for r in first}
    if len(lengths) > 1 or max(lengths) % parts:
        raise ValueError(f"vectors of {sorted(lengths)} components do not make {parts} equal parts")
    width = lengths.pop() // parts
    book = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    pivots = [far_apart(book[p], PIVOTS) for p in range(parts)]
    measured = with_pivots(rows, pivots, width)
    for _ in range(rounds):
        book = moved(measured, book, pivots)
    return coded(measured, book, pivots), book


def restored(codes: DataFrame, book: np.ndarray) -> DataFrame:
    """`codes` with `v`, the integers that the code stands for."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([list(c) for c in batch.column("code").to_pylist()], np.int64).reshape(len(batch), len(book))
            vectors = np.concatenate([book[p][at[:, p]] for p in range(len(book))], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(vectors), pa.list_(pa.int64()))], names=[*batch.schema.names, "v"])

    return codes.mapInArrow(look_up, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema) + ", v array<long>")


def book_digest(book: np.ndarray) -> str:
    return sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    out = compressed(vectors)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes, book = out
    by_label = written(codes.groupBy("_label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("_label", "_l")
    joined = codes.join(by_label, F.col("_label").eqNullSafe(F.col("_l")))
    return joined.select(F.col("_id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"))
