"""Toxicity by compression distance: a zstandard dictionary of ordinary text against one of toxic text.

Fitting uses a bounded sample of labelled windows (SAMPLE of each class, the least by hash, from all of their texts).
The ordinary dictionary is trained on windows of ordinary texts. The toxic one holds the same plus what toxic text has of
its own: stretches whose byte n-grams occur in toxic windows RATIO times as often as in ordinary ones. So a window
compresses better with the toxic dictionary only where it holds such a stretch. A text is cut at spaces into windows of
about WINDOW bytes; from the differences of the compressed lengths of all its windows come five numbers, and a logistic
curve over them, fitted on other labelled documents (CALIBRATE of each class), gives the score and so the thresholds.

Labels are used of rows whose crc32(doc_id) modulo 3 is not 1; neither label nor language, source or id enter a score.

Defined cases: a null text is empty and one empty window; labels null or of documents that are not there are left out;
conflicting labels of a document count as toxic; without labels of both classes every score is 0; rows that repeat a
doc_id are scored each; texts of any length are read window by window.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.llm.texts import keyed, pieces, public_id, split_by_filter

WINDOW, SLIDE = 64, 12
SAMPLE, CALIBRATE = 60_000, 4_000
GRAM, RATIO, LEAST = 5, 20, 8
ORDINARY_BYTES, TOXIC_BYTES = 7_000, 4_000
THRESHOLD = 0.7


def windows(text: bytes) -> Iterator[bytes]:
    """Consecutive pieces of about WINDOW bytes, cut at a space where one is near."""
    at, size = 0, len(text)
    while size - at > WINDOW:
        end = text.find(b" ", at + WINDOW - SLIDE, at + WINDOW + SLIDE)
        end = at + WINDOW if end < 0 else end
        yield text[at:end]
        at = end
    yield text[at:]


def grams(piece: bytes) -> set[bytes]:
    return {piece[k : k + GRAM] for k in range(len(piece) - GRAM + 1)}


def own_stretches(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Maximal stretches of words in toxic windows covered by n-grams that ordinary windows hardly have, rare ones first."""
    in_toxic, in_ordinary = Counter(), Counter()
    for w in toxic:
        in_toxic.update(grams(w))
    wanted = {g for g, c in in_toxic.items() if c >= LEAST}
    for w in ordinary:
        in_ordinary.update(grams(w) & wanted)
    scale = RATIO * len(toxic) / max(1, len(ordinary))
    marked = {g for g in wanted if in_toxic[g] >= scale * (in_ordinary[g] + 0.5)}
    found = Counter()
    for w in toxic:
        for word in w.split():
            word = b" " + word.strip(b".,;:!?") + b" "
            at = 0
            while at <= len(word) - GRAM:
                end = at
                while end <= len(word) - GRAM and word[end : end + GRAM] in marked:
                    end += 1
                if end > at:
                    found[word[at : end + GRAM - 1]] += 1
                at = end + 1
    kept = [s for s, c in found.items() if c >= LEAST // 2]
    return sorted(kept, key=lambda s: (found[s], s))


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES + 1024, ordinary).as_bytes()[-ORDINARY_BYTES:]
    except zstandard.ZstdError:  # too few windows to train on: they are the dictionary
        base = b" ".join(ordinary)[-ORDINARY_BYTES:]
    return b"\0".join(own_stretches(toxic, ordinary))[-TOXIC_BYTES:] + b" " + base, base


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Thorough search with matches of five bytes or more, no frame extras."""
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_BTLAZY2, window_log=14, chain_log=14, hash_log=14, search_log=6, min_match=5,
        target_length=64, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how)


def measures(text: str, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """From the bytes that the toxic dictionary saves in each window: the most, and how many windows save 2, 3 and 4."""
    saved = Counter(max(0, len(ordinary.compress(w)) - len(toxic.compress(w))) for w in windows(text.lower().encode()))
    count = sum(saved.values())
    at_least = [sum(c for s, c in saved.items() if s >= k) for k in (2, 3, 4)]
    share = np.log1p(at_least[1]) - np.log1p(count) / 2
    return min(max(saved), 8), np.log1p(at_least[0]), np.log1p(at_least[1]), np.log1p(at_least[2]), share, np.log1p(count)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights by Newton's method, classes weighed alike; the last is the constant."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge * w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def measured(docs: DataFrame, dicts: tuple[bytes, bytes]) -> DataFrame:
    """(_id, m): the measures of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary = map(compressor, dicts)
        for batch in pieces(batches):
            m = [measures(t, toxic, ordinary) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(m, pa.list_(pa.float64()))], names=["_id", "m"])

    return docs.select("_id", "_text").mapInArrow(run, "_id long, m array<double>")


def class_windows(rows: DataFrame, labelled: DataFrame, toxic: int, share: float) -> DataFrame:
    """(w): the distinct windows of a class whose hash lies in the lowest `share` of all hashes.

    Windows meet the labels after they are cut and chosen by hash, so whole texts are never shuffled, nor are windows of
    texts that cannot be of the class.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for key, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                some = list(windows(text.lower().encode()))
                for k in range(0, len(some), 8192):
                    w = pa.array(some[k : k + 8192], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(w), pa.int64()), w], names=["_id", "w"])

    cuts = rows.filter(learnt(0)).select("_id", "_text").mapInArrow(cut, "_id long, w binary")
    few = cuts.filter(F.xxhash64("w") < int(share * 2**64) - 2**63) if share < 1 else cuts
    ids = labelled.filter(learnt(0) & (F.col("toxic") == toxic)).select("_id")
    some, _ = split_by_filter(few, ids, ["_id"])
    return some.join(ids, "_id").select("w").distinct()


def window_sample(rows: DataFrame, labelled: DataFrame, toxic: int, likely: int) -> list[bytes]:
    """At most SAMPLE distinct windows, the least by hash, from all texts of a class.

    `labelled` has (_id, toxic), one row for each id; `likely` is about how many windows the class has. Where copies leave
    too few windows of small hash, more are let in.
    """
    share = 2 * SAMPLE / max(1, likely)
    while True:
        found = class_windows(rows, labelled, toxic, share).orderBy(F.xxhash64("w"), "w").limit(SAMPLE).collect()
        if share >= 1 or len(found) == SAMPLE:
            return [bytes(r["w"]) for r in found]
        share *= 4


def learnt(part: int) -> Column:
    """Ids that may be learnt from, halved by hash: 0 for the dictionaries, 1 for the calibration."""
    return ~held_out(F.col("_id")) & (F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(2)) == part)


def likely_windows(rows: DataFrame, labelled: DataFrame) -> dict[int, int]:
    """About how many windows the texts of each class have, from their lengths alone."""
    sizes = rows.filter(learnt(0)).select("_id", F.ceil((F.octet_length("_text") + 1) / WINDOW).alias("k"))
    found = sizes.join(labelled.filter(learnt(0)), "_id").groupBy("toxic").agg(F.sum("k").alias("k"))
    return {r["toxic"]: r["k"] for r in found.collect()}


def fit(rows: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "toxic"):
    """((toxic dictionary, ordinary dictionary), weights), or None without labels of both classes."""
    named = labels.select(F.col(label_id).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic")).filter("_id is not null and toxic is not null")
    named = named.filter(~held_out(F.col("_id"))).groupBy("_id").agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    likely = likely_windows(rows, named)
    toxic, ordinary = (window_sample(rows, named, k, likely[k]) if k in likely else [] for k in (1, 0))
    if not toxic or not ordinary:
        return None
    dicts = dictionaries(toxic, ordinary)
    chosen = [named.filter(learnt(1) & (F.col("toxic") == k)).orderBy(F.xxhash64("_id"), "_id").limit(CALIBRATE) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    known = measured(rows.join(chosen.select("_id"), "_id"), dicts).join(chosen, "_id").select("m", "toxic").limit(4 * CALIBRATE).collect()
    y = np.array([r["toxic"] for r in known])
    if len(set(y.tolist())) < 2:
        return None
    return dicts, logistic(np.array([r["m"] for r in known]), y)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(_id, _th, score) for every row of `docs`."""
    rows = keyed(docs, id_col, text_col)
    model = fit(rows, labels, label_id, label_col)
    if model is None:
        return rows.select("_id", "_th", F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(*model)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), pa.array(score(batch.column("_text")))], names=["_id", "_th", "score"])

    return rows.mapInArrow(run, "_id long, _th long, score double")


def scorer(dicts: tuple[bytes, bytes], weights: np.ndarray):
    """Function from a column of texts to their scores."""
    toxic, ordinary = map(compressor, dicts)

    def score(texts: pa.Array) -> np.ndarray:
        m = np.array([measures(t or "", toxic, ordinary) for t in texts.to_pylist()])
        return 1 / (1 + np.exp(-np.clip(m @ weights[:-1] + weights[-1], -30, 30)))

    return score


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, whose score is below THRESHOLD."""
    model = fit(keyed(docs, id_col, text_col), labels)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(*model)
        for batch in pieces(batches, text_col):
            yield batch.filter(pa.array(score(batch.column(text_col)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scores(docs, labels)
    doc_id = public_id()
    return found.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
