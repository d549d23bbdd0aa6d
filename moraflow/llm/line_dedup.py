"""Line deduplication over documents, in DataFrame functions only.

Lines travel as hashes, written once. They are range-partitioned by (hash, document) and sorted by position within, so
that a line which a third of all documents hold is spread over as many partitions as its rows need; each partition streams
its first row of every (hash, document), only those are counted, and the answer is a bitmap for each document that ends
with the last word that loses a line. Texts are not shuffled until a caller applies the bitmaps; `without_repeats` then
moves only rows that may have one.

Defined cases: a null or empty text is one empty line; keys shorter than `min_chars` never go; a line repeated inside
one document counts as one document; rows that repeat a doc_id are one document for the count, and all of them keep the
line if that doc_id is the largest; a null doc_id is smaller than any other; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraflow.llm.texts import discard, keyed, keyed_rows, public_id, split_by_filter, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
KEY = ["_id", "_th"]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(h1, h2, _id, _th, pos) of every line of `keyed` rows whose key is long enough."""
    key = F.btrim(F.col("line"), F.lit(SPACE))
    return (
        docs.select(*KEY, F.posexplode(lines_of(F.col("_text"))).alias("pos", "line"))
        .select(*KEY, "pos", key.alias("line"))
        .filter(F.length("line") >= min_chars)
        .select(*KEY, "pos", ascii_lower(F.col("line")).alias("line"))
        .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *KEY, "pos")
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The first line of every hash and document, streamed from range partitions in the order of position.

    The ranges are those the window asks for, so no second shuffle follows, and its sort is the secondary one.
    """
    held = Window.partitionBy("h1", "h2", "_id").orderBy("pos")
    ranged = lines.select("h1", "h2", "_id", "pos").repartitionByRange("h1", "h2", "_id")
    return ranged.withColumn("nth", F.row_number().over(held)).filter("nth = 1").drop("nth")


def frequent_lines(lines: DataFrame, min_docs: int = 5) -> DataFrame:
    """(h1, h2, keeper) of the lines that at least `min_docs` documents hold; the keeper is the largest of them."""
    held = first_occurrences(lines).groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("_id").alias("keeper"))
    return held.filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_id, _th, n_dropped, keep): `keep` holds 64 keep bits in a word, up to the last word that loses a line.

    Only documents that lose a line have a row. Hashed lines and frequent lines are written once each: raw lines then
    meet a table, which Spark broadcasts or, beyond its size limit, joins with hot lines split. Both are emptied once the
    bitmaps are written.
    """
    lines = written(hashed_lines(docs, min_chars), "hashed-lines")
    frequent = written(frequent_lines(lines, min_docs), "frequent-lines")
    gone = lines.join(frequent, ["h1", "h2"]).filter(F.col("_id") != F.col("keeper"))
    # Bits of rows that repeat id and text fall together, so a line is counted once.
    words = gone.groupBy(*KEY, F.expr("cast(pos div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("gone")
    )
    entries = F.array_sort(F.collect_list(F.struct("word", "gone")))
    bitmaps = words.groupBy(*KEY).agg(F.sum(F.bit_count("gone").cast("long")).alias("n_dropped"), entries.alias("words"))
    kept = written(bitmaps.select(*KEY, "n_dropped", _dense(F.col("words")).alias("keep")), "bitmaps")
    discard(lines, frequent)
    return kept


def _dense(words: Column) -> Column:
    """Keep words from 0 to the last of the sorted `words`; those between keep all their lines."""
    before = lambda i: F.coalesce(F.get(words, i - 1)["word"], F.lit(-1))
    keep_all = lambda n: F.array_repeat(F.lit(-1).cast("long"), n)
    return F.flatten(F.transform(words, lambda w, i: F.concat(keep_all(w["word"] - before(i) - 1), F.array(F.bitwise_not(w["gone"])))))


def kept_text(text: Column, keep: Column) -> Column:
    """The text without the lines whose bit is unset."""
    kept = F.filter(lines_of(text), lambda line, i: _kept_bit(keep, i))
    return F.when(keep.isNull(), text).otherwise(F.array_join(kept, "\n"))


def _kept_bit(keep: Column, i: Column) -> Column:
    bits = F.coalesce(F.get(keep, F.shiftright(i, 6)), F.lit(-1).cast("long"))
    return F.getbit(bits, i % F.lit(64)) == F.lit(1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_id, _text, _kept, n_lines, n_dropped) for every row of `docs`."""
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(keep_bitmaps(rows, min_chars, min_docs), KEY, "left")
    return joined.select(
        "_id",
        "_text",
        kept_text(F.col("_text"), F.col("keep")).alias("_kept"),
        F.size(lines_of(F.col("_text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The rows of `docs`, with all columns, their texts without the lines that go; `size_col`, if there, follows."""
    bitmaps = keep_bitmaps(keyed(docs, id_col, text_col)).select(*KEY, "keep")
    some, none = split_by_filter(keyed_rows(docs, id_col, text_col).drop("_text"), bitmaps, KEY)
    rows = some.join(bitmaps, KEY, "left").unionByName(none.withColumn("keep", F.lit(None).cast("array<long>")))
    text = F.when(F.col("keep").isNull(), F.col("_row")[text_col]).otherwise(kept_text(F.col("_row")[text_col], F.col("keep")))
    new = rows.withColumn("_new", text)
    size = F.when(F.col("keep").isNull(), F.col("_row")[size_col]).otherwise(F.length("_new")) if size_col in docs.columns else None
    changed = {text_col: F.col("_new")} | ({size_col: size.cast(docs.schema[size_col].dataType)} if size is not None else {})
    return new.select(*(changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select(
        public_id().alias("doc_id"), "n_lines", "n_dropped", F.sha2("_kept", 256).alias("kept_sha256")
    )
