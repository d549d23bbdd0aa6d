"""Sharding by a Feistel permutation over global row numbers, in DataFrame and SQL functions only.

Rows are numbered 0 .. n-1 in the order of id and text, so the numbers do not depend on files or partitions. A Feistel
network over a grid of a x b >= n places permutes the numbers; a place beyond n is sent through it again (cycle walking)
until it is below n. Place p means shard p mod `shards`, slot p div `shards`: shards differ by one row at most, slots
have no gaps, and both can be computed for any row number, as `rows_at` computes the row number of any shard and slot.

The grid is as square as n allows, so at most about sqrt(n) places lie beyond n. How often a walk must go on is not
guessed: all places beyond n that a row can reach are walked first, which is a small Spark job, and the longest walk is
the bound in the expression that all rows run.

Only ids, sizes and digests are numbered; texts are read once and not shuffled, unless `write_shards` writes them out.

Defined cases: a null text has no bytes and the digest of none; null ids come first; rows that repeat id and text are
rows of their own with neighbouring numbers; the law is `rows`, so equal texts are not kept together and `grown_shard`
is null; an empty table gives an empty result; other columns do not matter.
"""

from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraflow.llm.numbering import numbered
from moraflow.llm.texts import keyed, keyed_rows, public_id, written

SHARDS, ROUNDS, SEED = 40, 6, "moraflow"
OVERHEAD = 16  # bytes counted for a row beside its text


def grid(n: int) -> tuple[int, int]:
    """Sides a, b with a * b >= n and a * b - n < a."""
    a = max(1, isqrt(n))
    return a, max(1, -(-n // a))


def feistel(place: str, n: int, seed: str = SEED, inverse: bool = False) -> str:
    """SQL for where `place` goes in one pass over the grid of n, or, inverse, where it came from.

    Even rounds move the column c by a value that depends on the row r, odd ones the row by the column.
    """
    a, b = grid(n)
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    sign = "-" if inverse else "+"
    value = f"cast(conv(substr(md5(concat_ws(':', '{seed}', k, if(k % 2 = 0, s.r, s.c))), 1, 15), 16, 10) as bigint)"
    column = f"if(k % 2 = 0, pmod(s.c {sign} {value} % {a}L, {a}L), s.c)"
    row = f"if(k % 2 = 0, s.r, pmod(s.r {sign} {value} % {b}L, {b}L))"
    return (
        f"aggregate(array({', '.join(map(str, rounds))}), named_struct('c', {place} % {a}L, 'r', {place} div {a}L),"
        f" (s, k) -> named_struct('c', {column}, 'r', {row}), s -> s.r * {a}L + s.c)"
    )


def longest_walk(spark: SparkSession, n: int, seed: str = SEED) -> int:
    """How many further passes any row number below n needs until its place is below n.

    Only places beyond n that come from a row are walked; their walks end, as each lies on a cycle through that row.
    """
    a, b = grid(n)
    beyond = spark.range(n, a * b).filter(f"{feistel('id', n, seed, inverse=True)} < {n}L")
    bound = 8
    while True:
        step = f"named_struct('p', {feistel('t.p', n, seed)}, 'steps', t.steps + 1)"
        walk = f"aggregate(sequence(1, {bound}), named_struct('p', id, 'steps', 0), (t, i) -> if(t.p < {n}L, t, {step}))"
        ends = beyond.select(F.expr(walk).alias("w")).agg(F.max("w.p").alias("p"), F.max("w.steps").alias("steps")).first()
        if ends["p"] is None or ends["p"] < n:
            return ends["steps"] or 0
        bound *= 4


def permuted(number: str, n: int, walk: int, seed: str = SEED, inverse: bool = False) -> str:
    """SQL for the place of a row number among n, or, inverse, the row number of a place."""
    once = feistel(number, n, seed, inverse)
    if not walk:
        return once
    return f"aggregate(sequence(1, {walk}), {once}, (p, i) -> if(p < {n}L, p, {feistel('p', n, seed, inverse)}))"


def assigned(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """`rows` with `_no` (the row number in `order`), `_shard` and `_slot`."""
    numbers = numbered(rows, order)
    n = numbers.count()
    place = F.expr(permuted("_no", n, longest_walk(rows.sparkSession, n, seed), seed)) if n else F.col("_no")
    out = numbers.withColumn("_place", place)
    shard, slot = F.expr(f"cast(_place % {shards} as int)"), F.expr(f"_place div {shards}")
    return out.select(*rows.columns, "_no", shard.alias("_shard"), slot.alias("_slot"))


def rows_at(places: DataFrame, n: int, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """`places` (shard, slot) with `row_no`, the number of the row that stands there; null where none does."""
    place = "cast(slot as bigint) * {0} + shard".format(shards)
    inside = f"shard between 0 and {shards - 1} and slot >= 0 and {place} < {n}L"
    if n == 0:
        return places.withColumn("row_no", F.lit(None).cast("long"))
    number = permuted("_place", n, longest_walk(places.sparkSession, n, seed), seed, inverse=True)
    found = places.withColumn("_place", F.expr(f"if({inside}, {place}, null)"))
    return found.withColumn("row_no", F.when(F.col("_place").isNotNull(), F.expr(number))).drop("_place")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> None:
    """Whole rows (column `row`) with their `slot`, partitioned by `shard`, files in order of slots.

    A shard is cut by ranges of slots, so its size is not that of a task.
    """
    rows = assigned(keyed_rows(docs, id_col, text_col).select("_id", "_th", "_row"), ["_id", "_th"], shards, seed)
    out = rows.select(F.col("_row").alias("row"), F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame) -> DataFrame:
    sizes = keyed(docs).select(
        "_id", "_th", (F.octet_length("_text") + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(F.col("_text").cast("binary")).alias("text_crc32")
    )
    return assigned(written(sizes, "sizes"), ["_id", "_th"]).select(
        public_id().alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("_no").alias("row_no"),
    )
