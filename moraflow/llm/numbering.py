"""Gapless row numbers in a given order, without a task that sees all rows.

Rows are range-partitioned and sorted by the order, written once, and numbered by their partition's start plus their
place in it. The starts are running counts over one row for each partition (and group), so the only table that a window
orders has as many rows as there are partitions and groups together.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraflow.llm.texts import written

PLACE_BITS = 33  # monotonically_increasing_id() holds the partition above these


def numbered(rows: DataFrame, order: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """`rows` with `_no`, from 0 up in `order`, and `_of`, how many there are.

    With `within`, the first columns of `order`, each group counts anew. `rows` are computed twice, as ranges are found by
    a sample, so what is dear to compute should be written before.

    Rows that tie in the whole order get their numbers in any order; nulls come first. A tie is split over partitions too,
    as the row's place in the scan is the last key of the ranges.
    """
    placed = rows.withColumn("_mid", F.monotonically_increasing_id())
    sorted_rows = placed.repartitionByRange(*order, "_mid").sortWithinPartitions(*order, "_mid")
    kept = written(sorted_rows.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_mid", PLACE_BITS)
    spans = kept.groupBy(part.alias("_part"), *within).agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*within)
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(spans.select("_part", *within, (before - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("_of")), "starts")
    same: Column = F.col("l._part") == F.col("r._part")
    for c in within:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    joined = kept.withColumn("_part", part).alias("l").join(starts.alias("r"), same)
    return joined.select(*(F.col(f"l.{c}") for c in rows.columns), (F.col("l._mid") + F.col("r._shift")).alias("_no"), F.col("r._of").alias("_of"))
