"""What the operators on texts share: row keys, batches of bounded size, written steps, registered tables."""

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraflow.sources.sinks import written  # noqa: F401 - used by the operators

NO_ID = -(2**63)  # stands for a null id inside the operators; it sorts first
BATCH_BYTES = 1 << 20
BATCH_ROWS = 512
FILTER_BITS = 1 << 23  # of the key filter: at most 131,072 rows of 64 bits, whatever the number of keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _th, _text): id without null, hash of the text, text without null.

    Rows that repeat an id with other texts stay apart by the hash; rows that repeat id and text share one key, get the
    same answer each, and count as often as they occur. Other columns are left out, so their names cannot clash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `keyed`, with the whole row as `_row`."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"), F.struct("*").alias("_row"))


def public_id(column: str | Column = "_id") -> Column:
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID))


def discard(*steps: DataFrame) -> None:
    """Empties the folders of steps that `written` made, once nothing reads them any more.

    What was computed from them must be written itself by then, as lost work is done again from written steps.
    """
    for step in steps:
        for folder in {file.rsplit("/", 1)[0] for file in step.inputFiles()}:
            step.sparkSession.createDataFrame([], step.schema).coalesce(1).write.mode("overwrite").parquet(folder)


def split_by_filter(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """`rows` that may have a key of `keys`, and the rest, which has none.

    A bit for each hash of a key is set, and the words of these bits are broadcast: they are few for few keys and bounded
    for many. So a join with `keys` moves texts only of the first part; it still has to ask for equal keys. A key filter
    that is nearly full lets all rows through, which costs work and no results. Keys must not be null.
    """
    slot = F.pmod(F.xxhash64(*on, F.lit(11)), F.lit(FILTER_BITS))
    words = keys.select(slot.alias("_slot")).groupBy(F.expr("_slot div 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_slot % 64 as int))")).alias("_bits")
    )
    marked = rows.withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64")).join(F.broadcast(words), "_word", "left")
    may = F.coalesce(F.getbit("_bits", (F.col("_slot") % 64).cast("int")) == 1, F.lit(False))
    return marked.filter(may).select(*rows.columns), marked.filter(~may).select(*rows.columns)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "_text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most BATCH_ROWS rows and about BATCH_BYTES of text; a longer text comes alone."""
    for batch in batches:
        lengths = [n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and (held + n > BATCH_BYTES or i - start >= BATCH_ROWS):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def per_text(docs: DataFrame, make: Callable[[], Callable[[str], tuple]], columns: str) -> DataFrame:
    """(_id, *columns): `make()` is called once in a task, its result for each text of `keyed` rows."""
    schema = f"_id long, {columns}"
    names = [c.strip().split()[0] for c in columns.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = make()
        for batch in pieces(batches):
            rows = [answer(t) for t in batch.column("_text").to_pylist()]
            out = [batch.column("_id"), *([r[k] for r in rows] for k in range(len(names)))]
            yield pa.RecordBatch.from_pydict(dict(zip(["_id", *names], out)), schema=target)

    target = _arrow_schema(docs.sparkSession, schema)
    return docs.select("_id", "_text").mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
