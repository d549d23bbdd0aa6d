"""Benchmark decontamination by template canonicalisation, in DataFrame and SQL functions only.

Numbers, units behind them and names become typed placeholders that keep their value, so that "3 apples for Ann" and
"7 apples for Bob" have one template. Every window of WIDTH tokens of items and documents is hashed. Hashes are joined,
windows of a document and item on one diagonal are counted, and the values of their placeholders must map the item's
values to the document's one to one: a re-parameterised question passes, an accidental mix of slots does not.

A pair is reported when its windows on a diagonal cover half of the item or ENOUGH tokens, whichever is less. The
benchmark is broadcast only if its windows are counted to be at most BROADCAST_ROWS; otherwise a broadcast key filter picks
the document windows that may meet one, and these are shuffled. A document's placeholders are looked up for windows that met
or may meet one. Items with the same text are compared once; their ids come in at the end.

Defined cases: null or empty texts, and items or documents with fewer than WIDTH tokens, match nothing; items with the
same text are reported each; rows that repeat id and text count once; null ids are reported as null; patterns hold no
repeated group that could be given back, so texts and runs of any length need no deep stack.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.llm.texts import keyed, keyed_rows, public_id, split_by_filter, written

WIDTH, ENOUGH, BROADCAST_ROWS = 6, 24, 200_000
#: Units that may follow a number.
UNITS = "mm|cm|m|km|mg|g|kg|t|ml|l|s|min|h|hours|minutes|seconds|days|miles|feet|inches|pounds|dollars|euros|percent"
NUMBER = rf"([0-9]++(?:[.,][0-9]++)*+)(?:\x20?({UNITS})\b)?"
NAME = r"(?<=[\p{Ll},;:]\x20)(\p{Lu}\p{L}+)"
BREAK = r"(?:[^\p{L}\p{N}#.,]|[.,](?![0-9]))++"
KEY = ["_id", "_th"]


def tokens(text: Column) -> Column:
    """Lower-cased tokens; a placeholder is '#', its type (n, u or a), and its value."""
    plain = F.replace(text, F.lit("#"), F.lit(" "))
    typed = F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, NUMBER, " #n$1 #u$2 ")).otherwise(plain)
    named = F.lower(F.regexp_replace(typed, NAME, "#a$1"))
    return F.filter(F.split(named, BREAK), lambda t: t != "")


def templates(rows: DataFrame) -> DataFrame:
    """(_id, _th, n, w, pos, h) of each window; w holds all tokens of the row, null if none is a placeholder."""
    words = rows.select(*KEY, tokens(F.col("_text")).alias("w"))
    typed = F.transform("w", lambda t: F.when(t.startswith("#"), F.substring(t, 1, 2)).otherwise(t))
    slotted = F.when(F.exists("w", lambda t: t.startswith("#")), F.col("w"))
    shaped = words.select(*KEY, F.size("w").alias("n"), typed.alias("t"), slotted.alias("w")).filter(F.col("n") >= WIDTH)
    starts = shaped.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - WIDTH)).alias("pos"))
    return starts.select(*KEY, "n", "w", "pos", F.xxhash64(*(F.get("t", F.col("pos") + k) for k in range(WIDTH))).alias("h"))


def with_slots(windows: DataFrame) -> DataFrame:
    """`windows` with `slots`, their placeholders in order, null if they have none, in the place of `w`.

    No lambda, so that Spark compiles it with the explode before it: all windows of a text are held at that step's end,
    where a row that still had `w` would be as large as the text.
    """
    token = [F.get("w", F.col("pos") + k) for k in range(WIDTH)]
    slots = F.array_remove(F.array(*(F.when(t.startswith("#"), t).otherwise("") for t in token)), "")
    return windows.withColumn("slots", F.when(F.size(slots) > 0, slots)).drop("w")


def texts_of(items: DataFrame) -> DataFrame:
    """(_th, _text, _id) of each different text of `keyed` items, with the least id that has it."""
    return items.groupBy("_th", "_text").agg(F.min("_id").alias("_id"))


def matched(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(_id, _th, item, ith, n_windows, n_slots) of `keyed` documents and the texts of `keyed` items that they hold."""
    cut = with_slots(templates(texts_of(items)))
    cut = cut.select(F.col("_id").alias("item"), F.col("_th").alias("ith"), F.col("n").alias("size"), F.col("pos").alias("at"), "h", F.col("slots").alias("theirs"))
    cut = written(cut, "templates")
    windows = templates(docs).drop("n")
    if cut.count() <= BROADCAST_ROWS:
        met = with_slots(windows.join(F.broadcast(cut), "h"))
    else:  # the size of the written step, which is compressed, must not lead to a broadcast
        met = with_slots(split_by_filter(windows, cut, ["h"])[0]).join(cut.hint("merge"), "h")
    line = [*KEY, "item", "ith", "diagonal"]
    met = met.withColumn("diagonal", F.col("pos") - F.col("at")).select(*line, "size", "pos", "slots", "theirs").dropDuplicates([*line, "pos"])
    pair = F.explode_outer(F.arrays_zip("theirs", "slots"))
    slots = met.select(*line, "size", "pos", pair.alias("s")).select(*line, "size", "pos", "s.theirs", "s.slots")
    judged = slots.groupBy(*line).agg(
        F.max("size").alias("size"),
        F.count_distinct("pos").alias("n_windows"),
        F.count_distinct("theirs").alias("a"),
        F.count_distinct("slots").alias("b"),
        F.count_distinct("theirs", "slots").alias("n_slots"),
    )
    enough = F.col("n_windows") + WIDTH - 1 >= F.least(F.ceil(F.col("size") / 2), F.lit(ENOUGH))
    kept = judged.filter(enough & (F.col("a") == F.col("n_slots")) & (F.col("b") == F.col("n_slots")))
    return kept.groupBy(*KEY, "item", "ith").agg(F.max("n_windows").alias("n_windows"), F.max("n_slots").alias("n_slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(_id, _th, item, n_windows, n_slots) of documents that hold a benchmark item or a re-parameterised one."""
    items = keyed(benchmark, item_col, item_text)
    same = items.select(F.col("_id").alias("named"), "_th", "_text").join(texts_of(items), ["_th", "_text"])
    same = same.select("named", F.col("_id").alias("item"), F.col("_th").alias("ith")).distinct()
    found = matched(keyed(docs, id_col, text_col), items).join(same, ["item", "ith"]).drop("item").withColumnRenamed("named", "item")
    return found.groupBy(*KEY, "item").agg(F.max("n_windows").alias("n_windows"), F.max("n_slots").alias("n_slots"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, that hold no benchmark item."""
    found = written(matched(keyed(docs, id_col, text_col), keyed(benchmark, "item_id")).select(*KEY).distinct(), "contaminated")
    return keyed_rows(docs, id_col, text_col).select(*KEY, "_row").join(found, KEY, "left_anti").select("_row.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contaminated(docs, benchmark)
    return found.select(public_id().alias("doc_id"), public_id("item").alias("item_id"), "n_windows", "n_slots").distinct()
