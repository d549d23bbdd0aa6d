"""Jaccard self-join on word shingles with adaptive multi-match prefixes, and its components.

Tokens (hashes of five lower-cased words) have one global order: by a count-min estimate of how many texts hold them,
rare ones first, then by hash. The sketch has a fixed size, SLOTS counters, whatever the corpus; its errors cost work,
never results. Two sets that are similar enough share at least l of their first n - alpha + l tokens, where alpha is the
overlap they need. Each text picks its own l: more tokens in the prefix cost more postings, but a candidate must then
share more of them, so l is the one with the least estimated cost; a pair is judged by the smaller l of the two.

Texts with equal sets are one class. Candidates are made in two rounds, never all pairs of a posting list: first each
class against the hub of each list, the class whose tokens are the most frequent; then, among classes that no link
connects yet, every pair of a list that passes the size, position and match-count bounds and whose parity bitmaps
(BITMAP words of 64 bits, one bit for each token's hash) differ in no more bits than similar sets may differ in tokens. A
pair inside one component cannot change the components, so the result is that of all links.

Defined cases: null, empty and wordless texts have no shingles and link with nothing; a text of fewer than five words has
one shingle; rows that repeat a doc_id are one vertex; a null id is a vertex of its own, smaller than all others.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.llm.components import components
from moraflow.llm.hashing import Units, mix, prefix_sums, range_hash
from moraflow.llm.texts import discard, keyed, keyed_rows, pieces, public_id, split_by_filter, written

SHINGLE, PERCENT = 5, 75
SLOTS, PARTS, SPREAD = 1 << 20, 16, 32
MOST_MATCHES = 4
BITMAP = 8
CLASS = ["c", "n"]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    units = Units([t.encode().lower() for t in texts], words=True)
    sums = prefix_sums(units.values)
    out = []
    for a, b in zip(units.bounds[:-1].tolist(), units.bounds[1:].tolist()):
        if b - a >= SHINGLE:
            at = np.arange(a, b - SHINGLE + 1)
            out.append(np.unique(mix(range_hash(sums, at, at + SHINGLE))))
        else:
            out.append(mix(range_hash(sums, np.array([a]), np.array([b])) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def set_hash(tokens: np.ndarray) -> int:
    return int(mix(np.array([np.sum(mix(tokens), dtype=np.uint64) ^ np.uint64(len(tokens))])).view(np.int64)[0])


def slots(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each token in the sketch."""
    return (tokens % np.uint64(SLOTS)).astype(np.int64), ((tokens >> np.uint64(32)) % np.uint64(SLOTS)).astype(np.int64)


SCANNED = "_id long, _th long, n int, c long, part int, salt int, counts binary"


def scanned(docs: DataFrame) -> DataFrame:
    """One row for each text (n, c), and PARTS rows for each task with its share of the sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        salt = 0
        for batch in pieces(batches):
            sets = shingle_sets(batch.column("_text").to_pylist())
            for tokens in sets:
                for place in slots(tokens):
                    np.add.at(counts, place, 1)
            rows = len(sets)
            c = [set_hash(s) for s in sets]
            salt = c[0] % SPREAD
            yield _scan_batch(batch.column("_id"), batch.column("_th"), [len(s) for s in sets], c, [None] * rows, [None] * rows, [None] * rows)
        each = SLOTS // PARTS
        none = [None]
        if counts.any():
            for k in range(PARTS):
                yield _scan_batch(none, none, none, none, [k], [salt], [counts[k * each : (k + 1) * each].tobytes()])

    return docs.select("_id", "_th", "_text").mapInArrow(scan, SCANNED)


def _scan_batch(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.strip().split()[0] for c in SCANNED.split(",")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def sketch(scan: DataFrame) -> np.ndarray:
    """The summed counters: SLOTS of them, so what comes to the driver does not grow with the corpus."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, salt, counts in zip(*(batch.column(n) for n in ("part", "salt", "counts"))):
                key = part.as_py(), salt.as_py()
                held = total.setdefault(key, np.zeros(SLOTS // PARTS, np.uint32))
                held += np.frombuffer(counts.as_buffer(), np.uint32)
        for (part, salt), held in total.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "salt": pa.array([salt], pa.int32()), "counts": pa.array([held.tobytes()], pa.binary())})

    rows = scan.filter("part is not null").select("part", "salt", "counts")
    schema = "part int, salt int, counts binary"
    by_salt = rows.repartition("part", "salt").mapInArrow(summed, schema)
    by_part = by_salt.withColumn("salt", F.lit(0)).repartition(PARTS, "part").mapInArrow(summed, schema)
    out = np.zeros(SLOTS, np.uint32)
    each = SLOTS // PARTS
    for row in by_part.collect():
        out[row["part"] * each : (row["part"] + 1) * each] = np.frombuffer(row["counts"], np.uint32)
    return out


def needed(n: int) -> int:
    """Least overlap of a set of n with any similar set."""
    return -(-n * PERCENT // 100)


def matches_wanted(excess: np.ndarray, n: int) -> int:
    """The l with the least estimated cost for ordered tokens with estimated posting lengths `excess`.

    Postings read: their sum over the prefix. Candidates that share l tokens: at most that sum over l. Each costs as
    much as reading the set.
    """
    base = n - needed(n)
    read = np.cumsum(excess[: min(n, base + MOST_MATCHES)])
    costs = [read[base + l - 1] * (1 + n / 16 / l) + base + l for l in range(1, MOST_MATCHES + 1) if base + l <= n]
    return int(np.argmin(costs)) + 1


def parity(tokens: np.ndarray) -> np.ndarray:
    """BITMAP words; a bit is set if an odd number of tokens has it. Sets that differ in d tokens differ in d bits at most."""
    bits = np.bincount((mix(tokens) % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


PREFIX = "c long, n int, l int, central int, bits array<long>, tokens array<long>"


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """The ordered prefix of each text with shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 4 MB, fixed

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        usual = int(np.median(held))
        for batch in pieces(batches):
            out = []
            for tokens in shingle_sets(batch.column("_text").to_pylist()):
                n = len(tokens)
                if not n:
                    continue
                a, b = slots(tokens)
                seen = np.minimum(held[a], held[b]).astype(np.int64)
                order = np.lexsort((tokens, seen))
                l = matches_wanted(np.maximum(seen[order] - usual, 0), n)
                central = int(np.log2(seen + 1).mean() * 1000)
                out.append((set_hash(tokens), n, l, central, parity(tokens), tokens[order[: n - needed(n) + l]].view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(col, t.type) for col, t in zip(zip(*out), PREFIXES)], schema=PREFIXES)

    return docs.select("_text").mapInArrow(cut, PREFIX)


PREFIXES = pa.schema([("c", pa.int64()), ("n", pa.int32()), ("l", pa.int32()), ("central", pa.int32()), ("bits", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])


def class_prefixes(prefix: DataFrame) -> DataFrame:
    """One row of `prefixes` for each class."""
    return written(prefix.groupBy(*CLASS).agg(*(F.first(k).alias(k) for k in ("l", "central", "bits", "tokens"))), "prefixes")


def postings(one: DataFrame) -> DataFrame:
    """(token, pos, c, n, l, central) of each class, for tokens that more than one class has in its prefix."""
    rows = one.select("c", F.posexplode("tokens").alias("pos", "token"))
    many = rows.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token")
    return written(rows.join(many, "token").join(one.drop("tokens", "bits"), "c"), "postings")


def overlap_needed(n: Column, m: Column) -> Column:
    """Least overlap of sets of n and m at PERCENT: the ceiling of PERCENT * (n + m) / (100 + PERCENT)."""
    return F.ceil(F.lit(PERCENT) * (n + m) / F.lit(100 + PERCENT))


def possible(x: str, y: str) -> Column:
    """Whether sizes and places of a shared token allow the pair, for the smaller l of the two."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    least, l = overlap_needed(n, m), F.least(F.col(f"{x}.l"), F.col(f"{y}.l"))
    return (
        (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT)
        & (F.col(f"{x}.pos") < n - least + l)
        & (F.col(f"{y}.pos") < m - least + l)
    )


def bits_allow(x: str, y: str) -> Column:
    """Whether the bitmaps differ in no more bits than the sets may differ in tokens."""
    differ = sum((F.bit_count(F.col(f"{x}.b{k}").bitwiseXOR(F.col(f"{y}.b{k}"))) for k in range(BITMAP)), F.lit(0))
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return differ <= n + m - 2 * overlap_needed(n, m)


def candidates(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of `x` and `y` structs that share as many prefix tokens as they must."""
    keys = [F.col(f"{s}.{k}").alias(f"{s}{k}") for s in "xy" for k in CLASS]
    counted = pairs.select(*keys, F.least("x.l", "y.l").alias("l")).groupBy("xc", "xn", "yc", "yn").agg(F.count("*").alias("k"), F.min("l").alias("l"))
    return counted.filter("k >= l").select("xc", "xn", "yc", "yn")


def hub_pairs(post: DataFrame) -> DataFrame:
    """Each class of a posting list with the hub of the list. A match count is not asked for: lists may differ in hubs."""
    x = F.struct("central", "c", "n", "l", "pos")
    hubs = post.groupBy("token").agg(F.max(x).alias("y"))
    both = post.select("token", x.alias("x")).join(hubs, "token").filter((F.col("x.c") != F.col("y.c")) & possible("x", "y"))
    return both.select(*[F.col(f"{s}.{k}").alias(f"{s}{k}") for s in "xy" for k in CLASS]).distinct()


def open_postings(post: DataFrame, roots: DataFrame, one: DataFrame) -> DataFrame:
    """Postings of lists that hold several roots, with root and bitmaps; `roots` has (c, n, root) of connected classes."""
    known = post.join(roots, CLASS, "left").withColumn("root", F.coalesce("root", F.col("c")))
    ends = known.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("token")
    return written(known.join(ends, "token").join(one.select("c", "bits"), "c"), "open-postings")


def rest_pairs(open_: DataFrame) -> DataFrame:
    """Candidates between classes that no link connects yet."""
    x = F.struct(*CLASS, "l", "pos", "root", *(F.col("bits")[k].alias(f"b{k}") for k in range(BITMAP)))
    left, right = open_.select("token", x.alias("x")), open_.select("token", x.alias("y"))
    on = (F.col("p.token") == F.col("q.token")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.root") != F.col("y.root")) & possible("x", "y") & bits_allow("x", "y")
    return candidates(left.alias("p").join(right.alias("q"), on))


def sets_of(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(c, n, tokens) of the classes of `places`, read again from the text of their first document; few others move."""
    some, _ = split_by_filter(docs, places, ["_id", "_th"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("_text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("n"), pa.array(sets, pa.list_(pa.int64()))], names=["c", "n", "tokens"])

    return some.join(places, ["_id", "_th"]).select(*CLASS, "_text").mapInArrow(make, "c long, n int, tokens array<long>")


def links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, done: tuple[DataFrame, ...] = ()) -> DataFrame:
    """(xc, xn, yc, yn) of the pairs that are similar. `done` are steps that only the pairs were made from."""
    pairs = written(pairs, "pairs")
    discard(*done)
    wanted = pairs.select(F.col("xc").alias("c"), F.col("xn").alias("n")).unionByName(pairs.select(F.col("yc").alias("c"), F.col("yn").alias("n"))).distinct()
    places = written(classes.join(wanted, CLASS).select(*CLASS, "place.*"), "places")
    sets = written(sets_of(docs, places), "sets")
    side = lambda s: sets.select(F.col("c").alias(f"{s}c"), F.col("n").alias(f"{s}n"), F.col("tokens").alias(f"{s}set"))
    both = pairs.join(side("x"), ["xc", "xn"]).join(side("y"), ["yc", "yn"])
    shared = F.size(F.array_intersect("xset", "yset"))
    found = written(both.filter(100 * shared >= PERCENT * (F.col("xn") + F.col("yn") - shared)).select("xc", "xn", "yc", "yn"), "links")
    discard(pairs, places, sets)
    return found


def rooted(found: DataFrame, first: DataFrame, repeated: DataFrame) -> DataFrame:
    """(c, n, root) of every class: the smallest id that links reach from it. `first` has (c, n, u), u its least id."""
    end = lambda s, to: first.select(F.col("c").alias(f"{s}c"), F.col("n").alias(f"{s}n"), F.col("u").alias(to))
    edges = found.join(end("x", "u"), ["xc", "xn"]).join(end("y", "v"), ["yc", "yn"]).select("u", "v")
    reached = components(edges.unionByName(repeated))
    return first.join(reached, "u", "left").select(*CLASS, F.coalesce("root", "u").alias("root"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n, component) for every row of `docs`."""
    rows = keyed(docs, id_col, text_col)
    scan = written(scanned(rows), "shingles")
    every = scan.filter("part is null").select("_id", "_th", "n", "c")
    classes = written(every.filter("n > 0").groupBy(*CLASS).agg(F.min(F.struct("_id", "_th")).alias("place")), "classes")
    first = classes.select(*CLASS, F.col("place._id").alias("u"))
    several = every.filter("n > 0").groupBy("_id").agg(F.min("_th").alias("a"), F.max("_th").alias("b")).filter("a <> b").select("_id")
    repeated = every.filter("n > 0").join(several, "_id").join(first, CLASS).select("u", F.col("_id").alias("v"))
    one = class_prefixes(prefixes(rows, sketch(scan)))
    post = postings(one)
    near = links(rows, classes, hub_pairs(post))
    open_ = open_postings(post, rooted(near, first, repeated), one)
    discard(post, one)
    rest = links(rows, classes, rest_pairs(open_), done=(open_,))
    final = rooted(near.unionByName(rest), first, repeated)
    return every.join(final, CLASS, "left").select("_id", "n", F.coalesce("root", "_id").alias("component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, of the document with the smallest id of each component.

    Rows that repeat a doc_id are one document and stay or go together; documents without words stay.
    """
    stays = F.bool_or(F.col("_id") == F.col("component")).alias("stays")
    gone = written(groups(docs, id_col, text_col).groupBy("_id").agg(stays).filter("not stays").select("_id"), "gone")
    some, none = split_by_filter(keyed_rows(docs, id_col, text_col).select("_id", "_row"), gone, ["_id"])
    return some.join(gone, "_id", "left_anti").unionByName(none).select("_row.*")


def report(docs: DataFrame) -> DataFrame:
    found = groups(docs)
    return found.select(
        public_id().alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), public_id("component").alias("component_id")
    )
