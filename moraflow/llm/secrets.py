"""Secret scanning with multipart credential linking, in DataFrame and SQL functions only.

A credential has parts: an access identifier, a secret, an endpoint. Strong parts are reported wherever they stand; weak
candidates (a short secret, a user or client identifier, a URL) only where the parts that complete them stand in the
same scope, SCOPE code points around. Parts become rows, places come from running sums over the pieces between matches,
and scopes are an interval join on (document, bucket of places): a bucket holds a bounded number of parts, so neither a
document full of secrets nor a source full of them meets in one task. Texts are read once for the patterns and not shuffled.

Defined cases: a null text is empty; rows that repeat id and text get the same answer each; offsets are code points,
ends exclusive; a match that fails its length is dropped and not tried again.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraflow.llm.texts import keyed, public_id

SCOPE = 300
KEY = ["_id", "_th"]
#: The patterns of the base kinds.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # a shorter run is dropped as a whole, so the bound can stand in the pattern
#: Patterns of the parts that are reported only when linked.
USER = r"((?i:user(?:name)?|login|client_?id|access_?key_?id))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@-]{3,})"
ENDPOINT = r"(https?)://([A-Za-z0-9.-]+(?::[0-9]+)?)"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "weak", "user", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "weak": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}


def matches(docs: DataFrame, kind: str, pattern: str, value_group: int) -> DataFrame:
    """(_id, _th, kind, start, end, size) of leftmost matches that do not overlap; size is the length of the value."""
    text, rx = F.col("_text"), F.lit(pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.length).alias("hit"),
        F.transform(F.regexp_extract_all(text, rx, F.lit(value_group)), F.length).alias("size"),
    )
    rows = docs.filter(text.rlike(pattern))
    rows = rows.select(*KEY, F.posexplode(found).alias("at", "m")).select(*KEY, "at", "m.*").dropDuplicates([*KEY, "at"])
    until = Window.partitionBy(*KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("hit", F.lit(0))).over(until)
    placed = rows.withColumn("end", end).filter("hit is not null")
    return placed.select(*KEY, F.lit(kind).alias("kind"), (F.col("end") - F.col("hit")).alias("start"), "end", "size")


def parts(docs: DataFrame) -> DataFrame:
    """(_id, _th, kind, start, end) of all parts, linked or not."""
    assign = matches(docs, "assign", ASSIGN, 2)
    kind = F.when(F.col("size") >= 12, "assign").when(F.col("size") >= 6, "weak")
    every = (
        assign.withColumn("kind", kind).filter("kind is not null"),
        matches(docs, "access", ACCESS, 0).filter("size >= 18"),
        matches(docs, "hex", HEX, 0),
        matches(docs, "user", USER, 2),
        matches(docs, "endpoint", ENDPOINT, 2),
    )
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out.drop("size")


def has_kind(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin(*kinds)


def linked(found: DataFrame) -> DataFrame:
    """The base parts, and the weak ones whose scope holds what completes them.

    A weak secret needs an identifier, an identifier a secret, an endpoint both.
    """
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[F.col("kind")]
    bucket = F.floor(F.col("start") / SCOPE)
    near = found.select(*KEY, F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"), F.col("start").alias("place"), role.alias("role"))
    weak = found.filter(~has_kind(BASE)).withColumn("bucket", bucket)
    scope = weak.join(near, [*KEY, "bucket"]).filter(F.abs(F.col("place") - F.col("start")) <= SCOPE)
    seen = lambda r: F.max(F.col("role") == r)
    judged = scope.groupBy(*KEY, "kind", "start", "end").agg(seen("identifier").alias("i"), seen("secret").alias("s"))
    wanted = (
        ((F.col("kind") == "weak") & F.col("i")) | ((F.col("kind") == "user") & F.col("s")) | ((F.col("kind") == "endpoint") & F.col("i") & F.col("s"))
    )
    return found.filter(has_kind(BASE)).unionByName(judged.filter(wanted).drop("i", "s"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of `docs`."""
    rows = keyed(docs, id_col, text_col)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    listed = (
        linked(parts(rows))
        .groupBy(*KEY)
        .agg(
            *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE),
            F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "end", "kind"))).alias("s"),
        )
    )
    text_of = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    joined = rows.select(*KEY).join(listed, KEY, "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<start:bigint,place:bigint,end:bigint,kind:string>>")))
    return joined.select(
        public_id().alias("doc_id"),
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(text_of(F.filter("s", lambda s: s["place"] <= len(BASE))), 256).alias("base_sha256"),
        text_of(F.col("s")).alias("spans"),
    )
