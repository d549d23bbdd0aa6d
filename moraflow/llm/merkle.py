"""Merkle manifest of a table, with a version for each tampered row by path copying.

A row's leaf is the hash of its columns; the leaves of a group (a language), in order of id, are the bottom of a tree in
which every ARITY neighbours have a parent, and the groups' roots are the bottom of the tree over all groups. A tree is
cut into aligned blocks of BLOCK = ARITY ** BLOCK_LEVELS nodes, each one Spark row; the roots of the blocks are the nodes
of the next tier, blocked again, until one node is left: a tier has a 512th of the rows of the tier below it. On the way
down every block gets the siblings on its way to the root, by one join for each tier.

The tree is persistent: a tampered leaf makes a version that copies only the leaf's ancestors and shares every other
node. `changed` copies them within the aligned block, where the shared nodes are, and `continued` goes on through the
upper tiers, whose shared nodes are the siblings that the block was joined with; no other version is touched or needed,
so versions are as distributed as the blocks.

Texts are read once, by Spark's own functions, and never shuffled; a task holds a few blocks at a time, whatever group,
text or number of versions is large.

Defined cases: a null column is marked by a dash in its leaf; a null group comes first; null ids come first in their
group and are never tampered with; rows that repeat an id stand in order of their leaves; a text without letters to
change makes a version with equal nodes, which verifies; a group of one row has its leaf as root; an empty table gives an
empty result; other columns do not matter.
"""

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.llm.line_dedup import ascii_lower
from moraflow.llm.numbering import numbered
from moraflow.llm.texts import NO_ID, public_id, written

ARITY, BLOCK_LEVELS = 8, 3
BLOCK = ARITY**BLOCK_LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SIBLINGS = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(total: int) -> int:
    """Levels that a block of a tier with `total` nodes climbs."""
    levels = 0
    while total > 1 and levels < BLOCK_LEVELS:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def levels_of(nodes: list[str], up: int) -> list[list[str]]:
    """The nodes of a block, level by level, `up` levels above the given ones."""
    levels = [nodes]
    for _ in range(up):
        below = levels[-1]
        levels.append([digest("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The others of the runs on the way from node `at` to the top of its block, before and after it."""
    out = []
    for level in levels[:-1]:
        first = at - at % ARITY
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + ARITY])))
        at //= ARITY
    return out


def changed(levels: list[list[str]], at: int, leaf: str) -> list[str]:
    """The copies a version makes in its block: the leaf and its ancestors there; all other nodes stay shared."""
    copies = [leaf]
    for level in levels[:-1]:
        first = at - at % ARITY
        copies.append(digest("".join([*level[first:at], copies[-1], *level[at + 1 : first + ARITY]])))
        at //= ARITY
    return copies


def continued(copies: list[str], path: list[tuple[str, str]]) -> list[str]:
    """The copies of a version from its block's top on to the root."""
    out = list(copies)
    for before, after in path:
        out.append(digest(before + out[-1] + after))
    return out


def encoded(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(_g, _id, leaf, tampered): digests in bytes; tampered is null for rows that nobody tampers with.

    _g is the group as a string that sorts null first and others by their bytes.
    """
    lowered = {text_col: ascii_lower(F.col(text_col))}
    leaf = F.sha2(F.concat(*(encoded(c) for c in columns)), 256)
    other = F.sha2(F.concat(*(encoded(lowered.get(c, c)) for c in columns)), 256)
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    group = F.col(group_col).cast("string")
    return docs.select(
        F.when(group.isNull(), "-").otherwise(F.concat(F.lit("="), group)).alias("_g"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.unhex(leaf).alias("leaf"),
        F.when(hit, F.unhex(other)).alias("tampered"),
    )


def blocks(rows: DataFrame, *items: str) -> DataFrame:
    """(_g, block, total, items) of numbered rows: `items` in order of their numbers, at most BLOCK of them."""
    listed = F.array_sort(F.collect_list(F.struct("_no", *items)))
    return rows.groupBy("_g", F.expr(f"_no div {BLOCK}").alias("block")).agg(F.first("_of").alias("total"), listed.alias("items"))


def tops(leaf_blocks: DataFrame) -> DataFrame:
    """(_g, _no, _of, hash): the roots of the blocks of leaves, which are the nodes of the next tier."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for total, items in zip(batch.column("total").to_pylist(), batch.column("items")):
                roots.append(levels_of([d.hex() for d in items.values.field("leaf").to_pylist()], height(total))[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_g"), batch.column("block"), batch.column("total"), pa.array(roots, pa.string())], names=["_g", "_no", "_of", "hash"]
            )

    out = leaf_blocks.mapInArrow(climb, "_g string, _no long, _of long, hash string")
    return out.withColumn("_of", F.expr(f"(_of + {BLOCK - 1}) div {BLOCK}"))


def tier(nodes: DataFrame) -> DataFrame:
    """(_g, _no, _of, path, top) for each node of a tier: its siblings in its block, and the block's root."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items = row["items"]
                levels = levels_of([i["hash"] for i in items], height(row["total"]))
                paths = [[{"before": b, "after": a} for b, a in siblings(levels, at)] for at in range(len(items))]
                n = len(items)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["_g"]] * n, pa.string()), pa.array([i["_no"] for i in items], pa.int64()), pa.array([row["total"]] * n, pa.int64()),
                     pa.array(paths, PATH), pa.array([levels[-1][0]] * n, pa.string())],
                    names=["_g", "_no", "_of", "path", "top"],
                )

    return written(blocks(nodes, "hash").mapInArrow(climb, f"_g string, _no long, _of long, path {SIBLINGS}, top string"), "merkle-tier")


PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def climbed(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above `nodes`, lowest first, and (_g, hash) of the one node that each group has in the end."""
    tiers = []
    while (nodes.agg(F.max("_of")).first()[0] or 0) > 1:
        tiers.append(tier(nodes))
        above = tiers[-1].filter(f"_no % {BLOCK} = 0")
        nodes = above.select("_g", F.expr(f"_no div {BLOCK}").alias("_no"), F.expr(f"(_of + {BLOCK - 1}) div {BLOCK}").alias("_of"), F.col("top").alias("hash"))
    return tiers, nodes.select("_g", "hash")


def descended(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(_g, _no, path, *others of `tops`) for the nodes of the lowest tier, path going up to what `tops` (_g, path, ...) has.

    Without a tier the groups have one node each.
    """
    now = tops.withColumn("_no", F.lit(0).cast("long"))
    others = [c for c in tops.columns if c not in ("_g", "path")]
    for nodes in reversed(tiers):
        below = nodes.select("_g", "_no", F.expr(f"_no div {BLOCK}").alias("up"), F.col("path").alias("own"))
        above = now.withColumnRenamed("_no", "up")
        now = written(below.join(above, ["_g", "up"]).select("_g", "_no", F.concat("own", "path").alias("path"), *others), "merkle-paths")
    return now


def manifest(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks of leaves (_g, block, total, items), and (_g, _no, path, subroot, root) for each of them.

    `rows` are those of `leaves`.
    """
    kept = written(blocks(numbered(written(rows, "leaves"), ["_g", "_id", "leaf"], ("_g",)), "_id", "leaf", "tampered"), "merkle-blocks")
    tiers, subroots = climbed(written(tops(kept), "merkle-tops"))
    ordered = numbered(subroots, ["_g"]).withColumnRenamed("_g", "g")
    group_tiers, root = climbed(ordered.select(F.lit("").alias("_g"), "_no", "_of", "hash"))
    top = root.select("_g", F.array().cast(SIBLINGS).alias("path"), F.col("hash").alias("root"))
    of_group = descended(group_tiers, top).drop("_g")
    named = ordered.select(F.col("g").alias("_g"), "_no", F.col("hash").alias("subroot")).join(of_group, "_no").drop("_no")
    return kept, descended(tiers, written(named, "merkle-groups"))


def versions(rows: DataFrame) -> DataFrame:
    """(_id, leaf, subroot, root, proof, copies) for each row of `leaves`.

    proof is the digest of the siblings up to the root. copies are the nodes that the row's version copied, leaf first,
    root last; a row that nobody tampers with has the nodes on its way, recomputed from its leaf.
    """

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                originals = [i["leaf"].hex() for i in row["items"]]
                levels = levels_of(originals, height(row["total"]))
                upper = [(s["before"], s["after"]) for s in row["path"]]
                above = "".join(before + after for before, after in upper)
                ids, proofs, copies = [], [], []
                for at, item in enumerate(row["items"]):
                    ids.append(item["_id"])
                    proofs.append(digest("".join(before + after for before, after in siblings(levels, at)) + above))
                    leaf = item["tampered"].hex() if item["tampered"] else originals[at]
                    copies.append(continued(changed(levels, at, leaf), upper))
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(originals, pa.string()), pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string()),
                     pa.array(proofs, pa.string()), pa.array(copies, pa.list_(pa.string()))],
                    names=["_id", "leaf", "subroot", "root", "proof", "copies"],
                )

    kept, paths = manifest(rows)
    joined = kept.join(paths.withColumnRenamed("_no", "block"), ["_g", "block"])
    return joined.mapInArrow(copy, "_id long, leaf string, subroot string, root string, proof string, copies array<string>")


def report(docs: DataFrame) -> DataFrame:
    folded = F.element_at("copies", -1)
    return versions(leaves(docs)).select(
        public_id().alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
