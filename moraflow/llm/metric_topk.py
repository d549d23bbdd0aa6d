"""Exact top-k by inner product over M-trees, searched best-first.

Inner products are turned into distances: each vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the greatest
norm, each query a zero, and then d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the nearest are those with the highest product.

Vectors go to their nearest pivot of a bounded sample (PIVOTS rows, the least by hash of the id), regions of more than
TREE_ROWS rows are dealt over several trees, and each tree is built once, in pages of PAGE entries with a routing object,
a covering radius and the distance of every entry to its parent. Queries travel in blocks of BLOCK rows, one row for each
block and tree, so neither a hot vector nor a large query set makes a large group. The queries of a block search together,
best first: the node with the least bound of any of them is opened next, for those that still need it; the triangle
inequality with the stored parent distances skips entries before any distance is computed, and the k-th best product over
the pivots bounds it from the start. Products are exact: integers, in doubles where these hold them exactly.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, neither do null ids;
vectors of different lengths never meet; ties go to the smaller id; rows that repeat an id are one candidate each, and
none is a candidate of a query of the same id.
"""

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moraflow.llm.texts import written

PIVOTS, TREE_ROWS, PAGE, FANOUT, BLOCK = 64, 4096, 64, 16, 1024
SLACK = 1e-7  # relative, for rounding in distances; products themselves are exact


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, v array<long>) of the vectors that take part."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def lifted(points: np.ndarray, most: float) -> np.ndarray:
    """Points with the coordinate that gives all of them the norm sqrt(most)."""
    rest = np.maximum(most - (points.astype(np.float64) ** 2).sum(axis=1), 0)
    return np.concatenate([points.astype(np.float64), np.sqrt(rest)[:, None]], axis=1)


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def build(points: np.ndarray, rows: np.ndarray, centre: np.ndarray) -> dict:
    """A page over `rows` of `points`, parent distances taken to `centre`."""
    if len(rows) <= PAGE:
        return {"leaf": True, "rows": rows, "apart": distances(points[rows], centre)}
    picks = points[rows[np.linspace(0, len(rows) - 1, FANOUT).astype(int)]]
    near = np.stack([distances(points[rows], p) for p in picks]).argmin(axis=0)
    shares = [rows[near == k] for k in range(FANOUT)]
    if max(map(len, shares)) > 0.9 * len(rows):  # copies of one vector: no object parts them
        shares = [s for s in np.array_split(rows, FANOUT)]
    children = [(points[s[0]], s) for s in shares if len(s)]
    centres = np.array([c for c, _ in children])
    return {
        "leaf": False,
        "centres": centres,
        "apart": distances(centres, centre),
        "radius": np.array([distances(points[s], c).max() for c, s in children]),
        "pages": [build(points, s, c) for c, s in children],
    }


def search(tree: dict, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, most: float, floor: np.ndarray) -> list[tuple[int, int, int]]:
    """The k best (query id, id, product) of the tree for each query; `floor` holds products that k others are known to reach.

    The queries of a block walk the tree together: a page waits under the least bound of the queries that may need it,
    each of which leaves as soon as its own bound exceeds its own limit.
    """
    if most < 2**53:  # products of integers are exact in doubles then
        queries, points = queries.astype(np.float64), points.astype(np.float64)
    else:
        points = points.astype(np.int64)
    size = (queries.astype(np.float64) ** 2).sum(axis=1)
    moved = np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
    reach = lambda product, size: np.sqrt(np.maximum(size + most - 2 * product, 0.0)) * (1 + SLACK) + SLACK
    floor = floor.astype(np.float64)
    limit = np.where(floor > -np.inf, reach(np.maximum(floor, -most), size), np.inf)
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # (product, -id), the least first
    at_root = distances(moved, tree["centre"])
    bounds = np.maximum(at_root - tree["radius"], 0.0)
    waiting = [(bounds.min(), 0, np.arange(len(queries)), bounds, at_root, tree["page"])]
    count = 1
    while waiting:
        low, _, who, bounds, at, page = heapq.heappop(waiting)
        if low > limit.max():
            break
        stay = bounds <= limit[who]
        who, at = who[stay], at[stay]
        if not len(who):
            continue
        apart = np.abs(at[:, None] - page["apart"])
        if page["leaf"]:
            near = apart <= limit[who][:, None]
            used = np.flatnonzero(near.any(axis=0))
            rows = page["rows"][used]
            products = queries[who] @ points[rows].T
            fit = near[:, used] & (products >= floor[who][:, None]) & (ids[rows] != query_ids[who][:, None])
            for j, r in zip(*np.nonzero(fit)):
                held, new = best[who[j]], (int(products[j, r]), -int(ids[rows[r]]))
                if len(held) < k:
                    heapq.heappush(held, new)
                elif new > held[0]:
                    heapq.heapreplace(held, new)
            for q in who[fit.any(axis=1)]:
                if len(best[q]) == k and best[q][0][0] > floor[q]:
                    floor[q] = best[q][0][0]
                    limit[q] = min(limit[q], reach(floor[q], size[q]))
        else:
            radius = page["radius"]
            maybe = apart - radius <= limit[who][:, None]
            for j in np.flatnonzero(maybe.any(axis=0)):
                some = who[maybe[:, j]]
                away = distances(moved[some], page["centres"][j])
                bounds = np.maximum(away - radius[j], 0.0)
                go = bounds <= limit[some]
                if go.any():
                    heapq.heappush(waiting, (bounds[go].min(), count, some[go], bounds[go], away[go], page["pages"][j]))
                    count += 1
    return [(int(q), -i, p) for q, held in zip(query_ids, best) for p, i in held]


def trees(rows: DataFrame, pivots: dict[int, np.ndarray], most: float) -> DataFrame:
    """(tree, dim, data): pickled pages with their vectors and ids."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            region = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                x = lifted(matrix(batch.column("v").take(pa.array(here))), most)
                for part in range(0, len(here), 4096):
                    y = x[part : part + 4096]
                    region[here[part : part + 4096]] = np.stack([distances(y, p) for p in pivots[int(dim)]]).argmin(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dim"), batch.column("v"), pa.array(region)], names=["id", "dim", "v", "region"])

    placed = written(rows.mapInArrow(nearest, "id long, dim int, v array<long>, region int"), "regions")
    sizes = placed.groupBy("dim", "region").agg(F.count("*").alias("c")).orderBy("dim", "region").collect()  # PIVOTS a length at most
    shares = rows.sparkSession.createDataFrame([(r["dim"], r["region"], -(-r["c"] // TREE_ROWS)) for r in sizes], "dim int, region int, shares int")
    share = F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")
    dealt = placed.join(F.broadcast(shares), ["dim", "region"]).withColumn("share", share)

    def grow(key, group):
        group = group.combine_chunks().sort_by("id")
        points = matrix(group.column("v").chunk(0))
        x = lifted(points, most)
        centre = pivots[key[0].as_py()][key[1].as_py()]
        page = build(x, np.arange(len(x)), centre)
        tree = {"centre": centre, "radius": float(distances(x, centre).max()), "page": page}
        data = pickle.dumps((tree, points.astype(np.int32) if np.abs(points).max() < 2**31 else points, group.column("id").to_numpy()))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "region": pa.array([key[1].as_py()], pa.int32()), "share": pa.array([key[2].as_py()], pa.int32()), "data": pa.array([data], pa.binary())})

    grown = dealt.select("dim", "region", "share", "id", "v").groupBy("dim", "region", "share").applyInArrow(grow, "dim int, region int, share int, data binary")
    return written(grown, "trees"), shares


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where the Column `is_query` (of `id`) holds, their k best others."""
    schema = "query_id long, rank int, vec_id long, score long"
    spark = vectors.sparkSession
    rows = written(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e)
    most = rows.agg(F.max(norm)).first()[0]
    if most is None:
        return spark.createDataFrame([], schema)
    lengths = [r["dim"] for r in rows.select("dim").distinct().collect()]
    sample = {d: rows.filter(F.col("dim") == d).orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("id", "v").collect() for d in lengths}
    known = {d: (np.array([r["id"] for r in s]), np.array([r["v"] for r in s], np.int64)) for d, s in sample.items()}
    pivots = {d: lifted(v, most) for d, (_, v) in known.items()}
    grown, shares = trees(rows, pivots, most)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(len(batch)):
                row = batch.slice(one, 1)
                tree, points, ids = pickle.loads(row.column("data")[0].as_py())
                dim = row.column("dim")[0].as_py()
                pivot_ids, pivot_vectors = known[dim]
                query_ids = np.array(row.column("ids")[0].as_py(), np.int64)
                queries = matrix(row.column("queries")[0].values)
                seen = queries @ pivot_vectors.T
                seen = np.where(pivot_ids == query_ids[:, None], -np.inf, seen.astype(np.float64))
                floor = np.sort(seen, axis=1)[:, -k] if seen.shape[1] >= k else np.full(len(queries), -np.inf)
                found = search(tree, points, ids, queries, query_ids, k, most, floor)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], names=["query_id", "vec_id", "score"])

    asked = rows.filter(is_query(F.col("id"))).dropDuplicates(["id", "v"])
    blocks = max(1, -(-asked.count() // BLOCK))
    packed = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).groupBy("dim", "block")
    packed = packed.agg(F.collect_list(F.struct("id", "v")).alias("q")).select("dim", "block", F.col("q.id").alias("ids"), F.col("q.v").alias("queries"))
    each = packed.join(F.broadcast(shares), "dim").select("*", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    met = each.join(grown, ["dim", "region", "share"]).repartition("region", "share", "block", "dim")
    answers = met.select("dim", "data", "ids", "queries").mapInArrow(look, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, lambda i: i % 50 == 0)
