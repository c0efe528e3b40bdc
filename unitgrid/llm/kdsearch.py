"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are projected by a few Gaussian (2-stable) directions: squared projected distance over squared distance then
follows a chi-square distribution with as many degrees of freedom. The projections are indexed by kd-trees; a query
takes leaves in the order of their projected distance, verifies their vectors exactly, and stops when the chi-square
test holds: were an unseen vector nearer than the k-th best found, its projection would lie this far out with a
probability of at most `1 - confidence`.

Largest inner products become least distances by one more coordinate: with M the greatest norm, x is extended by
sqrt(M^2 - |x|^2) and a query by 0, so that |q' - x'|^2 = M^2 + |q|^2 - 2 qx.

On Spark: the top of the kd-tree is cut on a bounded sample; its cells, split further by a hash where they hold many
vectors, are the shards, each with its own tree. A query is first answered by one shard of its own cell, which bounds its k-th best;
then it is sent only to shards whose box passes the same test. Both rounds group bounded shards with bounded blocks of queries.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.session import materialize

LEAF = 64


def chi_square_quantile(m, p):
    """Quantile of the chi-square distribution by bisection on the incomplete gamma series."""
    from math import exp, lgamma, log

    def cdf(x):
        if x <= 0:
            return 0.0
        a, x = m / 2, x / 2
        term = total = 1 / a
        for k in range(1, 2000):
            term *= x / (a + k)
            total += term
            if term < total * 1e-14:
                break
        return min(1.0, total * exp(-x + a * log(x) - lgamma(a)))

    low, high = 0.0, 20.0 * m + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


def directions(dim, m, seed=11):
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dim + 1, m))


def split_tree(points, leaf):
    """kd-tree by medians of the widest coordinate, as a list of index arrays (leaves)."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= leaf or not spread.max() > 0:
            # equal points cannot be told apart; they are cut by number only
            out += [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
            continue
        axis = int(spread.argmax())
        order = rows[np.argsort(points[rows, axis], kind="stable")]
        stack += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


class Tree:
    """Leaves of a kd-tree over projected points, with their boxes."""

    def __init__(self, projected, leaf=LEAF):
        leaves = split_tree(projected, leaf)
        self.rows = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
        self.cuts = np.concatenate([[0], np.cumsum([len(x) for x in leaves])]).astype(np.int64)
        self.low = np.stack([projected[x].min(axis=0) for x in leaves])
        self.high = np.stack([projected[x].max(axis=0) for x in leaves])

    def gaps(self, q):
        """Squared projected distance from q to each leaf's box."""
        d = np.maximum(self.low - q, 0) + np.maximum(q - self.high, 0)
        return np.einsum("ij,ij->i", d, d)


def best_of(ids, scores, k):
    """The k greatest scores, ties to the smaller id; each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    return ids[:k], scores[:k]


def search_shard(ids, vectors, tree, queries, k, g, limit, biggest, scale):
    """Neighbours of each query (id, vector, bound so far or -inf) in one shard: lists of (ids, scores)."""
    for qid, q, floor in queries:
        scaled = q * scale
        norm = float(scaled @ scaled)
        gap = tree.gaps(scaled @ g[:-1])
        order = np.argsort(gap, kind="stable")
        got_ids, got = np.zeros(0, np.int64), np.zeros(0)
        step = 2
        at = 0
        while at < len(order):
            worst = max(floor, got[-1] if len(got) >= k else -np.inf)
            reach = max(0.0, biggest + norm - 2 * (worst * scale * scale))  # squared distance of the k-th best
            if gap[order[at]] > limit * reach:
                break
            part = order[at:at + step]
            rows = np.concatenate([tree.rows[tree.cuts[p]:tree.cuts[p + 1]] for p in part])
            rows = rows[ids[rows] != qid]
            got_ids, got = best_of(np.concatenate([got_ids, ids[rows]]), np.concatenate([got, vectors[rows] @ q]), k)
            at += step
            step = min(2 * step, 16)
        yield got_ids, got


def _matrix(column, dim):
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), dim)


def _extended(vectors, biggest):
    """Vectors, scaled, with the coordinate that makes all norms equal."""
    return np.concatenate([vectors, np.sqrt(np.maximum(0, biggest - np.einsum("ij,ij->i", vectors, vectors)))[:, None]], axis=1)


def shard_task(dim, m, k, limit, biggest, scale):
    def run(queries, members):
        names = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not members.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        g = directions(dim, m)
        ids, vectors = members.column("vec_id").to_numpy(), _matrix(members.column("m_vector"), dim)
        tree = Tree(_extended(vectors * scale, biggest) @ g)
        q = zip(queries.column("query_id").to_pylist(), _matrix(queries.column("q_vector"), dim), queries.column("floor").to_pylist())
        out_q, out_i, out_s = [], [], []
        for (qid, (found, score)) in zip(queries.column("query_id").to_pylist(), search_shard(ids, vectors, tree, q, k, g, limit, biggest, scale)):
            out_q.append(np.full(len(found), qid))
            out_i.append(found)
            out_s.append(score)
        return pa.table([pa.array(np.concatenate(x)) for x in (out_q, out_i, out_s)], names=names)
    return run


def place_task(dim, m, biggest, top, scale):
    """Cell of each vector (as a candidate and as a query) in the top tree: the cell whose box is nearest."""
    def run(batches):
        g = directions(dim, m)
        for batch in batches:
            v = _matrix(batch.column("vector"), dim) * scale
            cells = []
            for points in (_extended(v, biggest) @ g, v @ g[:-1]):
                d = np.maximum(top["low"][None] - points[:, None], 0) + np.maximum(points[:, None] - top["high"][None], 0)
                cells.append(np.einsum("ijk,ijk->ij", d, d).argmin(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cells[0]), pa.array(cells[1])], names=["vec_id", "vector", "cell", "q_cell"])
    return run


def box_task(dim, m, biggest, scale):
    """Projected bounding box of each shard."""
    def run(table):
        p = _extended(_matrix(table.column("vector"), dim) * scale, biggest) @ directions(dim, m)
        return pa.table([table.column("shard")[:1].combine_chunks(), pa.array([p.min(axis=0).tolist()]), pa.array([p.max(axis=0).tolist()])], names=["shard", "low", "high"])
    return run


def nearest(vectors, queries_where, k=20, id="vec_id", vector="embedding", m=10, confidence=0.9, sample=4096, shard=8192, block=2048):
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products found, in double precision.

    Queries are the rows for which the SQL condition `queries_where` holds; candidates are all rows with another id.
    Rows with a null id, or with a vector that is null, zero, of another length than most, or holds null or non-finite components take no
    part; huge and tiny ones do (their products are those of double precision). Rows that repeat an id are one vector, the first in order. Fewer than k candidates give fewer rows; an empty
    table gives none. Ties go to the smaller id. Other columns are not looked at.
    """
    common.ship("unitgrid.llm.common", __name__)
    v = F.transform(common.quoted(vector), lambda x: x.cast("double"))
    rows = vectors.select(common.quoted(id).alias("vec_id"), v.alias("vector"), F.expr(queries_where).alias("asks"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(~bad).filter(F.exists("vector", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("vector", "asks")).alias("r")).select("vec_id", "r.*")
    rows = materialize(rows, "vectors")
    peak = F.max(F.array_max(F.transform("vector", F.abs)))
    widths = rows.groupBy(F.size("vector").alias("w")).agg(F.count(F.lit(1)).alias("c"), peak.alias("peak")).orderBy(F.desc("c"), "w").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return vectors.sparkSession.createDataFrame([], empty)
    dim = widths[0].w
    rows = rows.filter(F.size("vector") == dim)
    # trees and tests see the vectors times a power of two that brings the greatest component near one; scores are of the originals
    scale = 2.0 ** -max(-1000, np.frexp(widths[0].peak)[1])
    biggest = float(rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x * scale) * (x * scale)))).first()[0])
    # a vector nearer than the k-th best has a projection within limit times its distance with this confidence
    limit = chi_square_quantile(m, confidence)
    picked = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    tops = Tree(_extended(np.array([r.vector for r in picked]) * scale, biggest) @ directions(dim, m), max(64, sample // 64))
    top = {"low": tops.low, "high": tops.high}
    placed = rows.select("vec_id", "vector").mapInArrow(place_task(dim, m, biggest, top, scale), "vec_id long, vector array<double>, cell int, q_cell int")
    placed = materialize(placed.join(rows.select("vec_id", "asks"), "vec_id"), "placed")
    # neighbouring small cells share a shard; a large one is dealt by the hash of the id
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).orderBy("cell").collect()  # at most 64 or so
    plan, filled, number = [], 0, 0
    for r in cells:
        if filled and filled + r.c > shard:
            number, filled = number + 1, 0
        parts = max(1, -(-r.c // shard))
        plan.append((r.cell, number, parts))
        filled += r.c
        if parts > 1:
            number, filled = number + parts, 0
    shards = F.broadcast(vectors.sparkSession.createDataFrame(plan, "cell int, first int, parts int"))
    members = placed.join(shards, "cell").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).cast("int").alias("shard"), "vec_id", "vector")
    members = materialize(members, "members")
    boxes = members.groupBy("shard").applyInArrow(box_task(dim, m, biggest, scale), "shard int, low array<double>, high array<double>")
    boxes = materialize(boxes, "boxes")
    asked = placed.filter("asks").join(shards.withColumnRenamed("cell", "q_cell"), "q_cell", "left").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"), F.coalesce("first", F.lit(0)).cast("int").alias("home"))

    def answered(sent):
        """sent: shard, query_id, q_vector, floor. Shards meet blocks of their queries."""
        counts = sent.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        sent = sent.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
        copies = members.join(counts, "shard").select(F.col("shard").alias("m_shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("m_block"), "vec_id", F.col("vector").alias("m_vector"))
        return (sent.select(F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), "query_id", "q_vector", "floor").groupBy("q_shard", "q_block")
                .cogroup(copies.groupBy("m_shard", "m_block")).applyInArrow(shard_task(dim, m, k, limit, biggest, scale), "query_id long, vec_id long, score double"))

    home = materialize(answered(asked.select(F.col("home").alias("shard"), "query_id", "q_vector", F.lit(float("-inf")).alias("floor"))), "home")
    floors = home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("floor"))
    told = asked.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    routed = told.mapInArrow(route_task(dim, m, limit, biggest, boxes.collect(), scale), "shard int, query_id long, q_vector array<double>, floor double")
    found = home.unionByName(answered(routed))
    # of a query's lists only the best k stay: a bounded sorted array for each
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id")))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "r")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), (-F.col("r.s")).alias("score"))


def route_task(dim, m, limit, biggest, boxes, scale, cells=1 << 20):
    """Sends each query to the shards, other than its home, whose box passes the chi-square test; at most `cells` pairs are looked at together."""
    number = np.array([b.shard for b in boxes], np.int32)
    low, high = np.array([b.low for b in boxes]), np.array([b.high for b in boxes])
    step = max(1, cells // max(1, len(number)))

    def run(batches):
        g = directions(dim, m)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                q = _matrix(batch.column("q_vector"), dim) * scale
                p, norm, floor = q @ g[:-1], np.einsum("ij,ij->i", q, q), batch.column("floor").to_numpy(zero_copy_only=False)
                gap = np.zeros((len(q), len(number)))
                for x in range(m):
                    gap += (np.maximum(low[None, :, x] - p[:, x, None], 0) + np.maximum(p[:, x, None] - high[None, :, x], 0)) ** 2
                goes = gap <= limit * np.maximum(0, biggest + norm - 2 * (floor * scale * scale))[:, None]
                goes &= number[None] != batch.column("home").to_numpy()[:, None]
                i, j = np.nonzero(goes)
                yield pa.RecordBatch.from_arrays([pa.array(number[j]), *(batch.column(c).take(pa.array(i)) for c in ("query_id", "q_vector", "floor"))],
                                                 names=["shard", "query_id", "q_vector", "floor"])
    return run
