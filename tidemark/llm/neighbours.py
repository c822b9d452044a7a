"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the neighbour graph, a balanced partition of it into many small parts, and a classifier (softmax
regression) that learns which parts hold a vector's neighbours. It puts every row of the table into its most probable part
and sends each query to its several most probable ones: as many as rows of the sample that weren't learned from need to find
COVER of their neighbours. There the query is compared with every row in double precision and the best ones are ranked.

Parts that lie together form a block of bounded size, and a query goes to a block once, with the parts it asks for; a
block takes a bounded number of queries at a time, and a part that is larger than a block is dealt over several, so a very
common vector loads no single task.

Only vectors of the same length have an inner product. Those of the most frequent length are partitioned; rarer
lengths are compared each among themselves, with all their rows. Vectors that are null, empty, zero or that hold null or
non-finite components take no part, nor do rows without a vec_id. Rows with one vec_id count as one, by their best score.
Ties go to the smaller vec_id. An empty table gives no rows. Under 2 * PART rows there is one part, and the search is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SMALL_IDS, cut, frugal, load, sampled

#: Rows that the partition is learned from, those of them that only measure it, and neighbours of each in the graph.
SAMPLE, HELD, NEAR = 9216, 1024, 12
#: Rows of a part, about; the most parts, which bound the classifier: beyond them parts grow with the table.
PART, MOST_PARTS = 48, 1024
#: Share of the held-out rows' neighbours that the parts a query is sent to have to hold.
COVER = 0.95
#: Rows and queries that meet in one task at most, about.
BLOCK, QUERIES = 4096, 2048


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id long, v array<double>: the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))


def graph(x: np.ndarray, near: int) -> np.ndarray:
    """The nearest other rows of each row, by inner product, in blocks."""
    near = min(near, len(x) - 1)
    out = np.zeros((len(x), near), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, near - 1, axis=1)[:, :near]
    return out


def balanced(x: np.ndarray, links: np.ndarray, parts: int, sweeps: int = 12) -> np.ndarray:
    """A partition of the graph into equal parts: halves along the main axis, so that parts of near numbers lie together,
    then moves that cut fewer links and keep parts within a quarter of their size and two rows."""
    part = np.zeros(len(x), np.int64)
    for level in range(int(math.log2(parts))):
        upper = np.zeros(len(x), np.int64)
        for p in range(1 << level):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            c = x[own] - x[own].mean(axis=0)
            axis = np.ones(c.shape[1]) / math.sqrt(c.shape[1])
            for _ in range(20):
                axis = c.T @ (c @ axis)
                axis /= np.linalg.norm(axis) or 1
            order = np.argsort(c @ axis, kind="stable")
            upper[own[order[len(own) // 2 :]]] = 1
        part = 2 * part + upper
    most = math.ceil(len(x) / parts * 1.25) + 2
    for _ in range(sweeps):
        votes = np.zeros((len(x), parts), np.int16)
        np.add.at(votes, (np.repeat(np.arange(len(x)), links.shape[1]), part[links.ravel()]), 1)
        np.add.at(votes, (links.ravel(), np.repeat(part, links.shape[1])), 1)
        gain = votes.max(axis=1) - votes[np.arange(len(x)), part]
        count, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if count[to] < most:
                count[part[i]] -= 1
                count[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


class Router:
    """Softmax regression: the probability that a part holds a vector's neighbours. It starts from the parts' means."""

    def __init__(self, x: np.ndarray, part: np.ndarray, target: np.ndarray, epochs: int = 12):
        rng, parts = np.random.default_rng(3), target.shape[1]
        self.mean, self.scale = x.mean(axis=0), x.std() or 1.0
        z = (x - self.mean) / self.scale
        sums = np.zeros((parts, z.shape[1]))
        np.add.at(sums, part, z)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        w, b = 4 / math.sqrt(z.shape[1]) * (sums / np.where(size > 0, size, 1)).T, np.zeros(parts)
        m, s, t = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)], 0
        for epoch in range(epochs):
            order = rng.permutation(len(z))
            for some in (order[i : i + 512] for i in range(0, len(z), 512)):
                q = z[some] @ w + b
                q = np.exp(q - q.max(axis=1, keepdims=True))
                q = (q / q.sum(axis=1, keepdims=True) - target[some]) / len(some)
                t += 1
                for k, (p, g) in enumerate(((w, z[some].T @ q), (b, q.sum(axis=0)))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    p -= 1e-2 * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        self.w, self.b = w, b

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.w + self.b


def learn(x: np.ndarray, parts: int, near: float, cover: float) -> tuple[Router, int]:
    """The router and the number of parts a query is sent to. near: how many of a row's neighbours that count are in the
    sample, on average; so those measured are as far away as those searched for."""
    held = min(HELD, len(x) // 4)
    own, probe = x[held:], x[:held]
    links = graph(own, NEAR)
    part = balanced(own, links, parts)
    target = np.zeros((len(own), parts))
    np.add.at(target, (np.repeat(np.arange(len(own)), links.shape[1]), part[links.ravel()]), 1.0)
    target[np.arange(len(own)), part] += 1.0
    router = Router(own, part, target / target.sum(axis=1, keepdims=True))
    place, ranks = router(own).argmax(axis=1), (-router(probe)).argsort(axis=1).argsort(axis=1)
    m = min(len(own), max(1, round(near * len(own) / len(x))))
    best = np.argpartition(-(probe @ own.T), m - 1, axis=1)[:, :m]
    need = np.sort(np.take_along_axis(ranks, place[best], axis=1).ravel())
    return router, min(parts, int(need[min(len(need) - 1, math.ceil(cover * len(need)))]) + 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _best(x: np.ndarray, ids: np.ndarray, part: np.ndarray, q: np.ndarray, qids: np.ndarray, asked: list, k: int) -> pd.DataFrame:
    """The k best rows of x, in the parts that it asks for (null: all), for each query, but not those with its own id.
    Equal vectors are scored once, so rounding never parts ties; each score is summed in one order."""
    order = np.argsort(ids, kind="stable")
    x, ids, part = np.ascontiguousarray(x[order]), ids[order], part[order]
    _, one, which = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    members = [np.unique(ids[rows]).tolist() for rows in np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])]
    most = k + 1 + len(ids) - len(np.unique(ids))  # the query's own row may be among the best, and repeated rows of one id
    u, part = x[one], part[one]
    columns = {int(p): np.flatnonzero(part == p) for p in np.unique(part)}
    out: list[tuple] = []
    for a in range(0, len(q), 256):
        some, wanted = q[a : a + 256], asked[a : a + 256]
        asks: dict[int, list[int]] = {p: [] for p in columns}
        for i, parts in enumerate(wanted):
            for p in columns if parts is None else parts:
                if p in asks:
                    asks[p].append(i)
        s = np.full((len(some), len(u)), -np.inf)
        for p, rows in asks.items():
            if rows:
                s[np.ix_(rows, columns[p])] = some[rows] @ u[columns[p]].T
        kth = np.partition(s, max(0, len(u) - most), axis=1)[:, max(0, len(u) - most)]
        for i, row in enumerate(s):
            near = np.flatnonzero((row >= kth[i] - 1e-9 * max(1.0, abs(kth[i]))) & (row > -np.inf) if kth[i] > -np.inf else row > -np.inf)
            exact = (u[near] * some[i]).sum(axis=1)
            found = sorted((-v, m) for v, c in zip(exact.tolist(), near.tolist()) for m in members[c][:most] if m != qids[a + i])
            best = {m: v for v, m in reversed(found)}  # each id's best score
            out += [(int(qids[a + i]), m, -v) for v, m in sorted((v, m) for m, v in best.items())[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(rows: DataFrame, is_query, k: int = 20, vector: str = "embedding", cover: float = COVER) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each row for which is_query(vec_id) holds. cover: the
    share of neighbours that the probed parts are to hold."""
    x = cut(usable(rows, vector))
    usual = x.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d, n = (usual["d"], usual["count"]) if usual else (0, 0)
    parts = 1 << max(0, min(int(math.log2(MOST_PARTS)), round(math.log2(max(1, n) / PART))))
    if parts > 1:
        sample = sampled(x.where(F.size("v") == d), "vec_id", SAMPLE, n).select("v").toArrow()["v"].combine_chunks()  # at most SAMPLE rows
        sample = _matrix(sample)
        router, probes = learn(sample, parts, k * len(sample) / n, cover)
    else:
        router, probes = None, 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = np.zeros((b.num_rows, 1)) if router is None else router(_matrix(b["v"]))
            yield pa.record_batch([b["vec_id"], b["v"], pa.array(said.argmax(axis=1).astype(np.int32) if b.num_rows else [], pa.int32())], names=["vec_id", "v", "part"])

    same = x.where(F.size("v") == d)
    index = cut(same.mapInArrow(frugal(place), "vec_id long, v array<double>, part int"))
    # blocks of parts that lie together: at most MOST_PARTS rows
    block, filled, block_of = 0, 0, np.zeros(parts, np.int32)
    for r in sorted(index.groupBy("part").count().collect()):
        if filled and filled + r["count"] > BLOCK:
            block, filled = block + 1, 0
        block_of[r["part"]], filled = block, filled + r["count"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = np.zeros((b.num_rows, 1)) if router is None else router(_matrix(b["v"]))
            to = np.argsort(-said, axis=1, kind="stable")[:, :probes]
            rows: list[int] = []
            groups: list[int] = []
            lists: list[np.ndarray] = []
            for i, own in enumerate(to):
                own = np.sort(own)
                edges = np.flatnonzero(np.diff(block_of[own])) + 1
                for some in np.split(own, edges):
                    rows.append(i)
                    groups.append(int(block_of[some[0]]))
                    lists.append(some)
            take = pa.array(rows, pa.int64())
            yield pa.record_batch([b["vec_id"].take(take), b["v"].take(take), pa.array(groups, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], names=["vec_id", "v", "grp", "parts"])

    spark = rows.sparkSession
    blocks = F.broadcast(spark.createDataFrame([(p, int(g)) for p, g in enumerate(block_of)], "part int, grp int"))
    other = x.where(F.size("v") != d).withColumn("grp", -F.size("v"))  # rarer lengths, each a block of its own
    left = index.join(blocks, "part").select("vec_id", "v", "grp", "part").unionByName(other.select("vec_id", "v", "grp", F.lit(0).alias("part")))
    right = cut(same.where(is_query(F.col("vec_id"))).mapInArrow(frugal(ask), "vec_id long, v array<double>, grp int, parts array<int>").unionByName(
        other.where(is_query(F.col("vec_id"))).select("vec_id", "v", "grp", F.lit(None).cast("array<int>").alias("parts"))))
    shape = left.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).join(
        right.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("asks")), "grp")
    shape = cut(shape)
    shape = F.broadcast(shape) if shape.count() <= SMALL_IDS else shape
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col(n)).cast("int")
    left = left.join(shape, "grp").select("grp", deal("blocks").alias("block"), each("asks").alias("ask"), "vec_id", "v", "part")
    right = right.join(shape, "grp").select("grp", each("blocks").alias("block"), deal("asks").alias("ask"), "vec_id", "v", "parts")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        asked = [None if p is None else p.tolist() for p in b["parts"]]
        return _best(np.stack(a["v"]), a["vec_id"].to_numpy(), a["part"].to_numpy(), np.stack(b["v"]), b["vec_id"].to_numpy(), asked, k)

    keys = ["grp", "block", "ask"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # of each query only k rows of a task go on
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
