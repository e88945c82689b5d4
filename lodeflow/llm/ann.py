"""Approximate nearest neighbours: learned partitions of a neighbour graph, a classifier that routes, and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeflow.llm.common import map_rows, session, settle

#: Rows that the partitions and the classifier are fitted on at most, and their components in all: what driver and tasks hold.
SAMPLE = 8192
SAMPLE_VALUES = 1 << 22
#: Partitions at most (they grow with the root of the number of rows), neighbours of a row in the graph, hidden units.
PARTS = 256
DEGREE = 10
HIDDEN = 128
#: Rows whose true neighbours among all rows set the number of partitions that a query is sent to, and the recall that they must have.
TRIAL = 256
TARGET = 0.97
#: Components on one side of a local problem, about.
BLOCK_VALUES = 1 << 20


@dataclass
class Router:
    """A classifier with one hidden layer: the most probable partitions of vectors."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def order(self, vectors: list, n: int) -> np.ndarray:
        """The ``n`` most probable partitions of each vector, most probable first; vectors of another length are cut or filled with zeros."""
        x = np.zeros((len(vectors), len(self.mean)))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v[: len(self.mean)]
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return np.argsort(-(h @ self.w2 + self.b2), axis=1, kind="stable")[:, :n]


def untrained(width: int) -> Router:
    """All vectors go to partition 0."""
    return Router(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, ``v`` as stored."""
    v = F.col("embedding")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.where(F.col("vec_id").isNotNull() & v.isNotNull() & whole & F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))


def graph(spark: SparkSession, sample: np.ndarray) -> np.ndarray:
    """Numbers of the DEGREE nearest rows of each row of the sample; blocks of rows are searched in tasks."""
    n = len(sample)
    sent = spark.sparkContext.broadcast(sample)

    def make():
        x = sent.value.astype(np.float64)
        sq = (x * x).sum(axis=1)

        def run(starts):
            out_i, out_n = [], []
            for start in starts:
                rows = np.arange(start, min(start + 256, n))
                d = sq[None, :] - 2 * (x[rows] @ x.T)
                d[np.arange(len(rows)), rows] = np.inf
                near = np.argpartition(d, DEGREE, axis=1)[:, :DEGREE] if n > DEGREE + 1 else np.array([[j for j in range(n) if j != i] for i in rows])
                out_i += rows.tolist()
                out_n += near.tolist()
            return [out_i, out_n]

        return run

    starts = spark.range(0, n, 256, numPartitions=max(1, math.ceil(n / 256)))
    rows = map_rows(starts, ["id"], "i int, near array<int>", make).collect()
    return np.array([r["near"] for r in sorted(rows, key=lambda r: r["i"])], dtype=np.int64)


def halves(x: np.ndarray, u: np.ndarray, v: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two equal sides of a graph with few edges between them: split at the median of the main direction, then swaps of the nodes that gain most."""
    n = len(x)
    z = x - x.mean(axis=0)
    direction = rng.standard_normal(x.shape[1])
    for _ in range(8):
        direction = z.T @ (z @ direction)
        direction /= np.linalg.norm(direction) or 1.0
    side = np.zeros(n, dtype=bool)
    side[np.argsort(z @ direction, kind="stable")[n // 2 :]] = True
    best, best_cut = side.copy(), np.inf
    for _ in range(16):
        across = side[u] != side[v]
        if across.sum() < best_cut:
            best, best_cut = side.copy(), across.sum()
        gain = np.bincount(u, weights=np.where(across, 1.0, -1.0), minlength=n)
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        t = min(len(a), len(b))
        swap = np.flatnonzero((gain[a[:t]] + gain[b[:t]] > 0) & (rng.random(t) < 0.5))
        if not len(swap):
            break
        side[a[swap]], side[b[swap]] = True, False
    return best


def partition(x: np.ndarray, near: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Balanced partition of the neighbour graph (``parts``, a power of two) by repeated halving; parts differ by a row or so for each level."""
    rng = np.random.default_rng(seed)
    u = np.repeat(np.arange(len(x)), near.shape[1])
    v = near.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    label = np.zeros(len(x), dtype=np.int64)
    for _ in range(parts.bit_length() - 1):
        inner = label[u] == label[v]
        u, v = u[inner], v[inner]
        place, side = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        for p in np.unique(label):
            nodes = np.flatnonzero(label == p)
            place[nodes] = np.arange(len(nodes))
            own = label[u] == p
            side[nodes] = halves(x[nodes], place[u[own]], place[v[own]], rng) if len(nodes) > 1 else False
        label = 2 * label + side
    return label


def train(x: np.ndarray, label: np.ndarray, near: np.ndarray, parts: int, epochs: int = 30, seed: int = 0) -> Router:
    """Cross-entropy against the partitions of a row's neighbours and its own, by Adam on small batches."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = (x - mean) / scale
    target = np.zeros((len(x), parts))
    for column in [label, *label[near].T]:
        target[np.arange(len(x)), column] += 1.0 / (near.shape[1] + 1)
    weights = [rng.standard_normal((x.shape[1], HIDDEN)) * math.sqrt(2 / x.shape[1]), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * math.sqrt(1 / HIDDEN), np.zeros(parts)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rows = rng.permutation(len(x))
        for i in range(0, len(rows), 256):
            at = rows[i : i + 256]
            h = np.maximum(z[at] @ weights[0] + weights[1], 0)
            s = h @ weights[2] + weights[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            err = (p / p.sum(axis=1, keepdims=True) - target[at]) / len(at)
            back = (err @ weights[2].T) * (h > 0)
            step += 1
            for j, g in enumerate([z[at].T @ back, back.sum(axis=0), h.T @ err, err.sum(axis=0)]):
                first[j] += 0.1 * (g - first[j])
                second[j] += 0.001 * (g * g - second[j])
                weights[j] -= 3e-3 * (1 - epoch / epochs) * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *weights)


def fit(spark: SparkSession, rows: DataFrame, n: int, parts: int | None = None, sample: int = SAMPLE) -> tuple[Router, int]:
    """Router and number of partitions, from at most ``sample`` of the ``n`` rows, which a hash of id and vector picks."""
    at = F.xxhash64("vec_id", "v")
    share = min(1.0, 1.5 * sample / max(1, n) + 1e-9)
    picked = rows.where(at.cast("double") < (share * 2 - 1) * 2.0**63).orderBy(at, "vec_id").limit(sample).collect()
    picked = picked or rows.limit(sample).collect()
    width = max(len(r["v"]) for r in picked)
    picked = picked[: max(16, SAMPLE_VALUES // width)]
    x = np.zeros((len(picked), width))
    for i, r in enumerate(picked):
        x[i, : len(r["v"])] = r["v"]
    peak = np.abs(x).max()
    if peak > 1e100:  # squares must stay finite; routing only needs directions and relative sizes
        x = x / peak
    parts = parts or 1 << max(0, int(math.log2(math.sqrt(n))))
    parts = 1 << int(math.log2(max(1, min(parts, PARTS, len(x) // 4))))
    if parts == 1:
        return untrained(width), 1
    near = graph(spark, x)
    router = train(x, partition(x, near, parts), near, parts)
    if peak > 1e100:
        router.mean, router.scale = router.mean * peak, router.scale * peak
    return router, parts


def nearest(q_ids: np.ndarray, q: list, d_ids: np.ndarray, d: list, k: int) -> list[tuple[int, int, float]]:
    """(query, vec, distance) of each query's ``k`` nearest ids but its own, ties to smaller ids; only vectors of equal length are compared.

    Distances by a matrix product, with a bound of their error for each, choose whom to measure; distances given are those of the differences.
    """
    out: list[tuple[int, int, float]] = []
    q_len, d_len = np.array([len(v) for v in q]), np.array([len(v) for v in d])
    for width in np.unique(q_len):
        rows = np.flatnonzero(d_len == width)
        if not len(rows):
            continue
        x, ids = np.array([d[i] for i in rows], dtype=np.float64), np.asarray(d_ids)[rows]
        # of equal vectors only the k + 1 smallest ids can matter
        _, same = np.unique(np.ascontiguousarray(x).view(f"V{8 * width}").ravel(), return_inverse=True)
        order = np.lexsort((ids, same))
        order = order[np.r_[True, (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0)]]
        starts = np.flatnonzero(np.r_[True, np.diff(same[order]) != 0])
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        keep = order[rank <= k]
        keep = keep[np.argsort(ids[keep], kind="stable")]
        x, ids = x[keep], ids[keep]
        groups = np.flatnonzero(np.r_[True, np.diff(ids) != 0])
        with np.errstate(over="ignore", invalid="ignore"):
            sq = (x * x).sum(axis=1)
            asked = np.flatnonzero(q_len == width)
            for i in range(0, len(asked), 256):
                at = asked[i : i + 256]
                y, own = np.array([q[j] for j in at], dtype=np.float64), np.asarray(q_ids)[at]
                size = (y * y).sum(axis=1)[:, None] + sq[None, :]
                rough, error = size - 2 * (y @ x.T), size * (4 * (width + 8) * 2.0**-53)
                error[~np.isfinite(rough)] = np.inf
                rough[~np.isfinite(rough)] = 0.0
                upper = rough + error
                upper[ids[None, :] == own[:, None]] = np.inf
                per_id = upper if len(groups) == len(ids) else np.minimum.reduceat(upper, groups, axis=1)
                kth = np.partition(per_id, k - 1, axis=1)[:, k - 1] if per_id.shape[1] > k else np.full(len(at), np.inf)
                for j in range(len(at)):
                    near = np.flatnonzero((rough[j] - error[j] <= kth[j]) & (ids != own[j]))
                    diff = x[near] - y[j]
                    dist = np.sqrt((diff * diff).sum(axis=1))
                    near, dist = near[(o := np.lexsort((ids[near], dist)))], dist[o]
                    _, best = np.unique(ids[near], return_index=True)
                    out += [(int(own[j]), int(ids[near[b]]), float(dist[b])) for b in np.sort(best)[:k]]
    return out


def index(table: DataFrame, parts: int | None = None, sample: int = SAMPLE) -> tuple[DataFrame, Router, int]:
    """Every usable row with its partition, materialised, the router and the number of partitions (0 for a table without usable rows)."""
    spark = session(table)
    rows = usable(table)
    n = rows.count()
    if not n:
        return rows.withColumn("part", F.lit(0)), untrained(1), 0
    router, parts = fit(spark, rows, n, parts, sample)
    sent = spark.sparkContext.broadcast(router)
    kind = rows.schema["v"].dataType.simpleString()

    def make():
        return lambda ids, vs: [ids, vs, sent.value.order(vs, 1)[:, 0].tolist()]

    return settle(map_rows(rows, ["vec_id", "v"], f"vec_id bigint, v {kind}, part int", make)), router, parts


def probes(indexed: DataFrame, router: Router, parts: int, k: int, target: float = TARGET, trial: int = TRIAL) -> tuple[int, float]:
    """The smallest number of partitions with a recall of ``target`` for ``trial`` rows, and that recall: their true neighbours among all rows are found in tasks, a stated set of queries against blocks of rows."""
    spark = session(indexed)
    n = indexed.count()
    at = F.xxhash64("v", "vec_id")
    share = min(1.0, 2.0 * trial / n + 1e-9)
    picked = indexed.where(at.cast("double") < (share * 2 - 1) * 2.0**63).orderBy(at, "vec_id").limit(trial).collect() or indexed.limit(trial).collect()
    ids, vs = np.array([r["vec_id"] for r in picked]), [r["v"] for r in picked]
    sent = spark.sparkContext.broadcast((ids, vs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vs = sent.value
        best = pd.DataFrame({"q": [], "vec_id": [], "score": [], "part": []})
        for b in batches:
            part = dict(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
            new = pd.DataFrame(nearest(ids, vs, b.column(0).to_numpy(), b.column(1).to_pylist(), k), columns=["q", "vec_id", "score"])
            best = pd.concat([best, new.assign(part=new["vec_id"].map(part))]).sort_values(["q", "score", "vec_id"]).groupby("q").head(k)
        yield pa.RecordBatch.from_pandas(best.astype({"q": "int64", "vec_id": "int64", "score": "float64", "part": "int32"}), preserve_index=False)

    found = indexed.select("vec_id", "v", "part").mapInArrow(run, "q bigint, vec_id bigint, score double, part int")
    found = found.selectExpr("q", "part", "row_number() over (partition by q order by score, vec_id) as r").where(F.col("r") <= k).collect()
    if not found:
        return 1, 1.0
    place = {int(i): {int(p): j for j, p in enumerate(row)} for i, row in zip(ids, router.order(vs, parts), strict=True)}
    ranks = np.array([place[r["q"]][r["part"]] for r in found])
    recall = np.searchsorted(np.sort(ranks), np.arange(parts), side="right") / len(ranks)
    p = int(np.argmax(recall >= min(target, recall[-1])))
    return p + 1, float(recall[p])


def search(table: DataFrame, k: int = 10, every: int = 100, parts: int | None = None, sample: int = SAMPLE, target: float = TARGET, told: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the ``k`` nearest rows by Euclidean distance of every row whose vec_id is divisible by ``every``.

    A sample's neighbour graph is cut into balanced parts with few edges between them; a small classifier learns to tell a row's part, and that of its neighbours.
    Every row of the table is indexed under its most probable part. A query goes to its most probable parts, as many as ``probes`` measured to
    be needed for a recall of ``target``; their rows are compared with it in full, in double precision. Parts are cut into blocks of rows
    and of queries, so that a part with a third of all rows is no larger problem than another. ``told`` gets ``parts``, ``probes`` and the
    ``recall`` of the trial. Where vectors point everywhere alike in many dimensions most parts must be asked.
    Defined results: null vectors, vectors of zeros or with null or non-finite components, empty vectors and null ids
    take no part; a query's own id is never its result; an id with several vectors counts with its nearest, as query and as result, and repeated rows count
    once; vectors of unlike lengths are not compared; fewer than k candidates give fewer results; an empty table gives no rows; other columns are not read.
    """
    spark = session(table)
    indexed, router, parts = index(table, parts, sample)
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked, recall = probes(indexed, router, parts, k, target)
    if told is not None:
        told.update(parts=parts, probes=asked, recall=recall)
    sent = spark.sparkContext.broadcast(router)
    kind = indexed.schema["v"].dataType.simpleString()

    def make():
        return lambda ids, vs: [ids, vs, sent.value.order(vs, asked).tolist()]

    routed = map_rows(indexed.where(F.col("vec_id") % every == 0), ["vec_id", "v"], f"vec_id bigint, v {kind}, parts array<int>", make)
    routed = settle(routed).select("vec_id", "v", F.explode("parts").alias("part"))
    block = max(64, BLOCK_VALUES // max(1, len(router.mean)))
    q_count = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    d_count = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}
    sizes = [(p, math.ceil(n / block), math.ceil(q_count[p] / block)) for p, n in d_count.items() if p in q_count]
    sizes = F.broadcast(spark.createDataFrame(sizes, "part int, blocks int, q_blocks int"))  # one row a part
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q_rows = routed.join(sizes, "part").select("part", copies("blocks").alias("block"), deal("q_blocks").alias("q_block"), "vec_id", "v")
    d_rows = indexed.join(sizes, "part").select("part", deal("blocks").alias("block"), copies("q_blocks").alias("q_block"), "vec_id", "v")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got = nearest(left["vec_id"].to_numpy(), list(left["v"]), right["vec_id"].to_numpy(), list(right["v"]), k) if len(left) and len(right) else []
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = ["part", "block", "q_block"]
    local = q_rows.groupBy(*key).cogroup(d_rows.groupBy(*key)).applyInPandas(solve, "query_id bigint, vec_id bigint, score double")
    # one exchange by query serves both the minimum of an id and the ranks
    merged = local.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = merged.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score, vec_id) as int) as rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
