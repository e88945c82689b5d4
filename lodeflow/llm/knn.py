"""Exact top-k by inner product: a Voronoi join of queries and data."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import map_rows, session, settle

#: Most pivots of the Voronoi cells (they grow with the root of the number of rows); with the cells' summaries all that is held on the driver.
PIVOTS = 512
#: Data rows and queries that one local problem holds, about.
DATA_BLOCK = 8192
QUERY_BLOCK = 4096


def quantise(vector: list | None, scale: float = 256.0) -> list[int] | None:
    """floor(scale * x) of each component; None for null vectors and for null or non-finite components."""
    if vector is None:
        return None
    try:
        x = np.array(vector, dtype=np.float64)
    except TypeError:
        return None
    if not np.isfinite(x).all():
        return None
    y = np.floor(x * scale)
    if np.abs(y).max(initial=0.0) >= 2.0**62:
        return None
    return y.astype(np.int64).tolist()


def quantised(table: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): the rows that take part, equal rows once."""

    def make():
        return lambda ids, vs: [ids, [None if i is None else quantise(v, scale) for i, v in zip(ids, vs, strict=True)]]

    rows = map_rows(table, ["vec_id", "embedding"], "vec_id bigint, v array<bigint>", make)
    return rows.where("v is not null and size(v) > 0").dropDuplicates(["vec_id", "v"])


def _matrix(vs) -> np.ndarray:
    """Rows as a float matrix, padded with zeros to the longest."""
    n = max((len(v) for v in vs), default=0)
    out = np.zeros((len(vs), n))
    for i, v in enumerate(vs):
        out[i, : len(v)] = v
    return out


def _fit(x: np.ndarray, n: int) -> np.ndarray:
    return x if x.shape[1] == n else np.pad(x[:, :n], ((0, 0), (0, max(0, n - x.shape[1]))))


def scores(q: list, d: list) -> np.ndarray:
    """Exact integer inner products, over the shorter length of both, held within 64 bits."""
    a, b = _matrix(q), _matrix(d)
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if n * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return np.array([[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(u, w, strict=False)))) for w in d] for u in q], dtype=np.int64)


def best(q_ids, q: list, d_ids, d: list, k: int) -> list[tuple[int, int, int]]:
    """(query, vec, score) of each query's k best rows but its own, ties to smaller ids."""
    order = np.argsort(np.asarray(d_ids), kind="stable")
    d_ids = np.asarray(d_ids)[order]
    d = [d[i] for i in order]
    s = scores(q, d)
    d_ids, first = np.unique(d_ids, return_index=True)
    s = np.maximum.reduceat(s, first, axis=1)  # the best score of an id counts
    out = []
    for i, qid in enumerate(q_ids):
        row = s[i]
        if len(row) > k + 1:
            # one more than k, as the query's own row may be among them; every tie of the last is kept at first
            row_at = np.flatnonzero(row >= np.partition(row, len(row) - k - 1)[len(row) - k - 1])
        else:
            row_at = np.arange(len(row))
        row_at = row_at[d_ids[row_at] != qid]
        row_at = row_at[np.lexsort((d_ids[row_at], -row[row_at]))][:k]
        out += [(int(qid), int(d_ids[j]), int(row[j])) for j in row_at]
    return out


def top_k(table: DataFrame, k: int = 5, every: int = 50, pivots: int | None = None, data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK, told: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k rows of highest integer inner product.

    Queries are the rows whose vec_id is divisible by ``every``. Rows and queries are grouped by their nearest
    pivot. A cell's summary (number, radius, largest distances of its k + 1 rows nearest to the pivot) bounds
    every score: q.c lies within |q| * distance(c, pivot) of q.pivot. So a query's k-th best score is at least the
    (k+1)-th largest lower bound, and only cells whose upper bound reaches it get the query: first judged for
    a whole query cell by its own radius, then for the query itself. Queries are sent to the cells that they need;
    each cell is cut into blocks of about ``data_block`` rows, so a vector that a third of the rows share is no larger
    problem, and the queries that reached it into blocks of about ``query_block``; a cell's rows are copied once for each
    block of its own queries. Every pair of blocks is solved locally, and local results meet in a grouped top-k per query.
    Where vectors point everywhere alike in many dimensions no bound can spare a cell, and this is a blocked comparison
    of all queries with all rows; where they form clusters most cells are spared (``told`` gets the mean number of ``cells_per_query`` and that of ``cells``).
    Defined results: null vectors, vectors with null or non-finite components (or beyond 2^62 after scaling), empty
    vectors and null ids take no part; equal rows count once; a query's own id is never its result; vectors of
    unlike lengths are compared over the shorter length; fewer than k rows give fewer results;
    scores beyond 64 bits are held at their ends; other
    columns are not read.
    """
    spark = session(table)
    data = settle(quantised(table))
    pivots = pivots or min(PIVOTS, max(16, math.isqrt(data.count())))
    picked = data.orderBy(F.xxhash64("v"), "vec_id").limit(pivots).collect()
    if not picked:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    centre = _matrix([r["v"] for r in picked])
    sent = spark.sparkContext.broadcast(centre)

    def assign():
        c = sent.value
        half = (c * c).sum(axis=1) / 2

        def run(ids, vs):
            full = _matrix(vs)
            x = _fit(full, c.shape[1])
            cell = (half[None, :] - x @ c.T).argmin(axis=1)
            pad = np.zeros((len(c), full.shape[1]))
            pad[:, : min(c.shape[1], full.shape[1])] = c[:, : full.shape[1]]
            extra = (c[:, full.shape[1] :] ** 2).sum(axis=1) if c.shape[1] > full.shape[1] else np.zeros(len(c))
            dist = np.sqrt(((full - pad[cell]) ** 2).sum(axis=1) + extra[cell])
            return [ids, vs, cell.tolist(), dist.tolist()]

        return run

    celled = settle(map_rows(data, ["vec_id", "v"], "vec_id bigint, v array<bigint>, cell int, dist double", assign))
    summary = {r["cell"]: (r["n"], r["radius"]) for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()}
    # an id with several vectors counts once among the k best, so only the others' rows bound the k-th score
    several = settle(data.groupBy("vec_id").count().where("count > 1").select("vec_id"))
    closest = _closest(celled.join(several, "vec_id", "left_anti"), k + 1)
    is_query = F.col("vec_id") % every == 0
    queries = celled.where(is_query)
    q_summary = {r["cell"]: (r["n"], r["radius"]) for r in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()}
    plan = spark.sparkContext.broadcast((centre, summary, closest, q_summary, k))

    def route():
        c, summary, closest, q_summary, k = plan.value
        cells = np.array(sorted(summary))
        radius = np.array([summary[i][1] for i in cells])
        pivot = c[cells]
        near_d = np.concatenate([closest.get(i, np.empty(0)) for i in cells])
        near_c = np.concatenate([np.full(len(closest.get(i, ())), j) for j, i in enumerate(cells)])
        whole: dict[int, np.ndarray] = {}

        def cells_for(cell: int) -> np.ndarray:
            """Cells that any query of this query cell may need."""
            if cell not in whole:
                u = q_summary[cell][1]
                p = c[cell]
                norm = np.linalg.norm(p) + u
                centre_dot, slack = pivot @ p, u * np.linalg.norm(pivot, axis=1)
                low = np.sort(centre_dot[near_c] - slack[near_c] - norm * near_d)[::-1]
                theta = low[k] if len(low) > k else -np.inf
                whole[cell] = np.flatnonzero(centre_dot + slack + norm * radius >= theta - 1e-6 * (1 + abs(theta)))
            return whole[cell]

        def run(ids, vs, own):
            out = []
            x = _fit(_matrix(vs), c.shape[1])
            norms = np.sqrt(np.array([sum(float(a) * a for a in v) for v in vs]))
            for q, row, norm, cell in zip(range(len(ids)), x, norms, own, strict=True):
                dot = pivot @ row
                low = np.sort(dot[near_c] - norm * near_d)[::-1]
                theta = low[k] if len(low) > k else -np.inf
                sure = cells_for(cell)
                out.append([int(cells[j]) for j in sure if dot[j] + norm * radius[j] >= theta - 1e-6 * (1 + abs(theta))])
            return [ids, vs, out]

        return run

    routed = settle(map_rows(queries, ["vec_id", "v", "cell"], "vec_id bigint, v array<bigint>, cells array<int>", route)).withColumn("cell", F.explode("cells"))
    asked = {r["cell"]: r["count"] for r in routed.groupBy("cell").count().collect()}
    if told is not None:
        told.update(cells_per_query=sum(asked.values()) / max(1, sum(n for n, _ in q_summary.values())), cells=len(summary))
    sizes = spark.createDataFrame([(c, max(1, math.ceil(n / data_block)), math.ceil(asked[c] / query_block)) for c, (n, _) in summary.items() if c in asked], "cell int, parts int, qparts int")
    sizes = F.broadcast(sizes)  # one row a pivot
    hash_ = lambda *c: F.xxhash64(*c)
    q_rows = routed.join(sizes, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("qpart", F.pmod(hash_("vec_id"), F.col("qparts")).cast("int")).select("cell", "part", "qpart", "vec_id", "v")
    d_rows = celled.join(sizes, "cell").withColumn("part", F.pmod(hash_("vec_id", "v"), F.col("parts")).cast("int")).withColumn("qpart", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1))).select("cell", "part", "qpart", "vec_id", "v")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        got = []
        for i in range(0, len(left), 512):
            q = left.iloc[i : i + 512]
            got += best(q["vec_id"].to_numpy(), list(q["v"]), right["vec_id"].to_numpy(), list(right["v"]), k)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

    key = ["cell", "part", "qpart"]
    local = q_rows.groupBy(*key).cogroup(d_rows.groupBy(*key)).applyInPandas(solve, "query_id bigint, vec_id bigint, score bigint")
    # equal ids with unlike vectors: the better score of an id counts
    merged = local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = merged.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def _closest(celled: DataFrame, k: int) -> dict[int, np.ndarray]:
    """The k smallest distances to the pivot of each cell, largest first: a top-k within tasks, then over them."""

    def run(batches):
        import pyarrow as pa

        kept: dict[int, np.ndarray] = {}
        for b in batches:
            cell, dist = b.column(0).to_numpy(), b.column(1).to_numpy()
            for c in np.unique(cell):
                kept[int(c)] = np.sort(np.concatenate([kept.get(int(c), np.empty(0)), dist[cell == c]]))[:k]
        rows = [(c, float(d)) for c, ds in kept.items() for d in ds]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64())], names=["cell", "dist"])

    tops = celled.select("cell", "dist").mapInArrow(run, "cell int, dist double")
    ranked = tops.selectExpr("cell", "dist", "row_number() over (partition by cell order by dist) as r").where(F.col("r") <= k)
    out: dict[int, list[float]] = {}
    for r in ranked.collect():
        out.setdefault(r["cell"], []).append(r["dist"])
    return {c: np.array(d) for c, d in out.items()}
