"""Ranking quality: average precision in its variants, matching of detections, recall."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeflow.operators import boxes, windows
from lodeflow.session import settle


def rank_flags(dets: DataFrame, truths: DataFrame, by: list[str], image: str, det: str, gt: str, score: str, size: float, threshold: float = 0.5) -> DataFrame:
    """Each detection with ``tp`` and ``fp``: its best truth must overlap above the threshold; the first detection of a truth
    counts, later ones are false; a difficult truth makes neither. Windows only, no group leaves the JVM. Pairs at or
    below the threshold can't count and are dropped before the best one is sought."""
    pairs = boxes.overlap_join(dets, truths, [*by, image], size).withColumn("iou", boxes.iou_pixel("a_", "b_")).where(F.col("iou") > threshold)
    best = pairs.groupBy(*by, image, F.col(f"a_{det}").alias(det)).agg(F.max(F.struct("iou", (-F.col(f"b_{gt}")).alias("__g"), F.col("b_difficult").alias("difficult"))).alias("m"))
    found = dets.join(best, [*by, image, det], "left").select(*by, image, det, score, (-F.col("m")["__g"]).alias(gt), F.coalesce(F.col("m")["iou"], F.lit(0.0)).alias("iou"), F.coalesce(F.col("m")["difficult"], F.lit(0)).alias("difficult"))
    hit = F.col("iou") > threshold
    first = F.row_number().over(Window.partitionBy(*by, image, F.when(hit, F.col(gt)).otherwise(-F.col(det) - 1)).orderBy(F.desc(score), det)) == 1
    counted = hit & (F.col("difficult") == 0)
    return found.select("*", F.when(counted & first, 1).otherwise(0).alias("tp"), F.when(~hit | (counted & ~first), 1).otherwise(0).alias("fp"))


def curve(flags: DataFrame, truths: DataFrame, by: list[str], score: str, det: list[str]) -> DataFrame:
    """Recall, precision and its envelope at each rank. Detections are dealt out by ranges of their score: a class may hold most of them."""
    n = truths.where("difficult = 0").groupBy(*by).agg(F.count("*").alias("npos"))
    order = [F.desc(score), *[F.col(c) for c in det]]
    parts = windows.ranged(flags.join(n, by), by, order)
    run = windows.running(parts, by, order, {"rank": F.lit(1), "ctp": F.col("tp"), "cfp": F.col("fp")})
    pr = run.select("*", (F.col("ctp") / F.col("npos")).alias("recall"), F.coalesce(F.try_divide(F.col("ctp"), F.col("ctp") + F.col("cfp")), F.lit(0.0)).alias("precision"))
    return windows.highest_ahead(pr, by, [F.desc("rank")], "precision", "envelope").drop("__range")


def average_precision(points: DataFrame, by: list[str]) -> DataFrame:
    """Area under the envelope, and the mean of its values at eleven recalls."""
    # the recall before a row is what its own true positive has not yet added
    step = points.withColumn("dr", F.col("tp") / F.col("npos"))
    eleven = sum((F.coalesce(F.max(F.when(F.col("recall") >= F.lit(t / 10.0), F.col("precision"))), F.lit(0.0)) for t in range(11)), F.lit(0.0)) / 11.0
    return step.groupBy(*by).agg(F.sum(F.col("dr") * F.col("envelope")).alias("ap"), eleven.alias("ap11"))


def mean_ap(ap: DataFrame, npos: DataFrame, by: list[str]) -> DataFrame:
    """Plain mean and mean weighted by the number of truths."""
    return ap.join(npos, by).agg(F.avg("ap").alias("map"), (F.sum(F.col("ap") * F.col("npos")) / F.sum("npos")).alias("weighted_map"))


def operating_threshold(points: DataFrame, by: list[str], score: str) -> DataFrame:
    """Score that maximises p*r/(p+r) of each group; groups without one get the mean of the others."""
    f = F.try_divide(F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    best = points.withColumn("f", F.coalesce(f, F.lit(0.0))).groupBy(*by).agg(F.max(F.struct("f", score)).alias("m")).select(*by, F.when(F.col("m")["f"] > 0, F.col("m")[score]).alias("t"))
    return best.select(*by, F.coalesce("t", F.avg("t").over(Window.partitionBy())).alias("threshold"))


#: Parameters of the many-threshold evaluation.
IOUS = [round(0.5 + 0.05 * i, 2) for i in range(10)]
RECALLS = [round(0.01 * i, 2) for i in range(101)]
MAX_DETS = [1, 10, 100]
AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}


def matched_truths(iou: np.ndarray, crowd: np.ndarray, ignore: np.ndarray, limits: list[float]) -> np.ndarray:
    """(limit, detection): the number of the truth that each detection gets, in their order; -1 for none.

    A truth is taken once unless it is a crowd. A detection gets the free truth of the highest overlap at or above
    the limit, an ignored one only where no other reaches it; of equal overlaps the later truth.
    ``ignore`` may have a row for each of several areas; the result then is (area, limit, detection).
    All areas and limits are worked out side by side: one step for each detection that reaches any limit.
    """
    n_det, n_truth = iou.shape
    apart = np.atleast_2d(ignore)
    out = np.full((len(apart), len(limits), n_det), -1)
    if n_truth:
        # reversed, so that the first maximum is the later truth
        turned, crowds, apart = iou[:, ::-1], crowd[::-1], apart[:, None, ::-1]
        least = np.minimum(np.array(limits), 1 - 1e-10)
        reached = turned[:, None, :] >= least[None, :, None]
        free = np.ones((len(out), len(limits), n_truth), dtype=bool)
        for d in np.flatnonzero(reached.any(axis=(1, 2))).tolist():
            worth = np.where(free & reached[d], turned[d], -1.0)
            plain = np.where(apart, -1.0, worth)
            chosen = np.where(plain.max(axis=2, keepdims=True) >= 0, plain, worth)
            area, limit = np.nonzero(chosen.max(axis=2) >= 0)
            at = chosen.argmax(axis=2)[area, limit]
            out[area, limit, d] = n_truth - 1 - at
            free[area, limit, at] = crowds[at]
    return out if ignore.ndim > 1 else out[0]


def match_images(dets: DataFrame, truths: DataFrame, image: str, category: str, score: str, ious: list[float] = IOUS, areas: dict | None = None, most: int = 100) -> DataFrame:
    """Per (category, image, area, IoU): flags of the detections in order of score, as rows; boxes are x1 y1 x2 y2, continuous.

    Rows of truths (rank 0) carry ``npos``. The order-bound matching runs per (image, category), a bounded group.
    """
    areas = areas or AREAS
    both = dets.select(image, category, F.col(score).cast("double").alias("score"), *[F.col(s).cast("double") for s in boxes.SIDES], F.lit(0).alias("crowd"), F.lit(False).alias("is_gt")).unionByName(truths.select(image, category, F.lit(0.0).alias("score"), *[F.col(s).cast("double") for s in boxes.SIDES], F.col("crowd").cast("int"), F.lit(True).alias("is_gt")))

    def each(c: dict, start: int, end: int) -> list[np.ndarray]:
        split = start + int(np.searchsorted(c["is_gt"][start:end], True))  # detections first
        a, b = (np.stack([c[s][lo:hi] for s in boxes.SIDES], axis=1) for lo, hi in ((start, min(split, start + most)), (split, end)))
        crowd, score_of = c["crowd"][split:end].astype(bool), c["score"][start : start + len(a)]
        size_a, size_b = (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1]), (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
        w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
        h = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
        inter = np.maximum(w, 0) * np.maximum(h, 0)
        over = np.where(crowd[None, :], size_a[:, None], size_a[:, None] + size_b[None, :] - inter)
        iou = np.divide(inter, over, out=np.zeros_like(inter), where=over > 0)
        out: list[list[np.ndarray]] = [[] for _ in range(7)]
        limit, k = np.array(ious), len(ious)
        ignored = np.array([crowd | (size_b < lo) | (size_b > hi) for lo, hi in areas.values()])
        for (name, (lo, hi)), ignore, at in zip(areas.items(), ignored, matched_truths(iou, crowd, ignored, ious), strict=True):
            outside = (size_a < lo) | (size_a > hi)
            t, i = np.nonzero(np.where(at >= 0, ~np.append(ignore, False)[at], ~outside[None, :]))
            hit = (at[t, i] >= 0).astype(np.int32)
            none = np.zeros(k, dtype=np.int32)
            rows = [np.full(len(t) + k, name, dtype=object), np.concatenate([limit[t], limit]), np.concatenate([i + 1, none]).astype(np.int32), np.concatenate([score_of[i], none]), np.concatenate([hit, none]), np.concatenate([1 - hit, none]), np.concatenate([np.zeros(len(t), dtype=np.int32), none + np.int32((~ignore).sum())])]
            for o, x in zip(out, rows, strict=True):
                o.append(x)
        return [np.concatenate(o) for o in out]

    order = ["is_gt", F.desc("score"), *boxes.SIDES]
    return windows.sorted_groups(both, [image, category], order, each, [("area", "string"), ("iou", "double"), ("rank", "int"), ("score", "double"), ("tp", "int"), ("fp", "int"), ("npos", "int")])


def accumulate(matched: DataFrame, category: str, image: str, most: list[int] = MAX_DETS) -> DataFrame:
    """Mean precision at 101 recalls and highest recall, per category, area, IoU and most detections; -1 without truths."""
    matched = settle(matched)
    key = [category, "area", "iou", "max_det"]
    wide = matched.withColumn("max_det", F.explode(F.array(*[F.lit(m) for m in most]))).where(F.col("rank") <= F.col("max_det"))
    npos = wide.groupBy(*key).agg(F.sum("npos").alias("npos"))
    order = [F.desc("score"), F.col(image), F.col("rank")]
    parts = windows.ranged(wide.where("rank > 0").drop("npos").join(npos, key).where("npos > 0").select(*key, "npos", "score", image, "rank", "tp", "fp"), key, order)
    run = windows.running(parts, key, order, {"r": F.lit(1), "ctp": F.col("tp"), "cfp": F.col("fp")})
    scored = run.select(*key, (F.col("ctp") / F.col("npos")).alias("recall"), (F.col("ctp") / (F.col("ctp") + F.col("cfp"))).alias("p"))
    # recall never falls, so the best precision from the first point that reaches a recall on is the best of all points that reach it: the best of
    # each of 101 steps of recall is taken first, partly in the tasks, and steps are added up from what is left
    low = F.floor(F.col("recall") * 100).cast("int")
    reached = lambda i: F.col("recall") >= F.element_at(F.array(*[F.lit(r - 1e-12) for r in RECALLS]), F.least(i, F.lit(100)) + 1)
    step = F.when(reached(low + 1), F.least(low + 1, F.lit(100))).when(reached(low), low).otherwise(low - 1)
    best = settle(scored.groupBy(*key, step.alias("step")).agg(F.max("p").alias("p"), F.max("recall").alias("recall")))
    first = best.select(*key, "p", F.explode(F.sequence(F.lit(0), "step")).alias("t")).groupBy(*key, "t").agg(F.max("p").alias("env"))
    prec = first.groupBy(*key).agg((F.sum("env") / len(RECALLS)).alias("precision"))
    rec = best.groupBy(*key).agg(F.max("recall").alias("recall"))
    none = F.when(F.col("npos") > 0, F.lit(0.0)).otherwise(F.lit(-1.0))
    return npos.join(prec, key, "left").join(rec, key, "left").select(*key, "npos", F.coalesce("precision", none).alias("precision"), F.coalesce("recall", none).alias("recall"))


def summary(acc: DataFrame) -> DataFrame:
    """The twelve summary numbers, one row each."""
    def mean(value, **where):
        cond = F.col(value) > -1
        for k, v in where.items():
            cond = cond & (F.col(k) == v)
        return F.coalesce(F.avg(F.when(cond, F.col(value))), F.lit(-1.0))

    top = MAX_DETS[-1]
    numbers = [("AP", mean("precision", area="all", max_det=top)), ("AP50", mean("precision", area="all", max_det=top, iou=0.5)), ("AP75", mean("precision", area="all", max_det=top, iou=0.75))]
    numbers += [(f"AP_{a}", mean("precision", area=a, max_det=top)) for a in ("small", "medium", "large")]
    numbers += [(f"AR{m}", mean("recall", area="all", max_det=m)) for m in MAX_DETS]
    numbers += [(f"AR_{a}", mean("recall", area=a, max_det=top)) for a in ("small", "medium", "large")]
    one = acc.agg(*[c.alias(n) for n, c in numbers])
    return one.select(F.explode(F.array(*[F.struct(F.lit(i).alias("no"), F.lit(n).alias("metric"), F.col(n).alias("value")) for i, (n, _) in enumerate(numbers)])).alias("s")).select("s.*")


#: Areas of truths that proposal recall is told for, with the most that one covers.
PROPOSAL_AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10), "96-128": (96.0**2, 128.0**2), "128-256": (128.0**2, 256.0**2), "256-512": (256.0**2, 512.0**2), "512-inf": (512.0**2, 1e10)}


def proposal_recall(dets: DataFrame, truths: DataFrame, image: str, thresholds: list[float], limit: int | None = None, key: str = "box_id", areas: dict | None = None) -> DataFrame:
    """(area, threshold, recall, average_recall): recall by greedy cover, and its mean over the thresholds.

    In each image the truth with the best cover takes its proposal, again and again. Truths that are crowds, and those
    whose area isn't in the range, don't count; an area without truths has null recall. ``limit`` keeps the highest
    scores of each image. Equal covers are taken in the order of the corners. An image's boxes are one group, which the source bounds. ``truths`` may have a ``crowd`` column.
    """
    areas = areas or PROPOSAL_AREAS
    if limit is not None:
        dets = dets.withColumn("__r", F.row_number().over(Window.partitionBy(image).orderBy(F.desc("score"), key))).where(F.col("__r") <= limit)
    cols = [image, *[F.col(s).cast("double").alias(s) for s in boxes.SIDES]]
    real = truths.where("coalesce(crowd, 0) = 0") if "crowd" in truths.columns else truths
    both = dets.select(*cols, F.lit(False).alias("is_gt")).unionByName(real.select(*cols, F.lit(True).alias("is_gt")))

    def each(c: dict, start: int, end: int) -> list[np.ndarray]:
        box = np.stack([c[s][start:end] for s in boxes.SIDES], axis=1)
        split = int(np.searchsorted(c["is_gt"][start:end], True))  # proposals first
        given, truth = box[:split], box[split:]
        size = lambda x: (x[:, 2] - x[:, 0] + 1) * (x[:, 3] - x[:, 1] + 1)
        low, high = np.maximum(given[:, None, :2], truth[None, :, :2]), np.minimum(given[:, None, 2:], truth[None, :, 2:])
        inter = np.maximum(high - low + 1, 0).prod(axis=2)
        own_size = size(truth)
        iou = inter / (size(given)[:, None] + own_size[None, :] - inter)
        names, cover = [], []
        for name, (lo, hi) in areas.items():
            within = (own_size >= lo) & (own_size <= hi)
            if not within.any():
                continue
            own = iou[:, within].copy()
            got = np.zeros(own.shape[1])
            for k in range(min(own.shape)):
                p, q = divmod(int(own.argmax()), own.shape[1])
                if own[p, q] <= 0:  # what is left covers nothing
                    break
                got[k] = max(0.0, own[p, q])
                own[p, :], own[:, q] = -1, -1
            names.append(np.full(len(got), name, dtype=object))
            cover.append(got)
        return [np.concatenate(names), np.concatenate(cover)] if names else [np.empty(0, dtype=object), np.empty(0)]

    cover = windows.sorted_groups(both, [image], ["is_gt", *boxes.SIDES], each, [("area", "string"), ("cover", "double")])
    at = [F.avg(F.when(F.col("cover") >= t, 1.0).otherwise(0.0)) for t in thresholds]
    every = truths.sparkSession.createDataFrame([(a,) for a in areas], "area string")
    told = every.join(cover.groupBy("area").agg(*[c.alias(f"r{i}") for i, c in enumerate(at)]), "area", "left")
    mean = sum((F.col(f"r{i}") for i in range(len(thresholds))), F.lit(0.0)) / len(thresholds)
    return told.select("area", mean.alias("average_recall"), F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"r{i}").alias("recall")) for i, t in enumerate(thresholds)])).alias("s")).select("area", "s.threshold", "s.recall", "average_recall")
