"""Box algebra: overlaps, spatial joins, anchors, regression deltas, suppression, sampling."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeflow.operators import windows
from lodeflow.session import settle

SIDES = ("x1", "y1", "x2", "y2")


def _side(a: str, b: str, axis: str, plus: float) -> Column:
    return F.greatest(F.least(F.col(f"{a}{axis}2"), F.col(f"{b}{axis}2")) - F.greatest(F.col(f"{a}{axis}1"), F.col(f"{b}{axis}1")) + plus, F.lit(0.0))


def area(p: str = "", plus: float = 0.0) -> Column:
    return (F.col(f"{p}x2") - F.col(f"{p}x1") + plus) * (F.col(f"{p}y2") - F.col(f"{p}y1") + plus)


def intersection(a: str, b: str, plus: float = 0.0) -> Column:
    return _side(a, b, "x", plus) * _side(a, b, "y", plus)


def iou_pixel(a: str, b: str) -> Column:
    """Overlap over union where a box includes its last pixel."""
    i = intersection(a, b, 1.0)
    return i / (area(a, 1.0) + area(b, 1.0) - i)


def iou_plain(a: str, b: str, crowd: Column | None = None) -> Column:
    """Overlap over union of continuous boxes; if b is a crowd, over a's own area."""
    i = intersection(a, b)
    union = area(a) + area(b) - i
    return i / (union if crowd is None else F.when(crowd, area(a)).otherwise(union))


def over_min_area(a: str, b: str) -> Column:
    """Overlap over the smaller area."""
    return intersection(a, b) / F.least(area(a), area(b))


def over_query_area(a: str, b: str) -> Column:
    """Overlap over b's area, last pixels included."""
    return intersection(a, b, 1.0) / area(b, 1.0)


def tiles(p: str, size: float) -> Column:
    """Grid tiles that a box touches, as structs of column and row."""
    def run(lo, hi):
        return F.sequence(F.floor(F.col(lo) / size), F.greatest(F.floor(F.col(hi) / size), F.floor(F.col(lo) / size)))

    return F.flatten(F.transform(run(f"{p}x1", f"{p}x2"), lambda i: F.transform(run(f"{p}y1", f"{p}y2"), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def overlap_join(left: DataFrame, right: DataFrame, by: list[str], size: float, a: str = "a_", b: str = "b_") -> DataFrame:
    """Pairs of boxes of the same ``by`` that touch, with their columns prefixed ``a`` and ``b``.

    An equi-join on (by, tile) in place of a cross join: boxes meet only where they share a tile of ``size``, and a pair
    that shares several is taken in the tile of its common corner, so no distinct is needed.
    """
    lt = left.select(*by, *[F.col(c).alias(a + c) for c in left.columns if c not in by]).withColumn("__t", F.explode(tiles(a, size)))
    rt = right.select(*by, *[F.col(c).alias(b + c) for c in right.columns if c not in by]).withColumn("__t", F.explode(tiles(b, size)))
    corner = F.struct(F.floor(F.greatest(F.col(f"{a}x1"), F.col(f"{b}x1")) / size).alias("i"), F.floor(F.greatest(F.col(f"{a}y1"), F.col(f"{b}y1")) / size).alias("j"))
    met = lt.join(rt, [*by, "__t"])
    return met.where((F.col("__t") == corner) & (F.col(f"{a}x1") <= F.col(f"{b}x2")) & (F.col(f"{b}x1") <= F.col(f"{a}x2")) & (F.col(f"{a}y1") <= F.col(f"{b}y2")) & (F.col(f"{b}y1") <= F.col(f"{a}y2"))).drop("__t")


def best_match(pairs: DataFrame, keys: list[str], overlap: str, value: str) -> DataFrame:
    """Highest overlap of each key and what it is with; ties to the smallest ``value``."""
    return pairs.groupBy(*keys).agg(F.max(F.struct(F.col(overlap), (-F.col(value)).alias("__v"))).alias("__m")).select(*keys, F.col("__m")[overlap].alias(overlap), (-F.col("__m")["__v"]).alias(value))


def to_deltas(a: str, g: str) -> dict[str, Column]:
    """Regression deltas that take box a to box g (last pixels included)."""
    w, h = F.col(f"{a}x2") - F.col(f"{a}x1") + 1.0, F.col(f"{a}y2") - F.col(f"{a}y1") + 1.0
    gw, gh = F.col(f"{g}x2") - F.col(f"{g}x1") + 1.0, F.col(f"{g}y2") - F.col(f"{g}y1") + 1.0
    cx, cy = F.col(f"{a}x1") + w * 0.5, F.col(f"{a}y1") + h * 0.5
    gx, gy = F.col(f"{g}x1") + gw * 0.5, F.col(f"{g}y1") + gh * 0.5
    return {"dx": (gx - cx) / w, "dy": (gy - cy) / h, "dw": F.ln(gw / w), "dh": F.ln(gh / h)}


def from_deltas(a: str, dx: Column, dy: Column, dw: Column, dh: Column) -> dict[str, Column]:
    """Box that deltas make of box a."""
    w, h = F.col(f"{a}x2") - F.col(f"{a}x1") + 1.0, F.col(f"{a}y2") - F.col(f"{a}y1") + 1.0
    pw, ph = F.exp(dw) * w, F.exp(dh) * h
    # corner by corner, not from the middle and back: a size that stays adds no rounding, which could tip an overlap that equals its limit
    x, y = F.col(f"{a}x1") + dx * w + (w - pw) * 0.5, F.col(f"{a}y1") + dy * h + (h - ph) * 0.5
    return {"x1": x, "y1": y, "x2": x + pw, "y2": y + ph}


def clip(width: Column, height: Column, p: str = "") -> dict[str, Column]:
    """Box held inside an image."""
    def held(c, most):
        return F.greatest(F.least(F.col(p + c), most - 1), F.lit(0.0))

    return {"x1": held("x1", width), "y1": held("y1", height), "x2": held("x2", width), "y2": held("y2", height)}


def xywh_to_xyxy(x, y, w, h) -> dict[str, Column]:
    return {"x1": x, "y1": y, "x2": x + F.greatest(w - 1, F.lit(0)), "y2": y + F.greatest(h - 1, F.lit(0))}


def xyxy_to_xywh(p: str = "") -> dict[str, Column]:
    return {"x": F.col(f"{p}x1"), "y": F.col(f"{p}y1"), "w": F.col(f"{p}x2") - F.col(f"{p}x1") + 1, "h": F.col(f"{p}y2") - F.col(f"{p}y1") + 1}


def flipped(width: Column, p: str = "") -> dict[str, Column]:
    """Box of the mirrored image."""
    return {"x1": width - F.col(f"{p}x2") - 1, "x2": width - F.col(f"{p}x1") - 1}


def large_enough(least: float, p: str = "") -> Column:
    """Small boxes are dropped with >= for the width and > for the height."""
    w, h = F.col(f"{p}x2") - F.col(f"{p}x1") + 1, F.col(f"{p}y2") - F.col(f"{p}y1") + 1
    return (w >= least) & (h > least)


def both_sides(least: float, p: str = "") -> Column:
    return (F.col(f"{p}x2") - F.col(f"{p}x1") + 1 >= least) & (F.col(f"{p}y2") - F.col(f"{p}y1") + 1 >= least)


def valid_box(width: Column, height: Column, p: str = "") -> Column:
    return (F.col(f"{p}x1") >= 0) & (F.col(f"{p}y1") >= 0) & (F.col(f"{p}x2") >= F.col(f"{p}x1")) & (F.col(f"{p}y2") >= F.col(f"{p}y1")) & (F.col(f"{p}x2") < width) & (F.col(f"{p}y2") < height)


def inside_image(width: Column, height: Column, border: float = 0, p: str = "") -> Column:
    return (F.col(f"{p}x1") >= -border) & (F.col(f"{p}y1") >= -border) & (F.col(f"{p}x2") < width + border) & (F.col(f"{p}y2") < height + border)


def anchors(spark: SparkSession, base: int = 16, ratios: tuple = (0.5, 1.0, 2.0), scales: tuple = (8, 16, 32)) -> DataFrame:
    """Anchor boxes around a base cell: every ratio (area kept, sides rounded), then every scale."""
    rows, mid = [], (base - 1) / 2
    for r in ratios:
        w = round(math.sqrt(base * base / r))
        h = round(w * r)
        for s in scales:
            rows.append((len(rows), mid - (w * s - 1) / 2, mid - (h * s - 1) / 2, mid + (w * s - 1) / 2, mid + (h * s - 1) / 2))
    return spark.createDataFrame(rows, "anchor int, x1 double, y1 double, x2 double, y2 double")


def anchor_grid(base: DataFrame, width: int, height: int, stride: int) -> DataFrame:
    """Anchors moved to every cell of a feature map (a few rows times width times height, by two explodes)."""
    at = base.withColumn("gx", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).withColumn("gy", F.explode(F.sequence(F.lit(0), F.lit(height - 1))))
    return at.select("anchor", "gx", "gy", *[(F.col(s) + F.col("gx" if s[0] == "x" else "gy") * stride).alias(s) for s in SIDES])


def nms_arrays(box: np.ndarray, order: np.ndarray, threshold: float) -> list[int]:
    """Greedy suppression in a given order; an overlap equal to the threshold survives."""
    keep, alive = [], order
    size = (box[:, 2] - box[:, 0] + 1) * (box[:, 3] - box[:, 1] + 1)
    while len(alive):
        head, alive = alive[0], alive[1:]
        keep.append(int(head))
        w = np.minimum(box[head, 2], box[alive, 2]) - np.maximum(box[head, 0], box[alive, 0]) + 1
        h = np.minimum(box[head, 3], box[alive, 3]) - np.maximum(box[head, 1], box[alive, 1]) + 1
        both = np.maximum(w, 0) * np.maximum(h, 0)
        alive = alive[both / (size[head] + size[alive] - both) <= threshold]
    return keep


def nms_groups(box: np.ndarray, starts: np.ndarray, threshold: float, keep: int | None = None) -> np.ndarray:
    """Rows that greedy suppression keeps in each of many groups, ``keep`` at most, where a group's rows begin at its start and lie in order.

    All groups go side by side: in each round the first open box of every group is kept, and what it covers goes.
    """
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(box))))
    size = (box[:, 2] - box[:, 0] + 1) * (box[:, 3] - box[:, 1] + 1)
    kept, alive = [np.empty(0, np.int64)], np.arange(len(box))
    while len(alive) and (keep is None or len(kept) <= keep):
        first = np.append(True, np.diff(group[alive]) != 0)
        heads = alive[first]
        kept.append(heads)
        head, alive = heads[np.cumsum(first) - 1][~first], alive[~first]
        w = np.minimum(box[head, 2], box[alive, 2]) - np.maximum(box[head, 0], box[alive, 0]) + 1
        h = np.minimum(box[head, 3], box[alive, 3]) - np.maximum(box[head, 1], box[alive, 1]) + 1
        both = np.maximum(w, 0) * np.maximum(h, 0)
        alive = alive[both / (size[head] + size[alive] - both) <= threshold]
    return np.sort(np.concatenate(kept))


#: Boxes of a group that one task holds at most; larger groups are settled by rounds of joins.
GROUP_BOXES = 20_000


def nms(dets: DataFrame, by: list[str], score: str, key: str, threshold: float, top: int | None = None, keep: int | None = None, most: int = GROUP_BOXES) -> DataFrame:
    """Non-maximum suppression within each group: by falling score, then key. ``top`` rows before it, ``keep`` after it.

    One window ranks the boxes of each group, and a pass over its sorted rows cuts the groups, so tens of thousands of small groups cost no call each.
    Groups of more than ``most`` boxes (told by grouped counts) don't go to a task: see ``dominance``. Both give the same rows. Groups with a null in ``by`` are kept apart like any other.
    """
    ranked = dets.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), key)))
    if top is not None:
        ranked = ranked.where(F.col("__r") <= top)
    sized = settle(ranked.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > most)) if top is None or top > most else None
    large = sized is not None and not sized.isEmpty()
    names, at = ranked.columns, ranked.columns.index("__r")
    sides = [names.index(c) for c in SIDES]

    def run(batches):
        held = None

        def out(table: pa.Table, starts: np.ndarray):
            box = np.stack([table.column(c).to_numpy().astype(float) for c in sides], axis=1)
            yield from table.take(pa.array(nms_groups(box, starts, threshold, keep), pa.int64())).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            starts = np.flatnonzero(table.column(at).to_numpy() == 1)
            if len(starts) > 1:
                yield from out(table.slice(0, starts[-1]), starts[:-1])
            held = table.slice(starts[-1]).combine_chunks() if len(starts) else table
        if held is not None and held.num_rows:
            yield from out(held, np.zeros(1, int))

    small = ranked.join(F.broadcast(sized) if sized.limit(10_001).count() <= 10_000 else sized, by, "left_anti").select(*names) if large else ranked
    if large:  # a join may disturb the order of the window's rows
        small = small.repartition(*by).sortWithinPartitions(*by, "__r")
    done = small.mapInArrow(run, ranked.schema).drop("__r")
    if not large:
        return done
    return done.unionByName(dominance(ranked.join(sized.select(*by), by, "left_semi").select(*names), by, "__r", threshold, keep).drop("__r"))


def dominance(ranked: DataFrame, by: list[str], rank: str, threshold: float, keep: int | None = None) -> DataFrame:
    """Greedy suppression of groups of any size, in the order of ``rank`` (unique in a group).

    Pairs that overlap by more than ``threshold`` meet on tiles, once. In each round a box that no better open neighbour has is kept, and its
    worse neighbours go, until none is open. That is the greedy order's result, as a box's fate depends on its better neighbours alone;
    there are as many rounds as the longest chain of neighbours that decide on each other.
    """
    rows = settle(ranked)
    wide = rows.select(*by, rank, "x1", "y1", (F.col("x2") + 1).alias("x2"), (F.col("y2") + 1).alias("y2"))
    size = rows.agg(F.avg(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0] or 0.0
    pairs = overlap_join(wide, wide, by, max(1.0, 2.0 * size)).where(F.col(f"a_{rank}") < F.col(f"b_{rank}"))
    edges = settle(pairs.where(iou_plain("a_", "b_") > threshold).select(*by, F.col(f"a_{rank}").alias("__a"), F.col(f"b_{rank}").alias("__b")))
    open_, kept = settle(edges.select(*by, F.col("__a").alias(rank)).unionByName(edges.select(*by, F.col("__b").alias(rank))).distinct()), []
    alone = rows.join(open_, [*by, rank], "left_anti").select(*by, rank)
    while True:
        beaten = edges.select(*by, F.col("__b").alias(rank)).distinct()
        won = settle(open_.join(beaten, [*by, rank], "left_anti"))
        if won.isEmpty():
            break
        kept.append(won)
        gone = edges.join(won.select(*by, F.col(rank).alias("__a")), [*by, "__a"], "left_semi").select(*by, F.col("__b").alias(rank)).distinct()
        open_ = settle(open_.join(won, [*by, rank], "left_anti").join(gone, [*by, rank], "left_anti").select(*by, rank))
        still = open_.select(*by, rank)
        edges = settle(edges.join(still.withColumnRenamed(rank, "__a"), [*by, "__a"], "left_semi").join(still.withColumnRenamed(rank, "__b"), [*by, "__b"], "left_semi").select(*by, "__a", "__b"))
    ranks = reduce(DataFrame.unionByName, [alone, *kept])
    out = rows.join(ranks, [*by, rank], "left_semi").select(*ranked.columns)
    if keep is not None:
        out = out.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy(rank))).where(F.col("__k") <= keep).drop("__k")
    return out


def label_anchors(anchors: DataFrame, truths: DataFrame, by: list[str], key: str, size: float, positive: float = 0.7, negative: float = 0.3) -> DataFrame:
    """Label 1 for anchors with a high overlap or the best one of some truth, 0 for a low one, -1 between."""
    pairs = overlap_join(anchors, truths, by, size).withColumn("iou", iou_pixel("a_", "b_"))
    per_truth = pairs.withColumn("top", F.max("iou").over(Window.partitionBy(*by, f"b_{key}")))
    best = per_truth.groupBy(*by, F.col(f"a_{key}").alias(key)).agg(F.max("iou").alias("iou"), F.max((F.col("iou") == F.col("top")) & (F.col("iou") > 0)).alias("is_best"))
    labelled = anchors.join(best, [*by, key], "left")
    iou = F.coalesce("iou", F.lit(0.0))
    return labelled.withColumn("label", F.when(F.coalesce("is_best", F.lit(False)) | (iou >= positive), 1).when(iou < negative, 0).otherwise(-1)).withColumn("iou", iou).drop("is_best")


def example_weights(labelled: DataFrame, by: list[str], label: str = "label") -> DataFrame:
    """Inside weight 1 for positives; outside weight 1 / examples for every labelled anchor."""
    n = F.sum(F.when(F.col(label) >= 0, 1).otherwise(0)).over(Window.partitionBy(*by))
    return labelled.withColumn("inside", F.when(F.col(label) == 1, 1.0).otherwise(0.0)).withColumn("outside", F.when(F.col(label) >= 0, 1.0 / n).otherwise(0.0))


def with_truths(rois: DataFrame, truths: DataFrame) -> DataFrame:
    """Candidates and the truths themselves, which are candidates too."""
    return rois.unionByName(truths, allowMissingColumns=True)


def sample_rois(rois: DataFrame, by: list[str], key: str, overlap: str, size: int = 128, foreground: float = 0.25, fg: float = 0.5, bg_high: float = 0.5, bg_low: float = 0.0) -> DataFrame:
    """``size`` regions of each group: foreground by quota without repeats, and background drawn with repeats for all the rest.

    Where one kind is missing, the other is drawn ``size`` times with repeats; groups without either give nothing.
    Draws come from hashes, so they are the same at every run. ``kind`` tells the kinds, ``draw`` numbers the draws.
    """
    kind = F.when(F.col(overlap) >= fg, "fg").when((F.col(overlap) < bg_high) & (F.col(overlap) >= bg_low), "bg")
    cast = rois.withColumn("kind", kind).where(F.col("kind").isNotNull())
    ranked = cast.withColumn("__r", F.row_number().over(Window.partitionBy(*by, "kind").orderBy(F.xxhash64(*by, key), key)) - 1)
    n = cast.groupBy(*by).agg(F.count_if(F.col("kind") == "fg").alias("__fg"), F.count_if(F.col("kind") == "bg").alias("__bg"))
    quota = F.when(F.col("__bg") == 0, F.lit(0)).otherwise(F.least("__fg", F.lit(round(size * foreground))))
    drawn = n.withColumn("__q", quota).select(*by, "__q", F.when(F.col("__bg") > 0, "bg").otherwise("fg").alias("kind"), F.greatest("__fg", F.lit(1)).alias("__fg"), F.greatest("__bg", F.lit(1)).alias("__bg"), F.explode(F.sequence(F.col("__q"), F.lit(size - 1).cast("bigint"))).alias("draw"))
    pick = F.pmod(F.xxhash64(*by, "draw"), F.when(F.col("kind") == "bg", F.col("__bg")).otherwise(F.col("__fg")))
    repeats = drawn.select(*by, "kind", "draw", pick.alias("__r")).join(ranked, [*by, "kind", "__r"])
    firsts = ranked.where("kind = 'fg'").join(n.select(*by, quota.alias("__q")), by).where("__r < __q").withColumn("draw", F.col("__r").cast("bigint")).drop("__q")
    return firsts.unionByName(repeats.select(*firsts.columns)).drop("__r")


#: Means and deviations that regression targets are normalised by.
TARGET_MEANS, TARGET_STDS = (0.0, 0.0, 0.0, 0.0), (0.1, 0.1, 0.2, 0.2)
DELTAS = ("dx", "dy", "dw", "dh")


def normalised_targets(deltas: dict[str, Column]) -> dict[str, Column]:
    return {n: (deltas[n] - m) / s for n, m, s in zip(DELTAS, TARGET_MEANS, TARGET_STDS, strict=True)}


def raw_targets(p: str = "") -> list[Column]:
    """Deltas from normalised ones."""
    return [F.col(p + n) * s + m for n, m, s in zip(DELTAS, TARGET_MEANS, TARGET_STDS, strict=True)]


def detections(raw: DataFrame, by: list[str], key: str, least: float = 0.7, threshold: float = 0.3) -> DataFrame:
    """What a detector's head gives, as boxes of the page: by, key, score, box.

    ``raw``: proposals (box) of a scaled image with normalised deltas, the class's score, and the image's width,
    height and scale. Low scores go first, then boxes are moved, held inside the image, scaled back and suppressed.
    """
    high = raw.where(F.col("score") > least)
    moved = high.withColumns(from_deltas("", *raw_targets()))
    held = moved.withColumns(clip(F.col("width"), F.col("height"))).withColumns({s: F.col(s) / F.col("scale") for s in SIDES})
    return nms(held.select(*by, key, "score", *SIDES), by, "score", key, threshold)


def minibatch_truths(truths: DataFrame, scale: Column, all_truths: bool = True) -> DataFrame:
    """Truths of a class (not background), without crowds unless all count, in the scaled image's coordinates."""
    kept = truths.where("class <> 0") if all_truths else truths.where("class <> 0 and not crowd")
    return kept.withColumns({s: F.col(s) * scale for s in SIDES})


def crop_start(low: Column, high: Column, length: Column, window: Column, draw: Column) -> Column:
    """Where a window of a long side begins so that it holds the truths from ``low`` to ``high``, or else part of them.

    Truths at the front put it there. If they fit, any start that holds them will do, else any in the first half of what
    sticks out; ``draw`` (a whole number, such as a hash) chooses.
    """
    spread = high - low + 1
    first, last = F.greatest(high - window, F.lit(0)), F.least(low, length - window)
    out = F.floor((spread - window) / 2)
    fits = F.when(last > first, first + F.pmod(draw, last - first)).otherwise(first)
    part = F.when(out > 0, low + F.pmod(draw, F.greatest(out, F.lit(1)))).otherwise(low)
    return F.when(low == 0, F.lit(0)).when(spread < window, fits).otherwise(part).cast("bigint")


def cropped(df: DataFrame, by: list[str], axis: str, length: str, window: str) -> DataFrame:
    """Boxes of each image moved into a window of one axis and held inside it; ``crop`` is where the window begins."""
    w = Window.partitionBy(*by)
    size = F.least(F.col(window), F.col(length))
    low, high = F.min(f"{axis}1").over(w), F.max(f"{axis}2").over(w)
    at = df.withColumn("crop", crop_start(F.floor(low), F.floor(high), F.col(length), size, F.xxhash64(*by)))
    return at.withColumns({f"{axis}{k}": F.least(F.greatest(F.col(f"{axis}{k}") - F.col("crop"), F.lit(0.0)), size - 1) for k in "12"})


def proposals_with_truth(proposals: DataFrame, truths: DataFrame, by: list[str], key: str, size: float) -> DataFrame:
    """Proposals with the class of the truth that they overlap most and by how much; class 0 and 0.0 where none does."""
    pairs = overlap_join(proposals.select(*by, key, *SIDES), truths.select(*by, "class", F.col(key).alias("truth"), *SIDES), by, size).withColumn("overlap", iou_pixel("a_", "b_")).where("overlap > 0")
    best = pairs.groupBy(*by, F.col(f"a_{key}").alias(key)).agg(F.max_by("b_class", F.struct("overlap", -F.col("b_truth"))).alias("class"), F.max("overlap").alias("overlap"))
    return proposals.join(best, [*by, key], "left").withColumns({"class": F.coalesce("class", F.lit(0)), "overlap": F.coalesce("overlap", F.lit(0.0))})


def with_boxes(images: DataFrame, boxes_: DataFrame, by: list[str]) -> DataFrame:
    """Images that have a box."""
    return images.join(boxes_.select(*by).distinct(), by, "left_semi")


def smooth_l1(pred: Column, target: Column, inside: Column, outside: Column, sigma: float = 1.0) -> Column:
    d = F.abs(inside * (pred - target))
    s2 = sigma * sigma
    return outside * F.when(d < 1.0 / s2, d * d * s2 / 2).otherwise(d - 0.5 / s2)


def unique_boxes(df: DataFrame, by: list[str], order: str, scale: float = 1.0) -> DataFrame:
    """First of equal boxes, told by a linear hash of the rounded corners."""
    h = sum((F.round(F.col(s) * scale) * w for s, w in zip(SIDES, (1, 1e3, 1e6, 1e9), strict=True)), F.lit(0.0))
    return df.withColumn("__h", h).withColumn("__r", F.row_number().over(Window.partitionBy(*by, "__h").orderBy(order))).where("__r = 1").drop("__h", "__r")


def ratio_rank(df: DataFrame, width: str, height: str, key: str) -> DataFrame:
    """Aspect ratio held between 0.5 and 2, whether it was cropped, and the rank by it (by ranges, so no task sees all rows)."""
    r = F.col(width) / F.col(height)
    held = df.select("*", F.least(F.greatest(r, F.lit(0.5)), F.lit(2.0)).alias("ratio"), ((r > 2) | (r < 0.5)).alias("need_crop"))
    order = [F.col("ratio"), F.col(key)]
    parts = windows.ranged(held, [], order)
    return windows.running(parts, [], order, {"rank": F.lit(1)}).drop("__range")


def scale_factor(height: Column, width: Column, short: int = 600, long: int = 1000) -> Column:
    """Resize factor that brings the short side to ``short`` unless the long one would pass ``long``."""
    small, large = F.least(height, width), F.greatest(height, width)
    s = F.lit(float(short)) / small
    return F.when(F.round(s * large) > long, F.lit(float(long)) / large).otherwise(s)
