"""Run-length masks as arrays of counts (column-major, zeros first)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def encode(pixels: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Counts of the runs of 0 and 1 in order, as (by, counts); a leading zero run of length 0 if the first pixel is set."""
    w = Window.partitionBy(*by).orderBy(order)
    change = pixels.withColumn("__c", F.when(F.coalesce(F.lag(value).over(w), F.lit(0)) != F.col(value), 1).otherwise(0))
    runs = change.withColumn("__i", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*by, "__i").agg(F.count("*").cast("int").alias("__n"))
    # a look into a map is a walk through it, so the runs are sorted instead; they are numbered without a gap, from 1 if the first pixel is set
    held = runs.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("__i", "__n"))).alias("__r"))
    lead = F.when(F.col("__r")[0]["__i"] == 1, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return held.select(*by, F.concat(lead, F.col("__r")["__n"]).alias("counts"))


def decode(counts: Column) -> Column:
    """Pixels, in column-major order."""
    return F.flatten(F.transform(counts, lambda n, i: F.array_repeat((i % 2).cast("int"), n)))


def area(counts: Column) -> Column:
    """Number of set pixels."""
    return F.aggregate(F.filter(counts, lambda n, i: i % 2 == 1), F.lit(0).cast("bigint"), lambda a, n: a + n)


def ends(counts: Column) -> Column:
    """Where each run ends, counted from the first pixel."""
    @F.pandas_udf("array<bigint>")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else np.cumsum(x, dtype=np.int64))

    return run(counts)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def runs_on(counts: Column) -> Column:
    """Runs of set pixels as structs of begin and end (exclusive)."""
    at = ends(counts)
    begins, stops = F.filter(at, lambda _, i: i % 2 == 0), F.filter(at, lambda _, i: i % 2 == 1)
    return F.filter(F.zip_with(begins, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda r: r["a"] < r["b"])


def to_bbox(counts: Column, height: Column) -> Column:
    """Bounding box (x, y, w, h) of the set pixels, zeros if there are none."""
    zero = F.lit(0).cast("bigint")

    def box(runs):
        first, last = (lambda r: F.floor(r["a"] / height)), (lambda r: F.floor((r["b"] - 1) / height))
        full = lambda r: first(r) != last(r)
        x1, x2 = F.array_min(F.transform(runs, first)), F.array_max(F.transform(runs, last))
        y1 = F.array_min(F.transform(runs, lambda r: F.when(full(r), zero).otherwise(r["a"] % height)))
        y2 = F.array_max(F.transform(runs, lambda r: F.when(full(r), height.cast("bigint") - 1).otherwise((r["b"] - 1) % height)))
        none = F.struct(zero.alias("x"), zero.alias("y"), zero.alias("w"), zero.alias("h"))
        return F.when(F.size(runs) > 0, F.struct(x1.alias("x"), y1.alias("y"), (x2 - x1 + 1).alias("w"), (y2 - y1 + 1).alias("h"))).otherwise(none)

    return let(runs_on(counts), box)


def _edges(masks: DataFrame, by: list[str], counts: str) -> DataFrame:
    """Positions where a mask switches on (+1) or off (-1)."""
    e = masks.select(*by, F.posexplode(ends(F.col(counts))).alias("i", "at"), F.size(counts).alias("k"))
    return e.select(*by, F.col("at"), F.when(F.col("i") % 2 == 0, 1).otherwise(-1).alias("d"))


def merge(masks: DataFrame, by: list[str], counts: str, size: str, intersect: bool) -> DataFrame:
    """Union or intersection of the masks of each group: (by, counts), by a sweep over all switches.

    ``size`` is the column with the number of pixels, the same for a group.
    """
    total = masks.groupBy(*by).agg(F.count("*").alias("n"), F.max(size).alias("size"))
    steps = _edges(masks, by, counts).groupBy(*by, "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*by).orderBy("at")
    level = steps.join(total, by).withColumn("on", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    need = F.col("n") if intersect else F.lit(1)
    lit = level.withColumn("v", F.when(F.col("on") >= need, 1).otherwise(0)).where("at < size")
    turn = lit.withColumn("p", F.coalesce(F.lag("v").over(w), F.lit(0))).where("v <> p").groupBy(*by).agg(F.array_sort(F.collect_list("at")).alias("t"))
    full = total.join(turn, by, "left").withColumn("t", F.coalesce("t", F.array().cast("array<bigint>")))
    stops = F.filter(F.concat("t", F.array(F.col("size").cast("bigint"))), lambda x, i: (x > 0) | (i == 0))
    # beside each stop the one before it, as a lambda that names the stops would make them anew for each
    before = F.slice(F.concat(F.array(F.lit(0).cast("bigint")), stops), F.lit(1), F.size(stops))
    return full.select(*by, F.zip_with(stops, before, lambda x, b: (x - b).cast("int")).alias("counts"))


def common(a: list[int], b: list[int]) -> int:
    """Number of pixels that two masks both set, by one merge of their switches."""
    own, other = np.cumsum(a, dtype=np.int64), np.cumsum(b, dtype=np.int64)
    stop = np.union1d(own, other)
    start = np.concatenate(([0], stop))[:-1]
    run, against = np.searchsorted(own, start, side="right"), np.searchsorted(other, start, side="right")
    both = (run % 2 == 1) & (run < len(own)) & (against % 2 == 1) & (against < len(other))
    return int((stop - start)[both].sum())


def common_area(a: Column, b: Column) -> Column:
    @F.pandas_udf("bigint")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else common(p, q) for p, q in zip(x, y, strict=True)], dtype="Int64")

    return run(a, b)


def iou(pairs: DataFrame, a: str, b: str, crowd: Column | None = None) -> DataFrame:
    """Adds ``iou`` of two masks; if the second is a crowd, over the first one's area."""
    sized = pairs.withColumn("__i", common_area(F.col(a), F.col(b)))
    union = area(F.col(a)) + area(F.col(b)) - F.col("__i")
    under = union if crowd is None else F.when(crowd, area(F.col(a))).otherwise(union)
    return sized.withColumn("iou", F.coalesce(F.try_divide(F.col("__i"), under), F.lit(0.0))).drop("__i")


def from_bbox(x: Column, y: Column, w: Column, h: Column, height: Column, width: Column) -> Column:
    """Counts of a filled box with whole corners inside an image: one run for each of its columns."""
    x0, x1 = F.greatest(x, F.lit(0)), F.least(x + w, width)
    y0, y1 = F.greatest(y, F.lit(0)), F.least(y + h, height)
    tall, n = y1 - y0, x1 - x0
    some = (tall > 0) & (n > 0)
    first = (x0 * height + y0).cast("int")
    inner = F.flatten(F.array_repeat(F.array(tall.cast("int"), (height - tall).cast("int")), F.greatest(n - 1, F.lit(0)).cast("int")))
    rest = (height * width - (first + (n - 1) * height + tall)).cast("int")
    tail = F.when(rest > 0, F.array(tall.cast("int"), rest)).otherwise(F.array(tall.cast("int")))
    solid = F.when(rest > 0, F.array(first, (n * height).cast("int"), rest)).otherwise(F.array(first, (n * height).cast("int")))
    return F.when(~some, F.array((height * width).cast("int"))).when(tall == height, solid).otherwise(F.concat(F.array(first), inner, tail))


#: Fixed value: a polygon's corners and edges are rounded to a grid so many times finer than pixels.
_FINE = 5


def polygon_counts(xy: list[float], h: int, w: int) -> list[int]:
    """Counts of a filled polygon given as x, y, x, y, ...: each column of pixels is switched where an edge crosses it.

    A column's middle lies between two neighbouring places of the finer grid; an edge crosses it at the smaller y
    that it has at these two, rounded to the grid along its longer side. Crossings in one place cancel out.
    """
    corner = np.trunc(np.array(xy, dtype=float).reshape(-1, 2) * _FINE + 0.5).astype(np.int64)
    column = np.arange(w, dtype=np.int64)
    middle = _FINE * column + _FINE // 2
    switches = [np.empty(0, dtype=np.int64)]
    for p, q in zip(corner, np.roll(corner, -1, axis=0), strict=True):
        span = np.abs(q - p)
        a, b = (p, q) if p[0 if span[0] >= span[1] else 1] <= q[0 if span[0] >= span[1] else 1] else (q, p)
        hit = (middle >= min(p[0], q[0])) & (middle < max(p[0], q[0]))
        at = middle[hit]
        if not len(at):
            continue
        if span[0] >= span[1]:
            slope = (b[1] - a[1]) / span[0]
            y = np.minimum(*(np.trunc(a[1] + slope * (at + k - a[0]) + 0.5) for k in (0, 1)))
        else:
            x = np.trunc(a[0] + (b[0] - a[0]) / span[1] * np.arange(span[1] + 1) + 0.5)
            sign = 1 if b[0] > a[0] else -1
            y = a[1] + np.searchsorted(sign * x, sign * (at + (sign < 0)), side="right") - 1
        row = np.ceil(np.clip((y + 0.5) / _FINE - 0.5, 0, h)).astype(np.int64)
        switches.append(column[hit] * h + row)
    place, times = np.unique(np.concatenate(switches), return_counts=True)
    place = place[(times % 2 == 1) & (place < h * w)]
    return np.diff(np.concatenate(([0], place, [h * w]))).tolist()


def to_text(counts: list[int]) -> str:
    """Printable form: groups of five bits with a continuation bit, counts from the fourth on as differences to two before."""
    out = []
    for i, c in enumerate(counts):
        x = c - counts[i - 2] if i > 2 else c
        more = True
        while more:
            low = x & 31
            x >>= 5
            more = x != -1 if low & 16 else x != 0
            out.append(chr((low | 32 if more else low) + 48))
    return "".join(out)


def from_text(text: str) -> list[int]:
    """Counts of a printable form."""
    out, i = [], 0
    while i < len(text):
        x, k, more = 0, 0, True
        while more:
            c = ord(text[i]) - 48
            x |= (c & 31) << (5 * k)
            more = bool(c & 32)
            i, k = i + 1, k + 1
            if not more and c & 16:
                x |= -1 << (5 * k)
        out.append(x + out[-2] if len(out) > 2 else x)
    return out


def text_column(counts: Column) -> Column:
    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else to_text([int(v) for v in x]))

    return run(counts)


def counts_column(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else from_text(x))

    return run(text)


def polygon_column(xy: Column, height: Column, width: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(p: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else polygon_counts(list(x), int(a), int(b)) for x, a, b in zip(p, h, w, strict=True)])

    return run(xy, height, width)
