"""Masks of very many runs: each step takes time in proportion to them."""

import time

from pyspark.sql import functions as F

from lodeflow.functions import rle

RUNS = 200_000
SECONDS = 60


def test_encode_of_many_runs(spark):
    start = time.perf_counter()
    px = spark.range(RUNS).select(F.lit(1).alias("m"), "id", ((F.col("id") + 1) % 2).cast("int").alias("v"))
    got = rle.encode(px, ["m"], "id", "v").select(F.size("counts").alias("n"), F.slice("counts", 1, 3).alias("first"), rle.area(F.col("counts")).alias("area")).first()
    assert (got.n, got["first"], got.area) == (RUNS + 1, [0, 1, 1], RUNS // 2)
    assert time.perf_counter() - start < SECONDS


def test_bbox_of_many_runs(spark):
    start = time.perf_counter()
    counts = F.concat(F.array(F.lit(5)), F.array_repeat(F.lit(1), RUNS))
    row = spark.range(1).select(counts.alias("c")).select(rle.to_bbox(F.col("c"), F.lit(20)).alias("b"), F.element_at(rle.ends(F.col("c")), -1).alias("e")).first()
    assert (row.b.x, row.b.y, row.b.w, row.b.h, row.e) == (0, 1, (RUNS + 4) // 20 + 1, 19, RUNS + 5)  # every other pixel from the fifth on
    assert time.perf_counter() - start < SECONDS


def test_runs_on(spark):
    rows = [([0, 6, 1],), ([2, 3, 1, 1],), ([4, 0, 2, 3, 5],), ([7],), ([],), (None,)]
    got = [r[0] if r[0] is None else [tuple(x) for x in r[0]] for r in spark.createDataFrame(rows, "c array<int>").select(rle.runs_on(F.col("c"))).collect()]
    assert got == [[(0, 6)], [(2, 5), (6, 7)], [(6, 9)], [], [], None]


def test_merge_of_many_runs(spark):
    start = time.perf_counter()
    a, b = F.array_repeat(F.lit(1), RUNS), F.concat(F.array(F.lit(0)), F.array_repeat(F.lit(1), RUNS))
    m = spark.range(2).select(F.lit(1).alias("img"), F.when(F.col("id") == 0, a).otherwise(b).alias("counts"), F.lit(RUNS).alias("size"))
    got = [rle.merge(m, ["img"], "counts", "size", both).select(rle.area(F.col("counts"))).first()[0] for both in (False, True)]
    assert got == [RUNS, 0] and time.perf_counter() - start < SECONDS


def test_merge_of_edges(spark):
    rows = [(1, [0, 4, 2], 6), (1, [2, 2, 2], 6), (2, [6], 6), (2, [6], 6), (3, [0, 6], 6), (3, [0, 6], 6)]
    m = spark.createDataFrame(rows, "img int, counts array<int>, size int")
    got = [{r.img: r.counts for r in rle.merge(m, ["img"], "counts", "size", both).collect()} for both in (False, True)]
    assert got == [{1: [0, 4, 2], 2: [6], 3: [0, 6]}, {1: [2, 2, 2], 2: [6], 3: [0, 6]}]


def test_iou_of_many_runs(spark):
    start = time.perf_counter()
    a, b = F.array_repeat(F.lit(1), RUNS), F.concat(F.array(F.lit(0)), F.array_repeat(F.lit(2), RUNS // 2))
    got = rle.iou(spark.range(1).select(a.alias("a"), b.alias("b")), "a", "b").first()
    assert got.iou == (RUNS // 4) / (RUNS // 2 + RUNS // 2 - RUNS // 4) and time.perf_counter() - start < SECONDS


def test_common_equals_pixels():
    for a, b in (([0, 3, 2], [1, 1, 1, 2]), ([5], [0, 5]), ([2, 0, 1, 2], [0, 1, 0, 4]), ([0, 4], [0, 9]), ([], [0, 2])):
        px = [[i % 2 for i, n in enumerate(c) for _ in range(n)] for c in (a, b)]
        assert rle.common(a, b) == sum(x * y for x, y in zip(*px, strict=False))
