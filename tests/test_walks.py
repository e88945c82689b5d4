"""Walks over exons and matching steps are made once, not once for each use."""

import numpy as np
from pyspark.sql import functions as F

from lodeflow.operators import coordinates as C
from lodeflow.operators import evaluation


def test_nearest_boundary_is_sought_once(spark):
    rows = [(1, 1, 100, 170, 100, 170, [100, 150], [120, 170]), (2, -1, 100, 170, 110, 160, [100, 150], [120, 170])]
    tx, t = C.Transcript.attach(spark.createDataFrame(rows, "k int, strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>"))
    q = tx.withColumn("at", F.explode(F.array(*[F.lit(x).cast("bigint") for x in (95, 101, 120, 125, 148, 151, 175)])))
    made = t.from_chromosome(F.col("at"))
    assert made._jc.toString().count("array_min") == 1
    got = {(r.k, r.at): (r.p.pos, r.p.offset, r.p.utr3) for r in q.select("k", "at", made.alias("p")).collect()}
    assert got[1, 101] == (1, 0, False) and got[1, 120] == (20, 0, False) and got[1, 125] == (20, 5, False) and got[1, 148] == (21, -3, False) and got[1, 175] == (40, 5, False)
    assert got[2, 151] == (10, 0, False) and got[2, 120] == (11, 0, False) and got[2, 95] == (10, 6, True)


def test_areas_are_matched_side_by_side():
    r = np.random.default_rng(4)
    for _ in range(200):
        n, m = r.integers(1, 9), r.integers(0, 9)
        iou, crowd, ignore = r.integers(0, 6, (n, m)) / 5, r.random(m) < 0.3, r.random((4, m)) < 0.4
        both = evaluation.matched_truths(iou, crowd, ignore | crowd, [0.2, 0.5, 1.0])
        for area, row in zip(both, ignore | crowd, strict=True):
            for got, limit in zip(area, (0.2, 0.5, 1 - 1e-10), strict=True):
                free = set(range(m))
                for d in range(n):
                    some = [j for j in free if iou[d, j] >= limit]
                    some = [j for j in some if not row[j]] or some
                    want = max(some, key=lambda j: (iou[d, j], j), default=-1)
                    free -= set() if want < 0 or crowd[want] else {want}
                    assert got[d] == want
