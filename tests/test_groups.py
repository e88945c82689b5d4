"""Many small groups, worked through in one pass over sorted rows."""

import numpy as np

from lodeflow.operators import boxes, evaluation, layout

SIDES = ", ".join(f"{s} double" for s in boxes.SIDES)


def page_boxes(seed: int, pages: int = 6, n: int = 25) -> list[tuple]:
    r = np.random.default_rng(seed)
    out = []
    for p in range(pages):
        for k in range(n):
            x, y, w, h = (float(v) for v in r.integers((0, 0, 1, 0), (400, 300, 40, 40)))
            out.append((p, p * n + k, x, y, x + w, y + h))
    return out


def test_merged_boxes_write_no_pairs(spark, monkeypatch):
    df = spark.createDataFrame([*page_boxes(1), (None, 999, 0.0, 0.0, 1.0, 1.0)], f"img int, id int, {SIDES}")
    by_joins = sorted(map(tuple, layout.merged_boxes(df, ["img"], "id", 64.0, most=0).collect()))
    monkeypatch.setattr(boxes, "overlap_join", None)
    assert sorted(map(tuple, layout.merged_boxes(df, ["img"], "id", 64.0).collect())) == by_joins and len(by_joins) > 6


def test_proposal_recall_makes_no_call_per_image(spark, monkeypatch):
    given = [(p, i, 1.0 - i / 1000, *b) for p, i, *b in page_boxes(2)]
    dets, truths = spark.createDataFrame(given, f"img int, box_id int, score double, {SIDES}"), spark.createDataFrame([(p, *b) for p, _, *b in page_boxes(3)] + [(99, 0.0, 0.0, 9.0, 9.0)], f"img int, {SIDES}")
    from pyspark.sql import GroupedData

    monkeypatch.setattr(GroupedData, "applyInPandas", None)
    got = {(r.area, r.threshold): r.recall for r in evaluation.proposal_recall(dets, truths, "img", [0.0, 0.1, 0.5]).collect()}
    cover = []
    for img in [*range(6), 99]:
        a, b = [d[3:] for d in given if d[0] == img], [t for p, _, *t in [*page_boxes(3), (99, 0, 0.0, 0.0, 9.0, 9.0)] if p == img]
        size = lambda x: (x[2] - x[0] + 1) * (x[3] - x[1] + 1)
        inter = lambda x, y: max(0.0, min(x[2], y[2]) - max(x[0], y[0]) + 1) * max(0.0, min(x[3], y[3]) - max(x[1], y[1]) + 1)
        pairs = sorted(((inter(x, y) / (size(x) + size(y) - inter(x, y)), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), reverse=True)
        used, best = set(), [0.0] * len(b)
        for v, i, j in pairs:
            if ("a", i) not in used and ("b", j) not in used:
                used |= {("a", i), ("b", j)}
                best[j] = v
        cover += best
    assert all(abs(got[("all", t)] - np.mean([v >= t for v in cover])) < 1e-12 for t in (0.0, 0.1, 0.5)) and got[("512-inf", 0.1)] is None
