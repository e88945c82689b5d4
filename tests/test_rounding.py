"""Results on an edge, where the order of the arithmetic decides."""

from pyspark.sql import functions as F

from lodeflow.operators import boxes
from lodeflow.sources import sinks


def test_histogram_edges(spark):
    bins = lambda *v: {r.bin: r.n for r in sinks.histogram(spark.createDataFrame([(x,) for x in v], "value double"), "value", 50).collect()}
    assert bins(0.0, 58.0, 100.0) == {1: 1, 29: 1, 50: 1}
    assert bins(3.0, 3.0) == {50: 2}


def test_moved_boxes_keep_their_size(spark):
    rows = [(float(x), float(y), float(x + 10 + k), float(y + 20 + k), 0.013 * k) for x in range(0, 300, 7) for y in range(0, 200, 11) for k in range(1, 5)]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, d double")
    got = df.select("*", *[c.alias(f"n_{s}") for s, c in boxes.from_deltas("", F.col("d"), -F.col("d"), F.lit(0.0), F.lit(0.0)).items()]).collect()
    for r in got:
        w, h = r.x2 - r.x1 + 1, r.y2 - r.y1 + 1
        assert (r.n_x1, r.n_y1) == (r.x1 + r.d * w, r.y1 - r.d * h) and (r.n_x2, r.n_y2) == (r.n_x1 + w, r.n_y1 + h)
