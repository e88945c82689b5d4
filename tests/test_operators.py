"""Joins, fills, cascades, boxes, evaluation and layout on hand-computed cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeflow.operators import asof, boxes, dictionary, evaluation, keyed, layout, windows


def test_ffill(spark):
    rows = {0: ". G1 .", 1: ". . .", 2: "G2 . .", 3: ". . G3"}
    cells = [("t", r, c, None if v == "." else v) for r, line in rows.items() for c, v in enumerate(line.split())]
    got = windows.ffill_2d(spark.createDataFrame(cells, "t string, r int, c int, g string"), ["t"], "r", "c", "g", "f").collect()
    out = {r: " ".join(x.f or "." for x in sorted((x for x in got if x.r == r), key=lambda x: x.c)) for r in rows}
    assert out == {0: ". G1 G1", 1: ". G1 G1", 2: "G2 G2 G2", 3: "G2 G2 G3"}


def test_nearest(spark):
    genes = spark.createDataFrame([("f", 10.0, 1), ("f", 20.0, 2)], "k string, at double, id int")
    v = spark.createDataFrame([("f", 5.0), ("f", 14.0), ("f", 15.0), ("f", 25.0), ("g", 1.0)], "k string, at double")
    got = {(r.k, r.at): r.near_id for r in asof.nearest_asof(v, genes, ["k"], "at", ["id"]).collect()}
    assert got == {("f", 5.0): 1, ("f", 14.0): 1, ("f", 15.0): 2, ("f", 25.0): 2, ("g", 1.0): None}


def test_neighbour_and_spans(spark):
    x = spark.createDataFrame([(1, 0, 4, "a"), (1, 8, 10, "b"), (1, 40, 44, "c")], "k int, s int, e int, v string")
    assert [r.near for r in asof.neighbour_within(x, ["k"], "s", "e", "v", 5).orderBy("s").collect()] == [None, "a", None]
    p = spark.createDataFrame([(1, 3), (1, 5), (1, 9)], "k int, at int")
    assert [r.inside for r in asof.inside_spans(p, x.select("k", "s", "e"), ["k"], "at", "s", "e").orderBy("at").collect()] == [True, False, True]


def test_islands_and_tags(spark):
    tags = ["O", "B", "I", "B", "O", "I", "B"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "k int, i int, t string")
    assert sorted((r["first"], r["last"]) for r in windows.bio_spans(df, ["k"], "i", "t", "B", "O").collect()) == [(1, 2), (3, 3), (6, 6)]
    assert [r.island for r in windows.islands(df, ["k"], ["i"], [F.col("t")]).orderBy("i").collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_last_write_and_majority(spark):
    df = spark.createDataFrame([("k", 1, "T1"), ("k", 2, "T2"), ("j", 1, "T3")], "k string, n int, t string")
    assert {(r.k, r.t) for r in keyed.last_write(df, ["k"], "n", ["t"]).collect()} == {("k", "T2"), ("j", "T3")}
    m = spark.createDataFrame([("p", 7, 1, "a"), ("p", 9, 2, "b"), ("p", 9, 3, "c"), ("p", 7, 4, "d")], "p string, g int, o int, m string")
    assert [(r.g, r.n, r.m) for r in keyed.majority(m, ["p"], "g", "o", "m").collect()] == [(7, 2, "d")]


@pytest.mark.parametrize("tree_keys", [0, 10**6])
def test_longest_matches_against_every_run(spark, tree_keys):
    rng = random.Random(9)
    keys = {" ".join(rng.choices("abcd", k=rng.choice([1, 2, 2, 3, 5]))): i for i in range(60)}
    docs = [(i, [rng.choice("abcde") for _ in range(rng.randint(0, 40))]) for i in range(60)] + [(60, None), (61, []), (None, ["a", "b"]), (62, ["a"] * 3000)]
    want = []
    for i, toks in docs:
        at = 0
        while at < len(toks or []):
            n = max((n for n in range(1, 6) if at + n <= len(toks) and " ".join(toks[at : at + n]) in keys), default=0)
            if n and i is not None:
                want.append((i, at, at + n - 1, " ".join(toks[at : at + n]), keys[" ".join(toks[at : at + n])]))
            at += max(n, 1)
    df, words = spark.createDataFrame(docs, "id int, toks array<string>"), spark.createDataFrame(list(keys.items()), "key string, v int")
    got = [tuple(r) for r in dictionary.longest_matches(df.where("id is not null"), words, "id", "toks", "key", "v", tree_keys=tree_keys).collect()]
    assert sorted(got) == sorted(want)
    assert dictionary.longest_matches(df, words.limit(0), "id", "toks", "key", "v", tree_keys=tree_keys).count() == 0
    assert dictionary.longest_matches(df.limit(0), words, "id", "toks", "key", "v", tree_keys=tree_keys).count() == 0


def test_longest_match(spark):
    words = spark.createDataFrame([("a b", 1), ("a", 2), ("b c", 3), ("c", 4)], "key string, v int")
    docs = spark.createDataFrame([(1, "a b c".split()), (2, "x b c a".split()), (3, [])], "id int, toks array<string>")
    got = sorted((r.id, r["first"], r["last"], r.v) for r in dictionary.longest_matches(docs, words, "id", "toks", "key", "v").collect())
    assert got == [(1, 0, 1, 1), (1, 2, 2, 4), (2, 1, 2, 3), (2, 3, 3, 2)]
    one = dictionary.longest_matches(spark.createDataFrame([(1, ["a"])], "id int, toks array<string>"), words, "id", "toks", "key", "v", compat=True)
    assert one.count() == 0
    tree = spark.createDataFrame([("1", "MYO", None), ("1-1", "15", None), ("1-1-1", "A", 51168), ("2", "TNF", 7124)], "path string, token string, gene_id int")
    assert {(r.key, r.gene_id) for r in dictionary.prefix_paths(tree).collect()} == {("myo 15 a", 51168), ("tnf", 7124)}


def test_cascade(spark):
    names = spark.createDataFrame([("symbol", "brca1", 1), ("synonym", "tnfa", 7), ("synonym", "tnfa", 8), ("synonym", "p53", 5), ("other", "tumorprotein", 9)], "kind string, name_key string, gene_id int")
    toks = [(7, "tumor"), (7, "necrosis"), (8, "other"), (8, "thing"), (9, "tumor"), (9, "protein"), (3, "growth"), (3, "hormone")]
    gt = spark.createDataFrame(toks, "gene_id int, token string")
    nt = spark.createDataFrame([(g, f"n{g}", t) for g, t in toks], "gene_id int, name string, token string")
    m = spark.createDataFrame([(1, 0, 5, "BRCA1"), (1, 100, 106, "hBRCA1"), (1, 200, 204, "p53"), (1, 300, 304, "TNFa"), (1, 400, 420, "growth hormone x"), (1, 500, 503, "zzz"), (1, 505, 508, "p53"), (2, 0, 4, "TNFa")], "block int, start int, end int, mention string")
    art = spark.createDataFrame([(1, "necrosis"), (3, "x")], "block int, token string")
    got = {(r.block, r.start): (r.gene_id, r.step) for r in dictionary.resolve_names(m, names, gt, nt, art).collect()}
    assert got[(1, 0)] == (1, 2) and got[(1, 100)] == (1, 2) and got[(1, 200)] == (5, 3)
    assert got[(1, 300)] == (7, 8) and got[(1, 400)] == (3, 5) and got[(1, 500)] == (5, 10) and got[(2, 0)] == (None, None)


def frame(spark, rows, cols="img int, cls string, id int, score double, x1 double, y1 double, x2 double, y2 double"):
    return spark.createDataFrame(rows, cols)


def test_overlaps(spark):
    df = spark.createDataFrame([(0.0, 0.0, 9.0, 9.0, 5.0, 5.0, 14.0, 14.0)], ", ".join(f"{p}{s} double" for p in ("a_", "b_") for s in boxes.SIDES))
    assert abs(df.select(boxes.iou_pixel("a_", "b_")).first()[0] - 25 / 175) < 1e-12
    df = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 15.0, 15.0)], df.schema)
    got = df.select(boxes.iou_plain("a_", "b_"), boxes.iou_plain("a_", "b_", F.lit(True)), boxes.over_min_area("a_", "b_")).first()
    assert [round(x, 6) for x in got] == [round(25 / 175, 6), 0.25, 0.25]


def test_nms(spark):
    df = frame(spark, [(1, "t", 1, 0.9, 0.0, 0.0, 9.0, 9.0), (1, "t", 2, 0.8, 1.0, 1.0, 10.0, 10.0), (1, "t", 3, 0.7, 20.0, 20.0, 29.0, 29.0)])
    keep = lambda t: sorted(r.id for r in boxes.nms(df, ["img", "cls"], "score", "id", t).collect())
    assert keep(0.5) == [1, 3] and keep(0.7) == [1, 2, 3] and keep(81 / 119) == [1, 2, 3]


def test_average_precision(spark):
    flags = spark.createDataFrame([("c", 1, 0.9, 1, 0), ("c", 2, 0.8, 0, 1), ("c", 3, 0.7, 1, 0)], "cls string, id int, score double, tp int, fp int")
    truths = spark.createDataFrame([("c", 0), ("c", 0)], "cls string, difficult int")
    got = evaluation.average_precision(evaluation.curve(flags, truths, ["cls"], "score", ["id"]), ["cls"]).first()
    assert abs(got.ap - 5 / 6) < 1e-9 and abs(got.ap11 - 28 / 33) < 1e-9


def test_many_thresholds(spark):
    det = frame(spark, [(1, "c", 1, 0.9, 0.0, 0.0, 100.0, 100.0), (1, "c", 2, 0.8, 200.0, 200.0, 260.0, 260.0)])
    gt = frame(spark, [(1, "c", 1, 0.0, 0.0, 0.0, 100.0, 100.0), (1, "c", 2, 0.0, 200.0, 200.0, 300.0, 300.0)]).withColumn("crowd", F.lit(0))
    got = {r.metric: r.value for r in evaluation.summary(evaluation.accumulate(evaluation.match_images(det, gt, "img", "cls", "score"), "cls", "img")).collect()}
    assert abs(got["AP50"] - 51 / 101) < 1e-9 and abs(got["AR1"] - 0.5) < 1e-9 and got["AP_small"] == -1.0
    rec = {r.threshold: r.recall for r in evaluation.proposal_recall(det.withColumnRenamed("id", "box_id"), gt, "img", [0.3, 0.5]).where("area = 'all'").collect()}
    assert rec == {0.3: 1.0, 0.5: 0.5}


def test_layout(spark):
    spans = [("t", c * 50.0, r * 12.0, c * 50.0 + 30, r * 12.0 + 10, f"r{r}c{c}") for r in range(3) for c in range(2)]
    got = {(r.row, r.col): r.text for r in layout.grids(spark.createDataFrame(spans, "t string, x1 double, y1 double, x2 double, y2 double, text string"), ["t"]).collect()}
    assert got == {(r, c): f"r{r}c{c}" for r in range(3) for c in range(2)}
    side = "x1 double, y1 double, x2 double, y2 double"
    t = spark.createDataFrame([("d", 1, 0, 0.0, 50.0, 100.0, 90.0), ("d", 2, 0, 0.0, 0.0, 100.0, 40.0)], f"doc string, page int, table_idx int, {side}")
    c = spark.createDataFrame([("d", 1, 0, "Table 1", 0.0, 40.0, 100.0, 48.0)], f"doc string, page int, caption_idx int, text string, {side}")
    got = {r.page: (r.caption, r.continued) for r in layout.caption_tables(t, c, ["doc"], "page").collect()}
    assert got == {1: ("Table 1", False), 2: ("Table 1", True)}
    b = spark.createDataFrame([("d", 1, 0.0, 0.0, 10.0, 10.0), ("d", 2, 5.0, 5.0, 20.0, 20.0), ("d", 3, 18.0, 18.0, 30.0, 30.0), ("d", 4, 90.0, 90.0, 95.0, 95.0)], f"doc string, id int, {side}")
    assert {r.id for r in layout.merged_boxes(b, ["doc"], "id", 16.0).collect()} == {1, 4}


def test_layout_fixpoints_have_no_cap(spark):
    chain = spark.createDataFrame([(1, i, 10.0 * i, 0.0, 10.0 * i + 12, 10.0) for i in range(36)], "page int, box int, x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r) for r in layout.merged_boxes(chain, ["page"], "box", 500.0).collect()] == [(1, 0, 0.0, 0.0, 362.0, 10.0)]
    lines = spark.createDataFrame([(1, 0.0, 10.0 * i - 10, 50.0, 10.0 * i + 5, "r", 400.0) for i in range(1, 15)], "page int, x1 double, y1 double, x2 double, y2 double, dir string, width double")
    table = spark.createDataFrame([(1, 0.0, 0.0, 50.0, 10.0), (1, 300.0, 0.0, 350.0, 10.0)], "page int, x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r) for r in layout.adjust_tables(table, lines, ["page"]).collect()] == [(1, 0, 0.0, 0.0, 50.0, 145.0)]


def test_columns_of_ragged_lines():
    def span(x1, x2, y, t="t"):
        return {"x1": float(x1), "x2": float(x2), "y1": float(y), "y2": float(y) + 10, "text": t}

    lines = layout.lines_of([span(50 * c, 50 * c + 30 + 3 * r, 12 * r) for r in range(5) for c in range(3)])
    assert [len(x) for x in lines] == [5 - 2] * 5
    assert layout.column_edges(lines) == [39.0, 89.0, 139.0]
    assert layout.cell_of(span(60, 70, 30), [22.0, 40.0], [42.0, 92.0]) == (1, 1) and layout.cell_of(span(-9, -5, 90), [22.0, 40.0], [42.0, 92.0]) == (1, 0)


def test_neighbours_like_plain_loops(spark):
    import random

    r = random.Random(4)
    rows = [(k, s := r.randrange(200), s + r.randrange(1, 6), i) for i in range(150) for k in [r.randrange(3)]]

    def slow(k, s, e):
        before = max(((b, -a) for q, a, b, _ in rows if q == k and b < s), default=None)
        after = min(((a, b) for q, a, b, _ in rows if q == k and a > e), default=None)
        d, f = s - (before[0] if before else 0), (after[0] if after else 10_000) - e
        return ("b", before and before[0]) if d < f and d < 5 else ("a", after and after[0]) if d >= f and f < 5 else None

    df = spark.createDataFrame(rows, "k int, s int, e int, id int")
    spots = {i: (a, b) for _, a, b, i in rows}
    got = {x.id: x.near for x in asof.neighbour_within(df, ["k"], "s", "e", "id").collect()}
    for k, s, e, i in rows:
        want = slow(k, s, e)
        near = got[i]
        assert (near is None) == (want is None or want[1] is None), (i, near, want)
        if near is not None:
            assert spots[near][1 if want[0] == "b" else 0] == want[1]


def test_running_values_of_large_groups(spark):
    n = 3000
    df = spark.range(n).selectExpr("id % 2 as k", "id * 7919 % 3001 as o", "id % 3 as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = windows.ranged(df, ["k"], [F.col("o")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts.select("__range").distinct().count() > 1
    got = windows.highest_ahead(windows.running(parts, ["k"], [F.col("o")], {"c": F.col("v")}), ["k"], [F.desc("o")], "v", "m").collect()
    for k in (0, 1):
        own = sorted((x.o, x.v, x.c, x.m) for x in got if x.k == k)
        total = 0
        for i, (_, v, c, m) in enumerate(own):
            total += v
            assert c == total and m == max(x[1] for x in own[i:])


def test_samples_and_targets(spark):
    rois = spark.createDataFrame([(1, i, i / 40) for i in range(40)] + [(2, i, 0.1) for i in range(3)] + [(3, 0, 0.9)], "img int, id int, iou double")
    got = boxes.sample_rois(rois, ["img"], "id", "iou", 32).collect()
    n = {(i, k): sum(x.img == i and x.kind == k for x in got) for i in (1, 2, 3) for k in ("fg", "bg")}
    assert n == {(1, "fg"): 8, (1, "bg"): 24, (2, "fg"): 0, (2, "bg"): 32, (3, "fg"): 32, (3, "bg"): 0}
    assert len({x.id for x in got if x.img == 1 and x.kind == "fg"}) == 8


def test_options_and_lookup(spark):
    import pytest

    from lodeflow import cli, options

    base = {"a": 1.0, "g": {"n": 2, "s": "x", "l": [1]}, "b": False}
    assert options.with_settings(base, ["a=3", "g.s=hello", "g.l=(4, 5)"]) == {"a": 3.0, "g": {"n": 2, "s": "hello", "l": [4, 5]}, "b": False}
    for bad, error in (("q=1", KeyError), ("g.n='t'", TypeError), ("b=1", TypeError)):
        with pytest.raises(error):
            options.with_settings(base, [bad])
    index = spark.createDataFrame([("chr1", 5, "A", "G", "p1", 0, 3, "c.1A>G")], "chrom string, pos bigint, ref string, alt string, paper_id string, file_idx int, start int, mention string")
    assert cli.answer(index, "chr1 5 A G", cli.OPTIONS | {"gene_label": "G1"}) == ["G1\tchr1 5 A G\t1", "p1\tc.1A>G"]


def test_layout_of_spans_without_width_ends():
    rng = random.Random(3)
    span = lambda a, b: {"x1": float(a), "x2": float(b), "y1": 0.0, "y2": 1.0, "text": ""}
    assert layout.column_edges([[span(5, 5), span(20, 30)]]) == [5.0, 30.0]
    for _ in range(3000):
        lines = [[span(a, a + rng.choice([0, 0, 0, 3])) for a in rng.choices(range(8), k=rng.randint(1, 5))] for _ in range(rng.randint(1, 4))]
        edges = layout.column_edges(lines)
        assert len(edges) <= sum(map(len, lines))
    box = lambda k: np.array([[x, y, x + rng.choice([0, 2, 5]), y + rng.choice([0, 2, 5])] for x, y in zip(rng.choices(range(40), k=k), rng.choices(range(40), k=k), strict=True)], dtype=float)
    for _ in range(300):
        k = rng.randint(1, 12)
        assert layout.page_tables(box(rng.randint(1, 4)), box(k), np.array(rng.choices([0, 1], k=k)), 40.0).shape[1] == 4


def test_suppression_of_any_group_is_the_greedy_one(spark):
    rng = random.Random(5)
    rows = []
    for img in range(30):
        for i in range(rng.choice([1, 2, 7, 40]) if img else 900):
            x, y = rng.randint(0, 120), rng.randint(0, 120)
            rows.append((img if img != 3 else None, rng.choice("ab"), i, float(rng.randint(0, 50)), float(x), float(y), float(x + rng.randint(0, 40)), float(y + rng.randint(0, 40)), f"t{i}"))
    df = spark.createDataFrame(rows, "img int, cls string, id int, score double, x1 double, y1 double, x2 double, y2 double, note string").repartition(3)
    want = set()
    for key in {(r[0], r[1]) for r in rows}:
        group = sorted((r for r in rows if (r[0], r[1]) == key), key=lambda r: (-r[3], r[2]))
        kept = boxes.nms_arrays(np.array([r[4:8] for r in group]), np.arange(len(group)), 0.3)
        want |= {(*key, group[i][2]) for i in kept}
    for most in (10**6, 300):
        got = boxes.nms(df.where("img is not null"), ["img", "cls"], "score", "id", 0.3, most=most)
        assert got.columns == df.columns and all(r["note"] == f"t{r['id']}" for r in got.collect())
        assert {(r["img"], r["cls"], r["id"]) for r in got.collect()} == {w for w in want if w[0] is not None}
    few = boxes.nms(df.where("img = 0"), ["img", "cls"], "score", "id", 0.3, keep=2, most=100).collect()
    assert {(r["cls"], r["id"]) for r in few} == {(r["cls"], r["id"]) for r in boxes.nms(df.where("img = 0"), ["img", "cls"], "score", "id", 0.3, keep=2).collect()} and len(few) == 4
    assert {(r["img"], r["cls"], r["id"]) for r in boxes.nms(df, ["img", "cls"], "score", "id", 0.3).collect()} == want
    assert boxes.nms(df.limit(0), ["img", "cls"], "score", "id", 0.3).count() == 0
