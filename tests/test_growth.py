"""Steps whose work must be dealt out, or made once a row, to grow no faster than their input and result."""

from pyspark.sql import functions as F

from lodeflow.operators import keyed


def test_rows_of_one_key_are_dealt_out(spark):
    left = spark.createDataFrame([(i, "A") for i in range(200)] + [(200, "B"), (201, None), (201, None), (7, "A")], "p bigint, k string")
    right = spark.createDataFrame([(i, "A") for i in range(50)] + [(0, "A"), (99, "C"), (98, None)], "s bigint, k string")
    got = keyed.expanded(left, right, "k", "s", slices=16, chunk=7)
    want = left.join(right, "k").select("p", "k", "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.select(F.spark_partition_id().alias("t")).distinct().count() > 4


def test_synonyms_of_a_small_file_take_all_cores(spark):
    from __spark_entry__ import queries

    got = queries()["j7_synonym_expansion"](spark, "/root/testdata/sf0.001")
    assert got.select(F.spark_partition_id().alias("t")).distinct().count() > 4


def test_suffixes_against_plain_loops(spark):
    from lodeflow.operators import coordinates as C

    texts = ["", "A", "CA", "ACGTACG", "CCGTACG", "TACGTACGT", "AACGTACGT", "A" * 40, "C" + "A" * 39, "ACGTACGTAC", "GCGTACGTAC"]
    rows = [(a, b, m) for a in texts for b in texts for m in (-1, 0, 3, 7, 8, 9, 200) if m <= min(len(a), len(b))]
    plain = lambda a, b, m: max(k for k in range(max(m, 0) + 1) if a[len(a) - k:] == b[len(b) - k:])
    got = spark.createDataFrame(rows, "a string, b string, m int").select("a", "b", "m", C.common_suffix(F.col("a"), F.col("b"), F.col("m")).alias("k")).collect()
    assert [r.k for r in got] == [plain(r.a, r.b, r.m) for r in got]


def test_routes_are_walked_once(spark, monkeypatch):
    """Places on transcripts are read for their slices and for their rows, alleles for their leftmost forms and for their rows: both are settled before."""
    from __spark_entry__ import queries
    from lodeflow.operators import coordinates as C

    seen = []
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    slices, leftmost = C.genome_slice, C.normalise_alleles
    monkeypatch.setattr(C, "genome_slice", lambda df, *a, **k: seen.append(plan(df)) or slices(df, *a, **k))
    monkeypatch.setattr(C, "normalise_alleles", lambda df, *a, **k: seen.append(plan(df)) or leftmost(df, *a, **k))
    queries()["p20_alleles"](spark, "/root/testdata/sf0.001")
    mentions = [p for p in seen if "__lo#" in p or "__listed#" in p]
    assert len(mentions) > 4 and not any("Join" in p or "Generate" in p for p in mentions)


def test_plain_positions_read_like_the_others(spark):
    from lodeflow.functions import variants as V

    texts = ["7", "007", "999999999999", "1234567890123", "-7", "+7", "7+2", "*7", "7\n", "", "?", "7?", None, "IVS3-2"]
    p = spark.createDataFrame([(t,) for t in texts], "t string").select(V.parse_position(F.col("t")).alias("p")).collect()
    want = [(7, 0, False, None), (7, 0, False, None), (999999999999, 0, False, None), (0, 0, False, None), (-7, 0, False, None), None, (7, 2, False, None), (7, 0, True, None)]
    assert [r.p and tuple(r.p) for r in p[:8]] == want and [r.p and tuple(r.p) for r in p[9:]] == [None, None, None, None, (None, -2, False, 3)]


def test_mentions_are_searched_once(spark):
    """The text of a mention is searched once for all spans, and once for all groups of a pattern beside the question whether it fits."""
    from lodeflow.functions import variants as V

    plan = spark.createDataFrame([("c.1A>G",)], "t string").select(V.parse_mention(F.col("t")).alias("v"), V.mention_spans(F.col("t")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 0 and plan.count("regexp_replace(") == len(V.PATTERNS) + 1
    size = spark.createDataFrame([("5",)], "t string").select(V.types_by_size(F.col("t")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert size.count("regexp_extract(") == 1


def test_mentions_with_lines_and_marks(spark):
    from lodeflow.functions import variants as V

    texts = ["x\n c.7_9delACG\n", "\u0001p.Arg7Gln\u0001", "c.5dupT3 $1 c.6dup", "\u0001", "a\\b rs12 rs34", "c.1_2"]
    got = [r.v and (r.v.mut_type, r.v.start, r.v.end, r.v.wild_type, r.v.mutant, r.v.rsid, r.v.dup) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(V.parse_mention(F.col("t")).alias("v")).collect()]
    assert got == [("DEL", "7", "9", "ACG", None, None, None), ("SUB", "7", "7", "R", "Q", None, None), ("DUP", "5", "5", "T", None, None, "3"), None, ("RSID", None, None, None, None, "12", None), None]


def test_routed_mentions_are_read_in_one_pass(spark):
    from __spark_entry__ import queries

    plan = queries()["p20_routes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation [") == 1


def test_groups_are_suppressed_side_by_side(spark):
    import numpy as np

    from lodeflow.operators import boxes

    r = np.random.default_rng(4)
    lengths = [1, 30, 2, 1, 60, 7]
    at = r.integers(0, 60, (sum(lengths), 2)).astype(float)
    box = np.concatenate([at, at + r.integers(-2, 40, at.shape)], axis=1)
    box[5, 2] = np.nan
    starts = np.cumsum([0, *lengths[:-1]])
    for keep in (None, 0, 1, 4):
        with np.errstate(all="ignore"):
            want = [int(a) + i for a, n in zip(starts, lengths, strict=True) for i in boxes.nms_arrays(box[a : a + n], np.arange(n), 0.3)[:keep]]
            assert boxes.nms_groups(box, starts, 0.3, keep).tolist() == want
    assert boxes.nms_groups(box[:0], starts[:0], 0.3).tolist() == []


def test_routes_settle_no_more_than_they_need(spark, monkeypatch):
    """Neither the mentions' own columns nor the bases around an allele are written down between the steps."""
    from __spark_entry__ import queries
    from lodeflow.operators import coordinates as C
    from lodeflow.plans import catalog_routes, routes

    seen, settle = [], C.settle
    for module in (C, routes, catalog_routes):
        monkeypatch.setattr(module, "settle", lambda df: seen.append(df.columns) or settle(df))
    got = queries()["p20_alleles"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["l_orderkey", "l_linenumber", "transcript", "chrom", "pos", "ref", "alt"]
    assert len(seen) > 6 and not any({"var", "gene_id", "__w", "__x"} & set(columns) for columns in seen)


def test_short_slices_are_those_of_any_length(spark):
    """Ranges in a chunk and the next, over missing and short chunks and a chromosome's ends, as the way of long ranges gives them."""
    from lodeflow.operators import coordinates as C

    chunks = spark.createDataFrame([("a", 0, "ACGTA"), ("a", 1, "CCGGT"), ("a", 3, "TTACG"), ("a", 4, "GAT"), ("b", 0, "AC"), ("b", 1, "G")], "chrom string, chunk int, seq string")
    points = spark.createDataFrame([(c, s, n) for c in ("a", "b", "c") for s in range(-6, 30) for n in range(0, 6)] * 2, "chrom string, s int, n int")
    rows = lambda df: sorted(map(tuple, df.select("chrom", "s", "n", "bases").collect()))
    short = C.genome_slice(points, chunks, 5, "s", "n")
    assert rows(short) == rows(C._long_slice(points, chunks, 5, "s", "n", "bases"))
