"""Text, variant, mask and coordinate functions on hand-computed cases."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeflow.functions import rle
from lodeflow.functions import text as T
from lodeflow.functions import variants as V
from lodeflow.operators import coordinates as C


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'array<int>' if isinstance(v, list) else 'bigint'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def test_tokens(spark):
    assert one(spark, T.variant_tokens(F.col("t")), t="Arg123Gln") == ["A", "rg", "123", "G", "ln"]
    assert one(spark, T.variant_tokens(F.col("t")), t="c.35delG") == ["c", ".", "35", "del", "G"]
    assert one(spark, T.gene_tokens(F.col("t")), t="MYO15A") == ["MYO", "15", "A"]
    assert [len(x) for x in one(spark, T.gene_tokens(F.col("t")), t="a" * 120)] == [50, 50, 20]
    assert one(spark, T.token_offsets(F.col("t"), T.gene_tokens(F.col("t"))), t="ab ab, c") == [0, 3, 5, 7]
    long = "x" * 120 + " é\u00022a\u0301-\n" + "word 7" * 300
    for text in ("ab ab, c", "", " ", long):
        spans = one(spark, T.gene_token_spans(F.col("t")), t=text)
        plain = [(m[0][i : i + 50].replace("\u0002", "\u0003"), m.start() + i) for m in re.finditer(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\s]", text) for i in range(0, len(m[0]), 50)]
        assert [tuple(s) for s in spans] == plain


def test_names(spark):
    for name, words, key in (("BRCA1", "brca 1", "brca1"), ("TP53 gene", "tp 53 ", "tp53")):
        assert one(spark, T.name_words(F.col("t")), t=name) == words
        assert one(spark, T.name_key(F.col("t")), t=name) == key
    assert one(spark, T.name_words(F.col("t")), t="") is None
    assert one(spark, T.without_h(F.col("t")), t="hbrca") == "brca" and one(spark, T.without_h(F.col("t")), t="brca") is None


def test_clean_text(spark):
    assert one(spark, T.clean_text(F.col("t")), t="β-catenin &amp; TNFα\n café") == "beta -catenin & TNF alpha caf e"
    assert one(spark, T.clean_text(F.col("t")), t="") == ""


def test_sentences_and_captions(spark):
    assert one(spark, T.sentences(F.col("t")), t="See Fig. 2 for it. Then stop! 3 more? no") == ["See Fig. 2 for it.", "Then stop!", "3 more? no"]
    assert [len(x) for x in one(spark, T.chop(F.col("t")), t="x" * 4001)] == [2000, 2000, 1]
    assert one(spark, T.caption_number(F.col("t")), t="Table IV. Results") == "IV" and one(spark, T.caption_number(F.col("t")), t="Tables are here") is None
    assert one(spark, T.caption_number(F.col("t")), t="Supplementary Table S12: x") == "12"
    assert one(spark, T.is_caption(F.col("t"), F.lit(0)), t="Table 2: a b. C d.") and not one(spark, T.is_caption(F.col("t"), F.lit(0)), t="Table 2 shows that. It is so.")


LOOKUPS = {
    "p.M34T": ("SUB", "p", "34", "M", "T"), "A34T": ("SUB", "p", "34", "A", "T"), "c.A34T": ("SUB", "c", "34", "A", "T"), "c.123C>A": ("SUB", "c", "123", "C", "A"), "c.35delG": ("DEL", "c", "35", "G", None),
    "c.35dupG": ("DUP", "c", "35", "G", None), "c.35insG": ("INS", "c", "35", None, "G"), "c.35delinsG": ("INDEL", "c", "35", None, "G"), "rs123": ("RSID", None, "123", None, None), "p.Met34Thr": ("SUB", "p", "34", "M", "T"), "c.12+3A/G": ("SUB", "c", "12+3", "A", "G"), "c.5_7del3bp;": ("DEL", "c", "5", "3", None), "34M>T": ("SUB", "p", "34", "M", "T"), "nonsense": None,
}


@pytest.mark.parametrize("form", LOOKUPS)
def test_lookup_forms(spark, form):
    got = one(spark, V.parse_lookup(F.col("q")), q=form)
    assert (got and (got.mut_type, got.seq, got.start, got.ref, got.alt)) == LOOKUPS[form]


def test_mentions(spark):
    got = one(spark, V.parse_mention(F.col("t")), t="c.76_78del")
    assert (got.mut_type, got.start, got.end, got.seq_types) == ("DEL", "76", "78", ["c"])
    got = one(spark, V.parse_mention(F.col("t")), t="p.Arg97Profs*23")
    assert (got.mut_type, got.wild_type, got.start, got.frameshift) == ("FS", "R", "97", "23")
    assert one(spark, V.parse_mention(F.col("t")), t="plain words") is None
    assert one(spark, V.parse_position(F.col("t")), t="?") is None
    assert [tuple(x) for x in [one(spark, V.parse_position(F.col("t")), t=t) for t in ("12+3", "*5", "-7", "IVS4-2")]] == [(12, 3, False, None), (5, 0, True, None), (-7, 0, False, None), (None, -2, False, 4)]


TX = [("+", 1), ("-", -1)]


def transcript(spark, strand, **values):
    row = (strand, 100, 220, 105, 215, [100, 200], [110, 220])
    df = spark.createDataFrame([(*row, *values.values())], "strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>" + "".join(f", {k} {'boolean' if isinstance(v, bool) else 'bigint'}" for k, v in values.items()))
    return df, C.Transcript()


@pytest.mark.parametrize("pos,offset,utr3,plus,minus", [(1, 0, False, 106, 215), (5, 0, False, 110, 201 + 10), (6, 0, False, 201, 210), (-1, 0, False, 105, 216), (5, 2, False, 112, None), (6, -1, False, 200, None), (1, 0, True, 216, 105), (6, 0, True, 221, 100), (26, 0, False, None, None), (15, 0, False, 210, 201), (16, 0, False, 211, 110)])
def test_positions(spark, pos, offset, utr3, plus, minus):
    for strand, want in ((1, plus), (-1, minus)):
        if want is None and not (pos == 26):
            continue
        df, t = transcript(spark, strand, p=pos, o=offset, u=utr3)
        assert df.select(t.to_chromosome(F.col("p"), F.col("o"), F.col("u"))).first()[0] == want


def test_position_round_trip(spark):
    for strand in (1, -1):
        df, t = transcript(spark, strand)
        q = df.withColumn("p", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(20).cast("bigint"))))
        at = q.withColumn("at", t.to_chromosome(F.col("p"), F.lit(0).cast("bigint"), F.lit(False)))
        back = at.select("p", t.from_chromosome(F.col("at")).alias("b")).collect()
        assert all(r.p == r.b.pos and r.b.offset == 0 and not r.b.utr3 for r in back)
        df2, t2 = C.Transcript.attach(transcript(spark, strand)[0])
        assert df2.select(t2.to_chromosome(F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.lit(False))).first()[0] == (106 if strand == 1 else 215)


def test_codons():
    table = dict(C.codons())
    assert table["ATG"] == "M" and table["TAA"] == "X" and table["GGG"] == "G" and len(table) == 64


@given(st.text("ACGTN-", max_size=30))
@settings(max_examples=30)
def test_revcomp_text(s):
    table = str.maketrans("ACGTN-", "TGCAN-")
    assert s.translate(table)[::-1].translate(table)[::-1] == s


def test_rle(spark):
    for px, counts, n in (([0, 0, 1, 1, 1, 0, 1], [2, 3, 1, 1], 4), ([1, 1, 1, 1, 1, 1, 0], [0, 6, 1], 6)):
        df = spark.createDataFrame([(1, i, v) for i, v in enumerate(px)], "m int, i int, v int")
        got = rle.encode(df, ["m"], "i", "v").select("counts", rle.area(F.col("counts")).alias("a"), rle.decode(F.col("counts")).alias("d")).first()
        assert (got.counts, got.a, got.d) == (counts, n, px)


@given(st.lists(st.integers(0, 5000), min_size=1, max_size=20))
def test_rle_text(counts):
    assert rle.from_text(rle.to_text(counts)) == counts


def test_rle_shapes(spark):
    box = spark.range(1).select(rle.from_bbox(F.lit(1), F.lit(1), F.lit(2), F.lit(2), F.lit(4), F.lit(5)).alias("c")).select("c", rle.to_bbox(F.col("c"), F.lit(4)).alias("b")).first()
    assert box.c == [5, 2, 2, 2, 9] and tuple(box.b) == (1, 1, 2, 2)
    assert rle.polygon_counts([1, 1, 3, 1, 3, 3, 1, 3], 4, 5) == [5, 2, 2, 2, 9]


def test_token_types_and_padding(spark):
    toks = ["cytochrome", "T", "cell", "q", "12", "p", "-", "alpha", "kinase", "r", "RNA", "Markers", "x"]
    row = spark.createDataFrame([(toks,)], "t array<string>").select(T.token_types(F.col("t")).alias("k"), T.constant_features(F.col("t")).alias("c")).first()
    assert row.k == ["-Type_cytochrome-", "-Type_Cell-", "__nil__", "-Type_ChromosomeStrain-", "__nil__", "-Type_ChromosomeStrain-", "-Type_strain-", "-Type_strain-", "-Type_Family-", "-Type_DomainMotif-", "__nil__", "-Type_Marker-", "__nil__"]
    assert tuple(row.c[0]) == ("__nil__", "NN")
    got = spark.createDataFrame([("abc",)], "t string").select(F.length(T.padded(F.col("t"))), T.unpadded(F.struct(F.lit(11).alias("start"), F.lit(14).alias("end")), F.lit(7))).first()
    assert got[0] == 3 + 11 + 13 and tuple(got[1]) == (7, 10)


def test_polygons_by_definition():
    assert rle.polygon_counts([2, 1, 6, 1, 6, 4, 2, 4], 6, 8) == [13, 3, 3, 3, 3, 3, 3, 3, 14]
    assert rle.polygon_counts([1, 1, 2, 2, 3, 3], 5, 5) == [25] and rle.polygon_counts([0, 0, 9, 0, 9, 9, 0, 9], 3, 3) == [0, 9]
