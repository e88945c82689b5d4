"""Readers, writers, streaming and the lookup from end to end on small files."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lodeflow.operators import coordinates
from lodeflow.plans import papers, routes
from lodeflow.sources import buckets, documents, reference, sinks
from lodeflow.streaming import ingest

XML = b"""<article><front><article-title>On genes</article-title></front><body><p>First one. Second one.</p>
<table-wrap><label>Table 1</label><caption><p>Things</p></caption><table><tr><th>g</th><th>v</th></tr><tr><td>A</td><td>c.1A&gt;G<break/>c.2del</td></tr></table></table-wrap>
<table><tr><td>bare</td></tr></table></body></article>"""
W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, body in files.items():
            z.writestr(n.replace("__", "/").replace("_DOT_", "."), body)
    return b.getvalue()


DOCX = zipped(word__document_DOT_xml=f"<w:document {W}><w:body><w:p><w:r><w:t>Hello there.</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>")
XLSX = zipped(xl__worksheets__sheet1_DOT_xml=f'<worksheet {S}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row><c r="B2" t="inlineStr"><is><t>y</t></is></c></row></sheetData></worksheet>', xl__sharedStrings_DOT_xml=f"<sst {S}><si><t>x</t></si></sst>")


def test_readers():
    got = documents.read_markup(XML)
    assert got["body"] == "On genes\nFirst one.\nSecond one."
    assert got["tables"][0] == {"label": "Table 1", "caption": "Things", "cells": [["g", "v"], ["A", "c.1A>G, c.2del"]]}
    assert got["tables"][1]["caption"] == "" and got["tables"][1]["cells"] == [["bare"]]
    assert documents.read_docx(DOCX) == {"body": "Hello there.", "tables": [{"label": None, "caption": "", "cells": [["a b", ""]]}]}
    assert documents.read_xlsx(XLSX)["tables"][0]["cells"] == [["x", "", ""], ["", "y", ""]]
    assert documents.read_xlsx(XLSX, numbers=True)["tables"][0]["cells"][0] == ["x", "", "5"]
    assert documents.read_csv(b"a,b\nc")["tables"][0]["cells"] == [["a", "b"], ["c", ""]]


def put(folder, **files):
    folder.mkdir(parents=True)
    for n, body in files.items():
        (folder / n.replace("_DOT_", ".")).write_bytes(body)


def test_parse_and_stream(spark, tmp_path):
    put(tmp_path / "in/p1", a_DOT_xml=XML, b_DOT_txt=b"plain", c_DOT_bin=b"?", d_DOT_docx=b"not a zip")
    put(tmp_path / "in/p2", z_DOT_zip=zipped(x_DOT_csv="q,r", y_DOT_zip=zipped(w_DOT_txt="deep")))
    got = documents.parse(documents.files(spark, f"{tmp_path}/in")).orderBy("paper_id", "file_idx").collect()
    assert [(r.paper_id, r.file_idx, r.status.split(":")[0]) for r in got] == [("p1", 0, "ok"), ("p1", 1, "ok"), ("p1", 2, "unsupported"), ("p1", 3, "unsupported"), ("p2", 0, "ok"), ("p2", 1, "ok")]
    assert {r.filename: r.body for r in got if r.paper_id == "p2"} == {"z.zip/x.csv": "", "z.zip/y.zip/w.txt": "deep"}
    assert documents.cells(documents.parse(documents.files(spark, f"{tmp_path}/in"))).where("paper_id = 'p1'").count() == 5
    for _ in range(2):
        ingest.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert buckets.read(spark, f"{tmp_path}/out").count() == 6


def test_replace_and_report(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.replace_by_key(spark.createDataFrame([("a", 1), ("b", 2)], "paper_id string, v int"), path)
    sinks.replace_by_key(spark.createDataFrame([("a", 9)], "paper_id string, v int"), path)
    assert {(r.paper_id, r.v) for r in spark.read.parquet(path).collect()} == {("a", 9), ("b", 2)}
    hits = spark.createDataFrame([("p1", 0, 5, "m"), ("p1", 0, 5, "m"), ("p2", 1, 3, "n")], "paper_id string, file_idx int, start int, mention string")
    assert [r.line for r in sinks.report(hits, "G", "v").collect()] == ["G\tv\t2", "p1\tm", "p2\tn"]


def test_reference_tables(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return f"{tmp_path}/{name}"

    gene = write("gene.tsv", "#h\n9606\t11\tGEN1\tx\tG-1|GA\ty\t1\n10090\t12\tGEN1\tx\t-\ty\t2\n")
    assert [tuple(r) for r in reference.genes(spark, gene, "9606").collect()] == [(11, "GEN1", "1")]
    assert {(r.key, r.gene_id) for r in reference.gene_symbols(spark, gene).collect()} == {("GEN1", 11), ("G1", 11), ("GA", 11)}
    snp = write("snp.tsv", "\n".join("\t".join(["0", "chr1", "9", "10", n, "0", "+", "A", "A", "A/G"]) for n in ("rs77", "bad")))
    assert [tuple(r) for r in reference.rsids(spark, snp).collect()] == [(77, "chr1", 9, 10, "A", "A/G")]
    tx = write("tx.tsv", "1\tNM_1.2\tchr1\t-\t100\t220\t105\t215\t2\t100,200,\t110,220,\tq\n1\tNM_9.1\tchr1\t+\t0\t5\t0\t5\t1\t0,\t5,\tq\n")
    alias = write("alias.txt", "NM_1.7 gen1\nNM_1.7 nothing\n")
    got = reference.transcripts([reference.transcript_rows(spark, tx)], [reference.alias_map(spark, alias, reference.gene_symbols(spark, gene))]).collect()
    assert [(r.name, r.strand, r.exon_ends, r.gene_id, r.is_coding) for r in got] == [("NM_1", -1, [110, 220], 11, True)]
    fa = write("g.fa", ">chr1 x\nACGT\nACG\n>chr2\nTT\n")
    chunks = coordinates.genome_chunks(reference.fasta(spark, fa), 5)
    pts = spark.createDataFrame([("chr1", 4, 3), ("chr1", 6, 9), ("chr2", 1, 2)], "chrom string, start bigint, n int")
    assert [r.bases for r in coordinates.genome_slice(pts, chunks, 5, "start", "n").orderBy("chrom", "start").collect()] == ["TAC", "CG", "TT"]
    d = reference.name_dictionary(spark, write("d.csv", "gene_id,symbol,synonyms,full_name,other_names\n1,BRCA1,A|B2,breast gene,-\n"))
    assert {(r.kind, r.name_key) for r in d["names"].collect()} == {("symbol", "brca1"), ("synonym", "a"), ("synonym", "b2"), ("other", "breast")}


def test_datasets(spark, tmp_path):
    ann = {"images": [{"id": 1, "width": 50, "height": 40, "file_name": "a"}], "categories": [{"id": 3, "name": "t", "supercategory": "s"}], "annotations": [{"id": 1, "image_id": 1, "category_id": 3, "bbox": [-5.0, 2.0, 70.0, 10.0], "area": 700.0, "iscrowd": 0}, {"id": 2, "image_id": 1, "category_id": 3, "bbox": [1.0, 1.0, 2.0, 2.0], "area": 4.0, "iscrowd": 1}]}
    (tmp_path / "c.json").write_text(json.dumps(ann))
    c = reference.coco(spark, f"{tmp_path}/c.json")
    assert sorted((r.x1, r.x2, r.overlap) for r in reference.coco_boxes(c["annotations"], c["images"]).collect()) == [(0.0, 49.0, 1.0), (1.0, 2.0, -1.0)]
    assert reference.annotation_filter(c["annotations"], area=(4.0, 700.0)).count() == 0 and reference.annotation_filter(c["annotations"], crowd=True).count() == 1
    (tmp_path / "r.json").write_text(json.dumps([{"image_id": 1, "category_id": 3, "bbox": [0.0, 0.0, 4.0, 5.0], "score": 0.5}]))
    assert reference.coco_results(spark, f"{tmp_path}/r.json", c["images"]).first().area == 20.0
    with pytest.raises(ValueError, match="unknown image"):
        reference.coco_results(spark, f"{tmp_path}/r.json", c["images"].where("id > 1"))
    box = "<bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox>"
    (tmp_path / "v.xml").write_text(f"<annotation><filename>i.jpg</filename><object><name>t</name><difficult>1</difficult>{box}</object><object><name>u</name><difficult>0</difficult>{box}</object></annotation>")
    assert reference.voc(spark, f"{tmp_path}/v.xml").count() == 2
    only = reference.voc(spark, f"{tmp_path}/v.xml", keep_difficult=False).first()
    assert (only.image, only["name"], only.x1, only.y2) == ("i", "u", 0.0, 3.0)
    with pytest.raises(KeyError):
        reference.dataset("none")


def test_index_and_lookup(spark):
    parsed = spark.createDataFrame([("p1", 0, "We saw MYO15A c.4T>A and more.\nElsewhere TNF was p.Met1Leu.")], "paper_id string, file_idx int, body string")
    names = spark.createDataFrame([("myo 15 a", 1), ("tnf", 2)], "key string, gene_id int")
    got = papers.assign_body(papers.variant_mentions(parsed), papers.gene_mentions(parsed, names), papers.body_sentences(parsed))
    assert sorted((r.mention, r.gene_id, r.gene) for r in got.collect()) == [("c.4T>A", 1, "MYO15A"), ("p.Met1Leu", 2, "TNF")]
    tx = spark.createDataFrame([(1, "T1", "1", 1, 0, 30, 0, 30, [0], [30]), (1, "T2", "1", 1, 0, 30, 0, 30, [0], [30]), (2, "T3", "1", 1, 8, 30, 8, 30, [8], [30])], "gene_id int, name string, chrom string, strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>")
    seq = "GGGTCCCCATGAAACCCGGGTTTACGTACG"
    chunks = coordinates.genome_chunks(spark.createDataFrame([("1", 0, seq)], "chrom string, start0 bigint, line string"), 50)
    coding, protein = routes.coding_alleles(got, tx, chunks, 50), routes.protein_alleles(got, tx, chunks, 50)
    assert {(r.pos, r.ref, r.alt) for r in coding.collect()} == {(4, "T", "A")}
    assert {r.alt for r in protein.collect()} == {"TTA", "TTG", "CTT", "CTC", "CTA", "CTG"} and {r.pos for r in protein.collect()} == {9}
    sizes = spark.createDataFrame([("1", len(seq))], "chrom string, chrom_size bigint")
    index = papers.index_rows(coordinates.normalise_alleles(coding.unionByName(protein), chunks, 50, sizes, 20))
    rows = index.collect()
    assert len(rows) == 7 and {r.transcript for r in rows if r.pos == 4} == {"T2"}
    wanted = spark.createDataFrame([("1", 4, "T", "A")], "chrom string, pos bigint, ref string, alt string")
    assert [r.paper_id for r in papers.lookup(index, wanted).collect()] == ["p1"]
    rs = routes.rsid_alleles(got.limit(1).withColumn("var", F.expr("named_struct('mut_type','RSID','rsid','77')")), spark.createDataFrame([(77, "1", 9, 10, "A", "A/-")], "name bigint, chrom string, start bigint, end bigint, ref string, observed string"))
    assert sorted((r.pos, r.ref, r.alt) for r in rs.collect()) == [(10, "A", ""), (10, "A", "A")]


def test_table_genes(spark):
    at = "paper_id string, file_idx int, table_idx int, row int, col int"
    v = spark.createDataFrame([("p", 0, 0, 1, 1, "m"), ("p", 0, 1, 0, 0, "n"), ("p", 0, 2, 0, 0, "o"), ("q", 0, 0, 0, 0, "x")], f"{at}, mention string")
    g = spark.createDataFrame([("p", 0, 0, 0, 1, 5)], f"{at}, gene_id int")
    cap = spark.createDataFrame([("p", 0, 1, 6)], "paper_id string, file_idx int, table_idx int, gene_id int")
    body = spark.createDataFrame([("p", 0, 7, 1, "g"), ("p", 0, 7, 9, "g"), ("p", 0, 8, 2, "h")], "paper_id string, file_idx int, gene_id int, start int, gene string")
    assert {r.mention: r.gene_id for r in papers.assign_tables(v, g, cap, body).collect()} == {"m": 5, "n": 6, "o": 7, "x": 0}


def _zip(files: dict) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def test_members_that_cannot_be_read_cost_no_other(spark):
    locked = bytearray(_zip({"a.txt": "secret", "b.txt": "plain"}))
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):  # the flag of encryption, in both headers of the first member
        locked[locked.find(mark) + at] |= 1
    damaged = _zip({"a.txt": "words here", "b.txt": "kept"}).replace(b"words here", b"wordz here")
    rows = [("p", 0, "one.zip", bytes(locked)), ("p", 1, "two.zip", damaged), ("p", 2, "three.zip", _zip({"in.zip": b"PK\x03\x04 no archive", "deep.zip": _zip({"c.txt": "deep"}), "d.txt": "beside", "e.bin": "x"})), ("q", 0, "four.zip", b"PK\x03\x04broken"), ("q", 1, "five.txt", None)]
    df = spark.createDataFrame(rows, "paper_id string, file_idx int, filename string, content binary")
    got = {(r["paper_id"], r["filename"]): (r["status"], r["body"]) for r in documents.parse(df).collect()}
    assert got == {
        ("p", "one.zip/a.txt"): ("failed: RuntimeError", ""), ("p", "one.zip/b.txt"): ("ok", "plain"), ("p", "two.zip/a.txt"): ("failed: BadZipFile", ""), ("p", "two.zip/b.txt"): ("ok", "kept"),
        ("p", "three.zip/in.zip"): ("failed: BadZipFile", ""), ("p", "three.zip/deep.zip/c.txt"): ("ok", "deep"), ("p", "three.zip/d.txt"): ("ok", "beside"), ("p", "three.zip/e.bin"): ("unsupported", ""),
        ("q", "four.zip"): ("failed: BadZipFile", ""), ("q", "five.txt"): ("unsupported", ""),
    }
    assert documents.parse(df.limit(0)).count() == 0


def test_a_file_that_loops_is_told_and_costs_no_other(spark):
    def slow(content):
        while content == b"loop":
            pass
        return {"body": "read", "tables": []}

    rows = [("p", i, f"{i}.txt", b"loop" if i % 3 == 1 else b"fine") for i in range(5)]
    df = spark.createDataFrame(rows, "paper_id string, file_idx int, filename string, content binary")
    got = documents.parse(df, {"txt": slow}, seconds=0.3).orderBy("file_idx").collect()
    assert [(r["status"], r["body"]) for r in got] == [("ok", "read"), ("timeout", ""), ("ok", "read"), ("ok", "read"), ("timeout", "")]
