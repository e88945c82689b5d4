"""The index run from files to lookups, the bucketed table, and papers that arrive in parts."""

import random

import pytest
from pyspark.sql import functions as F

from lodeflow import cli
from lodeflow.plans import indexing
from lodeflow.sources import buckets, documents, reference
from lodeflow.streaming import ingest

SEQ = "GGGTCCCCATGAAACCCGGGTTTACGTACGTTTGGGCATCATCAGGACACACACATTGCATGCAACGGTTACCGGT"
PAPER = """<article><front><article-title>On hearing</article-title></front><body><p>We saw MYO15A c.4T&gt;A in Fig 2. Elsewhere TNF was p.Met1Leu, and g.5A&gt;G too.</p>
<table-wrap><label>Table 1</label><caption><p>Changes of TNF in kin</p></caption><table>
<tr><td>gene</td><td>change</td></tr><tr><td>MYO15A</td><td>c.5C&gt;G</td></tr><tr><td></td><td>rs77</td></tr></table></table-wrap>
<table-wrap><label>Table 2</label><caption><p>More of TNF</p></caption><table><tr><td>who</td><td>Met1Val</td></tr></table></table-wrap></body></article>"""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("ref")

    def write(name, text):
        (folder / name).write_text(text)
        return f"{folder}/{name}"

    names = reference.name_dictionary(spark, write("names.csv", "gene_id,symbol,synonyms,full_name,other_names\n1,MYO15A,DFNB3,myosin fifteen a,-\n2,TNF,TNFA,tumor necrosis factor,-\n3,FIG2,-,figure gene,-\n4,MTND1,-,-,-\n"))
    keys = spark.createDataFrame([("myo 15 a", 1), ("tnf", 2), ("fig 2", 3), ("mtnd 1", 4)], "key string, gene_id int")
    genes = spark.createDataFrame([(1, "MYO15A", "1"), (2, "TNF", "1"), (3, "FIG2", "1"), (4, "MTND1", "MT")], "id int, symbol string, chrom string")
    cols = "gene_id int, name string, chrom string, strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>"
    tx = spark.createDataFrame([(1, "T1", "1", 1, 0, 40, 0, 40, [0], [40]), (1, "T2", "1", 1, 0, 30, 0, 30, [0], [30]), (2, "T3", "1", 1, 8, 60, 8, 60, [8], [60])], cols)
    rs = spark.createDataFrame([(77, "1", 9, 10, "T", "C/T")], "name bigint, chrom string, start bigint, end bigint, ref string, observed string")
    lines = spark.createDataFrame([("1", i, SEQ[i : i + 10]) for i in range(0, len(SEQ), 10)] + [("chrM", 0, "ACGTACGTAC")], "chrom string, start0 bigint, line string")
    indexing.save_reference(indexing.reference_of(names, keys, genes, tx, rs, lines, 16), f"{folder}/tables")
    return indexing.open_reference(spark, f"{folder}/tables")


OPTIONS = cli.OPTIONS | {"chunk": 16}


def test_from_folder_to_lookup(spark, tables, tmp_path):
    for name, body in (("p1/a.xml", PAPER), ("p2/b.txt", "The MTND1 change m.2C>T, and MTND1 c.3G>A. No gene here.")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(body)
    parsed = documents.parse(documents.files(spark, f"{tmp_path}/in"))
    got = {(r.paper_id, r.mention, r.in_table): (r.gene_id, r.gene) for r in indexing.results(parsed, tables).collect()}
    assert got == {
        ("p1", "c.4T>A", False): (1, "MYO15A"), ("p1", "p.Met1Leu", False): (2, "TNF"), ("p1", "g.5A>G", False): (2, "TNF"), ("p1", "c.5C>G", True): (1, "MYO15A"), ("p1", "rs77", True): (1, "MYO15A"), ("p1", "Met1Val", True): (2, "TNF"),
        ("p2", "m.2C>T", False): (4, "MTND1"), ("p2", "c.3G>A", False): (4, "MTND1"),
    }
    for _ in range(2):
        cli.build(spark, f"{tmp_path}/in", f"{tmp_path}/index", tables, OPTIONS | {"batch": "one"})
    index = buckets.read(spark, f"{tmp_path}/index")
    rows = {(r.paper_id, r.mention, r.chrom, r.pos, r.ref, r.alt, r.transcript) for r in index.collect()}
    leu = {("p1", "p.Met1Leu", "1", p, r, a, "T3") for p, r, a in ((9, "A", "T"), (9, "A", "C"), (9, "ATG", "CTC"), (9, "ATG", "CTA"), (9, "ATG", "CTT"), (9, "ATG", "TTA"))}
    assert {x for x in rows if x[1] == "c.4T>A"} == {("p1", "c.4T>A", "1", 4, "T", "A", "T2")}
    assert {x[1] for x in rows} == {"c.4T>A", "p.Met1Leu", "c.5C>G", "rs77", "Met1Val", "m.2C>T", "c.3G>A"}
    assert {x[3:6] for x in rows if x[1] == "p.Met1Leu"} == {x[3:6] for x in leu} and {x[2:] for x in rows if x[0] == "p2"} == {("chrM", 2, "C", "T", "Mitochondrial"), ("chrM", 3, "G", "A", "Mitochondrial")}
    ask = lambda q: cli.answer(index, q, OPTIONS, tables)
    assert ask("MYO15A c.4T>A")[1:] == ["p1\tc.4T>A"] and ask("1 4 T A")[1:] == ["p1\tc.4T>A"]
    assert ask("2 p.M1V")[1:] == ["p1\tMet1Val"]
    assert ask("NONE c.4T>A") == ["unknown gene: NONE"] and ask("TNF what") == ["unknown form of variant: what"] and ask("x") == ["neither a gene and a variant nor chrom pos ref alt: x"]
    assert ask("1 5 T A")[0].endswith("\t0")


def test_bucketed_table(spark, tmp_path):
    path, rng, want = f"{tmp_path}/t", random.Random(2), {}
    kind = "paper_id string, v int, note string"
    for batch in range(5):
        keys = [f"p{rng.randint(0, 40)}" for _ in range(12)]
        rows = [(k, rng.randint(0, 9), f"{batch}") for k in keys for _ in range(rng.randint(0, 2))]
        df = spark.createDataFrame(rows, kind)
        assert buckets.upsert(df, path, "paper_id", f"b{batch}", keys=spark.createDataFrame([(k,) for k in keys], "paper_id string"), buckets=8)
        want = {k: v for k, v in want.items() if k not in keys}
        for k, *rest in rows:
            want.setdefault(k, []).append(tuple(rest))
        got = {}
        for r in buckets.read(spark, path).collect():
            got.setdefault(r[0], []).append(tuple(r)[1:])
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert not buckets.upsert(spark.createDataFrame([("p1", 0, "again")], kind), path, "paper_id", "b2") and buckets.read(spark, path).where("note = 'again'").count() == 0
    assert len(buckets.read(spark, path).inputFiles()) <= 8 and buckets.vacuum(spark, path) > 0
    assert {r[0] for r in buckets.read(spark, path).collect()} == want.keys() and buckets.vacuum(spark, path) == 0
    buckets.upsert(spark.createDataFrame([], kind), path, "paper_id", "end", keys=buckets.read(spark, path).select("paper_id"))
    assert buckets.read(spark, path).count() == 0 and buckets.read(spark, path).columns == ["paper_id", "v", "note"]
    buckets.upsert(spark.createDataFrame([(None, 1, "x"), ("q", 2, "y")], kind), path, "paper_id", "null")
    buckets.upsert(spark.createDataFrame([(None, 3, "z")], kind), path, "paper_id", "null again")
    assert sorted(map(tuple, buckets.read(spark, path).collect()), key=str) == [("q", 2, "y"), (None, 3, "z")]


def test_a_batch_that_dies_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    buckets.upsert(spark.createDataFrame([("a", 1)], "k string, v int"), path, "k", "one", buckets=4)
    broken = spark.createDataFrame([("a", 2)], "k string, v int").withColumn("v", F.raise_error(F.lit("died")).cast("int"))
    with pytest.raises(Exception, match="died"):
        buckets.upsert(broken, path, "k", "two")
    assert buckets.read(spark, path).collect() == [("a", 1)]
    assert buckets.upsert(spark.createDataFrame([("a", 2)], "k string, v int"), path, "k", "two") and buckets.read(spark, path).collect() == [("a", 2)]


def test_files_in_three_batches_are_one_paper(spark, tmp_path):
    files = {"p1/a.txt": "first", "p1/c.txt": "third", "p2/x.txt": "lone", "p1/b.txt": "second", "p1/d.csv": "q,r"}
    for run, groups in (("one", [list(files)]), ("three", [["p1/c.txt"], ["p1/a.txt", "p2/x.txt"], ["p1/b.txt", "p1/d.csv"]])):
        for group in groups:
            for name in group:
                (tmp_path / run / "in" / name).parent.mkdir(parents=True, exist_ok=True)
                (tmp_path / run / "in" / name).write_text(files[name])
            joined = lambda df: df.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_idx", "filename", "body"))), lambda x: F.concat_ws(":", x["file_idx"], x["filename"], x["body"])), "|").alias("whole"))
            ingest.ingest(spark, f"{tmp_path}/{run}/in", f"{tmp_path}/{run}/out", f"{tmp_path}/{run}/cp", joined).awaitTermination(120)
    rows = [sorted(map(tuple, buckets.read(spark, f"{tmp_path}/{run}/out").collect())) for run in ("one", "three")]
    assert rows[0] == rows[1] == [("p1", "0:a.txt:first|1:b.txt:second|2:c.txt:third|3:d.csv:"), ("p2", "0:x.txt:lone")]


def test_an_empty_folder_of_mentions(spark, tables):
    parsed = documents.parse(spark.createDataFrame([("p", 0, "a.txt", b"nothing here")], "paper_id string, file_idx int, filename string, content binary"))
    assert indexing.index(parsed, tables, 16).count() == 0
