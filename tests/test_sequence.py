"""Sequence files by offset, and read in splits."""

import random

import pytest

from lodeflow.operators import coordinates
from lodeflow.sources import reference, sequence


def write(path, seqs, width, end="\n", last=True):
    out = "".join(f">{n} note{end}" + "".join(s[i : i + width] + end for i in range(0, len(s), width)) for n, s in seqs.items())
    path.write_bytes((out if last else out.rstrip()).encode())
    return str(path)


@pytest.mark.parametrize(("width", "end", "last"), [(60, "\n", True), (7, "\r\n", True), (50, "\n", False)])
def test_slices_by_offset(spark, tmp_path, width, end, last):
    rng = random.Random(width)
    seqs = {f"chr{i}": "".join(rng.choices("ACGTN", k=n)) for i, n in enumerate([1, width, width + 1, 3000, 0, 777, 2 * width, 5])}
    path = write(tmp_path / "g.fa", seqs, width, end, last)
    for step in (100, 1 << 20):
        entries = sequence.offset_index(spark, path, step)
        assert [(e.chrom, e.length) for e in entries] == [(n, len(s)) for n, s in seqs.items()]
    sequence.save_index(spark, entries, f"{tmp_path}/index")
    entries = sequence.load_index(spark, f"{tmp_path}/index")
    want = {(n, i // 100): s[i : i + 100] for n, s in seqs.items() for i in range(0, len(s), 100)}
    chunks = sequence.sequence_chunks(spark, path, entries, 100, 350)
    assert {(r.chrom, r.chunk): r.seq for r in chunks.collect()} == want
    plain = coordinates.genome_chunks(reference.fasta(spark, path), 100)
    assert {(r.chrom, r.chunk): r.seq for r in plain.collect()} == want
    some = chunks.where("chrom = 'chr3' and chunk >= 11 and chunk < 13")
    assert {(r.chrom, r.chunk): r.seq for r in some.collect()} == {k: v for k, v in want.items() if k[0] == "chr3" and 11 <= k[1] < 13}
    assert chunks.where("chrom in ('chr0', 'chr5') and chunk = 0 and seq like '%A%'").count() == sum("A" in want[n, 0] for n in ("chr0", "chr5"))
    assert chunks.where("chrom = 'none'").count() == 0


def test_a_small_slice_reads_one_small_range(tmp_path):
    entries = [sequence.Entry("chr1", 10_000_000, 6, 60, 61), sequence.Entry("chr2", 5000, 99, 60, 61)]
    from dataclasses import asdict
    import json

    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThanOrEqual

    reader = sequence.SequenceReader({"path": "x", "size": "1000", "bytes": "100000", "entries": json.dumps([asdict(e) for e in entries])})
    assert len(reader.partitions()) == 101
    left = list(reader.pushFilters([EqualTo(("chrom",), "chr1"), GreaterThanOrEqual(("chunk",), 5000), LessThanOrEqual(("chunk",), 5001), IsNotNull(("seq",))]))
    assert [type(f).__name__ for f in left] == ["IsNotNull"] and [(p.entry["chrom"], p.low, p.high) for p in reader.partitions()] == [("chr1", 5000, 5002)]


def test_splits_of_a_file(spark, tmp_path):
    rng = random.Random(4)
    seqs = {f"c{i}": "".join(rng.choices("ACGT", k=rng.randint(1, 4000))) for i in range(12)}
    path = write(tmp_path / "s.fa", seqs, 61)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = reference.fasta(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.start0 for r in rows}) > 1 and all(seqs[r.chrom][r.start0 : r.start0 + len(r.line)] == r.line for r in rows)
    assert sum(len(r.line) for r in rows) == sum(map(len, seqs.values()))


def test_uneven_lines_are_refused(spark, tmp_path):
    (tmp_path / "u.fa").write_text(">a\nACGT\nAC\nACGT\n")
    for step in (5, 1000):
        with pytest.raises(ValueError, match="not equally long"):
            sequence.offset_index(spark, f"{tmp_path}/u.fa", step)
