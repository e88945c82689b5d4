"""Ranges over many chunks, alleles in repeats of any length, and the routes from mentions to alleles."""

import random

import pytest

from lodeflow.operators import coordinates as C

KEY = "id int, chrom string, pos bigint, ref string, alt string"


def leftmost(seq, pos, ref, alt):
    """Step by step: trim on the right, extend on the left, trim on the left."""
    if pos <= 0 or pos + len(ref) - 1 >= len(seq):
        return pos, ref, alt

    def filled(p, r, a):
        if r and a:
            return p, r, a
        if p > 1:
            return p - 1, seq[p - 2] + r, seq[p - 2] + a
        return p, r + seq[p + len(r) - 1], a + seq[p + len(r) - 1]

    pos, ref, alt = filled(pos, ref, alt)
    while True:
        was = (pos, ref, alt)
        if not (len(ref) == len(alt) == 1) and set(ref + alt) != {"N"}:
            while ref and alt and ref[-1] == alt[-1] and (min(len(ref), len(alt)) > 1 or pos > 1):
                ref, alt = ref[:-1], alt[:-1]
        pos, ref, alt = filled(pos, ref, alt)
        if (pos, ref, alt) == was:
            break
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def genome(spark, seqs, size):
    lines = [(c, i, s[i : i + 60]) for c, s in seqs.items() for i in range(0, len(s), 60)]
    chunks = C.genome_chunks(spark.createDataFrame(lines, "chrom string, start0 bigint, line string"), size)
    return chunks.checkpoint(), spark.createDataFrame([(c, len(s)) for c, s in seqs.items()], "chrom string, chrom_size bigint")


def test_slices_over_many_chunks(spark):
    rng = random.Random(1)
    seqs = {"a": "".join(rng.choices("ACGT", k=997)), "b": "acgtn"}
    chunks, _ = genome(spark, seqs, 100)
    asked = [("a", s, n) for s in (-5, 0, 1, 2, 99, 100, 101, 500, 996, 997, 998) for n in (0, 1, 2, 99, 100, 101, 250, 550, 5000)] + [("b", 2, 3), ("b", 5, 10**12), ("c", 1, 5), ("a", None, 3), (None, 1, 1), ("a", 3, 500), ("a", 3, 500), ("a", 1, -4)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)], "id int, chrom string, s bigint, n bigint")
    got = {r["id"]: r["bases"] for r in C.genome_slice(df, chunks, 100, "s", "n").collect()}

    def want(c, s, n):
        return None if c is None or s is None else seqs.get(c, "")[max(s, 1) - 1 : max(s - 1 + n, 0)] if n > 0 else ""

    assert got == {i: want(*x) for i, x in enumerate(asked)}


@pytest.mark.parametrize("back", [4, 256])
def test_normalised_alleles(spark, back):
    rng = random.Random(2)
    seqs = {"1": "GATTACA" + "CA" * 40 + "GGT" + "A" * 90 + "NNNN" + "ACG" * 30 + "T", "2": "AAAAAAAAAA", "3": "NNNACNN"}
    chunks, sizes = genome(spark, seqs, 50)
    rows = []
    for _ in range(600):
        c = rng.choice("123")
        s = seqs[c]
        pos = rng.randint(-1, len(s) + 2)
        ref = s[max(pos - 1, 0) : max(pos - 1, 0) + rng.choice([0, 0, 1, 1, 2, 3, 6])] if pos > 0 else ""
        near = s[max(pos - 1, 0) : max(pos - 1, 0) + rng.randint(0, 6)]
        rows.append((len(rows), c, pos, ref, rng.choice(["", "A", "CA", "CACA", near, ref, ref + near, near + ref, "N", "NN"])))
    rows.append((len(rows), "9", 3, "A", ""))
    got = {r["id"]: (r["pos"], r["ref"], r["alt"]) for r in C.normalise_alleles(spark.createDataFrame(rows, KEY), chunks, 50, sizes, back).collect()}
    assert got == {i: leftmost(seqs[c], p, r, a) for i, c, p, r, a in rows if c != "9"}


def test_normalised_alleles_stay_and_mean_the_same(spark):
    rng = random.Random(6)
    seqs = {"1": "".join(rng.choices("ACG", k=80))}
    seq = seqs["1"]
    chunks, sizes = genome(spark, seqs, 11)
    rows = [(i, "1", p, seq[p - 1 : p - 1 + n], rng.choice(["", "A", "CA", "GGC"])) for i, (p, n) in enumerate((rng.randint(2, 70), rng.randint(0, 5)) for _ in range(200))]
    first = C.normalise_alleles(spark.createDataFrame(rows, KEY), chunks, 11, sizes)
    once, twice = {r["id"]: tuple(r)[2:] for r in first.collect()}, {r["id"]: tuple(r)[2:] for r in C.normalise_alleles(first, chunks, 11, sizes).collect()}
    put = lambda p, r, a: seq[: p - 1] + a + seq[p - 1 + len(r) :]
    assert len(once) == 200 and all(put(*once[i]) == put(p, r, a) and seq[once[i][0] - 1 :].startswith(once[i][1]) for i, _, p, r, a in rows)
    assert {i: x for i, x in twice.items() if rows[i][3] != rows[i][4]} == {i: x for i, x in once.items() if rows[i][3] != rows[i][4]}


def test_a_long_repeat_has_no_window(spark):
    seqs = {"1": "GT" + "CAG" * 3400 + "T"}
    chunks, sizes = genome(spark, seqs, 500)
    rows = [(0, "1", 10_000, seqs["1"][9999:10002], ""), (1, "1", 10_150, "", seqs["1"][10149:10152]), (2, "1", 3, seqs["1"][2:9002], "")]
    got = {r["id"]: (r["pos"], r["ref"], r["alt"]) for r in C.normalise_alleles(spark.createDataFrame(rows, KEY), chunks, 500, sizes).collect()}
    assert got == {i: leftmost(seqs["1"], p, r, a) for i, c, p, r, a in rows}
    assert got[0][0] == 2 and len(got[2][1]) == 9001


# --- routes -------------------------------------------------------------------------------------------------------

import re  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from lodeflow.functions import variants as V  # noqa: E402
from lodeflow.plans import routes  # noqa: E402

TX = "gene_id int, name string, chrom string, strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>"
VAR = "mut_type string, seq_types array<string>, wild_type string, start string, end string, mutant string, dup string, rsid string, chrom string, position string, ref string, alt string"
CODE = {c: a for c, a in C.codons()}


def turned(s):
    return s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))


def ladder(tx):
    """Chromosome positions of a transcript's exonic bases in its direction, by listing them."""
    _, _, _, strand, _, _, c0, c1, starts, ends = tx
    bases = [p for a, b in zip(starts, ends, strict=True) for p in range(a + 1, b + 1)]
    bases = bases if strand > 0 else bases[::-1]
    if c0 == c1:  # not coding: counted from the start, and behind the whole stretch of the chromosome
        return bases, 0, tx[5] - tx[4]
    before = sum(1 for p in bases if (p <= c0 if strand > 0 else p > c1))
    upto = sum(1 for p in bases if (p <= c1 if strand > 0 else p > c0))
    return bases, before, upto


def place(tx, text):
    """Chromosome position of a plain position (digits, offset) of a transcript, or None."""
    m = re.fullmatch(r"(\*?)(-?\d+)([+-]\d+)?", text)
    if not m:
        return None
    bases, before, upto = ladder(tx)
    n = int(m[2])
    i = n + upto if m[1] else n + before + 1 if n < 0 else n + before
    off = int(m[3] or 0)
    if i < 1:
        edge = tx[4] if tx[3] > 0 else tx[5] + 1
        return edge + i + off if tx[3] > 0 else edge - i - off
    if i > len(bases):
        if not m[1]:
            return None
        last = bases[-1]
        return last + tx[3] * (i - len(bases) + off)
    return bases[i - 1] + tx[3] * off


def told(seqs, chrom, kind, lo, hi, ref, alt, dup, strand):
    if lo is None or hi is None or lo < 1:
        return []
    lo = hi if kind == "INS" else lo
    have = seqs[chrom][lo - 1 : hi] if hi >= lo else ""
    flip = turned if strand < 0 else (lambda s: s)
    if ref and flip(ref) != have:
        return []
    r, a = flip(ref), flip(alt)
    if kind in ("DEL", "INDEL"):
        r = have
    if kind == "DUP":
        r, a = "", have * (dup - 1)
    return [(chrom, *leftmost(seqs[chrom], lo, r, a))] if r or a else []


def plain_route(seqs, genes, txs, rsids, gene, v):
    """The stated rule, one mention after the other."""
    seq, kind = set(v.get("seq_types") or []), v["mut_type"]
    if kind == "VCF":
        return {("", v["chrom"], int(v["position"]), v["ref"], v["alt"])}
    if kind.startswith("RSID+"):
        listed = {a[1:] for a in plain_route(seqs, genes, txs, rsids, gene, {"mut_type": "RSID", "rsid": v["rsid"]})}
        return {a for a in plain_route(seqs, genes, txs, rsids, gene, {**v, "mut_type": kind[5:]}) if a[1:] in listed}
    if kind == "RSID":
        return {("", c, *leftmost(seqs[c], s + 1, r.replace("-", ""), o.replace("-", ""))) for n, c, s, r, obs in rsids if str(n) == v["rsid"] for o in obs.split("/")}
    out, strip = set(), lambda s: s if re.fullmatch("[ACGT]*", s) else ""
    mine = [t for t in txs if t[0] == gene]
    if "p" in seq and kind == "SUB":
        for t in mine:
            i = int(v["start"])
            at = place(t, str(i * 3 - 2 if t[3] > 0 else i * 3))
            if at is None:
                continue
            have = seqs[t[2]][at - 1 : at + 2]
            codon = have if t[3] > 0 else turned(have)
            new = v["wild_type"] if v["mutant"] == "=" else v["mutant"]
            if CODE.get(codon) == v["wild_type"]:
                out |= {(t[1], t[2], *leftmost(seqs[t[2]], at, have, c if t[3] > 0 else turned(c))) for c, a in CODE.items() if a == new}
        return out
    coded = seq & {"c", "n", "r"}
    if not coded and "m" not in seq or kind not in routes.KINDS:
        return out
    ref, alt = v.get("wild_type") or "", v.get("mutant") or ""
    size = int(ref) if ref.isdigit() else len(ref)
    if re.search("[^ACGT]", alt) or (kind == "INS" and not alt):
        return out
    dup = int(v["dup"]) if v.get("dup") else 2
    if not coded or genes.get(gene) == "MT":
        number = lambda text: (m := re.fullmatch(r"\*?(-?\d+)([+-]\d+)?", text)) and int(m[1])
        s = number(v["start"])
        if s is None:
            return out
        e = s + size - 1 if kind in ("SUB", "DEL") and size else s + 1 if kind == "INS" else number(v["end"]) if number(v["end"]) is not None else s
        return {("Mitochondrial", *a) for a in told(seqs, "chrM", kind, s, e, strip(ref), alt, dup, 1)}
    for t in mine:
        s, e = place(t, v["start"]), place(t, v["end"] if v["end"] != "?" else v["start"])
        if s is None:
            continue
        if kind in ("SUB", "DEL") and size:
            e = s + t[3] * (size - 1)
        if kind == "INS":
            e = s + t[3]
        lo, hi = (s, e) if t[3] > 0 else (e, s)
        out |= {(t[1], *a) for a in told(seqs, t[2], kind, lo, hi, strip(ref), alt, dup, t[3])}
    return out


def test_routes_follow_the_rule(spark):
    rng = random.Random(4)
    seqs = {"1": "".join(rng.choices("ACGT", k=900)) + "ACACACACAC" * 8 + "".join(rng.choices("ACGT", k=120)), "chrM": "".join(rng.choices("ACGT", k=300))}
    chunks, sizes = genome(spark, seqs, 40)
    txs = [(1, "T1", "1", 1, 20, 700, 50, 650, [20, 200, 400], [100, 300, 700]), (1, "T2", "1", 1, 20, 300, 20, 20, [20, 200], [100, 300]), (2, "T3", "1", -1, 100, 900, 150, 850, [100, 300, 600], [250, 500, 900]), (4, "T4", "1", 1, 880, 1000, 880, 1000, [880], [1000])]
    genes = {1: "1", 2: "1", 3: "MT", 4: "1"}
    rsids = [(77, "1", 199, "-", "A/ACG"), (78, "1", 210, seqs["1"][210], f"{seqs['1'][210]}/T/-"), (79, "chrM", 9, seqs["chrM"][9], "A/C/G/T"), (80, "1", 899, "AC", "-/AC")]
    found = []

    def add(gene, **v):
        found.append((len(found), gene, {"seq_types": [], **v}))

    spots = ["1", "5", "31", "60", "81", "82", "120", "200", "230", "350", "900", "-3", "-40", "*4", "*300", "60+2", "81-5", "-3-2", "?"]
    for gene in (1, 2, 3, 4):
        for seq in (["c"], ["n"], ["r"], ["m"], ["g"], ["c", "n"], [], ["chr"]):
            for _ in range(14):
                s = rng.choice(spots)
                e = rng.choice([s, rng.choice(spots), str(int(s) + rng.randint(0, 150)) if s.isdigit() else s])
                kind = rng.choice(routes.KINDS)
                if s in ("81-5", "-3-2") and e == s:  # a range or an intron: tested below
                    e = "82-5"
                wild = rng.choice(["", "A", "C", "G", "T", "AC", "3", "130", "N", "B"])
                add(gene, mut_type=kind, seq_types=seq, start=s, end=e, wild_type="" if kind in ("INS", "INDEL") else wild, mutant="" if kind in ("DEL", "DUP") else rng.choice(["A", "C", "GT", "x", "ACAC", ""]), dup=rng.choice([None, "3", "1"]) if kind == "DUP" else None)
        for i in range(1, 60):
            add(gene, mut_type="SUB", seq_types=["p"], start=str(i), end=str(i), wild_type=rng.choice("ARNDCQEGHILKMFPSTWYVX"), mutant=rng.choice(["L", "M", "=", "X", "J"]))
        for t in txs:
            if t[0] == gene:
                for i in range(1, 40):
                    at = place(t, str(i * 3 - 2 if t[3] > 0 else i * 3))
                    codon = seqs["1"][at - 1 : at + 2]
                    add(gene, mut_type="SUB", seq_types=["p"], start=str(i), end=str(i), wild_type=CODE[codon if t[3] > 0 else turned(codon)], mutant=rng.choice(["R", "="]))
        for r in ("77", "78", "79", "80", "81"):
            add(gene, mut_type="RSID", rsid=r)
            for s in ("5", "81", "91", "10", "92"):
                for wild in "ACGT":
                    add(gene, mut_type="RSID+SUB", seq_types=[rng.choice("cmg")], start=s, end=s, wild_type=wild, mutant="T", rsid=r)
    add(9, mut_type="VCF", chrom="7", position="12", ref="A", alt="CC")
    add(1, mut_type="FS", seq_types=["p"], start="3", end="3", wild_type="A")
    add(1, mut_type="DEL", seq_types=["c"], start="120", end="260", wild_type="")
    names = [f.split()[0] for f in VAR.split(", ")]
    df = spark.createDataFrame([(i, g, tuple(v.get(n) for n in names)) for i, g, v in found], f"id int, gene_id int, var struct<{VAR.replace(' ', ':').replace(',:', ',')}>")
    g = spark.createDataFrame(list(genes.items()), "gene_id int, chrom string")
    r = spark.createDataFrame(rsids, "name bigint, chrom string, start bigint, ref string, observed string")
    got = {}
    for row in routes.alleles(df, ["id"], g, spark.createDataFrame(txs, TX), r, chunks, 40, sizes).collect():
        got.setdefault(row["id"], set()).add((row["transcript"], row["chrom"], row["pos"], row["ref"], row["alt"]))
    want = {i: w for i, gene, v in found if (w := plain_route(seqs, genes, txs, rsids, gene, v))}
    assert {i: (got.get(i), w, found[i]) for i, w in want.items() if got.get(i) != w} == {}
    assert got.keys() == want.keys()
    kinds = {(v["mut_type"], "".join(v["seq_types"])) for i, _, v in found if i in want}
    assert {("DEL", "c"), ("DUP", "m"), ("SUB", "p"), ("RSID", ""), ("RSID+SUB", "c"), ("VCF", "")} <= kinds and not any(s == "g" for _, s in kinds)


def test_ranges_written_with_a_dash_and_introns(spark):
    seqs = {"1": "ACGTTGCATGCCATGAAACCCGGGTTTACGTACGTTTGGGCATCATCAGGA"}
    chunks, sizes = genome(spark, seqs, 7)
    tx = spark.createDataFrame([(1, "T", "1", 1, 0, 50, 0, 50, [0, 30], [20, 50])], TX)
    rows = [(0, 1, ("DEL", ["c"], None, "3-6", "3-6")), (1, 1, ("DEL", ["c"], None, "21-2", "21-2")), (2, 1, ("DEL", ["c"], None, "IVS1+2", "IVS1+3")), (3, 1, ("DEL", ["c"], None, "IVS1-2", "IVS1-1"))]
    df = spark.createDataFrame(rows, "id int, gene_id int, var struct<mut_type:string,seq_types:array<string>,wild_type:string,start:string,end:string>")
    got = {r["id"]: (r["pos"], r["ref"]) for r in routes.coding_alleles(df, tx, chunks, 7).collect()}
    s = seqs["1"]
    assert got == {0: (3, s[2:6]), 1: (29, s[28:29]), 2: (22, s[21:23]), 3: (29, s[28:30])}


def test_types_by_form_and_size(spark):
    cases = {
        "123A>G": ["c", "n"], "Arg12Gln": ["p"], "c.76_78del": ["c"], "50000del": ["c", "n"], "200000delA": ["g"], "3000000insA": ["chr"], "rs123": [], "m.5A>G": ["m"], "*12A>G": ["c", "n"],
        "IVS2+1G>A": ["c", "n"], "p.Arg97Profs*23": ["p"], "76dupT": ["c", "n"],
    }
    df = V.parsed(spark.createDataFrame([(k,) for k in cases], "mention string"))
    assert {r["mention"]: r["var"]["seq_types"] for r in df.collect()} == cases
    assert V.parsed(spark.createDataFrame([("none",)], "mention string")).first()["var"] is None
    assert V.parsed(spark.createDataFrame([("c.5dup3",), ("c.5dupAC",)], "mention string")).select("var.dup").collect() == [("3",), (None,)]
