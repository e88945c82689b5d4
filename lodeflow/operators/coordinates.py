"""Positions through transcripts: cumulative exon lengths, strands, codons, and normalised alleles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.functions.once import once
from lodeflow.session import few, settle, shuffled, tidy

#: Bases in the order of the codon table's rule.
_BASES = "TCAG"
#: Amino acids of the 64 codons, bases in the order T C A G, last base fastest; X is stop.
_CODE = "FFLLSSSSYYXXCCXWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codons() -> list[tuple[str, str]]:
    """(codon, amino acid) of all 64."""
    return [(a + b + c, _CODE[16 * i + 4 * j + k]) for i, a in enumerate(_BASES) for j, b in enumerate(_BASES) for k, c in enumerate(_BASES)]


def codon_map() -> Column:
    return F.create_map(*[x for c, a in codons() for x in (F.lit(c), F.lit(a))])


def codons_of() -> Column:
    """Map from an amino acid to its codons."""
    by: dict[str, list[str]] = {}
    for c, a in codons():
        by.setdefault(a, []).append(c)
    return F.create_map(*[x for a, cs in by.items() for x in (F.lit(a), F.array(*[F.lit(c) for c in cs]))])


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN-", "TGCAN-"))


def exons(starts: Column, ends: Column, strand: Column) -> Column:
    """Exons in transcript order as structs a, b (0-based, half open on the chromosome)."""
    pairs = F.zip_with(starts, ends, lambda a, b: F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")))
    return F.when(strand < 0, F.reverse(pairs)).otherwise(pairs)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda s, x: s + x)


def exonic_before(ex: Column, pos: Column, strand: Column) -> Column:
    """Exonic bases upstream of a boundary (a 0-based cut on the chromosome) in transcript direction."""
    plus = _sum(F.transform(ex, lambda e: F.greatest(F.least(e["b"], pos) - e["a"], F.lit(0).cast("bigint"))))
    minus = _sum(F.transform(ex, lambda e: F.greatest(e["b"] - F.greatest(e["a"], pos), F.lit(0).cast("bigint"))))
    return F.when(strand < 0, minus).otherwise(plus)


class Transcript:
    """Expressions over the columns strand (+1, -1), tx_start, tx_end, cds_start, cds_end, exon_starts, exon_ends."""

    def __init__(self, prefix: str = ""):
        c = lambda n: F.col(prefix + n)
        self.strand, self.tx0, self.tx1, self.cds0, self.cds1 = c("strand"), c("tx_start"), c("tx_end"), c("cds_start"), c("cds_end")
        self.exons = exons(c("exon_starts"), c("exon_ends"), self.strand)
        self.coding = self.cds0 != self.cds1
        minus = self.strand < 0
        head, tail = F.when(minus, self.cds1).otherwise(self.cds0), F.when(minus, self.cds0).otherwise(self.cds1)
        zero = F.lit(0).cast("bigint")
        self.utr5 = F.when(self.coding, exonic_before(self.exons, head, self.strand)).otherwise(zero)
        self.base3 = F.when(self.coding, exonic_before(self.exons, tail, self.strand)).otherwise(self.tx1 - self.tx0)

    @classmethod
    def attach(cls, df: DataFrame, prefix: str = "") -> tuple[DataFrame, Transcript]:
        """Adds the exons and untranslated lengths as columns of their own, so that plans read them instead of repeating them."""
        t = cls(prefix)
        df = df.withColumn(f"{prefix}ex", t.exons)
        t.exons = F.col(f"{prefix}ex")
        minus, zero = t.strand < 0, F.lit(0).cast("bigint")
        head, tail = F.when(minus, t.cds1).otherwise(t.cds0), F.when(minus, t.cds0).otherwise(t.cds1)
        u5 = F.when(t.coding, exonic_before(t.exons, head, t.strand)).otherwise(zero)
        b3 = F.when(t.coding, exonic_before(t.exons, tail, t.strand)).otherwise(t.tx1 - t.tx0)
        df = df.withColumns({f"{prefix}u5": u5, f"{prefix}b3": b3})
        t.utr5, t.base3 = F.col(f"{prefix}u5"), F.col(f"{prefix}b3")
        return df, t

    def ordinal(self, pos: Column, utr3: Column) -> Column:
        """Number of a transcript position among exonic bases, from 1; zero or less lies upstream."""
        return F.when(utr3, pos + self.base3).when(pos < 0, pos + self.utr5 + 1).otherwise(pos + self.utr5)

    def to_chromosome(self, pos: Column, offset: Column, utr3: Column) -> Column:
        """Chromosome position (1-based) of a transcript position; null beyond the last exon, unless told from the 3' end."""
        n = self.ordinal(pos, utr3)
        minus = self.strand < 0
        state = F.struct(n.cast("bigint").alias("left"), F.lit(None).cast("bigint").alias("at"))

        def walk(s, e):
            size = e["b"] - e["a"]
            here = s["at"].isNull() & (s["left"] >= 1) & (s["left"] <= size)
            at = F.when(here, F.when(minus, e["b"] + 1 - s["left"]).otherwise(e["a"] + s["left"])).otherwise(s["at"])
            return F.struct(F.when(at.isNull(), s["left"] - size).otherwise(s["left"]).alias("left"), at.alias("at"))

        end = F.aggregate(self.exons, state, walk)
        # upstream: position 0 is the base before the first; the frame has none, so -1 is next to the first base
        up = F.when(minus, self.tx1 + 1 - n).otherwise(self.tx0 + n)
        past = lambda left: F.when(minus, self.tx0 + 1 - left).otherwise(self.tx1 + left)
        found = F.transform(F.array(end), lambda e: F.when(n < 1, up).when(e["at"].isNotNull(), e["at"]).when(utr3, past(e["left"])))[0]
        return found + offset * self.strand

    def from_chromosome(self, at: Column) -> Column:
        """Transcript position as a struct of pos, offset, utr3: the nearest exon boundary and the distance from it."""
        minus = self.strand < 0
        a0 = at - 1

        def each(e):
            inside = (a0 >= e["a"]) & (a0 < e["b"])
            near = F.when(a0 < e["a"], e["a"]).when(a0 >= e["b"], e["b"] - 1).otherwise(a0)
            return F.struct(F.when(inside, F.lit(0).cast("bigint")).otherwise(F.abs(a0 - near)).alias("d"), near.alias("near"))

        best = F.array_min(F.transform(self.exons, each))
        # a lambda reads the boundary, and another its ordinal, so that neither walk over the exons is repeated for each use or each exon
        ordinal = lambda near: F.when(minus, exonic_before(self.exons, near + 1, self.strand) + 1).otherwise(exonic_before(self.exons, near, self.strand) + 1)
        placed = F.transform(F.array(best), lambda s: F.struct(s["near"].alias("near"), ordinal(s["near"]).alias("n")))
        return F.transform(placed, lambda s: self._place(a0, s["near"], s["n"]))[0]

    def _place(self, a0: Column, near: Column, ordinal: Column) -> Column:
        """Position, offset and side of a place whose nearest exonic base, the ``ordinal``-th, is at ``near``."""
        offset = (a0 - near) * self.strand
        pos = F.when(ordinal > self.base3, ordinal - self.base3).when(ordinal <= self.utr5, ordinal - self.utr5 - 1).otherwise(ordinal - self.utr5)
        return F.struct(pos.alias("pos"), offset.alias("offset"), (ordinal > self.base3).alias("utr3"))

    def shifted(self, pos: Column, offset: Column, utr3: Column, length: Column) -> Column:
        """Transcript position (pos, offset, utr3) that lies ``length`` bases further along the transcript's direction; null off it."""
        at = self.to_chromosome(pos, offset, utr3)
        return F.when(at.isNotNull(), self.from_chromosome(at + self.strand * length))

    def intron(self, number: Column, offset: Column) -> Column:
        """Chromosome position at an offset from intron ``number``: from its upstream exon if positive, else from the downstream one."""
        minus = self.strand < 0
        up, down = F.try_element_at(self.exons, number.cast("int")), F.try_element_at(self.exons, (number + 1).cast("int"))
        after = F.when(minus, up["a"] + 1 - offset).otherwise(up["b"] + offset)
        before = F.when(minus, down["b"] - offset).otherwise(down["a"] + 1 + offset)
        return F.when(offset > 0, after).otherwise(before)

    def negative_intron(self, pos: Column, offset: Column) -> Column:
        """Whether a negative offset is plausible: the position begins an exon, and the offset lies within half the intron."""
        n = self.ordinal(pos, F.lit(False))
        first = F.aggregate(self.exons, F.struct(F.lit(0).cast("bigint").alias("c"), F.lit(None).cast("bigint").alias("half"), F.lit(None).cast("bigint").alias("edge")), lambda s, e: F.struct(
            (s["c"] + e["b"] - e["a"]).alias("c"),
            F.when((s["c"] + 1 == n) & s["edge"].isNotNull(), F.floor(F.abs(F.when(self.strand < 0, s["edge"] - e["b"]).otherwise(e["a"] - s["edge"])) / 2)).otherwise(s["half"]).alias("half"),
            F.when(self.strand < 0, e["a"]).otherwise(e["b"]).alias("edge")))
        return F.coalesce(-offset <= first["half"], F.lit(False))


def fix_variant(kind: Column, start: Column, end: Column, ref: Column) -> dict[str, Column]:
    """Repairs: a range written ``34-36``; the end of a deletion from its reference's length or digit count; an insertion ends behind its start."""
    low = F.regexp_extract(start, r"^([0-9]+)-([0-9]+)$", 1)
    ranged = low != ""
    s = F.when(ranged, low).otherwise(start)
    e = F.when(ranged, F.regexp_extract(start, r"^([0-9]+)-([0-9]+)$", 2)).otherwise(F.coalesce(end, start))
    n = F.try_to_number(F.when(s.rlike("^[0-9]+$"), s), F.lit("999999999999")).cast("bigint")
    digits = F.when(ref.rlike("^[0-9]+$"), ref.try_cast("bigint"))
    size = F.coalesce(digits, F.when(F.length(ref) > 0, F.length(ref).cast("bigint")))
    longer = kind.isin("DEL", "SUB") & (s == e) & n.isNotNull() & (size > 1)
    e = F.when(longer, (n + size - 1).cast("string")).when((kind == "INS") & (s == e) & n.isNotNull(), (n + 1).cast("string")).otherwise(e)
    return {"start": s, "end": e, "ref": F.when(digits.isNotNull(), F.lit("")).otherwise(ref)}


def plain_alleles(kind: Column, ref: Column, alt: Column, copies: Column | None = None) -> dict[str, Column]:
    """Cleaned alleles and whether the variant stays: an odd reference counts as unknown, an odd alternative or none for an insertion drops it; a duplication has the told copies or two."""
    r = F.when(F.coalesce(ref, F.lit("")).rlike("^[ACGT]*$"), F.coalesce(ref, F.lit(""))).otherwise("")
    a = F.coalesce(alt, F.lit(""))
    return {"ref": r, "alt": a, "ok": a.rlike("^[ACGT]*$") & ~((kind == "INS") & (a == "")), "dup": F.when(kind == "DUP", F.lit(2) if copies is None else F.coalesce(F.when(copies.rlike("^[0-9]{1,4}$"), copies.cast("int")), F.lit(2)))}


def to_alleles(kind: Column, strand: Column, start: Column, end: Column, ref: Column, alt: Column, genome: Column, copies: Column | None = None) -> dict[str, Column]:
    """Chromosome alleles: complemented and swapped on the minus strand; a missing reference is filled from the genome
    (``genome`` is the sequence from the lower to the higher position); an insertion stands behind its start."""
    minus = strand < 0
    lo = F.when(minus, end).otherwise(start)
    r, a = F.when(minus, revcomp(ref)).otherwise(ref), F.when(minus, revcomp(alt)).otherwise(alt)
    filled = F.when(kind == "INS", F.lit("")).when(kind.isin("DEL", "INDEL") | (r == ""), genome).otherwise(r)
    return {"pos": F.when(kind == "INS", lo + 1).otherwise(lo), "ref": filled, "alt": F.when(kind == "DUP", F.repeat(filled, F.lit(2) if copies is None else copies)).when(kind == "DEL", F.lit("")).otherwise(a), "ok": (r == "") | (kind == "INS") | (r == genome)}


def mitochondrial_alleles(kind: Column, start: Column, end: Column, ref: Column, alt: Column, genome: Column, copies: Column | None = None) -> dict[str, Column]:
    """Alleles of a variant told on the mitochondrial sequence itself; ``genome`` is that from ``start`` to ``end``
    (for an insertion the base at its end). A reference that isn't the sequence's drops it; a duplication inserts the rest of its ``copies`` (2)."""
    more = F.repeat(genome, (F.lit(2) if copies is None else copies) - 1)
    return {"pos": F.when(kind == "INS", end).otherwise(start), "ref": F.when(kind.isin("DEL", "INDEL"), genome).when(kind == "DUP", "").otherwise(ref), "alt": F.when(kind == "DUP", more).otherwise(alt), "ok": (ref == "") | (ref == genome)}


def synonymous(aa: Column) -> Column:
    """Codons of an amino acid."""
    return F.coalesce(F.try_element_at(codons_of(), aa), F.array().cast("array<string>"))


def observed_alleles(observed: Column) -> Column:
    """Alleles of a listed variation; a dash is empty."""
    return F.transform(F.split(observed, "/"), lambda a: F.when(a == "-", F.lit("")).otherwise(a))


def genome_chunks(lines: DataFrame, size: int) -> DataFrame:
    """(chrom, chunk, seq) from (chrom, start0, line): lines of a sequence file dealt to chunks by their start."""
    parts = lines.withColumn("__p", F.explode(F.sequence(F.floor(F.col("start0") / size), F.floor((F.col("start0") + F.length("line") - 1) / size))))
    lo, hi = F.greatest(F.col("start0"), F.col("__p") * size), F.least(F.col("start0") + F.length("line"), (F.col("__p") + 1) * size)
    cut = parts.select("chrom", F.col("__p").alias("chunk"), lo.alias("__lo"), F.substring("line", (lo - F.col("start0") + 1).cast("int"), (hi - lo).cast("int")).alias("s"))
    return cut.groupBy("chrom", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__lo", "s"))), lambda x: x["s"]), "").alias("seq"))


def genome_slice(points: DataFrame, chunks: DataFrame, size: int, start: str, length: str, out: str = "bases") -> DataFrame:
    """Adds the bases from ``start`` (1-based) over ``length``, through as many chunks as it takes, clamped at the chromosome's ends.

    Ranges of at most ``size`` bases lie in one chunk and the next: their rows meet the two side by side, and are shuffled once.
    Longer ones are made distinct, dealt out to their chunks, cut there and joined up again in order, so a range that many rows ask for is read once.
    A range without bases, or on a chromosome that isn't there, gives an empty text; a null range gives null.
    """
    kept = [c for c in points.columns if c != out]
    known = F.col(start).isNotNull() & F.col(length).isNotNull() & F.col("chrom").isNotNull()
    low, long = F.greatest(F.col(start).cast("bigint"), F.lit(1)), F.coalesce(F.col(length) > size, F.lit(False))
    none = F.lit(None).cast("string")
    two = chunks.select("chrom", F.col("chunk").cast("bigint").alias("__chunk"), F.col("seq").alias("__own"), none.alias("__next")).unionByName(chunks.select("chrom", (F.col("chunk") - 1).cast("bigint").alias("__chunk"), none.alias("__own"), F.col("seq").alias("__next")))
    two = two.groupBy("chrom", "__chunk").agg(F.max("__own").alias("__own"), F.max("__next").alias("__next"))
    begin, end = low - F.col("__chunk") * size, F.col(start) + F.col(length) - 1 - F.col("__chunk") * size
    cut = lambda text, a, b: F.coalesce(F.when(b >= a, F.substring(text, a.cast("int"), (b - a + 1).cast("int"))), F.lit(""))
    own, behind = cut("__own", begin, F.least(end, F.lit(size))), cut("__next", F.lit(1), end - size)
    # rows without bases have no chunk, and meet none
    short = points.where(~long).withColumn("__chunk", F.when(known & (F.col(length) > 0) & (F.col(start) + F.col(length) > 1), F.floor((low - 1) / size)))
    short = short.join(shuffled(two), ["chrom", "__chunk"], "left").select(*kept, F.when(known, F.concat(own, behind)).alias(out))
    return short.unionByName(_long_slice(points.where(long), chunks, size, start, length, out))


def _long_slice(points: DataFrame, chunks: DataFrame, size: int, start: str, length: str, out: str) -> DataFrame:
    lo, hi = F.greatest(F.col("__s"), F.lit(1)), F.col("__s") + F.col("__n") - 1
    want = points.select("chrom", F.col(start).cast("bigint").alias("__s"), F.col(length).cast("bigint").alias("__n")).where("__n > 0").distinct()
    last = chunks.groupBy("chrom").agg(F.max("chunk").alias("__last"))
    bound = want.join(last, "chrom").select("chrom", "__s", "__n", F.floor((lo - 1) / size).alias("__a"), F.least(F.floor((hi - 1) / size), "__last").alias("__b")).where("__b >= __a and __s + __n > 1")
    cut = bound.select("chrom", "__s", "__n", F.explode(F.sequence("__a", "__b")).alias("chunk"))
    begin = F.greatest(lo - F.col("chunk") * size, F.lit(1))
    piece = F.substring("seq", begin.cast("int"), (F.least(hi - F.col("chunk") * size, F.lit(size)) - begin + 1).cast("int"))
    pieces = cut.join(chunks.select("chrom", F.col("chunk").cast("bigint").alias("chunk"), "seq"), ["chrom", "chunk"]).select("chrom", "__s", "__n", F.struct("chunk", piece.alias("p")).alias("x"))
    whole = pieces.groupBy("chrom", "__s", "__n").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["p"]), "").alias("__bases"))
    named = whole.select("chrom", F.col("__s").alias(start), F.col("__n").alias(length), "__bases")
    got = points.drop(out).join(named, ["chrom", start, length], "left")
    known = F.col(start).isNotNull() & F.col(length).isNotNull() & F.col("chrom").isNotNull()
    return got.select(*[c for c in points.columns if c != out], F.when(known, F.coalesce("__bases", F.lit(""))).alias(out))


def common_suffix(a: Column, b: Column, most: Column) -> Column:
    """Length of the longest common suffix of two texts, ``most`` at the largest: comparisons of suffixes, each of half the step of the one before.

    Few texts share eight letters, so three comparisons do for those that don't, and twenty-odd for the others.
    """
    def seek(v: Column, powers: range) -> Column:
        steps = F.array(*[F.lit(1 << i) for i in powers])
        return F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= v["m"]) & (F.right(v["a"], k + s) == F.right(v["b"], k + s)), k + s).otherwise(k))

    def found(v: Column) -> Column:
        return F.when((v["m"] < 8) | (F.right(v["a"], F.lit(8)) != F.right(v["b"], F.lit(8))), seek(v, range(2, -1, -1))).otherwise(seek(v, range(24, -1, -1)))

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"), F.greatest(most.cast("int"), F.lit(0)).alias("m"))), found)[0]


def common_prefix(a: Column, b: Column, most: Column) -> Column:
    return common_suffix(F.reverse(a), F.reverse(b), most)


def normalise_alleles(alleles: DataFrame, chunks: DataFrame, size: int, sizes: DataFrame, back: int = 256) -> DataFrame:
    """Leftmost, shortest form of the alleles in ``chrom, pos, ref, alt`` on a genome of ``chunks``; ``sizes`` has chrom, chrom_size.

    Common suffixes go first. Where that leaves one allele empty, it may lie anywhere in a repeat: it moves left as long as the bases before it
    continue the repeat, which is the common suffix of what stands before it and the same text moved on by the allele's length.
    A round reads ``back`` bases before each allele; only alleles that moved through all of them go on to a round with twice as many, so there is no
    limit, and the rounds grow with the logarithm of the longest repeat. Alleles with bases on both sides need no genome and stay in their rows; of
    the others equal ones are worked on once, and what a round leaves has no windows in it. All of it is column expressions.
    Defined results: alleles off the chromosome (position zero or less, or up to its end) stay as they are, those made of N alone aren't shortened; chromosomes without a size go.
    """
    key = ["chrom", "pos", "ref", "alt"]
    n = lambda c: F.length(c).cast("bigint")
    inside = (F.col("pos") > 0) & (F.col("pos") + n("ref") - 1 < F.col("chrom_size"))
    fewest = F.least(n("ref"), n("alt"))
    still = ((n("ref") == 1) & (n("alt") == 1)) | (F.concat("ref", "alt").rlike("^N+$") & (fewest > 0))
    cut = F.when(still | (fewest == 0), F.lit(0)).otherwise(common_suffix(F.col("ref"), F.col("alt"), fewest - F.when(F.col("pos") > 1, 0).otherwise(1)))
    ends = few(sizes.select("chrom", "chrom_size"))

    def trimmed(df: DataFrame) -> DataFrame:
        return once(df.join(ends, "chrom"), {"__in": inside, "__c": cut}).selectExpr(*[f"`{c}`" for c in df.columns], "__in", "left(ref, length(ref) - __c) as __r", "left(alt, length(alt) - __c) as __a")

    rows = trimmed(alleles.dropna(subset=key))
    open_ = F.col("__in") & ((F.col("__r") == "") | (F.col("__a") == ""))
    ahead = common_prefix(F.col("__r"), F.col("__a"), F.least(n("__r"), n("__a")) - 1).cast("bigint")
    shut = once(rows.where(~open_), {"__l": F.when(F.col("__in"), ahead).otherwise(F.lit(0))})
    shut = shut.selectExpr(*[f"`{c}`" for c in alleles.columns], "pos + __l as __pos", "case when __in then substring(__r, int(__l) + 1) else ref end as __ref", "case when __in then substring(__a, int(__l) + 1) else alt end as __alt")
    d = trimmed(settle(rows.where(open_).select(*key).distinct()))
    # at the first base nothing stands before; the base behind is added instead
    edge = genome_slice(d.where(open_ & (F.col("pos") == 1)).withColumn("__at", F.col("pos") + n("__r")).withColumn("__one", F.lit(1)), chunks, size, "__at", "__one", "__b")
    edge = edge.selectExpr(*key, "pos as __pos", "concat(__r, upper(__b)) as __ref", "concat(__a, upper(__b)) as __alt")
    done = [edge]
    state = d.where(open_ & (F.col("pos") > 1)).selectExpr(*key, "cast(pos as bigint) as __p", "concat(__r, __a) as __s", "__r <> '' as __gone")
    while True:
        w = state.withColumn("__w0", F.when(F.col("__p") - back <= 2, F.lit(1)).otherwise(F.col("__p") - back)).withColumn("__wn", F.col("__p") - F.col("__w0"))
        g = genome_slice(w, chunks, size, "__w0", "__wn", "__w").withColumn("__x", F.concat(F.lpad(F.upper("__w"), F.col("__wn").cast("int"), F.lit("N")), "__s"))
        most = F.col("__p") - F.greatest("__w0", F.lit(2))
        moves = F.when((F.col("__s") == "") | F.col("__s").rlike("^N+$"), F.lit(0)).otherwise(common_suffix(F.left("__x", F.col("__wn").cast("int")), F.right("__x", F.col("__wn").cast("int")), most)).cast("bigint")
        g = once(g, {"__k": moves}).withColumn("__t", F.substring("__x", (F.col("__wn") - F.col("__k") + 1).cast("int"), F.length("__s"))).withColumn("__b", F.substring("__x", (F.col("__wn") - F.col("__k")).cast("int"), F.lit(1)))
        g = settle(g.select(*key, "__p", "__k", "__t", "__b", "__gone", ((F.col("__k") == most) & (F.col("__w0") > 1)).alias("__more")))
        tidy(g.sparkSession)
        more = F.col("__more")
        done.append(g.where(~more).selectExpr(*key, "__p - 1 - __k as __pos", "if(__gone, concat(__b, __t), __b) as __ref", "if(__gone, __b, concat(__b, __t)) as __alt"))
        state = g.where(more).selectExpr(*key, "__p - __k as __p", "__t as __s", "__gone")
        if state.isEmpty():
            break
        back *= 2
    fixed = reduce(DataFrame.unionByName, done)
    put = {"pos": F.col("__pos").cast(alleles.schema["pos"].dataType), "ref": F.col("__ref"), "alt": F.col("__alt")}
    placed = [put[c].alias(c) if c in put else F.col(f"`{c}`") for c in alleles.columns]
    return shut.select(*placed).unionByName(rows.where(open_).select(*[f"`{c}`" for c in alleles.columns]).join(fixed, key).select(*placed))
