"""From mentions with a gene to alleles on the genome: one route for each kind of sequence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.functions import variants as V
from lodeflow.functions.once import once
from lodeflow.operators import coordinates as C
from lodeflow.session import settle, tidy

#: The chromosome of mitochondrial genes, that of their sequence, and what stands for a transcript.
MT_GENES, MT_SEQUENCE, MT_TRANSCRIPT = "MT", "chrM", "Mitochondrial"
#: Types that have alleles, and the mark of a mention that also names a listed variation.
KINDS = ("SUB", "DEL", "INS", "DUP", "INDEL")
BOTH = "RSID+"
#: Bases before an allele that the first round reads: few alleles move further, and those go on.
NEAR = 16
ALLELE = ["transcript", "chrom", "pos", "ref", "alt"]


def field(df: DataFrame, name: str) -> Column:
    """A field of the variant, null where the variants of this table have none of that name."""
    return F.col(f"var.{name}") if name in df.schema["var"].dataType.fieldNames() else F.lit(None).cast("string")


def kind(df: DataFrame) -> Column:
    """The type without its mark."""
    return F.regexp_replace(field(df, "mut_type"), r"^RSID\+", "")


def is_type(df: DataFrame, *letters: str) -> Column:
    return F.coalesce(F.arrays_overlap(F.col("var.seq_types"), F.array(*[F.lit(x) for x in letters])), F.lit(False))


def _transcripts(transcripts: DataFrame) -> tuple[DataFrame, C.Transcript]:
    tx = transcripts.select("gene_id", F.col("chrom").alias("t_chrom"), F.col("name").alias("t_name"), *[F.col(c).alias(f"t_{c}") for c in ("strand", "tx_start", "tx_end", "cds_start", "cds_end", "exon_starts", "exon_ends")])
    return C.Transcript.attach(tx, "t_")


def _parts(df: DataFrame) -> DataFrame:
    """Cleaned fields: an odd reference counts as unknown, a number as a length; an odd alternative, or none for an insertion, drops the row; two copies unless a number is told."""
    ref, alt, dup = F.coalesce(field(df, "wild_type"), F.lit("")), F.coalesce(field(df, "mutant"), F.lit("")), field(df, "dup")
    rows = df.withColumns({
        "__kind": kind(df), "__size": F.when(ref.rlike("^[0-9]+$"), ref.try_cast("bigint")).when(ref != "", F.length(ref).cast("bigint")),
        "__ref": F.when(ref.rlike("^[ACGT]*$"), ref).otherwise(""), "__alt": alt, "__copies": F.coalesce(F.when(dup.rlike("^[0-9]{1,4}$"), dup.cast("int")), F.lit(2)),
    })
    return rows.where(F.col("__kind").isin(*KINDS) & F.col("__alt").rlike("^[ACGT]*$") & ~((F.col("__kind") == "INS") & (F.col("__alt") == "")))


def _written(df: DataFrame, columns: list[str], chunks: DataFrame, size: int, transcript: Column, strand: Column) -> DataFrame:
    """Rows with __lo, __hi on chrom, and alleles in chromosome direction, to alleles by what the genome has there.

    A stated reference that the genome doesn't have drops the row, and so does a change without any base.
    """
    ranges = settle(df.withColumn("__n", F.col("__hi") - F.col("__lo") + 1).select(*columns, "chrom", "__lo", "__n", "__kind", "__ref", "__alt", "__copies", transcript.alias("transcript"), strand.alias("__strand")))  # read for the slices and again for the rows
    g = C.genome_slice(ranges, chunks, size, "__lo", "__n", "__bases").withColumn("__bases", F.upper("__bases"))
    k, strand = F.col("__kind"), F.col("__strand")
    turn = lambda c: F.when(strand < 0, C.revcomp(F.col(c))).otherwise(F.col(c))
    ref = F.when(k.isin("DEL", "INDEL"), F.col("__bases")).when(k == "DUP", F.lit("")).otherwise(turn("__ref"))
    alt = F.when(k == "DUP", F.repeat(F.col("__bases"), F.col("__copies") - 1)).otherwise(turn("__alt"))
    kept = g.where((F.col("__ref") == "") | (turn("__ref") == F.col("__bases")))
    return kept.select(*columns, "transcript", "chrom", F.col("__lo").alias("pos"), ref.alias("ref"), alt.alias("alt")).where("ref <> '' or alt <> ''")


def coding_alleles(found: DataFrame, transcripts: DataFrame, chunks: DataFrame, size: int, kept: list[str] | None = None) -> DataFrame:
    """Changes told on c, n or r positions through every transcript of their gene: adds transcript, chrom, pos, ref, alt, not yet normalised, to the columns ``kept`` (here and below: all).

    Repairs by the transcript: one position with a negative offset that can't be an intron's is a range (``34-36``); the end of a
    substitution or deletion follows from its reference's length; an insertion lies before the base behind its start. On the minus strand alleles turn round.
    """
    v = _parts(found.where(is_type(found, "c", "n", "r") & ~(is_type(found, "p") & (kind(found) == "SUB"))))
    v = once(v, {"__p": V.parse_position(F.col("var.start")), "__e": V.parse_position(F.col("var.end"))}).withColumn("__q", F.coalesce("__e", "__p")).where("__p is not null")
    tx, t = _transcripts(transcripts)
    j = v.join(tx, "gene_id")
    same = F.col("__p").eqNullSafe(F.col("__q")) & (F.col("__p.offset") < 0) & F.col("__p.intron").isNull()
    ranged = same & ~t.negative_intron(F.col("__p.pos"), F.col("__p.offset"))
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    j = once(j, {"__range": ranged})

    def place(p: str) -> Column:
        return F.when(F.col(f"{p}.intron").isNotNull(), t.intron(F.col(f"{p}.intron"), F.col(f"{p}.offset"))).otherwise(t.to_chromosome(F.col(f"{p}.pos"), F.when(F.col("__range"), zero).otherwise(F.col(f"{p}.offset")), F.col(f"{p}.utr3") & ~F.col("__range")))

    strand = F.col("t_strand")
    end = F.when(F.col("__kind").isin("SUB", "DEL") & F.col("__size").isNotNull(), F.col("__from") + strand * (F.col("__size") - 1)).when(F.col("__kind") == "INS", F.col("__from") + strand)
    j = once(j, {"__from": place("__p"), "__told": F.when(F.col("__range"), t.to_chromosome(-F.col("__p.offset"), zero, no)).otherwise(place("__q"))})
    j = j.withColumn("__to", F.coalesce(end, "__told")).where("__from is not null and __to is not null")
    turned = strand < 0
    low, high = F.when(turned, F.col("__to")).otherwise(F.col("__from")), F.when(turned, F.col("__from")).otherwise(F.col("__to"))
    j = j.withColumn("__hi", high).withColumn("__lo", F.when(F.col("__kind") == "INS", high).otherwise(low)).where("__lo > 0")
    return _written(j.withColumn("chrom", F.col("t_chrom")), kept or found.columns, chunks, size, F.col("t_name"), strand)


def mitochondrial_alleles(found: DataFrame, chunks: DataFrame, size: int, kept: list[str] | None = None) -> DataFrame:
    """Changes told on the mitochondrial sequence itself, whatever their gene: no transcript is looked up."""
    v = _parts(found.where(~(is_type(found, "p") & (kind(found) == "SUB")))).withColumn("chrom", F.lit(MT_SEQUENCE))
    v = once(v, {"__from": V.parse_position(F.col("var.start"))["pos"], "__e": V.parse_position(F.col("var.end"))["pos"]}).withColumn("__to", F.coalesce("__e", "__from")).where("__from is not null")
    end = F.when(F.col("__kind").isin("SUB", "DEL") & F.col("__size").isNotNull(), F.col("__from") + F.col("__size") - 1).when(F.col("__kind") == "INS", F.col("__from") + 1).otherwise(F.col("__to"))
    v = v.withColumn("__hi", end).withColumn("__lo", F.when(F.col("__kind") == "INS", F.col("__hi")).otherwise(F.col("__from"))).where("__lo > 0")
    return _written(v, kept or found.columns, chunks, size, F.lit(MT_TRANSCRIPT), F.lit(1))


def rna_alleles(found: DataFrame, genes: DataFrame, transcripts: DataFrame, chunks: DataFrame, size: int, kept: list[str] | None = None) -> DataFrame:
    """c, n and r: those of mitochondrial genes (``genes``: gene_id, chrom) on the sequence itself, the others through transcripts."""
    mt = genes.where(F.col("chrom") == MT_GENES).select("gene_id").distinct()
    coded = found.where(is_type(found, "c", "n", "r"))
    return coding_alleles(coded.join(mt, "gene_id", "left_anti").select(*found.columns), transcripts, chunks, size, kept).unionByName(mitochondrial_alleles(coded.join(mt, "gene_id", "left_semi").select(*found.columns), chunks, size, kept))


def protein_alleles(found: DataFrame, transcripts: DataFrame, chunks: DataFrame, size: int, kept: list[str] | None = None) -> DataFrame:
    """Protein substitutions to every codon of the new residue (``=`` means the old one), where the three bases from the codon's first on give the stated residue."""
    v = found.where(is_type(found, "p") & (kind(found) == "SUB") & F.col("var.start").rlike("^[0-9]{1,9}$")).withColumn("__i", F.col("var.start").cast("bigint"))
    old = V.one_letter(F.upper("var.wild_type"))
    v = v.withColumn("__old", old).withColumn("__new", F.when(F.col("var.mutant") == "=", old).otherwise(V.one_letter(F.upper("var.mutant"))))
    tx, t = _transcripts(transcripts)
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    turned = F.col("t_strand") < 0
    j = once(v.join(tx, "gene_id"), {"__lo": t.to_chromosome(F.when(turned, F.col("__i") * 3).otherwise(F.col("__i") * 3 - 2), zero, no)}).where("__lo > 0").withColumn("__n", F.lit(3)).withColumn("chrom", F.col("t_chrom"))
    g = C.genome_slice(settle(j.select(*(kept or found.columns), "t_name", "t_strand", "chrom", "__lo", "__n", "__old", "__new")), chunks, size, "__lo", "__n", "__bases").withColumn("__bases", F.upper("__bases"))
    codon = F.when(turned, C.revcomp(F.col("__bases"))).otherwise(F.col("__bases"))
    alts = g.where(F.try_element_at(C.codon_map(), codon) == F.col("__old")).withColumn("__c", F.explode(C.synonymous(F.col("__new"))))
    return alts.select(*(kept or found.columns), F.col("t_name").alias("transcript"), "chrom", F.col("__lo").alias("pos"), F.col("__bases").alias("ref"), F.when(turned, C.revcomp(F.col("__c"))).otherwise(F.col("__c")).alias("alt"))


def rsid_alleles(found: DataFrame, rsids: DataFrame, drop_reference: bool = False, kept: list[str] | None = None) -> DataFrame:
    """Listed variations to each of their alleles, the reference's own among them."""
    marked = (kind(found) == "RSID") | field(found, "mut_type").startswith(BOTH)
    v = found.where(marked).withColumn("__name", F.regexp_replace(F.col("var.rsid"), "^(?i:rs)", "").try_cast("bigint"))
    listed = rsids.select(F.col("name").alias("__name"), "chrom", F.col("start").alias("__s"), F.col("ref").alias("__ref"), "observed")
    j = v.join(listed, "__name").withColumn("alt", F.explode(C.observed_alleles(F.col("observed"))))
    out = j.select(*(kept or found.columns), F.lit("").alias("transcript"), "chrom", (F.col("__s") + 1).alias("pos"), F.when(F.col("__ref") == "-", "").otherwise(F.col("__ref")).alias("ref"), "alt")
    return out.where("ref <> alt") if drop_reference else out


def given_alleles(found: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """Variants that are alleles already (type VCF with chrom, position, ref, alt)."""
    v = found.where(field(found, "mut_type") == "VCF")
    return v.select(*(kept or found.columns), F.lit("").alias("transcript"), field(found, "chrom").alias("chrom"), field(found, "position").cast("bigint").alias("pos"), *[F.coalesce(field(found, c), F.lit("")).alias(c) for c in ("ref", "alt")])


def alleles(found: DataFrame, by: list[str], genes: DataFrame, transcripts: DataFrame, rsids: DataFrame, chunks: DataFrame, size: int, sizes: DataFrame, kept: list[str] | None = None, cheap: bool = False) -> DataFrame:
    """Every mention's normalised alleles: ``found`` (with gene_id and var; ``by`` tells mentions apart and has no nulls) with transcript, chrom, pos, ref, alt.

    Of the mention's columns only ``kept`` are carried through the routes and stay in the result, which spares disk; all, unless told.
    Each route reads the mentions: they are settled before, unless it is told that making them again is cheap (files and plain expressions).

    ======================= ===========================================================
    mention                 route
    ======================= ===========================================================
    VCF                     as it is, not normalised
    RSID                    the listed alleles
    p, substitution         codons through transcripts
    c, n, r                 through transcripts; of a mitochondrial gene on chrM
    m                       on chrM, whatever the gene
    RSID+type               what its sequence type gives, if the listed alleles have it too
    g and anything else     nothing
    ======================= ===========================================================

    The first route that fits is taken. A mention without a sequence type has none.
    """
    kept = kept or found.columns
    found = found.select(*dict.fromkeys([*kept, *by, "gene_id", "var"]))
    found = found if cheap else settle(found)
    told = {c: f"__own_{c}" for c in ALLELE if c in found.columns}  # a mention's own columns of these names
    base = found.withColumnsRenamed(told)
    base = base.withColumn("__both", field(base, "mut_type").startswith(BOTH))
    told_by = [told.get(c, c) for c in by]
    carried = list(dict.fromkeys([*[told.get(c, c) for c in kept], *told_by, "__both"]))
    protein = is_type(base, "p") & (kind(base) == "SUB")
    coded = ~protein & is_type(base, "c", "n", "r")
    routes = [
        lambda: protein_alleles(base.where(protein), transcripts, chunks, size, carried), lambda: rna_alleles(base.where(coded), genes, transcripts, chunks, size, carried),
        lambda: mitochondrial_alleles(base.where(~protein & ~coded & is_type(base, "m")), chunks, size, carried), lambda: rsid_alleles(base, rsids, kept=carried),
    ]
    sided = []
    for i, route in enumerate(routes):  # one after the other, so that only one route's shuffles are on disk at a time
        sided.append(settle(route().withColumn("__listed", F.lit(i == len(routes) - 1))))  # read for the distinct alleles and again for the rows
        tidy(found.sparkSession)
    sides = reduce(DataFrame.unionByName, sided)
    del sided
    flat = settle(C.normalise_alleles(sides, chunks, size, sizes, NEAR))
    del sides
    tidy(flat.sparkSession)
    both = F.col("__both")
    wanted = flat.where(both & F.col("__listed")).select(*told_by, "chrom", "pos", "ref", "alt").distinct()
    joint = flat.where(both & ~F.col("__listed")).join(wanted, [*told_by, "chrom", "pos", "ref", "alt"], "left_semi").select(*flat.columns)
    out = flat.where(~both).unionByName(joint).drop("__listed").unionByName(given_alleles(base, carried))
    return out.select(*[F.col(told.get(c, c)).alias(f"mention_{c}" if c in told else c) for c in kept], *ALLELE)
