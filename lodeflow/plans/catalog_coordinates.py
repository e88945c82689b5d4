"""Queries over pseudo-transcripts: an order is a transcript, its lines are exons of their quantity's length, 20 bases apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.functions.once import once
from lodeflow.operators import coordinates as C
from lodeflow.registry import query
from lodeflow.session import table

_TX = """ex as materialized (select l_orderkey as tx, l_linenumber as k, cast(max(l_quantity) as bigint) as len from lineitem group by 1, 2),
ex2 as (select *, 1000 + coalesce(sum(len + 20) over (partition by tx order by k rows between unbounded preceding and 1 preceding), 0) as a from ex),
exons as (select tx, case when tx % 2 = 0 then 1 else -1 end as strand, a, a + len as b, len, coalesce(sum(len) over (partition by tx order by case when tx % 2 = 0 then a else -a end rows between unbounded preceding and 1 preceding), 0) as before from ex2)"""


def transcripts(spark, d) -> DataFrame:
    x = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("k")).agg(F.max("l_quantity").cast("bigint").alias("len"))
    g = x.groupBy("tx").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "len"))), lambda e: e["len"]).alias("lens"))
    starts = F.transform("lens", lambda n, i: 1000 + F.aggregate(F.slice("lens", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, v: a + v + 20))
    s = g.withColumn("exon_starts", starts).withColumn("exon_ends", F.zip_with("exon_starts", "lens", lambda a, n: a + n))
    lo, hi = F.col("exon_starts")[0], F.element_at("exon_ends", -1)
    return s.select("tx", F.when(F.col("tx") % 2 == 0, 1).otherwise(-1).alias("strand"), lo.alias("tx_start"), hi.alias("tx_end"), lo.alias("cds_start"), hi.alias("cds_end"), "exon_starts", "exon_ends")


@query("w3_cumulative_lengths", f"with {_TX} select tx, a as start0, cast(before as bigint) as before from exons")
def w3_cumulative_lengths(spark, d):
    t = transcripts(spark, d).withColumn("ex", C.exons(F.col("exon_starts"), F.col("exon_ends"), F.col("strand")))
    e = t.select("tx", F.posexplode("ex").alias("i", "e"), "ex")
    return e.select("tx", F.col("e.a").alias("start0"), F.aggregate(F.slice("ex", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda s, x: s + x["b"] - x["a"]).alias("before"))


@query("v1_to_chromosome", f"""with {_TX}, q as (select unnest([1, 10, 30, 77]) as n)
select t.tx, q.n, max(case when before < n and n <= before + len then case when strand = 1 then a + n - before else b + 1 - (n - before) end end) as pos from exons t, q group by 1, 2""")
def v1_to_chromosome(spark, d):
    t = C.Transcript()
    q = transcripts(spark, d).withColumn("n", F.explode(F.array(*[F.lit(x) for x in (1, 10, 30, 77)])))
    return q.select("tx", "n", t.to_chromosome(F.col("n").cast("bigint"), F.lit(0).cast("bigint"), F.lit(False)).alias("pos"))


@query("v2_from_chromosome", f"with {_TX} select tx, n from (select tx, sum(len) as total from exons group by 1), (select unnest([1, 10, 30, 77]) as n) where n <= total")
def v2_from_chromosome(spark, d):
    tx, t = C.Transcript.attach(transcripts(spark, d))
    q = tx.withColumn("n", F.explode(F.array(*[F.lit(x) for x in (1, 10, 30, 77)])))
    at = once(q, {"at": t.to_chromosome(F.col("n").cast("bigint"), F.lit(0).cast("bigint"), F.lit(False))}).where("at is not null")
    back = once(at, {"p": t.from_chromosome(F.col("at"))})
    return back.where("p.offset = 0 and not p.utr3 and p.pos = n").select("tx", "n")


@query("v3_utr_lengths", f"with {_TX} select tx, cast(sum(greatest(least(b, 1030) - a, 0)) as bigint) as upstream from exons where strand = 1 group by 1")
def v3_utr_lengths(spark, d):
    t = transcripts(spark, d).where("strand = 1")
    ex = C.exons(F.col("exon_starts"), F.col("exon_ends"), F.col("strand"))
    return t.select("tx", C.exonic_before(ex, F.lit(1030), F.col("strand")).alias("upstream"))


@query("v4_intron_positions", f"""with {_TX}, r as (select tx, strand, a, b, row_number() over (partition by tx order by before) as i from exons)
select u.tx, case when u.strand = 1 then u.b + 3 else u.a + 1 - 3 end as after, case when w.strand = 1 then w.a + 1 - 2 else w.b + 2 end as before from r u join r w on u.tx = w.tx and u.i = 1 and w.i = 2""")
def v4_intron_positions(spark, d):
    t = C.Transcript()
    x = transcripts(spark, d).where("size(exon_starts) > 1")
    one = F.lit(1).cast("bigint")
    return x.select("tx", t.intron(one, F.lit(3).cast("bigint")).alias("after"), t.intron(one, F.lit(-2).cast("bigint")).alias("before"))


@query("v5_negative_introns", f"""with {_TX}, n as (select tx, case when min(before) filter (where before > 0) is null then null else min(before) filter (where before > 0) + 1 end as edge from exons group by 1)
select tx, true as at_edge, false as inside from n where edge is not null and (select count(*) from exons e where e.tx = n.tx and e.before = n.edge) = 0""")
def v5_negative_introns(spark, d):
    t = C.Transcript()
    x = transcripts(spark, d).where("size(exon_starts) > 1")
    first = F.aggregate(F.slice(t.exons, F.lit(1), F.lit(1)), F.lit(0).cast("bigint"), lambda s, e: s + e["b"] - e["a"])
    second = F.try_element_at(t.exons, F.lit(2))
    ok = x.withColumn("n1", first + 1).withColumn("one_base", second["b"] - second["a"] == 1).where("not (one_base and size(exon_starts) > 2)")
    return ok.select("tx", t.negative_intron(F.col("n1"), F.lit(-10).cast("bigint")).alias("at_edge"), t.negative_intron(F.col("n1") + 1, F.lit(-10).cast("bigint")).alias("inside"))


@query("v7_fix_variants", """select p_partkey, cast(p_size as varchar) as start, case p_partkey % 3 when 0 then cast(p_size + 2 as varchar) when 1 then cast(p_size + 1 as varchar) else cast(p_size + 4 as varchar) end as stop from part""")
def v7_fix_variants(spark, d):
    n = F.col("p_size").cast("string")
    kind = F.element_at(F.array(F.lit("DEL"), F.lit("INS"), F.lit("DEL")), (F.col("p_partkey") % 3 + 1).cast("int"))
    start = F.when(F.col("p_partkey") % 3 == 2, F.concat(n, F.lit("-"), (F.col("p_size") + 4).cast("string"))).otherwise(n)
    f = C.fix_variant(kind, start, F.lit(None).cast("string"), F.when(F.col("p_partkey") % 3 == 0, F.lit("ACG")).otherwise(F.lit("")))
    return table(spark, d, "part").select("p_partkey", f["start"].alias("start"), f["end"].alias("stop"))


@query("v8_plain_alleles", "select p_partkey, case when p_size % 3 = 0 then 'ACG' else '' end as ref, p_size % 2 = 0 as ok from part")
def v8_plain_alleles(spark, d):
    p = C.plain_alleles(F.lit("INS"), F.when(F.col("p_size") % 3 == 0, "ACG").otherwise("A?"), F.when(F.col("p_size") % 2 == 0, "T").otherwise("X1"))
    return table(spark, d, "part").select("p_partkey", p["ref"].alias("ref"), p["ok"].alias("ok"))


_DNA = "translate(md5(cast(p_partkey as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def dna():
    return F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT")


@query("v15_revcomp", f"select p_partkey, reverse(translate({_DNA}, 'ACGT', 'TGCA')) as rc from part")
def v15_revcomp(spark, d):
    return table(spark, d, "part").select("p_partkey", C.revcomp(dna()).alias("rc"))


@query("v16_codons", f"""with c as (select p_partkey, i, substr({_DNA}, 3 * i + 1, 3) as codon from part, range(10) r(i))
select p_partkey, string_agg(substr('FFLLSSSSYYXXCCXWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', cast(16 * (position(codon[1] in 'TCAG') - 1) + 4 * (position(codon[2] in 'TCAG') - 1) + position(codon[3] in 'TCAG') as bigint), 1), '' order by i) as protein from c group by 1""")
def v16_codons(spark, d):
    """The residues of each part's first ten codons."""
    codon = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.substring(dna(), i * 3 + 1, F.lit(3)))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(codon, lambda c: F.try_element_at(C.codon_map(), c)), "").alias("protein"))


@query("v11_synonymous", "select p_partkey, case p_size % 3 when 0 then 6 when 1 then 1 else 3 end as n from part")
def v11_synonymous(spark, d):
    aa = F.element_at(F.array(F.lit("L"), F.lit("M"), F.lit("I")), F.col("p_size") % 3 + 1)
    return table(spark, d, "part").select("p_partkey", F.explode(C.synonymous(aa)).alias("c")).groupBy("p_partkey").agg(F.count("*").cast("int").alias("n"))


@query("v12_observed", "select p_partkey, case when a = '-' then '' else a end as alt from (select p_partkey, unnest(string_split('-/A/' || left(p_name, 2), '/')) as a from part)")
def v12_observed(spark, d):
    o = F.concat(F.lit("-/A/"), F.left("p_name", F.lit(2)))
    return table(spark, d, "part").select("p_partkey", F.explode(C.observed_alleles(o)).alias("alt"))


@query("v17_genome_slice", """with g as (select string_agg(translate(md5(cast(p_partkey as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT'), '' order by p_partkey) as s from part)
select p_partkey, substr(s, cast((p_partkey - (select min(p_partkey) from part)) * 31 + 1 as bigint), 5 + p_size % 9) as bases from part, g""")
def v17_genome_slice(spark, d):
    size = 100
    p = table(spark, d, "part")
    low = p.agg(F.min("p_partkey").alias("m"))
    lines = p.crossJoin(F.broadcast(low)).select(F.lit("1").alias("chrom"), ((F.col("p_partkey") - F.col("m")) * 32).alias("start0"), dna().alias("line"))  # one row of minima
    pts = p.crossJoin(F.broadcast(low)).select("p_partkey", F.lit("1").alias("chrom"), ((F.col("p_partkey") - F.col("m")) * 31 + 1).alias("start"), (F.lit(5) + F.col("p_size") % 9).alias("n"))
    return C.genome_slice(pts, C.genome_chunks(lines, size), size, "start", "n").select("p_partkey", "bases")


@query("v9_to_alleles", f"select p_partkey, case when p_size % 2 = 0 then g else reverse(translate(left(s, 3), 'ACGT', 'TGCA')) end as ref from (select p_partkey, p_size, {_DNA} as s, left({_DNA}, 3) as g from part)")
def v9_to_alleles(spark, d):
    s = F.left(dna(), F.lit(3))
    strand = F.when(F.col("p_size") % 2 == 0, 1).otherwise(-1)
    a = C.to_alleles(F.lit("SUB"), strand, F.lit(10), F.lit(12), s, F.lit("A"), s)
    return table(spark, d, "part").select("p_partkey", a["ref"].alias("ref"))


@query("p20_routes", "select l_partkey % 7 as form, count(*) as n from lineitem where l_partkey % 7 in (0, 1, 2, 3, 4, 5) group by 1")
def p20_routes(spark, d):
    """Branches by type: listed variations, protein substitutions, coding changes; each mention takes one of them."""
    from lodeflow.functions import variants as V
    from lodeflow.plans.catalog_text import mention_column

    x = once(table(spark, d, "lineitem").select((F.col("l_partkey") % 7).alias("form"), mention_column().alias("mention")), {"var": V.parse_mention(F.col("mention"))}).where("var is not null")
    protein, listed = F.array_contains("var.seq_types", "p"), F.col("var.mut_type") == "RSID"
    route = F.when(listed, "listed").when(protein & (F.col("var.mut_type") == "SUB"), "protein").when(~protein, "coding")
    return x.where(route.isNotNull()).groupBy("form").agg(F.count("*").alias("n"))


@query("v14_normalise", """select p_partkey, cast(3 as integer) as pos, 'GCA' as ref, 'G' as alt from part""")
def v14_normalise(spark, d):
    """A deleted pair inside a repeat moves to the repeat's left end."""
    p = table(spark, d, "part").select("p_partkey", F.lit("1").alias("chrom"), F.lit(8).alias("pos"), F.lit("CA").alias("ref"), F.lit("").alias("alt"))
    chunks = C.genome_chunks(spark.createDataFrame([("1", 0, "GGGCACACACAGGG")], "chrom string, start0 bigint, line string"), 5)
    return C.normalise_alleles(p, chunks, 5, spark.createDataFrame([("1", 14)], "chrom string, chrom_size bigint")).select("p_partkey", "pos", "ref", "alt")
