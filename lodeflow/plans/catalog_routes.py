"""Queries from mentions to alleles: every line is a mention of its supplier's gene, on a pseudo-genome of parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeflow.operators import coordinates as C
from lodeflow.plans import routes
from lodeflow.registry import query
from lodeflow.session import settle, table

#: Bases of a chunk, small so that ranges cross chunks.
SIZE = 100


def _dna(key) -> F.Column:
    return F.translate(F.md5(key), "0123456789abcdef", "ACGTACGTACGTACGT")


def genome(spark, d):
    """Chunks of two sequences: each part gives 32 bases to both, in the order of keys. With it their sizes."""
    p = table(spark, d, "part")
    low = p.agg(F.min("p_partkey").alias("low"))
    at = p.crossJoin(F.broadcast(low)).select(F.col("p_partkey").cast("string").alias("k"), ((F.col("p_partkey") - F.col("low")) * 32).alias("start0"))  # one row of minima
    lines = at.select(F.lit("1").alias("chrom"), "start0", _dna(F.col("k")).alias("line")).unionByName(at.select(F.lit("chrM").alias("chrom"), "start0", _dna(F.concat(F.lit("m"), F.col("k"))).alias("line")))
    sizes = lines.groupBy("chrom").agg(F.sum(F.length("line")).alias("chrom_size"))
    return settle(C.genome_chunks(lines, SIZE)), settle(sizes)


_GENOME = """letters as materialized (select p_partkey, translate(md5(cast(p_partkey as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT') as one, translate(md5('m' || p_partkey), '0123456789abcdef', 'ACGTACGTACGTACGT') as mt from part),
genome as materialized (select '1' as chrom, string_agg(one, '' order by p_partkey) as s from letters union all select 'chrM', string_agg(mt, '' order by p_partkey) from letters),
size as (select 32 * count(*) as n from part),
base as materialized (select chrom, (p_partkey - (select min(p_partkey) from part)) * 32 + i as pos, substr(s, i, 1) as b from (select '1' as chrom, p_partkey, one as s from letters union all select 'chrM', p_partkey, mt from letters), range(1, 33) r(i))"""

#: Alleles (chrom, pos, ref, alt) of a table ``flat`` to their leftmost form, base by base.
_LEFTMOST = """walk as (select distinct chrom, pos as p0, ref as r0, alt as a0, pos as p, ref as r, alt as a, 0 as k, false as cut from flat union all
  select w.chrom, p0, r0, a0, case when r = '' or a = '' then p - 1 else p end, case when r = '' or a = '' then b.b || r else left(r, len(r) - 1) end,
    case when r = '' or a = '' then b.b || a else left(a, len(a) - 1) end, k + 1, r <> '' and a <> ''
  from walk w left join base b on b.chrom = w.chrom and b.pos = w.p - 1
  where p > 1 and (r = '' or a = '' or (right(r, 1) = right(a, 1) and (cut or len(r) > 1 or len(a) > 1)))),
still as (select chrom, p0, r0, a0, arg_max(p, k) as p, arg_max(r, k) as r, arg_max(a, k) as a from walk group by all),
lead as (select *, coalesce((select min(i) from range(1, least(len(r), len(a))) t(i) where substr(r, i, 1) <> substr(a, i, 1)), least(len(r), len(a))) - 1 as l from still),
leftmost as materialized (select chrom, p0, r0, a0, p + l as pos, substr(r, cast(l + 1 as bigint)) as ref, substr(a, cast(l + 1 as bigint)) as alt from lead)"""


def transcripts(spark, d, bases: int):
    """One coding exon of 360 bases for each supplier; genes of suppliers that end in 9 are mitochondrial."""
    k = F.col("s_suppkey")
    a = (k * 500) % (bases - 400) + 10
    s = table(spark, d, "supplier")
    strand = F.when(k % 2 == 0, 1).otherwise(-1)
    tx = s.select(k.alias("gene_id"), F.concat(F.lit("T"), k.cast("string")).alias("name"), F.lit("1").alias("chrom"), strand.alias("strand"), a.alias("tx_start"), (a + 360).alias("tx_end"), a.alias("cds_start"), (a + 360).alias("cds_end"), F.array(a).alias("exon_starts"), F.array(a + 360).alias("exon_ends"))
    return tx, s.select(k.alias("gene_id"), F.when(k % 10 == 9, "MT").otherwise("1").alias("chrom"))


_FORMS = [
    # type, sequence type, reference, alternative, bases from the start
    ("SUB", "c", "A", "T", 1), ("DEL", "c", "", "", 3), ("INS", "n", "", "ACG", 2), ("DUP", "r", "", "", 2), ("INDEL", "c", "", "TT", 2), ("SUB", "m", "C", "G", 1), ("DEL", "m", "", "", 2), ("SUB", "g", "A", "T", 1),
    ("SUB", "p", "L", "M", 1), ("RSID", "", "", "", 1), ("RSID+SUB", "c", "A", "T", 1), ("FS", "p", "L", "", 1),
]
_SQL_FORMS = "(values " + ", ".join(f"({i}, '{k}', '{t}', '{r}', '{a}', {n})" for i, (k, t, r, a, n) in enumerate(_FORMS)) + ") f(form, kind, seq, ref, alt, n)"


def mentions(spark, d):
    """Lines as mentions with a parsed variant: twelve forms in turn."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("gene_id"), F.col("l_partkey"), (F.col("l_partkey") % 300 + 2).alias("p"), ((F.col("l_orderkey") + F.col("l_linenumber")) % 12).cast("int").alias("form"))
    pick = lambda i: F.element_at(F.array(*[F.lit(str(f[i])) for f in _FORMS]), F.col("form") + 1)
    start = F.when(pick(1) == "p", F.col("p") % 100 + 1).otherwise(F.col("p"))
    var = F.struct(
        pick(0).alias("mut_type"), F.array_remove(F.array(pick(1)), "").alias("seq_types"), pick(2).alias("wild_type"), start.cast("string").alias("start"), (start + pick(4).cast("int") - 1).cast("string").alias("end"), pick(3).alias("mutant"),
        F.when(pick(0) == "RSID", F.col("l_partkey")).when(F.col("form") == 10, 10_000_000 + F.col("gene_id") * 1000 + F.col("p")).cast("string").alias("rsid"),
    )
    return x.select("l_orderkey", "l_linenumber", "gene_id", "p", "form", var.alias("var"))


@query("p20_alleles", f"""with recursive {_GENOME},
tx as materialized (select s_suppkey as gene, s_suppkey % 2 = 0 as plus, s_suppkey % 10 = 9 as mt, (s_suppkey * 500) % (n - 400) + 10 as a, (s_suppkey * 500) % (n - 400) + 370 as z from supplier, size),
m as materialized (select l_orderkey as o, l_linenumber as l, l_suppkey as gene, l_partkey as part, l_partkey % 300 + 2 as p, f.* from lineitem join {_SQL_FORMS} on f.form = (l_orderkey + l_linenumber) % 12),
spot as (select m.*, t.plus, 'T' || m.gene as name, '1' as chrom, case when plus then a + p else z + 1 - p end as s from m join tx t on t.gene = m.gene where seq in ('c', 'n', 'r') and not mt
  union all select m.*, true, 'Mitochondrial', 'chrM', p from m left join tx t on t.gene = m.gene where seq = 'm' or (seq in ('c', 'n', 'r') and mt)),
range_ as (select *, case when kind = 'INS' then case when plus then s + 1 else s end when plus then s else s - n + 1 end as lo, case when kind = 'INS' then 1 else n end as w from spot),
seen as (select r.*, substr(g.s, cast(lo as bigint), w) as bases, case when plus then ref else reverse(translate(ref, 'ACGT', 'TGCA')) end as r, case when plus then alt else reverse(translate(alt, 'ACGT', 'TGCA')) end as a from range_ r join genome g on g.chrom = r.chrom where lo > 0),
told as (select o, l, kind, name, chrom, lo as pos, case when kind in ('DEL', 'INDEL') then bases when kind = 'DUP' then '' else r end as ref, case when kind = 'DUP' then bases else a end as alt from seen where r = '' or r = bases),
codon as (select m.*, t.plus, 'T' || m.gene as name, case when plus then a + (p % 100 + 1) * 3 - 2 else z + 1 - (p % 100 + 1) * 3 end as place from m join tx t on t.gene = m.gene where seq = 'p' and kind = 'SUB'),
prot as (select o, l, kind, name, '1' as chrom, place as pos, bases as ref, case when plus then 'ATG' else 'CAT' end as alt from (select c.*, substr(g.s, cast(place as bigint), 3) as bases from codon c, genome g where g.chrom = '1')
  where case when plus then bases else reverse(translate(bases, 'ACGT', 'TGCA')) end in ('TTA', 'TTG', 'CTT', 'CTC', 'CTA', 'CTG')),
listed as (select o, l, kind, '' as name, '1' as chrom, (part * 7) % (select n - 1 from size) + 2 as pos, '' as ref, unnest(['A', 'C']) as alt from m where kind = 'RSID'),
shared as (select o, l, '1' as chrom, case when plus then a + p else z + 1 - p end as pos from m join tx t on t.gene = m.gene where kind = 'RSID+SUB'),
flat as materialized (select * from told union all select * from prot union all select * from listed),
{_LEFTMOST}
select f.o as l_orderkey, f.l as l_linenumber, f.name as transcript, f.chrom, cast(x.pos as bigint) as pos, x.ref, x.alt from flat f join leftmost x on x.chrom = f.chrom and x.p0 = f.pos and x.r0 = f.ref and x.a0 = f.alt
where f.kind <> 'RSID+SUB' or exists (select 1 from shared b join base g on g.chrom = b.chrom and g.pos = b.pos where b.o = f.o and b.l = f.l and b.chrom = f.chrom and b.pos = x.pos and x.ref = g.b and x.alt in (g.b, 'T'))""")
def p20_alleles(spark, d):
    """All forms through their routes to leftmost alleles: g. and frameshifts give none, m. stands on its own sequence whatever the gene, RSID+ keeps what both sides have."""
    chunks, sizes = genome(spark, d)
    bases = table(spark, d, "part").count() * 32
    tx, genes = transcripts(spark, d, bases)
    found = mentions(spark, d)
    at = F.col("tx_start") + F.col("p")
    spot = F.when(F.col("strand") > 0, at).otherwise(F.col("tx_end") + 1 - F.col("p"))
    both = found.where("form = 10").select("gene_id", "p").distinct().join(tx, "gene_id").select((10_000_000 + F.col("gene_id") * 1000 + F.col("p")).alias("name"), F.lit("1").alias("chrom"), spot.alias("at"), F.lit(1).alias("n"))
    both = C.genome_slice(both, chunks, SIZE, "at", "n").select("name", "chrom", (F.col("at") - 1).alias("start"), F.col("bases").alias("ref"), F.concat("bases", F.lit("/T")).alias("observed"))
    alone = table(spark, d, "part").select(F.col("p_partkey").alias("name"), F.lit("1").alias("chrom"), ((F.col("p_partkey") * 7) % (bases - 1) + 1).alias("start"), F.lit("-").alias("ref"), F.lit("A/C").alias("observed"))
    got = routes.alleles(found, ["l_orderkey", "l_linenumber"], genes, tx, alone.unionByName(both), chunks, SIZE, sizes, ["l_orderkey", "l_linenumber"], cheap=True)
    return got.select("l_orderkey", "l_linenumber", "transcript", "chrom", "pos", "ref", "alt")
