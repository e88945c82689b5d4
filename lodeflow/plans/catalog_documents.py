"""Queries over file parsing and the mining pipeline from end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeflow.operators import coordinates
from lodeflow.plans import papers, routes
from lodeflow.registry import query
from lodeflow.session import shared_path, spread, table
from lodeflow.sources import buckets, documents, sinks


@query("s4_pages_parsed", "select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' as titled from pages")
def s4_pages_parsed(spark, d):
    files = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("paper_id"), F.lit(0).alias("file_idx"), F.lit("page.html").alias("filename"), F.encode("html", "utf-8").alias("content"))
    p = documents.parse(files)
    return p.select(F.col("paper_id").cast("bigint").alias("page_id"), ((F.col("status") == "ok") & (F.length("body") > 0)).alias("titled"))


@query("s9_text_bodies", "select doc_id, length(substr(text, 1, 100000)) as n from documents")
def s9_text_bodies(spark, d):
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.lit(0).alias("file_idx"), F.lit("a.txt").alias("filename"), F.encode("text", "utf-8").alias("content"))
    return documents.parse(files).select(F.col("paper_id").cast("bigint").alias("doc_id"), F.length("body").cast("bigint").alias("n"))


def _papers(spark, d):
    """Bodies built from part rows: a gene symbol and a coding variant of it in one sentence, another gene in the next."""
    p = spread(table(spark, d, "part"))
    gene = F.concat(F.lit("GEN"), (F.col("p_size") % 7).cast("string"))
    other = F.concat(F.lit("GEN"), ((F.col("p_size") + 1) % 7).cast("string"))
    body = F.concat(F.lit("The "), gene, F.lit(" change c."), (F.col("p_size") + 1).cast("string"), F.lit("delA was seen.\nLater "), other, F.lit(" was too."))
    return p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("paper_id"), F.lit(0).alias("file_idx"), body.alias("body"))


@query("m1_body_results", """select p_partkey, p_size % 7 + 1 as gene_id, 'c.' || (p_size + 1) || 'delA' as mention, 4 as gene_start from part""")
def m1_body_results(spark, d):
    """Sentences, mentions, longest dictionary match, nearest gene: the slice that answers which gene a mention belongs to."""
    parsed = _papers(spark, d)
    names = spark.createDataFrame([(f"gen {i}", i + 1) for i in range(7)], "key string, gene_id int")
    got = papers.assign_body(papers.variant_mentions(parsed), papers.gene_mentions(parsed, names), papers.body_sentences(parsed))
    return got.select(F.substring("paper_id", F.lit(2), F.length("paper_id")).cast("bigint").alias("p_partkey"), "gene_id", "mention", "gene_start")


@query("m2_variant_index", """select p_partkey, cast(p_size as bigint) as pos, 'TA' as ref, 'T' as alt from part where p_size % 4 = 0""")
def m2_variant_index(spark, d):
    """The same papers through transcripts and genome to index rows: a stated reference must be the genome's, and a deletion stands behind the base before it."""
    parsed = _papers(spark, d)
    names = spark.createDataFrame([(f"gen {i}", i + 1) for i in range(7)], "key string, gene_id int")
    got = papers.assign_body(papers.variant_mentions(parsed), papers.gene_mentions(parsed, names), papers.body_sentences(parsed))
    tx = spark.createDataFrame([(i + 1, f"T{i}", "1", 1, 0, 300, 0, 300, [0], [300]) for i in range(7)], "gene_id int, name string, chrom string, strand int, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_starts array<bigint>, exon_ends array<bigint>")
    chunks = coordinates.genome_chunks(spark.createDataFrame([("1", 0, "ACGT" * 100)], "chrom string, start0 bigint, line string"), 200)
    sizes = spark.createDataFrame([("1", 400)], "chrom string, chrom_size bigint")
    index = papers.index_rows(coordinates.normalise_alleles(routes.coding_alleles(got, tx, chunks, 200), chunks, 200, sizes))
    return index.select(F.substring("paper_id", F.lit(2), F.length("paper_id")).cast("bigint").alias("p_partkey"), "pos", "ref", "alt")


@query("p8_zone_lookup", """select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where (l_partkey, l_suppkey) in (select distinct l_partkey, l_suppkey from lineitem where l_orderkey % 1000 = 7)""")
def p8_zone_lookup(spark, d):
    """Lines by the part and supplier of some orders, from a table sorted by both whose files are chosen by their ranges of keys."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    path, key = shared_path(spark, "zones"), ["l_partkey", "l_suppkey"]
    sinks.index_load(lines, path, key, 16)
    return sinks.index_lookup(lines.where("l_orderkey % 1000 = 7"), path, key).select(*lines.columns)


@query("k1_bucket_upsert", "select user_id, event_id, case when user_id % 10 = 3 then 'new' else 'old' end as state from events where (user_id % 10 <> 3 or event_type = 'view')")
def k1_bucket_upsert(spark, d):
    """Users' events in a bucketed table; a second batch replaces some users, and a batch that comes again changes nothing."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    path, some = shared_path(spark, "buckets"), e.where("user_id % 10 = 3")
    buckets.upsert(e.select("user_id", "event_id", F.lit("old").alias("state")), path, "user_id", "first", buckets=16)
    for _ in range(2):
        buckets.upsert(some.where("event_type = 'view'").select("user_id", "event_id", F.lit("new").alias("state")), path, "user_id", "second", keys=some.select("user_id"))
    return buckets.read(spark, path)


@query("f13_pattern_scan", """with m as (select l_orderkey, l_linenumber, l_partkey, l_partkey % 7 as form, case l_partkey % 7 when 0 then 'c.' || l_partkey || 'A>G' when 1 then 'p.Arg' || l_partkey || 'Gln' when 2 then 'c.' || l_partkey || '_' || (l_partkey + 2) || 'del' when 3 then 'rs' || (l_partkey + 100) when 4 then 'c.' || l_partkey || 'insACG' when 5 then 'c.' || l_partkey || 'dupT' else 'none here' end as mention from lineitem)
select l_orderkey, l_linenumber, case when form = 1 then 'protein' when form = 3 then 'listed' else 'dna' end as kind, cast(case when form in (2, 4, 5) then 0 when form = 0 then 1 else 0 end as integer) as place, mention, 5 as start, cast(5 + len(mention) as integer) as "end", true as kept from m where form <> 6
union all select l_orderkey, l_linenumber, 'dna', 2, 'c.' || l_partkey, 5, cast(7 + len(cast(l_partkey as varchar)) as integer), false from m where form in (0, 2, 4, 5)""")
def f13_pattern_scan(spark, d):
    """Mentions by a table of patterns, in the order of the lists: spans of a group, and which ones an earlier pattern has taken."""
    from lodeflow.operators import patterns
    from lodeflow.plans.catalog_text import mention_column

    front, back = r"([^0-9a-zA-Z])", r"(?=[^0-9a-zA-Z])"
    lists = {"protein": [rf"{front}(p\.[A-Z][a-z]+[0-9]+[A-Z][a-z]+)(){back}"], "dna": [rf"{front}(c\.[0-9_]+(del|ins|dup)[ACGT]*){back}", rf"{front}(c\.[0-9]+[ACGT]>[ACGT])(){back}", rf"{front}(c\.[0-9]+)()"], "listed": [rf"{front}(rs[0-9]+){back}"]}
    tables = {k: spark.createDataFrame(list(enumerate(v)), "place int, line string") for k, v in lists.items()}
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("with "), mention_column(), F.lit(" seen")).alias("text"))
    return patterns.scan(x, patterns.pattern_table(tables), ["l_orderkey", "l_linenumber"], "text")
