"""The mining pipeline end to end: parsed papers to an index of variants that can be looked up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.functions import text as T
from lodeflow.functions import variants as V
from lodeflow.functions.once import once
from lodeflow.operators import asof, dictionary, keyed, windows
from lodeflow.plans import routes

#: Alleles longer than this stay out of the index.
MOST_ALLELE = 200
INDEX_KEY = ["chrom", "pos", "ref", "alt", "paper_id", "file_idx", "in_table", "table_idx", "row", "col", "start"]


def body_sentences(parsed: DataFrame) -> DataFrame:
    """paper_id, file_idx, sent_idx, start, text: lines of a body and where they begin."""
    s = parsed.select("paper_id", "file_idx", F.posexplode(F.split("body", "\n")).alias("sent_idx", "text"))
    return s.withColumn("start", windows.running_start(F.length("text"), ["paper_id", "file_idx"], ["sent_idx"]))


def variant_mentions(parsed: DataFrame) -> DataFrame:
    """Mentions in bodies with offsets and the parsed variant; incomplete ones go."""
    m = parsed.select("paper_id", "file_idx", F.explode(V.mention_spans(F.col("body"))).alias("m")).select("paper_id", "file_idx", "m.start", "m.end", F.col("m.body").alias("mention"))
    return V.parsed(m).where(V.valid_variant(F.col("var")))


def gene_mentions(parsed: DataFrame, names: DataFrame) -> DataFrame:
    """Longest dictionary matches in bodies: ``names`` has key (lower-case tokens by spaces) and gene_id."""
    raw = once(parsed.select(F.struct("paper_id", "file_idx").alias("id"), "body"), {"spans": T.gene_token_spans(F.col("body"))})
    plain = F.filter(F.transform("spans", lambda s: F.struct(F.lower(s["token"]).alias("t"), s["start"].alias("a"), F.length(s["token"]).alias("n"))), lambda p: ~p["t"].rlike(r"[^a-z0-9_]"))
    kept = raw.withColumn("pairs", plain)
    toks = kept.select("id", "pairs", F.transform("pairs", lambda p: p["t"]).alias("tokens"), "body")
    hits = dictionary.longest_matches(toks, names, "id", "tokens", "key", "gene_id")
    spot = hits.join(toks.select("id", "pairs", "body"), "id")
    start = F.element_at("pairs", F.col("first") + 1)["a"]
    last = F.element_at("pairs", F.col("last") + 1)
    return spot.select("id.paper_id", "id.file_idx", start.alias("start"), (last["a"] + last["n"]).alias("end"), "gene_id", F.substring("body", start + 1, last["a"] + last["n"] - start).alias("gene"))


def assign_body(variants: DataFrame, genes: DataFrame, sentences: DataFrame) -> DataFrame:
    """Each body variant with its nearest gene by midpoint (a tie to the right); in another sentence the gene's place is blank, its id stays."""
    by = ["paper_id", "file_idx"]
    mid = (F.col("start") + F.col("end")) / 2
    near = asof.nearest_asof(variants.withColumn("at", mid), genes.withColumn("at", mid), by, "at", ["gene_id", "gene", "start", "end"])
    v = near.join(sentences.groupBy(*by).agg(F.sort_array(F.collect_list("start")).alias("starts")), by, "left")
    same = asof.same_span(F.col("starts"), F.col("start"), F.col("near_start"))
    blank = lambda c: F.when(same, F.col(c)).otherwise(F.lit(-1))
    return v.select(*by, "mention", "var", "start", "end", F.coalesce("near_gene_id", F.lit(0)).alias("gene_id"), F.coalesce("near_gene", F.lit("")).alias("gene"), blank("near_start").alias("gene_start"), blank("near_end").alias("gene_end"), F.lit(False).alias("in_table"), *[F.lit(-1).alias(c) for c in ("table_idx", "row", "col")])


def assign_tables(cell_variants: DataFrame, cell_genes: DataFrame, captions: DataFrame, body_genes: DataFrame) -> DataFrame:
    """Each cell variant with a gene: the cell's own or a neighbour's by the two-axis fill, a caption's only gene, the body's majority, or 0.

    ``cell_variants`` and ``cell_genes``: paper_id, file_idx, table_idx, row, col and mention, var, start, end or gene_id.
    """
    by, at = ["paper_id", "file_idx"], ["paper_id", "file_idx", "table_idx"]
    spots = cell_variants.select(*at, "row", "col").unionByName(cell_genes.select(*at, "row", "col")).distinct()
    shape = spots.groupBy(*at).agg(F.max("row").alias("r"), F.max("col").alias("c"))
    grid = shape.select(*at, F.explode(F.sequence(F.lit(0), "r")).alias("row"), "c").select(*at, "row", F.explode(F.sequence(F.lit(0), "c")).alias("col"))
    last = F.max_by("gene_id", F.struct("start", "gene_id")) if "start" in cell_genes.columns else F.max("gene_id")
    own = cell_genes.groupBy(*at, "row", "col").agg(last.alias("gene_id"))  # of several in a cell the last one
    filled = windows.ffill_2d(grid.join(own, [*at, "row", "col"], "left"), at, "row", "col", "gene_id", "cell_gene")
    caption = keyed.only_one(captions, at, "gene_id").withColumnRenamed("gene_id", "caption_gene")
    major = keyed.majority(body_genes, by, "gene_id", "start", "gene").select(*by, F.col("gene_id").alias("body_gene"))
    j = cell_variants.join(filled.select(*at, "row", "col", "cell_gene"), [*at, "row", "col"], "left").join(caption, at, "left").join(major, by, "left")
    return j.withColumn("gene_id", keyed.coalesce_chain(F.col("cell_gene"), F.col("caption_gene"), F.col("body_gene"), default=0)).drop("cell_gene", "caption_gene", "body_gene")


def index_rows(alleles: DataFrame) -> DataFrame:
    """One row for each index key; of several transcripts the last by name stays."""
    short = alleles.where((F.length("ref") <= MOST_ALLELE) & (F.length("alt") <= MOST_ALLELE))
    return keyed.last_write(short, INDEX_KEY, "transcript", ["gene_id", "end", "mention", "gene_start", "gene_end"])


def unsupported(found: DataFrame) -> DataFrame:
    """Mentions that no route takes: genomic positions, frameshifts, protein changes other than substitutions, no sequence type."""
    some = routes.is_type(found, "c", "n", "r", "m") & routes.kind(found).isin(*routes.KINDS)
    protein = routes.is_type(found, "p") & (routes.kind(found) == "SUB")
    return found.where(~(some | protein | routes.field(found, "mut_type").isin("RSID", "VCF")))


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Index rows of the wanted alleles: an equi-join on the four columns that the index is sorted by."""
    return index.join(wanted.select("chrom", "pos", "ref", "alt").distinct(), ["chrom", "pos", "ref", "alt"])
