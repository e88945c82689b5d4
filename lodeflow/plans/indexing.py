"""The index run: from a folder of papers and a folder of reference tables to rows that can be looked up by allele."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeflow.functions import text as T
from lodeflow.functions import variants as V
from lodeflow.functions.once import once
from lodeflow.operators import coordinates, dictionary
from lodeflow.plans import papers, routes
from lodeflow.session import settle
from lodeflow.sources import documents

#: Bases of a chunk of the genome table.
CHUNK = 10_000
PLACE = ["paper_id", "file_idx", "table_idx", "row", "col"]


@dataclass
class Reference:
    """The tables that an index run reads.

    ``keys``: key (lower-case tokens by spaces), gene_id: what counts as a gene's mention. ``names``: kind, name_key, gene_id; ``gene_tokens``: gene_id, token;
    ``name_tokens``: gene_id, name, token: what the name cascade resolves by. ``symbols``: key, written as cells write them. ``genes``: gene_id, symbol, chrom.
    ``transcripts``: gene_id, name, chrom, strand, starts and ends. ``rsids``: name, chrom, start, ref, observed. ``chunks``: chrom, chunk, seq; ``sizes``: chrom, chrom_size.
    """

    keys: DataFrame
    names: DataFrame
    gene_tokens: DataFrame
    name_tokens: DataFrame
    symbols: DataFrame
    genes: DataFrame
    transcripts: DataFrame
    rsids: DataFrame
    chunks: DataFrame
    sizes: DataFrame


def save_reference(ref: Reference, folder: str) -> None:
    """All tables below one folder, each written whole (what was there goes), the genome and the listed variations in the order that they are looked up by."""
    order = {"chunks": ["chrom", "chunk"], "rsids": ["name"], "transcripts": ["gene_id"]}
    for f in fields(ref):
        table = getattr(ref, f.name)
        if f.name in order:
            table = table.repartitionByRange(*order[f.name]).sortWithinPartitions(*order[f.name])
        table.write.mode("overwrite").parquet(f"{folder}/{f.name}")


def open_reference(spark: SparkSession, folder: str) -> Reference:
    return Reference(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(Reference)})


def reference_of(dictionary_tables: dict[str, DataFrame], keys: DataFrame, genes: DataFrame, transcripts: DataFrame, rsids: DataFrame, lines: DataFrame, size: int = CHUNK) -> Reference:
    """Reference tables from what the readers give: ``name_dictionary``, ``tree``'s paths, ``genes`` (id, symbol, chrom), ``transcripts``, ``rsids`` and ``fasta``."""
    spelled = genes.where("symbol is not null").select(F.col("symbol").alias("key")).distinct()
    chunks = coordinates.genome_chunks(lines, size)
    sizes = lines.groupBy("chrom").agg(F.max(F.col("start0") + F.length("line")).alias("chrom_size"))
    return Reference(keys, dictionary_tables["names"], dictionary_tables["gene_tokens"], dictionary_tables["name_tokens"], spelled, genes.select(F.col("id").alias("gene_id"), "symbol", "chrom"), transcripts, rsids, chunks, sizes)


def cell_variants(cells: DataFrame) -> DataFrame:
    """Valid variant mentions of table cells: place, start, end, mention, var."""
    m = once(cells.select(*PLACE, "text"), {"ms": V.mention_spans(F.col("text"))}).select(*PLACE, F.explode("ms").alias("m")).select(*PLACE, "m.start", "m.end", F.col("m.body").alias("mention"))
    return V.parsed(m).where(V.valid_variant(F.col("var")))


def text_mentions(texts: DataFrame, ref: Reference) -> DataFrame:
    """place, start, end, gene: dictionary matches of texts (place, body), without what reads as a figure or a chromosome."""
    keys = ref.keys.groupBy("key").agg(F.max("gene_id").alias("gene_id"))
    found = papers.gene_mentions(texts.select(F.col("place").alias("paper_id"), F.lit(0).alias("file_idx"), "body"), keys)
    found = V.drop_look_alikes(found.withColumn("__tokens", T.gene_tokens(F.lower("gene"))), "__tokens")
    return found.select(F.col("paper_id").alias("place"), "start", "end", "gene")


def cell_words(cells: DataFrame, ref: Reference) -> DataFrame:
    """place, row, col, at, gene: words of cells that are symbols, in their order."""
    plain = F.regexp_replace("text", r"[^0-9A-Za-z_.'@+-]", " ")
    words = cells.select(*PLACE, F.posexplode(F.filter(F.split(plain, r"\s+"), lambda w: w != "")).alias("at", "gene"))
    return words.join(ref.symbols.withColumnRenamed("key", "gene"), "gene", "left_semi").select(*PLACE, "at", "gene")


def found_genes(parsed: DataFrame, cells: DataFrame, ref: Reference, block_chars: int = 5000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Genes of bodies (paper_id, file_idx, start, end, gene, gene_id), of captions (paper_id, file_idx, table_idx, gene_id) and of cells (place, gene, gene_id).

    Mentions of all three go through one name cascade: those of a text are resolved together within blocks of ``block_chars`` characters, whose words
    stand for the article; a cell's words are resolved each by itself, and the first that has a gene is the cell's.
    """
    none = F.lit(None).cast("int")
    place = lambda t, w: F.struct(F.col("paper_id"), F.col("file_idx").cast("int").alias("file_idx"), t.cast("int").alias("table_idx"), w.cast("string").alias("word"))
    bodies = parsed.select(place(none, none).alias("place"), "body")
    captions = parsed.select("paper_id", "file_idx", F.posexplode("tables").alias("table_idx", "t")).select(place(F.col("table_idx"), none).alias("place"), F.col("t.caption").alias("body"))
    texts = settle(bodies.unionByName(captions).where("body <> ''"))
    block = lambda k: F.struct("place", k.cast("int").alias("k"))
    told = settle(text_mentions(texts, ref))
    spelled = settle(cell_words(cells, ref))
    blank = F.lit("").alias("paper_id"), F.lit(0).alias("file_idx")
    alone = spelled.select("gene").distinct().select("gene", *blank).select(place(none, F.col("gene")).alias("place"), F.lit(0).alias("start"), F.length("gene").alias("end"), "gene")
    mentions = told.unionByName(alone).select(block(T.block_of(F.col("start"), block_chars)).alias("block"), "start", "end", F.col("gene").alias("mention"))
    parts = texts.join(told.select("place").distinct(), "place", "left_semi").select("place", "body", F.explode(F.sequence(F.lit(0), F.floor((F.length("body") - 1) / block_chars).cast("int"))).alias("k"))
    words = F.split(T.name_words(F.substring("body", F.col("k") * block_chars + 1, F.lit(block_chars))), " +")
    articles = parts.select(block(F.col("k")).alias("block"), F.explode(words).alias("token")).where("token <> ''").distinct()
    got = settle(dictionary.resolve_names(mentions, ref.names, ref.gene_tokens, ref.name_tokens, articles).where("gene_id is not null").select("block.place", "start", "end", F.col("mention").alias("gene"), "gene_id"))
    body = got.where("place.word is null and place.table_idx is null").select("place.paper_id", "place.file_idx", "start", "end", "gene", "gene_id")
    caption = got.where("place.word is null and place.table_idx is not null").select("place.paper_id", "place.file_idx", "place.table_idx", "gene_id")
    cell = spelled.join(got.where("place.word is not null").select("gene", "gene_id"), "gene").withColumn("__n", F.row_number().over(Window.partitionBy(*PLACE).orderBy("at")))
    return body, caption, cell.where("__n = 1").select(*PLACE, "gene", "gene_id")


def results(parsed: DataFrame, ref: Reference) -> DataFrame:
    """Every valid variant mention of bodies and table cells with its gene (0 without one) and where both stand."""
    parsed = settle(parsed)
    cells = settle(documents.cells(parsed))
    genes, told, own = found_genes(parsed, cells, ref)
    body = papers.assign_body(papers.variant_mentions(parsed), genes, papers.body_sentences(parsed))
    table = papers.assign_tables(settle(cell_variants(cells)), own.select(*PLACE, "gene_id"), told, genes)
    gene_name = ref.genes.groupBy("gene_id").agg(F.min("symbol").alias("gene"))
    table = table.join(gene_name, "gene_id", "left").select("paper_id", "file_idx", "mention", "var", "start", "end", "gene_id", F.coalesce("gene", F.lit("")).alias("gene"), F.lit(-1).alias("gene_start"), F.lit(-1).alias("gene_end"), F.lit(True).alias("in_table"), "table_idx", "row", "col")
    return body.select(table.columns).unionByName(table)


def index(parsed: DataFrame, ref: Reference, size: int = CHUNK) -> DataFrame:
    """Index rows of parsed papers: each mention's alleles through the routes, the last transcript by name for each key, alleles of bounded length."""
    found = settle(results(parsed, ref))
    by = ["paper_id", "file_idx", "in_table", "table_idx", "row", "col", "start", "end", "gene_id", "mention"]
    got = routes.alleles(found, by, ref.genes.select("gene_id", "chrom"), ref.transcripts, ref.rsids, ref.chunks, size, ref.sizes)
    return papers.index_rows(got)


def alleles_of(spark: SparkSession, gene: str, variant: str, ref: Reference, size: int = CHUNK) -> tuple[int, str, DataFrame]:
    """Gene id, the variant as it was understood, and its alleles, for a gene (a number or a symbol) and a variant as a user writes it; ValueError for an unknown gene or form."""
    if gene.isdigit():
        gene_id = int(gene)
    else:
        row = ref.genes.where(F.col("symbol") == gene).agg(F.min("gene_id")).first()
        if row[0] is None:
            raise ValueError(f"unknown gene: {gene}")
        gene_id = row[0]
    asked = spark.createDataFrame([(0, gene_id, variant)], "id int, gene_id int, text string")
    v = once(asked, {"q": V.parse_lookup(F.col("text"))}).where("q is not null")
    listed = F.col("q.mut_type") == "RSID"
    var = F.struct(
        F.col("q.mut_type").alias("mut_type"), F.when(listed, F.array().cast("array<string>")).otherwise(F.array("q.seq")).alias("seq_types"), F.col("q.ref").alias("wild_type"), F.col("q.start").alias("start"), F.col("q.end").alias("end"),
        F.col("q.alt").alias("mutant"), F.when(listed, F.col("q.start")).alias("rsid"),
    )
    found = settle(v.select("id", "gene_id", var.alias("var")))
    told = found.select(F.to_json("var")).first()
    if told is None:
        raise ValueError(f"unknown form of variant: {variant}")
    return gene_id, told[0], routes.alleles(found, ["id"], ref.genes.select("gene_id", "chrom"), ref.transcripts, ref.rsids, ref.chunks, size, ref.sizes)
