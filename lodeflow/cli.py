"""Command line: ``index PAPERS INDEX --reference FOLDER`` makes an index of papers, ``lookup INDEX ...`` answers queries of variants from it."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeflow.options import with_settings
from lodeflow.plans import indexing, papers
from lodeflow.session import prepare
from lodeflow.sources import buckets, documents, sinks

#: Options and their defaults.
OPTIONS = {"gene_label": "", "limit": 1000, "chunk": indexing.CHUNK, "batch": "", "seconds": documents.READ_SECONDS}


def _report(index: DataFrame, wanted: DataFrame, gene: str, variant: str, options: dict) -> list[str]:
    hits = papers.lookup(index, wanted).withColumn("mention", F.coalesce("mention", F.lit("")))
    return [r.line for r in sinks.report(hits, gene, variant).limit(options["limit"]).collect()]


def answer(index: DataFrame, variant: str, options: dict, reference: indexing.Reference | None = None) -> list[str]:
    """Lines of the report on ``chrom pos ref alt`` ('-' for an empty allele) or, with reference tables, on ``gene variant``."""
    parts = variant.split()
    if len(parts) == 2 and reference is not None:
        try:
            gene_id, told, wanted = indexing.alleles_of(index.sparkSession, *parts, reference, options["chunk"])
        except ValueError as e:
            return [str(e)]
        return _report(index, wanted, str(gene_id), told, options)
    if len(parts) != 4:
        return [f"neither a gene and a variant nor chrom pos ref alt: {variant}"]
    chrom, pos, ref, alt = parts
    wanted = index.sparkSession.createDataFrame([(chrom, int(pos), ref.strip("-"), alt.strip("-"))], "chrom string, pos bigint, ref string, alt string")
    return _report(index, wanted, options["gene_label"], variant, options)


def build(spark: SparkSession, folder: str, path: str, reference: indexing.Reference, options: dict) -> None:
    """Parses all papers of a folder and replaces their rows in the bucketed index at ``path``; a batch of the same name is not done again."""
    parsed = documents.parse(documents.files(spark, folder), seconds=options["seconds"]).checkpoint()
    rows = indexing.index(parsed, reference, options["chunk"])
    buckets.upsert(rows, path, "paper_id", options["batch"] or uuid.uuid4().hex, keys=parsed.select("paper_id"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lodeflow")
    commands = parser.add_subparsers(dest="command", required=True)
    make = commands.add_parser("index", help="index the papers of a folder")
    make.add_argument("papers")
    ask = commands.add_parser("lookup", help="look variants up in an index")
    for p in (make, ask):
        p.add_argument("index", help="folder of the index table")
        p.add_argument("--reference", help="folder of the reference tables")
        p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    ask.add_argument("variants", nargs="*", help="'gene variant' or 'chrom pos ref alt', quoted; without any, lines of standard input")
    args = parser.parse_args(argv)
    spark = prepare(SparkSession.builder.getOrCreate())
    options = with_settings(OPTIONS, args.set)
    reference = indexing.open_reference(spark, args.reference) if args.reference else None
    if args.command == "index":
        if reference is None:
            parser.error("index needs --reference")
        build(spark, args.papers, args.index, reference, options)
        return
    index = buckets.read(spark, args.index) if buckets.exists(spark, args.index) else spark.read.parquet(args.index)
    for variant in args.variants or (line.strip() for line in sys.stdin):
        if not variant:
            break
        print("\n".join(answer(index, variant, options, reference)))


if __name__ == "__main__":
    main()
