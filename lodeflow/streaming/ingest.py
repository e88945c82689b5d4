"""Streaming ingest of paper folders: files may arrive in any number of batches, a paper is always indexed as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodeflow.session import settle
from lodeflow.sources import buckets, documents


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """New files below a folder of papers, as paper_id, file_idx, filename, content; numbers follow names within a batch."""
    raw = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    parts = F.split("path", "/")
    return raw.select(F.element_at(parts, -2).alias("paper_id"), F.lit(0).alias("file_idx"), F.element_at(parts, -1).alias("filename"), "content")


def whole_papers(fresh: DataFrame, held: DataFrame | None) -> DataFrame:
    """The papers of ``fresh`` (newly parsed files) with the files that earlier batches brought; a file that comes again replaces itself, with all members of an archive. Files are numbered by name."""
    rows = fresh
    if held is not None:
        top = F.split_part("filename", F.lit("/"), F.lit(1))
        came = fresh.select("paper_id", top.alias("__top")).distinct()
        before = held.join(came.select("paper_id").distinct(), "paper_id", "left_semi").withColumn("__top", top)
        rows = before.join(came, ["paper_id", "__top"], "left_anti").select(*fresh.columns).unionByName(fresh)
    return rows.withColumn("file_idx", F.row_number().over(Window.partitionBy("paper_id").orderBy("filename")) - 1)


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, files: str | None = None) -> StreamingQuery:
    """Parse each batch of files and replace its papers in the bucketed table at ``out`` by ``transform`` of the whole papers.

    The state of a paper is its parsed files, in a table of their own (``files``, by default beside ``out``), bucketed by paper: a late file brings
    its paper's earlier ones with it, so any split of the files into batches ends in the same rows as one batch.
    A batch that is run again changes nothing, as both tables know its number.
    """
    files = files or f"{out.rstrip('/')}-files"

    def batch(df: DataFrame, number: int) -> None:
        fresh = documents.parse(df)
        try:
            held = buckets.read(df.sparkSession, files)
        except ValueError:
            held = None
        papers = settle(whole_papers(settle(fresh), held))
        rows = transform(papers) if transform else papers
        buckets.upsert(rows, out, "paper_id", str(number), keys=papers.select("paper_id"))
        buckets.upsert(papers, files, "paper_id", str(number))

    return file_stream(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
