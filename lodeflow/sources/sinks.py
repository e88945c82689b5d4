"""Writers: replace by key, bulk load, folder fan-out, reports and result files."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.functions import text as T


def replace_by_key(df: DataFrame, path: str, key: str = "paper_id") -> None:
    """Each key in ``df`` replaces all rows of that key in the table; other keys stay. Writing the same rows again changes nothing."""
    df.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def bulk_load(df: DataFrame, path: str, sort: list[str], files: int | None = None) -> None:
    """Whole-table load, ranges of ``sort`` to files and sorted within: min and max of each row group stand in for an index."""
    (df.repartitionByRange(files, *sort) if files else df.repartitionByRange(*sort)).sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)


def index_load(df: DataFrame, path: str, key: list[str], files: int | None = None) -> None:
    """A table for lookups by ``key``: ranges of the key to files, and beside them a table of each file's least and greatest key (columns with nulls are sorted first)."""
    bulk_load(df, path, key, files)
    spark = df.sparkSession
    whole = spark.read.parquet(path)
    zones = whole.groupBy(F.input_file_name().alias("file")).agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"), F.count("*").alias("rows"))
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}/_zones")  # one row a file; a reader of the table passes over names like this


def index_files(wanted: DataFrame, path: str, key: list[str]) -> list[str]:
    """The files whose range of keys holds any of the ``wanted`` keys; a list as long as the table has such files."""
    zones = wanted.sparkSession.read.parquet(f"{path}/_zones")
    asked = wanted.select(F.struct(*key).alias("k"))
    return sorted(r[0] for r in zones.join(asked, (F.col("k") >= F.col("low")) & (F.col("k") <= F.col("high")), "left_semi").select("file").collect())


def index_lookup(wanted: DataFrame, path: str, key: list[str], few: int = 1000) -> DataFrame:
    """Rows of the table at ``path`` with a wanted key. At most ``few`` keys (counted) choose the files, so one lookup reads one file, or two where a key lies on a border; more are joined with the whole table."""
    spark, keys = wanted.sparkSession, wanted.select(*key).distinct()
    schema = spark.read.parquet(path).schema
    if keys.limit(few + 1).count() > few:
        return spark.read.parquet(path).join(keys, key, "left_semi")
    found = index_files(keys, path, key)
    table = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return table.join(F.broadcast(keys), key, "left_semi")  # at most ``few`` rows


def truncate(df: DataFrame, path: str) -> None:
    df.limit(0).write.mode("overwrite").parquet(path)


def fan_out(df: DataFrame, path: str, name: str) -> None:
    """Rows below two levels of folders, told by a hash of a name."""
    h = F.upper(F.md5(F.col(name)))
    df.withColumn("d1", F.substring(h, 1, 2)).withColumn("d2", F.substring(h, 3, 2)).write.mode("overwrite").partitionBy("d1", "d2").parquet(path)


def detection_lines(dets: DataFrame, image: str, score: str) -> DataFrame:
    """Lines ``image score x1 y1 x2 y2`` with corners from 1."""
    return dets.select(F.format_string("%s %.3f %.1f %.1f %.1f %.1f", F.col(image), F.col(score), *[F.col(s) + 1 for s in ("x1", "y1", "x2", "y2")]).alias("line"))


def coco_result(dets: DataFrame, image: Column, category: Column, score: str) -> DataFrame:
    """One JSON object a row: image, category, box as x y w h, score."""
    box = F.array("x1", "y1", F.col("x2") - F.col("x1") + 1, F.col("y2") - F.col("y1") + 1)
    return dets.select(F.to_json(F.struct(image.alias("image_id"), category.alias("category_id"), box.alias("bbox"), F.col(score).alias("score"))).alias("line"))


def write_lines(df: DataFrame, path: str, col: str = "line") -> None:
    df.select(col).write.mode("overwrite").text(path)


def report(hits: DataFrame, gene: str, variant: str) -> DataFrame:
    """Lines of a lookup's answer: the gene, the variant, how many papers, then each paper with its mentions by place."""
    per = hits.groupBy("paper_id").agg(F.array_sort(F.collect_set(F.struct("file_idx", "start", "mention"))).alias("ms"))
    lines = per.select(F.lit(1).alias("o"), F.col("paper_id").alias("k"), F.concat(F.col("paper_id"), F.lit("\t"), F.array_join(F.transform("ms", lambda m: m["mention"]), ", ")).alias("line"))
    head = per.agg(F.count("*").alias("n")).select(F.lit(0).alias("o"), F.lit("").alias("k"), F.concat_ws("\t", F.lit(gene), F.lit(variant), F.col("n").cast("string")).alias("line"))
    return head.unionByName(lines).orderBy("o", "k").select("line")


def histogram(df: DataFrame, value: str, bins: int = 1000) -> DataFrame:
    """Equal bins between the extremes (the last holds the highest value, also where all are equal), with the moments on each row: bin, n, low, high, total, squares."""
    m = df.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value).alias("total"), F.sum(F.col(value) * F.col(value)).alias("squares"))
    # the order of the steps decides where a value on the edge of two bins is rounded to: the share of the range first, then the bins
    b = F.when(F.col(value) >= F.col("high"), F.lit(bins).cast("bigint")).otherwise(F.floor((F.col(value) - F.col("low")) / (F.col("high") - F.col("low")) * bins) + 1)
    wide = df.crossJoin(F.broadcast(m))  # one row of extremes
    return wide.groupBy(b.alias("bin"), "low", "high", "total", "squares").agg(F.count("*").alias("n"))


def path_of(name: Column) -> Column:
    return T.fanout_path(name)


def array_bytes(values: Column) -> Column:
    """An array of numbers as the bytes of a compressed array file, as services exchange them."""
    @F.pandas_udf("binary")
    def run(a: pd.Series) -> pd.Series:
        def one(x):
            with io.BytesIO() as f:
                np.savez_compressed(f, array=np.asarray(x, dtype=float))
                return f.getvalue()

        return a.map(lambda x: None if x is None else one(x))

    return run(values)


def bytes_array(data: Column) -> Column:
    """The numbers in the bytes of an array file."""
    @F.pandas_udf("array<double>")
    def run(b: pd.Series) -> pd.Series:
        return b.map(lambda x: None if x is None else np.load(io.BytesIO(bytes(x)), allow_pickle=False)["array"].ravel().tolist())

    return run(data)


def write_curves(points: DataFrame, path: str, by: list[str]) -> None:
    """Precision and recall at each rank, sorted by group and rank."""
    points.select(*by, "rank", "recall", "precision").repartitionByRange(*by, "rank").sortWithinPartitions(*by, "rank").write.mode("overwrite").parquet(path)
