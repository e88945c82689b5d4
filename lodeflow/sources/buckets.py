"""A table of keyed rows in hash buckets: keys are replaced by writing their buckets anew, and a log says which files are the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_json_string

from lodeflow.session import settle

#: Buckets of a new table; their number is fixed when the table is made.
BUCKETS = 64
_LOG = "batch string, version long, bucket int, live boolean, buckets int, key string, schema string"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LOG).json(f"{path}/_log/*") if exists(spark, path) else spark.createDataFrame([], _LOG)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, f"{path}/_log")
    return fs.exists(p)


def _live(spark: SparkSession, path: str) -> list:
    """The newest version of each bucket: one row a bucket."""
    return _log(spark, path).groupBy("bucket").agg(F.max(F.struct("version", "live", "buckets", "key", "schema")).alias("x")).select("bucket", "x.*").where("bucket >= 0").collect()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows. Files of older versions are never read."""
    first = _log(spark, path).select("schema").first()
    if first is None:
        raise ValueError(f"no table at {path}")
    schema = _parse_datatype_json_string(first["schema"])
    assert isinstance(schema, StructType)
    paths = [f"{path}/data/version={r['version']}/__bucket={r['bucket']}" for r in _live(spark, path) if r["live"]]
    return spark.read.schema(schema).parquet(*sorted(paths)) if paths else spark.createDataFrame([], schema)


def upsert(df: DataFrame, path: str, key: str, batch: str, keys: DataFrame | None = None, buckets: int = BUCKETS) -> bool:
    """Each key of ``keys`` (else those of ``df``) loses its rows in the table and gets those of ``df``; other keys stay. False if ``batch`` was written before, and nothing happens.

    Only the buckets of these keys are read and written again, as a new version; the table changes when the log's one small file of the version is
    there, so a batch that dies leaves the table as it was and can be run again. The number of files follows the buckets, not the keys. One writer at a time.
    A null key is a key. Versions that no one reads any more go by ``vacuum``.
    """
    spark = df.sparkSession
    log = _log(spark, path)
    if not log.where(F.col("batch") == batch).isEmpty():
        return False
    known = log.agg(F.max("version").alias("v"), F.max("buckets").alias("n")).first()
    version, buckets = (known["v"] or 0) + 1, known["n"] or buckets
    place = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    new = settle(df.withColumn("__bucket", place))
    changed = settle((df if keys is None else keys).select(key).distinct().withColumn("__bucket", place))
    touched = {r[0] for r in changed.select("__bucket").distinct().collect()} | {r[0] for r in new.select("__bucket").distinct().collect()}
    rows = new
    held = [f"{path}/data/version={r['version']}/__bucket={r['bucket']}" for r in _live(spark, path) if r["live"] and r["bucket"] in touched]
    if held:
        old = spark.read.schema(df.schema).parquet(*sorted(held))
        mark = changed.select(F.col(key).alias("__key"))
        rows = old.join(mark, old[key].eqNullSafe(F.col("__key")), "left_anti").withColumn("__bucket", place).unionByName(new)
    target = f"{path}/data/version={version}"
    rows.hint("rebalance", "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(target)
    fs, p = _fs(spark, target)
    there = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith("__bucket=")}
    schema = df.schema.json()
    entries = [(batch, version, b, b in there, buckets, key, schema) for b in sorted(touched)] or [(batch, version, -1, False, buckets, key, schema)]
    spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("overwrite").json(f"{path}/_log/version={version:010d}")
    return True


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes the buckets of versions that newer ones have replaced; how many."""
    kept = {(r["version"], r["bucket"]) for r in _live(spark, path) if r["live"]}
    fs, p = _fs(spark, f"{path}/data")
    n = 0
    for v in fs.listStatus(p) if fs.exists(p) else []:
        for b in fs.listStatus(v.getPath()):
            name = b.getPath().getName()
            if name.startswith("__bucket=") and (int(v.getPath().getName().split("=")[1]), int(name.split("=")[1])) not in kept:
                fs.delete(b.getPath(), True)
                n += 1
    return n
