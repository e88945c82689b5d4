"""Per-key choices: last write wins, majority, fallback, top n, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_write(df: DataFrame, keys: list[str], seq: str, values: list[str]) -> DataFrame:
    """One row for each key: that with the highest ``seq``; a grouped maximum, combined before the shuffle."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*values), seq).alias("__v"), F.max(seq).alias(seq))
    return best.select(*keys, seq, "__v.*")


def merge_last(parts: list[DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """Union of sources where a later source overwrites an earlier one; within one, the greatest value wins."""
    both = None
    for i, p in enumerate(parts):
        part = p.select(*keys, *values, F.lit(i).alias("__p"))
        both = part if both is None else both.unionByName(part)
    best = both.groupBy(*keys).agg(F.max(F.struct("__p", *values)).alias("__v"))
    return best.select(*keys, *[F.col("__v")[v].alias(v) for v in values])


def majority(df: DataFrame, by: list[str], value: str, order: str, shown: str) -> DataFrame:
    """The commonest value of each group (a tie goes to the one seen first), how often, and its last ``shown``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("__first"), F.max_by(shown, order).alias(shown))
    top = counts.groupBy(*by).agg(F.max(F.struct("n", (-F.col("__first")).alias("__f"), value, shown)).alias("__m"))
    return top.select(*by, F.col("__m")[value].alias(value), F.col("__m")["n"].alias("n"), F.col("__m")[shown].alias(shown))


def only_one(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The value of groups that have exactly one row."""
    return df.groupBy(*by).agg(F.count("*").alias("__n"), F.first(value).alias(value)).where("__n = 1").drop("__n")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n rows a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def hash_quota(df: DataFrame, by: list[str], key: list[str], n: int, seed: int = 0) -> DataFrame:
    """A repeatable random sample of at most n rows of each group, chosen by a hash of the key."""
    return top_n(df, by, [F.xxhash64(*key, F.lit(seed)), *[F.col(k) for k in key]], n).drop("rank")


def replicate_to(df: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    """Cyclic resampling: each group gets exactly n rows, by repeating its rows in order (fewer are cut)."""
    w = Window.partitionBy(*by)
    numbered = df.select("*", (F.row_number().over(w.orderBy(order)) - 1).alias("__r"), F.count("*").over(w).alias("__n"))
    reps = F.when(F.col("__r") < n, F.floor((F.lit(n - 1) - F.col("__r")) / F.col("__n")) + 1).otherwise(0)
    return numbered.where(reps > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), (reps - 1).cast("int")))).drop("__r", "__n")


def coalesce_chain(*columns: Column, default) -> Column:
    """First value that isn't null along a chain of fallbacks."""
    return F.coalesce(*columns, F.lit(default))


def in_all(df: DataFrame, item: str, group: str, groups: list) -> DataFrame:
    """Items that occur in every one of the groups."""
    return df.where(F.col(group).isin(groups)).groupBy(item).agg(F.countDistinct(group).alias("__n")).where(F.col("__n") == len(set(groups))).select(item)


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of a table; each task keeps n at most."""
    return df.orderBy(*order).limit(n)


def expanded(left: DataFrame, right: DataFrame, key: str, value: str, slices: int = 64, chunk: int = 50_000) -> DataFrame:
    """Every row of ``left`` with every ``value`` of the rows of ``right`` under its key: an inner join for few keys with many rows on both sides.

    Its result may be far larger than both tables, which shuffles and files judge by their own bytes. So the rows of a key on the left are dealt out to
    ``slices``, and the values of a key on the right go to each slice as lists of at most ``chunk``: no task has a whole key, and nothing goes through the driver.
    """
    lists = right.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, F.floor(F.monotonically_increasing_id() / chunk).alias("__c")).agg(F.collect_list(value).alias("__v"))
    dealt = lists.select(key, "__v", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("__s"))
    rows = left.withColumn("__s", F.pmod(F.xxhash64(*left.columns), F.lit(slices)).cast("int")).repartition(4 * left.sparkSession.sparkContext.defaultParallelism, key, "__s")
    return rows.join(dealt.hint("merge"), [key, "__s"]).select(*left.columns, F.explode("__v").alias(value))
