"""Names in doubt: the work follows mentions and genes, not their product."""

import time

from pyspark.sql import functions as F

from lodeflow.operators import dictionary

GENES, MENTIONS = 4000, 8000


def test_doubt_is_settled_once_a_block_and_name(spark):
    start = time.perf_counter()
    gene = spark.range(1, GENES + 1).select(F.col("id").cast("int").alias("gene_id"))
    names = gene.select(F.lit("synonym").alias("kind"), F.lit("foo").alias("name_key"), "gene_id")
    word = lambda k: F.when(F.col("gene_id") % 10 < k, F.concat(F.lit("w"), F.lit(k).cast("string"))).otherwise(F.concat(F.lit("u"), F.col("gene_id").cast("string")))
    tokens = gene.select("gene_id", F.explode(F.array(F.lit("all"), *[word(k) for k in range(1, 5)])).alias("token"))
    mentions = spark.range(MENTIONS).select(F.floor(F.col("id") / 100).cast("int").alias("block"), (F.col("id") * 30).cast("int").alias("start"), (F.col("id") * 30 + 3).cast("int").alias("end"), F.lit("foo").alias("mention"))
    articles = mentions.select("block", F.explode(F.array(F.lit("all"), F.lit("w1"), F.lit("w2"), F.lit("w3"), F.lit("w4"))).alias("token")).distinct()
    got = dictionary.resolve_names(mentions, names, tokens, tokens.select("gene_id", F.lit("n").alias("name"), "token"), articles)
    row = got.where("start = 0").first()
    assert row.options == list(range(10, GENES + 1, 10)) and (row.gene_id, row.step) == (10, 9)
    assert got.drop("options").distinct().count() == MENTIONS and time.perf_counter() - start < 90


def test_no_table_goes_to_the_driver(spark, monkeypatch):
    """Estimates of the tables' sizes go by their files, so no join may broadcast a side because it seems small."""
    from __spark_entry__ import queries

    plans, settle = [], dictionary.settle
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(dictionary, "settle", lambda df: plans.append(plan(df)) or settle(df))
    plans.append(plan(queries()["g17_name_cascade"](spark, "/root/testdata/sf0.001")))
    assert len(plans) > 5 and sum("Join" in p for p in plans) > 5 and not any("Broadcast" in p for p in plans)
