"""The pipeline's stages on small planted documents."""

from __future__ import annotations

import random

import corpus_pipeline
from lodeflow.llm import queries, simhash


def rows():
    r = random.Random(1)
    vocab = [a + b + c for a in ("th", "re", "in", "or", "ed") for b in ("ea", "on", "er", "an") for c in ("st", "ly", "ing", "es")]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(20)) for i in range(5)]
    docs = [(i, text(120), "en", "s", 0) for i in range(40)]
    docs += [(100, docs[0][1], "en", "s", 0), (101, docs[1][1].replace(" ", "  ", 3), "en", "s", 0), (102, text(30) + " " + items[2][1] + " " + text(30), "en", "s", 0), (103, "12 34 !!", "en", "s", 0), (104, None, None, None, None), (105, "", "en", "s", 0)]
    return docs, items


def test_stages(spark, tmp_path):
    docs, items = rows()
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = now.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        path = f"{tmp_path}/out{k}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        assert k == len(corpus_pipeline.STAGES) - 1 or now.columns == columns
        seen[name] = {r.doc_id for r in now.collect()}
    assert seen["language_id"] == {d[0] for d in docs} - {103, 104, 105}
    assert seen["line_dedup"] == seen["language_id"]
    assert seen["near_dedup"] >= set(range(2, 40)) | {102} and len(seen["near_dedup"] & {0, 100}) >= 1
    assert seen["near_dedup"] - seen["decontamination"] == {102}
    assert seen["packing"] == seen["decontamination"]
    assert queries.queries()["pipeline"](spark, str(tmp_path)).count() >= len(seen["packing"])


def test_stages_keep_columns_of_any_name_and_take_empty_tables(spark, tmp_path):
    docs, items = rows()
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = ["__row", "_row", "__cut", "gone", "runs", "copy", "row", "root", "id", "r", "g", "n", "kept", "__new"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in extra)
    docs.append((106, docs[0][1] + "\n" + docs[5][1] + "\nown end", "en", "s", 0))
    df = spark.createDataFrame([(*d, *[f"{c}{d[0]}" for c in extra]) for d in docs], schema)
    df.write.parquet(f"{tmp_path}/wide")
    wide = spark.read.parquet(f"{tmp_path}/wide")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns, name
        got = out.collect()
        assert len(got) > 30 and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in extra), name
        assert stage(spark, wide.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, wide.limit(0), str(tmp_path)).collect() == []


def test_the_survivor_does_not_depend_on_the_layout(spark):
    docs, _ = rows()
    base = [(7, docs[3][1]), (3, docs[3][1]), (None, docs[4][1]), (2, docs[4][1]), (5, docs[3][1] + " one more"), (9, docs[9][1])]
    for order in (base, base[::-1]):
        for n in (1, 3):
            df = spark.createDataFrame(order, "doc_id bigint, text string").repartition(n)
            assert sorted((r["doc_id"] for r in simhash.one_of_each(df.checkpoint()).collect()), key=str) == [3, 9, None]


def test_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names[:10]] == [f"op{i}" for i in range(1, 11)] and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)
    assert len(corpus_pipeline.STAGES) == 5
