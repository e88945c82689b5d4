"""Pattern tables against plain re, and lookups by files' ranges."""

import random
import re

from pyspark.sql import functions as F

from lodeflow.operators import patterns
from lodeflow.sources import reference, sinks

FRONT, BACK = r"([^0-9a-zA-Z])", r"(?=[^0-9a-zA-Z])"
LISTS = {
    "one": [rf"{FRONT}([cg]\.[0-9]+(del|ins|dup|delins)[ACGT]*){BACK}", rf"{FRONT}(IVS[0-9]+[+-][0-9]+){BACK}", rf"{FRONT}((Ala|Gly)?[0-9]+(fs|X)?){BACK}"],
    "two": [rf"{FRONT}(p\.[A-Z][0-9]+[A-Z]){BACK}", rf"(?i){FRONT}(RS[0-9]+){BACK}", r"whole [0-9]+"],
}


def test_needed_literals():
    need = patterns.needed_literals
    assert need("abc") == ["abc"] and need("a(bc|def)+g?") in (["bc", "def"], ["a"]) and need("[ab]x*") == [] and need("(?i)abc") == [] and need("x(?=yy)[0-9]zz") == ["zz"] and need("(abc)?d") == ["d"]
    rng = random.Random(1)
    parts = ["ab", "c", "[xy]", "(?:de|f)", "(g)?", "h*", "(?:ij){2}", "k+", "(?=.)", "."]
    for _ in range(300):
        pattern = "".join(rng.choices(parts, k=rng.randint(1, 5)))
        needed = need(pattern)
        for _ in range(20):
            text = "".join(rng.choices(["ab", "c", "x", "de", "f", "g", "h", "ij", "ijij", "k"], k=8))
            m = re.search(pattern, text)
            assert not m or not needed or any(x in text for x in needed), (pattern, needed, text)


def test_scan_against_plain_patterns(spark, tmp_path):
    rng = random.Random(2)
    words = ["c.5delA", "g.12dup", "IVS2+1", "p.R5Q", "rs77", "RS9", "Ala12fs", "12", "whole 3", "and", "c.5", "(c.9delins)", "é"]
    texts = [(i, " " + " ".join(rng.choices(words, k=rng.randint(0, 12))) + rng.choice([" ", ".", ""])) for i in range(120)] + [(500, None), (501, ""), (502, " rs77 " * 4000)]
    for kind, lines in LISTS.items():
        (tmp_path / kind).write_text("\n".join(lines))
    lists = {k: spark.read.text(f"{tmp_path}/{k}").withColumn("place", F.monotonically_increasing_id().cast("int")) for k in LISTS}
    table = patterns.pattern_table(lists, "value")
    df = spark.createDataFrame(texts, "id int, text string")
    want = []
    for i, t in texts:
        taken = []
        for kind, lines in LISTS.items():
            for place, p in enumerate(lines):
                for m in re.finditer(p, t or ""):
                    g = 2 if re.compile(p).groups >= 2 else 0
                    a, b = m.span(g)
                    kept = not any(x < b and a < y for x, y in taken)
                    taken += [(a, b)] * kept
                    want.append((i, kind, place, a, b, m[g], kept))
    got = [tuple(r) for r in patterns.scan(df, table, ["id"], "text").collect()]
    assert sorted(got) == sorted(want) and len(want) > 400
    assert patterns.scan(df, table.limit(0), ["id"], "text").count() == 0 and patterns.scan(df.limit(0), table, ["id"], "text").count() == 0
    assert reference.line_list(spark, f"{tmp_path}/one").count() == 3


def test_a_lookup_reads_the_files_that_hold_it(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["1", "2", "X"]), rng.randint(1, 5000), rng.choice("ACGT"), i) for i in range(4000)] + [(None, 5, "A", -1)]
    key = ["chrom", "pos", "ref"]
    df = spark.createDataFrame(rows, "chrom string, pos int, ref string, id int")
    path = f"{tmp_path}/index"
    sinks.index_load(df, path, key, 12)
    assert spark.read.parquet(path).count() == len(rows)
    for wanted in (rows[:1], rows[5:9], [("9", 1, "A", 0)]):
        asked = spark.createDataFrame([r[:3] for r in wanted], "chrom string, pos int, ref string")
        found = sinks.index_lookup(asked, path, key)
        assert sorted(r["id"] for r in found.collect()) == sorted(r[3] for r in rows if r[:3] in {w[:3] for w in wanted})
        assert len(found.inputFiles() if wanted[0][0] != "9" else []) <= len(wanted) + 1
    many = df.select(*key).where("chrom = 'X'")
    assert sinks.index_lookup(many, path, key, few=10).count() == sum(r[0] == "X" for r in rows)
