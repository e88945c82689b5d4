import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lodeflow.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"


def plain_form(doc_id, text, seed=42, moved=50, suffix_first=80):
    """(n, form, prefix characters, middle characters, output), one document after the other."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    g = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or g[2] % 100 >= moved:
        return n, "plain", None, None, text
    a, b = sorted((g[0] % (n + 1), g[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if g[3] % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return fim.restore(fim.fill_in_middle(df, **more)).collect()


def same(got, rows, **more):
    want = sorted(((i, *plain_form(i, t, **more), t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_edges(spark):
    texts = [None, "", " ", "a", " a", "a ", "a\x00b c", "x y  z　w", "a<P", "P> <S", "a <M> b", "퟿ \U0001f600 é", "\x0b\x0c\r\n\t t \x1c\x85", "<S", "<<P <<S <", "it's \\1 %s {x}"]
    rows = [(i, t) for i in range(12) for t in texts] + [(None, "a b c d"), (None, None), (-5, "one two three"), (2**63 - 1, "one two three"), (3, "again"), (3, "again")]
    for more in ({}, {"moved": 100, "suffix_first": 0}, {"moved": 100, "suffix_first": 100, "seed": 7}, {"moved": 0}):
        same(run(spark, rows, **more), rows, **more)


def test_long_texts_and_many_rows(spark):
    rows = [(i, "word " * 600_000 + str(i)) for i in range(4)] + [(i, f"a b {i} c") for i in range(1000)] + [(7, "x" * 3_000_000), (8, "\n" * 1_000_000)]
    same(run(spark, rows, moved=100), rows, moved=100)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b", "x", 3, 4)], "doc_id bigint, text string, output string, id int, n int")
    assert [tuple(r) for r in fim.digest(fim.fill_in_middle(df)).select("doc_id", "n").collect()] == [(1, 2)]
    other = spark.createDataFrame([(5, "a b c")], "key bigint, body string")
    assert fim.restore(fim.fill_in_middle(other, "key", "body"), "key").first()["restored"] == "a b c"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\x0b\x1f aé<>PSM0\x00"), max_size=30), max_size=60))
def test_random_texts(spark, texts):
    rows = list(enumerate(texts))
    same(run(spark, rows, moved=100, suffix_first=50), rows, moved=100, suffix_first=50)
