import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodeflow.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string"


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_counts(rows, every=97, least_length=5, least_count=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def plain_variants(counts, ratio=2):
    """Every pair of words compared."""
    found, form = {}, {}
    for w, n in counts.items():
        others = [(-counts[o], o) for o in counts if o != w and near(w, o)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        found[w] = [n, len(others), -best[0] if form[w] else None]
    rows = []
    for w, (n, k, m) in found.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, m))
    return sorted(rows)


def check(spark, rows, **more):
    kept = {k: v for k, v in more.items() if k in ("every", "least_length", "least_count")}
    got = sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(rows, SCHEMA), **more).collect())
    assert got == plain_variants(plain_counts(rows, **kept))
    return got


def test_edges(spark):
    assert check(spark, []) == []
    assert check(spark, [(1, None), (None, ""), (2, "a1b2 ... \x00")]) == []
    rows = [(1, "Straße straße STRASSE strasse strasse"), (None, "strasse strasse Études études Études Études"), (3, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaa"), (3, "aaaaa aaaaa"), (3, "aaaaa aaaaa"), (4, "×÷×÷× " * 3 + "xıyİz")]
    assert check(spark, rows, every=10**9)


def test_ties_chains_and_repeats(spark):
    counts = {"tests": 3, "testz": 6, "teztz": 12, "leztz": 24, "abcde": 3, "abcdf": 6, "abcda": 6, "bcdea": 5, "abcdea": 11, "lonely": 9}
    rows = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    got = {r[0]: r for r in check(spark, rows, every=10**9)}
    assert got["tests"][2] == "leztz" and got["abcde"][1] == "abcdea" and got["lonely"][1:3] == (None, "lonely")
    assert check(spark, rows * 2, every=3)


@pytest.mark.parametrize("shard", [1, 4, 256])
def test_hot_shards_are_split(spark, shard):
    """A third and more of the words share their first or last half."""
    words = [f"common{a}{b}" for a in "abcdefgh" for b in "abcdefgh"] + [f"{a}{b}ending" for a in "abcdef" for b in "abcdef"] + [f"{a}bcd{b}" for a in "vwxyz" for b in "vwxyz"] + ["commona", "endings", "x" * 40, "x" * 41, "x" * 39 + "y"]
    rows = [(i, " ".join([w] * (3 + i % 7))) for i, w in enumerate(words)]
    assert check(spark, rows, every=10**9, shard=shard)


def test_long_texts_and_clashing_columns(spark):
    rows = [(1, "spelling speling " * 50_000), (2, "q" * 200_000 + " " + ("q" * 200_000 + " ") * 2 + ("q" * 199_999 + " ") * 9)]
    assert len(check(spark, rows)) >= 4
    df = spark.createDataFrame([(1, "words words words", "x", 1, 2)], "doc_id bigint, text string, word string, n int, id int")
    assert [r["word"] for r in spelling.variants(df).collect()] == ["words"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abABé ", max_size=80), max_size=12))
def test_random(spark, texts):
    check(spark, list(enumerate(texts)), every=3, least_length=2, least_count=1, shard=3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=3, max_size=6), max_size=30, unique=True))
def test_shard_pairs_are_all_pairs_of_the_window(words):
    for m in {len(w) for w in words}:
        held = [w for w in words if len(w) in (m, m - 1)]
        got = sorted(tuple(sorted((held[a], held[b]))) for a, b in spelling.shard_pairs(m, 0, m, held))
        assert got == sorted(tuple(sorted((x, y))) for i, x in enumerate(held) for y in held[:i] if near(x, y) and max(len(x), len(y)) == m)
