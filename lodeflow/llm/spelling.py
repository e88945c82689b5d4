"""Spelling variants: words within one edit of each other, found by a positional q-gram index with a count filter."""

from __future__ import annotations

import heapq
from collections import defaultdict
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import ascii_lower, map_rows, session, settle, small

#: Length of the grams of the index.
Q = 2
#: Words that one shard of the index holds at most before it is split; a shard whose window is one character can't exceed the alphabet.
SHARD = 256
#: Hot shards' keys that are broadcast at most (counted first).
SENT = 100_000
RUN = "[A-Za-z\\u00C0-\\u00FF]+"


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """The lower-cased run, without one code point where ``every`` divides crc32('id:run')."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n``: words of all whole texts with at least ``least_length`` code points and ``least_count`` occurrences; one shuffle of counts that were summed up in their tasks."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least_length)
    words = runs.select(damaged(F.col("run"), F.col("id"), every).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def windows(rows: DataFrame) -> DataFrame:
    """Each row (word, n, m, lo, hi) as two, for the halves of its window, with the shard's ``key``: the characters outside of the window.

    Of two words, the longer one of ``m`` characters, that differ by an edit at one place, the one window which holds the place leaves the
    rest of both as it is, counted from the start for what is before the window and from the end for what is behind it. So they share a shard at every level.
    """
    mid = F.expr("(lo + hi) div 2").cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    cut = rows.select("word", "n", "m", F.explode(halves).alias("w")).select("word", "n", "m", "w.lo", "w.hi").where("hi > lo")
    tail = F.col("m") - F.col("hi")
    key = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.lit("|"), F.substring("word", F.length("word") - tail + 1, tail))
    return cut.withColumn("key", key)


def one_edit(a: str, b: str) -> int:
    """Where ``a`` must be edited to become ``b`` (as long, or one shorter), or -1 if one edit isn't enough."""
    i = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        i += 1
    if len(a) == len(b):
        return i if i < len(a) and a[i + 1 :] == b[i + 1 :] else -1
    return i if len(a) == len(b) + 1 and a[i + 1 :] == b[i:] else -1


def shard_pairs(m: int, lo: int, hi: int, words: list[str]) -> list[tuple[int, int]]:
    """Numbers (a, b) of the near pairs of a shard whose edit lies in its window, a having ``m`` characters.

    The postings of the positional grams of the windows hold word numbers in order. A probe merges its grams' postings by a heap, under the
    limits of length (m or m - 1) and position (equal, for the shorter word also one less), and counts how often each word
    comes up. Two strings of w and at most w characters that are one edit apart share w - 1 of the grams between their borders, as an edit touches Q
    of them; a number below is no candidate. Candidates are verified in full.
    """
    w = hi - lo
    bound = w + 2 - Q + 1 - Q
    order = sorted(range(len(words)), key=lambda i: (len(words[i]), words[i]))
    if bound <= 0:
        found = [(a, b) for i, a in enumerate(order) if len(words[a]) == m for b in order[:i]]
        return [(a, b) for a, b in found if lo <= one_edit(words[a], words[b]) < hi]
    postings: dict[tuple[int, str, int], list[int]] = defaultdict(list)
    pairs = []
    for i, at in enumerate(order):
        word = words[at]
        body = f"^{word[lo : len(word) - (m - hi)]}$"
        grams = [body[p : p + Q] for p in range(len(body) - Q + 1)]
        if len(word) == m:
            lists = []
            for p, g in enumerate(grams):
                for key in ((m, g, p), (m - 1, g, p), (m - 1, g, p - 1)):
                    if key in postings:
                        lists.append(postings[key])
            for j, same in groupby(heapq.merge(*lists)):
                if sum(1 for _ in same) >= bound and lo <= one_edit(word, words[order[j]]) < hi:
                    pairs.append((at, order[j]))
        for p, g in enumerate(grams):
            postings[len(word), g, p].append(i)
    return pairs


def near_pairs(vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word, near, near_n``: both directions of all pairs of words that differ by exactly one inserted, deleted or replaced code point.

    ``vocabulary`` (word, n; words distinct) should be materialised. The index is sharded by all characters outside of a window, at first one half or the
    other of the word. Shards above ``shard`` words, told by grouped counts before any row moves, are split by halving their window
    as often as it takes; a window of one character leaves no more words than the alphabet has letters (and one), so no
    shard grows with the input, and none is capped.
    """
    session(vocabulary)
    lengths = F.explode(F.array(F.length("word"), F.length("word") + 1))
    level = windows(vocabulary.select("word", "n", lengths.alias("m")).selectExpr("word", "n", "m", "0 as lo", "m as hi"))
    shards = []
    while True:
        hot = settle(level.where("hi - lo > 1").groupBy("m", "key").agg(F.count("*").alias("members")).where(F.col("members") > shard).select("m", "key"))
        if small(hot, 0):
            shards.append(level)
            break
        sent = F.broadcast(hot) if small(hot, SENT) else hot
        shards.append(level.join(sent, ["m", "key"], "left_anti"))
        level = settle(windows(level.join(sent, ["m", "key"], "left_semi")))
    rows = reduce(DataFrame.unionByName, shards)
    members = F.collect_list(F.struct("word", "n"))
    packed = rows.groupBy("m", "lo", "hi", "key").agg(members.alias("members"), F.max(F.length("word")).alias("longest")).where((F.size("members") > 1) & (F.col("longest") == F.col("m")))
    packed = packed.select("m", "lo", "hi", F.col("members.word").alias("words"), F.col("members.n").alias("ns"))

    def make():
        def run(ms, los, his, all_words, all_ns):
            out = []
            for m, lo, hi, words, ns in zip(ms, los, his, all_words, all_ns, strict=True):
                for a, b in shard_pairs(m, lo, hi, words):
                    out += [(words[a], words[b], ns[b]), (words[b], words[a], ns[a])]
            return [list(c) for c in zip(*out, strict=True)] if out else [[], [], []]

        return run

    return map_rows(packed, ["m", "lo", "hi", "words", "ns"], "word string, near string, near_n bigint", make)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each (word, form): the end of the chain of forms, by jumping twice as far each round.

    A form has at least twice its word's number, so chains have no cycle and at most log2 of the largest number of links; the rounds are log2 of that.
    """
    ends = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(ends.join(further, "root", "left"))
        if small(moved.where("next is not null"), 0):
            return ends
        ends = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2, shard: int = SHARD) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every frequent word of the corpus, with the commoner word that it may be a spelling of.

    Words are maximal runs of letters of whole texts, A-Z lower-cased; where ``every`` divides crc32('id:run'), a code point of the run is left out. A word's near
    words differ by exactly one edit; its form is the near word of largest ``n`` (ties: the smallest in code-point order)
    if that is at least ``ratio`` times its own, and its root the end of the chain of forms.
    Defined results: null and empty texts have no words; a null id counts as an empty one; repeated rows count each; an
    empty table gives no rows; texts and words of any length are read whole; other columns, whatever their names, are not read.
    """
    session(docs)
    vocabulary = settle(word_counts(docs, id_col, text_col, every, least_length, least_count))
    near = near_pairs(vocabulary, shard).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    judged = settle(vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best.near")).alias("form"), (-F.col("best.order")).alias("best_n")))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
