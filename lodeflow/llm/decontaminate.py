"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import free_name, map_rows, session, settle, small

#: Words of a window.
WINDOW = 8
#: Characters of the windows that one automaton, and one broadcast, holds at most (about 50 bytes of trie each).
BLOCK_CHARS = 4_000_000

#: Bytes of UTF-8 text: A-Z to lower case; digits, letters and all non-ASCII bytes stay; the rest separates words.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(item_words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Every run of ``size`` words; of a shorter item its whole sequence; of an empty one nothing."""
    n = len(item_words)
    if not n:
        return []
    return [b" ".join(item_words[i : i + size]) for i in range(max(1, n - size + 1))]


class Scanner:
    """Aho-Corasick automaton over windows; finds every occurrence, overlapping ones too, in one pass."""

    def __init__(self, found: dict[bytes, list[str]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for key, items in found.items():
            # one character for each UTF-8 byte; spaces at both ends keep matches on word boundaries
            self.automaton.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, len(key) + 1, items))
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def hits(self, toks: list[bytes], size: int = WINDOW) -> tuple[list[tuple[int, int]], set[str], set[str]]:
        """Word spans (first, end) of matches, the items that they belong to, and those with a match of ``size`` words."""
        spans, items, long_, starts = [], set(), set(), None
        if not toks or not self.any:
            return spans, items, long_
        line = f" {b' '.join(toks).decode('latin-1')} "
        for end, (n, back, ids) in self.automaton.iter(line):
            if starts is None:
                starts = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
            first = int(np.searchsorted(starts, end - back))
            spans.append((first, first + n))
            items.update(ids)
            if n >= size:
                long_.update(ids)
        return spans, items, long_


_cache: dict = {}


def _scanner(block: list, key: str) -> Scanner:
    """One automaton per worker process: blocks are scanned one after the other, never by one task."""
    if key not in _cache:
        _cache.clear()
        _cache[key] = Scanner(dict(block))
    return _cache[key]


def window_blocks(benchmark: DataFrame, size: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[bytes, list[str]]]]:
    """Windows of all items with the ids that have them, in blocks of bounded size; one empty block if there are none.

    The benchmark is a stated query set. Its windows are made, grouped and sorted by Spark and come to the driver
    block by block, so neither it nor what is broadcast at once holds the whole.
    """

    def make():
        def run(ids, texts):
            out = [[], []]
            for i, t in zip(ids, texts, strict=True):
                for w in dict.fromkeys(windows(words(t), size)):
                    out[0].append(w.decode("utf-8", "surrogatepass"))
                    out[1].append(i)
            return out

        return run

    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    found = settle(map_rows(items, ["item", "text"], "w string, item string", make).groupBy("w").agg(F.array_sort(F.collect_set("item")).alias("own")))
    block, chars, some = [], 0, False
    for w, own in found.orderBy("w").toLocalIterator():
        key = w.encode("utf-8", "surrogatepass")
        if chars + len(key) > block_chars and block:
            yield block
            block, chars = [], 0
        block.append((key, own))
        chars, some = chars + len(key), True
    if block or not some:
        yield block


def covered(spans: list[tuple[int, int]], n: int) -> int:
    """Words inside any span."""
    if not spans:
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    a = np.asarray(spans)
    np.add.at(edge, a[:, 0], 1)
    np.add.at(edge, a[:, 1], -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Merged word spans as code-point offsets (end exclusive) into the original text."""
    if not spans:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    word = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8) != 32
    edge = np.diff(np.concatenate(([0], word.astype(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(int(points[first[a]]), int(points[last[b - 1]])) for a, b in out]


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_items: int = 2, id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Occurrences of benchmark windows in each document.

    Returns ``id_col, n_words, n_hit, n_items, items_sha256, contaminated, n_long_items, spans``; spans are
    code-point offsets into the original text, merged where they touch, and n_long_items counts the
    items hit by a window of full size. Benchmarks up to ``block_chars`` characters are one block, scanned for in
    one map over the documents without a shuffle; larger ones are scanned for block by block, and the hits joined.
    What is broadcast for a block is bounded by its size.
    Defined results: null and empty texts have no words and no hits; items with null id or no words are
    ignored; repeated items count once; repeated documents give a row each; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), "text")
    hits, n = _all_hits(numbered.select("row", "text"), benchmark, size, block_chars)
    final = f"`{id_col}` {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, n_long_items bigint, spans array<struct<start:int,end:int>>"
    if n == 1:
        block, sent, key = hits

        def make():
            scanner = _scanner(sent.value, key)

            def run(ids, texts):
                return _columns([_sums(i, t, toks, *scanner.hits(toks, size), min_items) for i, t in zip(ids, texts, strict=True) for toks in [words(t)]])

            return run

        return map_rows(docs, [id_col, "text"], final, make)

    def total():
        def run(ids, texts, spans, items, longs):
            return _columns([_sums(i, t, words(t), [(x["start"], x["end"]) for x in s or []], set(own or []), set(ln or []), min_items) for i, t, s, own, ln in zip(ids, texts, spans, items, longs, strict=True)])

        return run

    return map_rows(numbered.join(hits, "row", "left"), [id_col, "text", "spans", "items", "longs"], final, total)


def _columns(rows: list[tuple]) -> list[list]:
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(8)]


def _sums(doc_id, text: str | None, toks: list[bytes], spans: list, items: set[str], longs: set[str], min_items: int) -> tuple:
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return doc_id, len(toks), covered(spans, len(toks)), len(items), digest, len(items) >= min_items, len(longs), [{"start": a, "end": b} for a, b in original_offsets(text or "", spans)]


def _all_hits(rows: DataFrame, benchmark: DataFrame, size: int, block_chars: int):
    """((block, its broadcast, its key), 1) where one block is all; else the rows' hits over all blocks, settled, and how many blocks.

    Further blocks are scanned one after the other, and only rows with hits are kept of each scan.
    """
    spark, parts, n, last = session(rows), [], 0, None
    for block in window_blocks(benchmark, size, block_chars):
        key = hashlib.md5(repr(block).encode()).hexdigest()
        if last is not None:
            parts.append(_block_hits(rows, last, size))
        last, n = (block, spark.sparkContext.broadcast(block), key), n + 1
    if n == 1:
        return last, 1
    parts.append(_block_hits(rows, last, size))
    every = reduce(DataFrame.unionByName, parts)
    flat = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "longs")]
    return settle(every.groupBy("row").agg(*flat)), n


def _block_hits(rows: DataFrame, block: tuple, size: int) -> DataFrame:
    _, sent, key = block

    def make():
        scanner = _scanner(sent.value, key)

        def run(ids, texts):
            out = [[] for _ in range(4)]
            for i, t in zip(ids, texts, strict=True):
                spans, items, longs = scanner.hits(words(t), size)
                if spans:
                    for o, v in zip(out, (i, [{"start": a, "end": b} for a, b in spans], sorted(items), sorted(longs)), strict=True):
                        o.append(v)
            return out

        return run

    return settle(map_rows(rows, ["row", "text"], "row bigint, spans array<struct<start:int,end:int>>, items array<string>, longs array<string>", make))


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; columns unchanged.

    A document goes if it holds windows of two items, or of one item at least ``size`` words long:
    a short item's few words may be ordinary prose, a full window is a quotation. One block is scanned in place,
    without a shuffle; with several, the rows to go are joined. Edge rows as above: null and empty texts stay, and so
    does everything if the benchmark is empty; ``docs`` must be a repeatable plan such as a Parquet read.
    """
    row = free_name(docs, "__row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    hits, n = _all_hits(numbered.select(F.col(row).alias("row"), "text"), benchmark, size, block_chars)
    if n > 1:
        gone = settle(hits.where("size(longs) > 0 or size(array_distinct(items)) >= 2").select(F.col("row").alias(row)))
        return numbered.join(F.broadcast(gone) if small(gone, 1_000_000) else gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    block, sent, key = hits
    if not block:
        return docs

    @F.pandas_udf("boolean")
    def goes(texts: pd.Series) -> pd.Series:
        scanner = _scanner(sent.value, key)
        found = (scanner.hits(words(t), size) for t in texts)
        return pd.Series([bool(longs) or len(items) >= 2 for _, items, longs in found], dtype=bool)

    return docs.where(~goes("text"))
