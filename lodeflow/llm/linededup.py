"""Line dedup by content-defined chunks of lines, and by passages wherever they stand."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import free_name, map_rows, settle, small
from lodeflow.llm.rolling import Words, least_places, scramble

#: Lines that the rolling hash looks back over, and the mean number of lines in a chunk.
LOOK_BACK = 2
MEAN_LINES = 3
#: Words of a passage that goes wherever it stands, in a line or over parts of lines, if it occurred before.
PASSAGE = 51
#: Seeds are cut at the least hash of three words in each run of so many: a passage has two cuts of its own, always.
SEED_RUN = (PASSAGE - 2) // 2
#: Rows of one or a few longs each that may be broadcast.
BROADCAST_ROWS = 2_000_000
#: Characters of texts that are hashed together; a longer text is handled alone.
TOGETHER = 1 << 21
_BASE, _MIX, _MASK = 0x100000001B3, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def chunks(text: str | None, look_back: int = LOOK_BACK, mean: int = MEAN_LINES) -> list[tuple[int, int, bool]]:
    """(first line, end line, eligible) of the chunks of a text's lines.

    A boundary follows a line if the rolling hash over it and the lines before it (``look_back`` in all) is zero
    modulo ``mean``, so boundaries depend on a few lines' content only and find themselves again after any shift.
    Eligible for removal are chunks of two lines or more with a word in them.
    """
    if not text:
        return []
    lines = text.split("\n")
    hashes = [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 7) for x in lines]
    out, start, last = [], 0, len(lines) - 1
    for i in range(len(lines)):
        roll = 0
        for h in hashes[max(0, i - look_back + 1) : i + 1]:
            roll = (roll * _BASE + h) & _MASK
        roll = ((roll ^ (roll >> 29)) * _MIX) & _MASK
        if i == last or (roll >> 32) % mean == 0:
            out.append((start, i + 1, i > start and any(x.strip() for x in lines[start : i + 1])))
            start = i + 1
    return out


def _bodies(text: str | None) -> list[tuple[int, bytes]]:
    """(number, bytes) of the chunks that may go."""
    if not text or "\n" not in text:
        return []
    lines = text.split("\n")
    return [(k, "\n".join(lines[a:b]).encode("utf-8", "surrogatepass")) for k, (a, b, ok) in enumerate(chunks(text)) if ok]


def _hash(body: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(body)
    return _signed(d >> 64), _signed(d & _MASK)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class Seeds:
    """Seeds of the words of several texts: the stretches between neighbouring cuts of one text.

    Cuts are the leftmost least hashes of three words in every run of ``SEED_RUN`` (winnowing), a seed goes from cut
    to cut. A passage's first and last run of ``SEED_RUN`` give two cuts, and runs over its edges give none between
    them; so wherever a passage stands, it has the same seeds between these two, one at least.
    """

    def __init__(self, words: Words):
        self.words = words
        n = len(words.start)
        text = np.repeat(np.arange(len(words.count)), words.count)
        left = np.repeat(words.first[1:], words.count) - np.arange(n)
        if n < PASSAGE:
            self.place = self.cut = np.empty(0, dtype=np.int64)
            self.hash, self.text = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
            self.passages = np.empty(0, dtype=np.int64)
            return
        least = least_places(words.runs(3), SEED_RUN)
        long_ = np.repeat(words.count >= PASSAGE, words.count)
        inside = np.flatnonzero((left[: len(least)] >= SEED_RUN + 2) & long_[: len(least)])
        #: For each word from which a run of words starts, the number of its cut.
        self.place = np.full(len(least), -1)
        least = least[inside]  # never falls
        new = np.concatenate(([True], least[1:] != least[:-1])) if len(least) else np.empty(0, dtype=bool)
        self.cut, self.place[inside] = least[new], np.cumsum(new) - 1
        a, b = self.cut[:-1], self.cut[1:]
        self.hash = scramble(words.span(a, b + 2), 57)
        #: Text of each seed; -1 where two cuts are of unlike texts.
        self.text = np.where(text[a] == text[b], text[a], -1)
        #: First words of all runs of PASSAGE words within a text.
        self.passages = np.flatnonzero(left >= PASSAGE)

    def of_texts(self) -> list[np.ndarray]:
        """Hashes of each text's seeds, each at most twice."""
        there = self.text >= 0
        h, t = self.hash[there], self.text[there]
        order = np.lexsort((h, t))
        h, t = h[order], t[order]
        keep = np.ones(len(h), dtype=bool)
        keep[2:] = (h[2:] != h[:-2]) | (t[2:] != t[:-2])
        h, t = h[keep], t[keep]
        return np.split(h.view(np.int64), np.searchsorted(t, np.arange(1, len(self.words.count))))

    def candidates(self, wanted: np.ndarray) -> np.ndarray:
        """First words of the runs of PASSAGE words whose seeds are all wanted."""
        if not len(self.passages) or not len(self.hash):
            return np.empty(0, dtype=np.int64)
        missing = np.concatenate(([0], np.cumsum(~np.isin(self.hash, wanted))))
        p = self.passages
        return p[missing[self.place[p]] == missing[self.place[p + PASSAGE - 2 - SEED_RUN]]]


def _together(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are hashed together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > TOGETHER:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def repeats(rows: DataFrame, id_col: str, text: str = "text", order: str | None = None) -> DataFrame:
    """(id_col, gone: array of chunk numbers, runs: array of word ranges, copy): what occurred before.

    ``gone`` are chunks of lines whose bytes occurred before, ``runs`` the words (a to b - 1) inside any run of ``PASSAGE`` words that
    did, by the order of ``order``, then ``id_col``, then the place in the text. Rows whose whole text equals an
    earlier one's (128 bits and length) have only ``copy``. ``id_col`` must be a unique long.

    One pass over the texts gives hashes of whole texts, of chunks and of seeds; they alone are shuffled, with partial
    counts. A second pass over those texts that hold a repeated hash gives the chunks' bytes, for the comparison, and
    the runs of words all of whose seeds are repeated, with 128 bits each. A chunk or passage that a third of all
    texts hold is one row in the counts, and adaptive execution splits its side of the joins. What is broadcast is counted first.
    """
    source = rows.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kinds = "r bigint, runs struct<h1:array<bigint>,h2:array<bigint>,at:array<int>,own:array<int>>, chunks array<struct<h1:bigint,h2:bigint,at:int,own:boolean,body:string>>"

    def hashes():
        def run(ids, texts):
            t1, t2, units = [], [], []
            for t in texts:
                a, b = _hash(t.encode("utf-8", "surrogatepass")) if t else (None, None)
                t1.append(a)
                t2.append(b)
            for a, b in _together(texts):
                for t, found in zip(texts[a:b], Seeds(Words(texts[a:b])).of_texts(), strict=True):
                    own = [_signed(xxhash.xxh3_64_intdigest(x)) for _, x in _bodies(t)]
                    units.append(np.concatenate((found, np.array(own, dtype=np.int64))) if own else found)
            return [ids, t1, t2, [len(t) if t else 0 for t in texts], units]

        return run

    def places():
        def run(ranks, texts, wanted):
            runs, found = [], []
            for a, b in _together(texts):
                want = np.unique(np.concatenate([np.array(w, dtype=np.int64) for w in wanted[a:b]]))
                known = set(want.tolist())
                found += [_known_chunks(t, known) for t in texts[a:b]]
                runs += _known_runs(texts[a:b], want.view(np.uint64))
            return [ranks, runs, found]

        return run

    hashed = settle(map_rows(source, ["id", "text"], "id bigint, t1 bigint, t2 bigint, n bigint, units array<bigint>", hashes).where("size(units) > 0"))
    ranks = _ranks(rows, id_col, order)
    whole = ["t1", "t2", "n"]
    equal = hashed.select("id", *whole)
    doubled = settle(equal.groupBy(*whole).agg(F.count("*").alias("c")).where("c > 1").select(*whole))
    members = settle(_join(equal, doubled, whole).join(ranks, "id").select("id", "r", *whole))
    copies = settle(members.join(members.groupBy(*whole).agg(F.min("r").alias("m")), whole).where("r > m").select("id"))
    units = _join(hashed.select("id", "units"), copies, ["id"], "left_anti").select("id", F.explode("units").alias("h"))
    again = settle(units.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"))
    wanted = settle(_join(units, again, ["h"]).groupBy("id").agg(F.collect_set("h").alias("wanted")).join(ranks, "id"))
    held = _join(source, wanted.select("id"), ["id"], "left_semi").join(wanted, "id")
    found = settle(map_rows(held, ["r", "text", "wanted"], kinds, places))
    key = ["h1", "h2"]

    def repeated(own: DataFrame) -> DataFrame:
        """Rows whose hash several texts have, with the first one's rank."""
        first = own.groupBy(*key).agg(F.min("r").alias("m"), F.max("r").alias("x")).where("m < x").select(*key, "m")
        return own.join(first, key)

    chunk = found.select("r", F.explode("chunks").alias("c")).select("r", "c.*")
    again = repeated(chunk.where("not own").drop("own"))
    bodies = again.where("r = m").select(*key, F.col("body").alias("first_body"))
    run = found.select("r", F.explode(F.arrays_zip("runs.h1", "runs.h2", "runs.at")).alias("c")).select("r", "c.*")
    later = [(again.where("r > m").join(bodies, key).where("body = first_body"), 0), (chunk.where("own"), 0), (repeated(run).where("r > m"), 1), (found.select("r", F.explode("runs.own").alias("at")), 1)]
    spots = reduce(DataFrame.unionByName, [x.select("r", F.lit(k).alias("kind"), "at") for x, k in later])
    gone = spots.groupBy("r").agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("at")))).alias(c) for k, c in enumerate(("gone", "at"))])
    starts = F.expr(f"filter(at, (x, i) -> i = 0 or x > at[i - 1] + {PASSAGE})")
    ends = F.expr(f"transform(filter(at, (x, i) -> i = size(at) - 1 or at[i + 1] > x + {PASSAGE}), x -> x + {PASSAGE})")
    gone = gone.select("r", "gone", starts.alias("a"), ends.alias("b")).select("r", "gone", F.arrays_zip("a", "b").alias("runs"))
    named = gone.join(wanted.select("id", "r"), "r").select(F.col("id").alias(id_col), "gone", "runs", F.lit(False).alias("copy"))
    return named.unionByName(copies.select(F.col("id").alias(id_col), F.lit(True).alias("copy")), allowMissingColumns=True)


def _ranks(rows: DataFrame, id_col: str, order: str | None) -> DataFrame:
    """(id, r): unique longs that rise with ``order``, then ``id_col``. Only these two columns are sorted, by ranges."""
    ids = rows.select(F.col(id_col).alias("id"), *([F.col(order).alias("o")] if order else []))
    if not order:
        return ids.withColumn("r", F.col("id"))
    return settle(ids.repartitionByRange("o", "id").sortWithinPartitions("o", "id").select("id", F.monotonically_increasing_id().alias("r")))


def _known_chunks(text: str, known: set[int]) -> list[dict]:
    """Chunks with a known hash; ``own``: one of equal bytes stands before it in the text."""
    out, seen = [], set()
    for k, body in _bodies(text):
        if _signed(xxhash.xxh3_64_intdigest(body)) in known:
            own = body in seen
            seen.add(body)
            out.append(dict(zip(("h1", "h2", "at", "own", "body"), (*_hash(body), k, own, None if own else body.decode("utf-8", "surrogatepass")), strict=True)))
    return out


def _known_runs(texts: list[str], wanted: np.ndarray) -> list[dict]:
    """Of each text, the runs of words whose seeds are all wanted; ``own``: those that stand before in the text, without overlap."""
    words = Words(texts)
    at = Seeds(words).candidates(wanted)
    last = at + PASSAGE - 1
    h1, h2 = words.span(at, last).view(np.int64), words.span(at, last, 1).view(np.int64)
    owner = np.searchsorted(words.first, at, side="right") - 1
    order = np.lexsort((at, h1, owner))
    h1, h2, at, owner = h1[order], h2[order], at[order], owner[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    own = at >= at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + PASSAGE
    place = at - words.first[owner]
    out = []
    for a, b in zip((cut := np.searchsorted(owner, np.arange(len(texts) + 1))), cut[1:], strict=False):
        free = ~own[a:b]
        out.append({"h1": h1[a:b][free], "h2": h2[a:b][free], "at": place[a:b][free], "own": place[a:b][own[a:b]]})
    return out


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a settled table of narrow rows, which is broadcast only if counted to be small."""
    return left.join(F.broadcast(right) if small(right, BROADCAST_ROWS) else right, on, how)


def strip(text: str | None, gone: list[int] | None, runs: list[tuple[int, int]] | None, copy: bool = False) -> str | None:
    """A text without the chunks of these numbers and the words of these ranges; lines that lose all words go too.

    Of a copy, all chunks that may go are gone, and all words if they are enough for a passage.
    """
    if not text:
        return text
    if copy:
        gone, n = [k for k, x in enumerate(chunks(text)) if x[2]], len(text.split())
        runs = [(0, n)] if n >= PASSAGE else []
    if not gone and not runs:
        return text
    return "\n".join(_without(text, set(gone or []), runs or []))


def _without(text: str, gone: set[int], runs: list[tuple[int, int]]) -> Iterator[str]:
    """The lines of a text that stay, without the words of the ranges."""
    dropped = {k for n, (a, b, _) in enumerate(chunks(text)) if n in gone for k in range(a, b)} if gone else set()
    word, at = 0, 0
    for k, line in enumerate(text.split("\n")):
        n = len(line.split())
        while at < len(runs) and runs[at][1] <= word:
            at += 1
        if k not in dropped:
            if at == len(runs) or runs[at][0] >= word + n:
                yield line
            elif not (runs[at][0] <= word and runs[at][1] >= word + n):
                kept, place, i = [], 0, at
                for j, m in enumerate(re.finditer(r"\S+", line), word):
                    while i < len(runs) and runs[i][1] <= j:
                        i += 1
                    if i < len(runs) and runs[i][0] <= j:
                        kept.append(line[place : m.start()])
                        place = m.end()
                if len("".join([*kept, line[place:]]).split()):
                    yield "".join([*kept, line[place:]])
        word += n


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with a text that lacks the chunks of lines and the passages of over 50 words which occurred before anywhere; other columns unchanged.

    The first occurrence, by ``doc_id`` (nulls first, then the scan's order) and then by place in the text, stays; so do single lines and
    shorter passages, however often repeated. ``n_chars`` follows the text where there is such a column. Defined
    results: null and empty texts stay as they are; an exact copy of an earlier text keeps only lines and runs of
    words that are too short to go; a document may end up empty but no row is dropped. Rows are told apart by a row
    number of the scan, so null or repeated ids do no harm; ``docs`` must be a repeatable plan such as a Parquet
    read. An empty table gives no rows.
    """
    stripped, cut = _stripped(docs)
    new = F.col(f"{cut}.text")
    return stripped.select(*[F.length(new).cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else new.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def _stripped(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: a struct of gone, runs, copy and the text that stays."""
    row, out = free_name(docs, "__row"), free_name(docs, "__cut")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    order = "doc_id" if "doc_id" in docs.columns else None
    rows = numbered.select(F.col(row).alias("row"), "text", *([order] if order else []))
    gone = settle(repeats(rows, "row", order=order).select(F.col("row").alias(row), F.struct("gone", "runs", "copy").alias(out)))

    @F.pandas_udf("string")
    def cut(text: pd.Series, gone: pd.Series, runs: pd.Series, copy: pd.Series) -> pd.Series:
        return pd.Series([strip(t, None if g is None else list(g), None if r is None else [(x["a"], x["b"]) for x in r], bool(c)) for t, g, r, c in zip(text, gone, runs, copy, strict=True)], dtype=object)

    joined = numbered.join(F.broadcast(gone) if _few_bytes(gone, out) else gone, row, "left")
    none: Column = F.col(out).isNull()
    new = F.when(none, F.col("text")).otherwise(cut(F.when(~none, F.col("text")), f"{out}.gone", f"{out}.runs", f"{out}.copy"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(f"{out}.gone", f"{out}.runs", f"{out}.copy", new.alias("text")).alias(out)), out


def _few_bytes(gone: DataFrame, cut: str) -> bool:
    """Whether a table of what goes is small enough to broadcast: by rows, and by the elements of all its arrays."""
    size = F.lit(4) + F.greatest(F.size(f"{cut}.gone"), F.lit(0)) + 2 * F.greatest(F.size(f"{cut}.runs"), F.lit(0))
    return small(gone, BROADCAST_ROWS // 10) and (gone.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_ROWS


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed_chunks, n_removed_words, is_copy, text`` of every document, the text after the removal.

    ``n_lines`` counts the lines before it; a copy of an earlier text has no counts of its own (0). Null texts have
    null lines; null ids stay; repeated rows give a row each; an empty table gives no rows; other columns are not read.
    """
    base, cut = _stripped(docs.select("doc_id", "text"))
    words = F.aggregate(f"{cut}.runs", F.lit(0), lambda n, x: n + x["b"] - x["a"])
    return base.select("doc_id", F.size(F.split("text", "\n")).alias("n_lines"), F.coalesce(F.greatest(F.size(f"{cut}.gone"), F.lit(0)), F.lit(0)).alias("n_removed_chunks"), F.coalesce(words, F.lit(0)).alias("n_removed_words"), F.coalesce(f"{cut}.copy", F.lit(False)).alias("is_copy"), F.col(f"{cut}.text").alias("text"))
