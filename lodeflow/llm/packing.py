"""Best-fit-decreasing packing of documents into sequences of bounded length."""

from __future__ import annotations

import math
import os
import re
import unicodedata
import zlib
from array import array
from operator import attrgetter
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import map_rows, session, settle, sized_join

CAPACITY = 4096
#: Words whose ids a worker remembers.
CACHE = 150_000
#: Separators that the str.split of Python knows and the tokenizer's \\s doesn't.
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
END_ID = 1
_ID = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level model writes for each byte: itself where printable, else from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _word_pattern() -> re.Pattern:
    """How the tokenizer cuts text of Latin-1 characters: short endings, letters, single digits, runs of others."""
    chars = [chr(c) for c in range(256)]
    letters = "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("L"))
    digits = "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("N"))
    return re.compile(rf"[{letters}]+|[{digits}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{letters}{digits}]+")


class Words(dict):
    """Ids of words, as bytes; a word that isn't there goes to the tokenizer's model and is remembered."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        seen = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
        got = array("I", map(_ID, self.tokenize(seen))).tobytes()
        if len(self) >= CACHE:
            self.clear()
        self[word] = got
        return got


class Tokens:
    """Ids of whole texts as little-endian bytes.

    The tokenizer folds case, drops white space and cuts text into words, each of which has ids of its own. Text of
    Latin-1 characters is cut here, and only words that aren't remembered go to the tokenizer's model. Other text is
    handled by chunks between white space, across which nothing looks: those with other characters go through the
    tokenizer whole, and so do texts that hold one of its added tokens, which is one id there.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(definition)
        self.added = [x.content.lower() for x in self.tok.get_added_tokens_decoder().values()]
        self.find = _word_pattern().findall
        self.words = Words(self.tok.model)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(text.lower())))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without the end."""
        return [self.text(t) if t else b"" for t in texts]

    def text(self, text: str) -> bytes:
        if any(c in text for c in _ODD_SPACE) or any(x in low for low in [text.lower()] for x in self.added):
            return self._whole(text)
        if _is_latin(text):
            return self._latin(text)
        return b"".join(self._latin(c) if _is_latin(c) else self._whole(c) for c in text.split())


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_tokens: dict[int, Tokens] = {}


def tokens_of(definition: str) -> Tokens:
    """One tokenizer, with its memory of words, for each worker process."""
    key = zlib.crc32(definition.encode())
    if key not in _tokens:
        _tokens[key] = Tokens(definition)
    return _tokens[key]


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids with the end id."""
    ids += END_ID.to_bytes(4, "little")
    step = 4 * capacity
    return [(k, k * capacity, len(part) // 4, zlib.crc32(part)) for k, part in enumerate(ids[i : i + step] for i in range(0, len(ids), step))]


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), a row for each piece.

    The tokenizer's file is read on the driver and broadcast: executors need no such path. Null and empty texts are
    the end id alone; null ids stay; repeated rows give rows each.
    """
    sent = session(docs).sparkContext.broadcast(Path(path).read_text())

    def make():
        tokens = tokens_of(sent.value)

        def run(doc_ids, texts):
            out = [[] for _ in range(5)]
            for d, ids in zip(doc_ids, tokens.ids(texts), strict=True):
                for row in pieces_of(ids, capacity):
                    for o, v in zip(out, (d, *row), strict=True):
                        o.append(v)
            return out

        return run

    return map_rows(docs, ["doc_id", "text"], f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start bigint, length bigint, ids_crc32 bigint", make)


class Capacities:
    """Segment tree over remaining capacities 0 .. capacity: how many leaves below a node have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, capacity.bit_length())
        if self.size <= capacity:
            self.size *= 2
        self.tree = [0] * (2 * self.size)

    def set(self, at: int, there: bool) -> None:
        i = at + self.size
        if self.tree[i] == there:
            return
        step = 1 if there else -1
        while i:
            self.tree[i] += step
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` with an open bin."""
        i = least + self.size
        if self.tree[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over a histogram of lengths: runs of like placements, and the number of bins.

    A run (length, first, count, per_bin, bin, offset) says: documents first .. first + count - 1 of that length go,
    ``per_bin`` to each, into bins from ``bin`` on, behind ``offset`` tokens. The outcome is that of placing the
    documents one by one, longest first, each in the tightest open bin: after a document has gone into the
    tightest bin, that bin, if it has room for the next of equal length, is the tightest again; and bins of equal
    capacity are alike. So documents of one length and bins of one capacity are handled together, and the work
    depends on the number of lengths, not of documents.
    """
    open_: dict[int, list[tuple[int, int]]] = {}
    tree, runs, bins = Capacities(capacity), [], 0

    def put(room: int, start: int, n: int) -> None:
        if n and room:
            open_.setdefault(room, []).append((start, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, start = capacity, bins
                n = math.ceil(left / (capacity // length))
                bins += n
            else:
                start, n = open_[room].pop()
                if not open_[room]:
                    tree.set(room, False)
            per = room // length
            whole = min(n, left // per)
            if whole:
                runs.append((length, first, whole * per, per, start, capacity - room))
                put(room - per * length, start, whole)
                first, left = first + whole * per, left - whole * per
            if whole < n and left:
                # fewer are left than a bin takes
                runs.append((length, first, left, left, start + whole, capacity - room))
                put(room - left * length, start + whole, 1)
                whole, first, left = whole + 1, first + left, 0
            put(room, start + whole, n - whole)
    return runs, bins


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    The driver gets a histogram of at most ``capacity`` lengths, whatever the input, and plans on it. Each piece's
    number among those of its length comes from row numbers within (length, salt), where the salt keeps a length that
    a third of all documents have from landing in one task, and from sums over salts; places are then
    looked up in the plan, which is broadcast (its runs grow with the number of lengths alone).
    Defined results: null and empty texts are the end id alone; null ids stay; repeated rows are packed each; an
    empty table gives no rows; other columns are not read.
    """
    spark = session(docs)
    rows = settle(tokenised(docs, path, capacity))
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    runs, _ = best_fit(histogram, capacity)
    runs.sort()
    arr = np.array(runs, dtype=np.int64).reshape(-1, 6)
    sent = spark.sparkContext.broadcast(arr)
    total = sum(histogram.values())
    salts = max(1, math.ceil(max(histogram.values(), default=1) / max(256, total // 800)))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "salt").count().selectExpr("length", "salt", "sum(count) over (partition by length order by salt rows between unbounded preceding and current row) - count as before")
    numbered = salted.selectExpr("*", "row_number() over (partition by length, salt order by doc_id, piece, ids_crc32) - 1 as own")
    placed = sized_join(numbered, before, ["length", "salt"], "inner", 100_000).withColumn("number", F.col("own") + F.col("before"))

    def make():
        plan = sent.value
        key = (plan[:, 0] << 44) + plan[:, 1]

        def run(doc_ids, piece, start, length, crc, number):
            n, o = np.array(length, dtype=np.int64), np.array(number, dtype=np.int64)
            r = plan[np.searchsorted(key, (n << 44) + o, side="right") - 1]
            at = o - r[:, 1]
            return [doc_ids, piece, start, length, crc, (r[:, 4] + at // r[:, 3]).tolist(), (r[:, 5] + at % r[:, 3] * n).tolist()]

        return run

    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(placed, ["doc_id", "piece", "start", "length", "ids_crc32", "number"], f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint", make)
