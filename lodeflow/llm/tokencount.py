"""Count-only Viterbi: how many unigram pieces the best segmentation of a text has, without making them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from lodeflow.llm.common import map_rows, session

#: Chunks whose counts a worker remembers.
CACHE = 300_000
#: What an unknown character costs below the worst piece: the tokenizer's fixed penalty.
UNK_PENALTY = 10.0
SPACE = "▁"

_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id, of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


def is_special(piece: str) -> bool:
    """Control, unknown and byte pieces, which never match text."""
    return bool(re.fullmatch(r"<unk>|<s>|</s>|<0x[0-9A-F]{2}>", piece))


class Counter:
    """Unigram segmentation by Viterbi over the matches of an Aho-Corasick automaton.

    Rules of the tokenizer: of two ways to reach a position, the better sum of scores wins; on a tie the one whose
    last piece began first, i.e. the longest. A character that no single-character piece covers may be taken as unknown
    at the worst score less a penalty; runs of unknown characters are one unknown token, which falls back to one
    token for each UTF-8 byte where the vocabulary has byte pieces.
    Scores of single chunks add up: no piece but runs of the space mark holds a mark after another character, so every
    segmentation has a boundary there, and best ways before and after it are independent.
    """

    def __init__(self, vocab: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        low = min((s for _, s in vocab), default=0.0)
        self.unk = low - UNK_PENALTY
        pieces = {p for p, _ in vocab}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.cuts = True
        n = 0
        for p, s in vocab:
            if p and (not is_special(p)):
                self.automaton.add_word(p, (len(p), s))
                n += 1
                if SPACE in p.lstrip(SPACE):
                    self.cuts = False
        if n:
            self.automaton.make_automaton()
        self.any = n > 0
        self.cache: dict[str, tuple[int, float]] = {}

    def chunk(self, s: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of a string."""
        n = len(s)
        none = float("-inf")
        score, count, tail = [none] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        # tail: UTF-8 bytes of the run of unknown characters that ends here, 0 if none does
        score[0] = 0.0
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = [False] * n
        if self.any:
            for end, value in self.automaton.iter(s):
                matches[end + 1].append(value)
                if value[0] == 1:
                    single[end] = True
        for i in range(1, n + 1):
            best, at, unk = none, 0, False
            # earliest start first: longest piece first; the unknown character starts last of all
            for length, piece_score in sorted(matches[i], reverse=True):
                x = score[i - length] + piece_score
                if x > best:
                    best, at = x, i - length
            if not single[i - 1]:
                x = score[i - 1] + self.unk
                if x > best:
                    best, at, unk = x, i - 1, True
            score[i] = best
            if unk:
                more = len(s[i - 1].encode("utf-8", "surrogatepass"))
                tail[i] = tail[at] + more
                count[i] = count[at] + (more if self.bytes else 0 if tail[at] else 1)
            else:
                count[i] = count[at] + 1
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text, after the tokenizer's normalisation: a mark for each space and one in front."""
        if not text:
            return 0, 0.0
        line = SPACE + text.replace(" ", SPACE)
        if not self.cuts:
            return self.chunk(line)
        total, score = 0, 0.0
        cache = self.cache
        for c in _CHUNK.findall(line):
            got = cache.get(c)
            if got is None:
                if len(cache) >= CACHE:
                    cache.clear()
                got = self.chunk(c)
                if len(c) <= 64:
                    cache[c] = got
            total += got[0]
            score += got[1]
        return total, score


_counters: dict = {}


def counter_of(key: int, vocab: list[tuple[str, float]]) -> Counter:
    """One automaton, with its memory of chunks, for each worker process."""
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(vocab)
    return _counters[key]


def count_tokens(docs: DataFrame, vocab: list[tuple[str, float]], id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, score) of every whole text, in one map over the scan.

    The vocabulary is broadcast: its size is that of a tokenizer file. Defined results: null and empty texts have no
    tokens and score 0; repeated rows give a row each; null ids stay; other columns are not read.
    """
    spark = session(docs)
    sent = spark.sparkContext.broadcast(vocab)
    key = hash(tuple(vocab))

    def make():
        counter = counter_of(key, sent.value)

        def run(ids, texts):
            got = [counter.text(t) for t in texts]
            return [ids, [g[0] for g in got], [float(g[1]) for g in got]]

        return run

    return map_rows(docs, [id_col, "text"], f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_tokens bigint, score double", make)
