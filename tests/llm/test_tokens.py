import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lodeflow.llm.packing import Tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(tok, text):
    return np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_every_latin_character_alone_and_within_words():
    tok, mine = Tokenizer.from_file(PATH), Tokens(open(PATH).read())
    for c in map(chr, range(256)):
        for text in (c, c * 3, f"a{c}b", f" {c} x", f"Word{c}", f"1{c}2", f"'{c}s"):
            assert mine.text(text) == plain(tok, text), repr(text)


def test_random_mixtures():
    rng = random.Random(11)
    tok, mine = Tokenizer.from_file(PATH), Tokens(open(PATH).read())
    letters = [chr(c) for c in range(256)] + list("aAbB12 '  \n\x00\x01\x1b") * 4 + ["ſ", "İ", "中", "\U0001f600", "­", " ", "'s", "<|endoftext|>", "'LL"]
    for _ in range(6000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 24)))
        assert mine.text(text) == plain(tok, text), repr(text)
