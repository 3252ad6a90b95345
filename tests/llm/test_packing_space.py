"""Operator 7: ids of texts with runs of white space of any length equal those of the full tokenizer, in about its time."""

import time

import public_tokenizers
from tokenizers import Tokenizer

from curbflow.llm.packing import LONG_SPACE, encoder

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def test_runs_of_white_space():
    encode, full = encoder(VOCABULARY, RANKS), Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for length in (0, 1, 2, LONG_SPACE - 1, LONG_SPACE, LONG_SPACE + 1, 3000):
        for space in (" ", "\n", "\t ", "　"):
            text = f"a{space * length}b c"
            assert encode(text) == full.encode(text, add_special_tokens=False).ids


def test_long_white_space_takes_no_longer_than_the_full_tokenizer():
    encode, full = encoder(VOCABULARY, RANKS), Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for length in (9000, LONG_SPACE - 1):
        text = "\n".join(["x" + " " * length] * (1_000_000 // length))
        encode("x" + " " * LONG_SPACE)
        start = time.process_time()
        ids = encode(text)
        middle = time.process_time()
        assert ids == full.encode(text, add_special_tokens=False).ids
        assert middle - start <= 2 * (time.process_time() - middle) + 1
