"""The cached pieces give the library's ids, whatever a worker saw before."""

import random

import pytest

from veritrail.llm import token_store
from veritrail.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def ids(encoder, texts):
    return [memoryview(x).cast(encoder.kind).tolist() for x in encoder.encode(texts)]


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_marks_and_line_breaks(library, order):
    texts = ["a word. and | more| than - one* ... thing.", "x \n. y \n| z \n- u \n* v", "| Name | Age| \n| Bob | 3 |", "word| \n|", "\n. \n", "- a\n- b \n - c"]
    encoder = token_store.PieceEncoder(PATH)
    for k in order:
        mine = texts[k :: 2]
        assert ids(encoder, mine) == library(mine)


def test_random_texts(library):
    """60,000 texts of words, marks, line breaks and spaces in any order."""
    r = random.Random(11)
    parts = ["word", "Ärger", "it's", "3", "|", "-", "*", ".", "...", "\n", "\r\n", "\t", " ", "  ", "", "a", "I'll", "|x|", " ", "<|endoftext|>", "é", "\n\n", "#", "_"]
    texts = ["".join(r.choice(parts) + r.choice([" ", " ", "", "\n"]) for _ in range(r.randint(1, 12))) for _ in range(60_000)]
    encoder = token_store.PieceEncoder(PATH)
    for k in range(0, len(texts), 500):
        mine = texts[k : k + 500]
        assert ids(encoder, mine) == library(mine)


def test_new_pieces_are_one_text(library):
    """A batch's new pieces, with marks, digits and line breaks in them, go to the library together."""
    encoder, sent = token_store.PieceEncoder(PATH), []
    raw = encoder.raw
    encoder.raw = lambda texts: sent.append(len(texts)) or raw(texts)
    texts = ["one " + " ".join(f"w{k}.\nx {k} wörd{k}, |{k}| a{k}" for k in range(100))]
    assert ids(encoder, texts) == library(texts) and sum(sent) == 2  # the first piece, and all others as one
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|> b"]
    assert ids(encoder, texts) == library(texts)
