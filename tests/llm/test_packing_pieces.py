"""The tokenizer of packing remembers pieces, not words, and gives the ids of the whole tokenizer."""

import random

from linkspark.llm import packing
from linkspark.llm.queries import tokenizer


def test_forms_of_a_word_share_a_piece():
    words = packing.WordTokenizer(tokenizer())
    cores, marks = [f"w{'ab'[i % 2]}{chr(97 + i % 26)}{chr(97 + i // 26)}ß" for i in range(100)], [".", ",", "!?", "***"]
    words.encode(" ".join(form + mark for core in cores for form in (core, core.title()) for mark in marks), 1)
    assert len(words.known) == len(cores) + len(marks)


def test_ids_are_the_tokenizers_own():
    words, whole = packing.WordTokenizer(tokenizer(), most=50), packing.WordTokenizer(tokenizer()).encoder
    rng = random.Random(3)
    parts = [*"abzABZ019'. \t\n\r\x1c\x85\xa0éÉßẞÿŸ×ªµ²œσςΣKİñ日🙂ſ", "é", "'s", "'LL", "don't", "<|", "<|endoftext|>", "straße", "Über"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert words.encode(text, 1).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1], repr(text)
        assert len(words.known) <= 50 and len(words.known.old) < 300
