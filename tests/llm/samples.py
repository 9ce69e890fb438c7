"""Invented texts that several tests share."""

import random

#: Texts that trip tokenizers, regexes and offsets: empty, blank, odd blanks, astral, controls, no blanks, long.
ODD = [None, "", " ", "\n\t\x0b\x0c\r ", "a", " ", "É x", "😀 😀😀 naïve", "\x00\x01 b", "x" * 5000, "ab " * 3000, "Ünï " * 400]


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", ".", "é"]) for _ in range(words))
