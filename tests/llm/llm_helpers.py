"""Brute-force counterparts and texts for the tests of the training-data operators."""

from __future__ import annotations

import random
import re


def prose(seed: int, words: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]


def word_list(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    w = word_list(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0
