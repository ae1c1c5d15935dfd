"""Token ids of whole batches of texts, with a public byte-level BPE vocabulary.

Texts are cut into pre-tokens by NumPy over the code points of a batch; equal
pre-tokens of a batch are encoded once, and frequent ones are remembered.  Texts with a
special token's string, or with code points that Unicode leaves unassigned, go to the
``tokenizers`` library as they are; the ids are the same by either way (tests compare).
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

import numpy as np

from playlake.llm import words as W

# The contractions that the vocabulary's pattern cuts off.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACES = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
LETTER, NUMBER, OTHER, SPACE, UNSURE = range(5)
#: Pre-tokens remembered by a Python worker.
REMEMBERED = 1_000_000


@lru_cache(1)
def classes() -> np.ndarray:
    t = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        k = unicodedata.category(chr(c))
        t[c] = LETTER if k[0] == "L" else NUMBER if k[0] == "N" else UNSURE if k in ("Cn", "Cs") else OTHER
    t[list(SPACES)] = SPACE
    return t


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BatchEncoder:
    """Ids of many texts; ``path`` is a ``tokenizers`` JSON file of a byte-level BPE."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        table = byte_of_char()
        ranks = {bytes(table[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.pieces = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)  # start of each remembered pre-token's ids in self.ids
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        code, at = code_points(texts)
        kind = classes()[code]
        bad = np.zeros(len(texts), bool)
        bad[np.searchsorted(at, np.flatnonzero(kind == UNSURE), "right") - 1] = True
        for s in self.special:
            bad |= np.fromiter((s in t for t in texts), bool, len(texts))
        slow = {int(i): np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(bad)}
        if slow:
            texts = ["" if i in slow else t for i, t in enumerate(texts)]
            code, at = code_points(texts)
            kind = classes()[code]
        starts = token_starts(code, kind, at)
        ids, count = self.lookup("".join(texts), code, starts)
        edges = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, at)]
        return [slow[i] if i in slow else ids[edges[i] : edges[i + 1]] for i in range(len(texts))]

    def lookup(self, text: str, code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each pre-token."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ends = np.concatenate([starts[1:], [len(code)]])
        pre = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(W.mix(code.astype(np.uint64) + np.uint64(1)) * W.powers(W._BASE, len(code)), out=pre[1:], dtype=np.uint64)
        h = (pre[ends] - pre[starts]) * W.powers(W._INVERSE, len(code))[starts]
        h = W.mix(h + (ends - starts).astype(np.uint64) * W._SEED)
        value, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        where = np.searchsorted(self.hash, value)
        known = np.zeros(len(value), bool)
        if len(self.hash):
            where = np.minimum(where, len(self.hash) - 1)
            known = self.hash[where] == value
        new = np.flatnonzero(~known)
        encode = self.pieces.encode_ordinary
        got = [encode(text[starts[k] : ends[k]]) for k in first[new]]
        size = np.zeros(len(value), np.int64)
        at = np.zeros(len(value), np.int64)
        size[known], at[known] = self.size[where[known]], self.at[where[known]]
        size[new] = [len(g) for g in got]
        at[new] = len(self.ids) + np.cumsum(size[new]) - size[new]
        pool = np.concatenate([self.ids, np.array([x for g in got for x in g], np.uint32)])
        count = size[inverse]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = pool[np.arange(total[-1]) - np.repeat(total[:-1] - at[inverse], count)]
        self.remember(value[new], at[new], size[new], pool)
        return ids, count

    def remember(self, value: np.ndarray, at: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        if len(self.hash) + len(value) > REMEMBERED:
            self.forget()
            return
        put = np.searchsorted(self.hash, value)
        self.hash, self.at, self.size = (np.insert(x, put, y) for x, y in ((self.hash, value), (self.at, at), (self.size, size)))
        self.ids = pool


@lru_cache(4)
def encoder(path: str) -> BatchEncoder:
    """One encoder for each worker: its memory outlives the tasks, until another operator begins (``common.KEPT``)."""
    return BatchEncoder(path)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), at


def token_starts(code: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens begin; texts begin at ``at``."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)  # a text begins or ends here
    edge[at] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # a white space before something else: its last character stands alone, or joins if it is a blank
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
    start[last] = True
    blank = last[code[last] == 32]
    start[blank + 1] = False
    # an apostrophe by itself, not after a blank, takes a contraction off the word after it
    quote = np.flatnonzero((code == 39) & start)
    quote = quote[(quote + 1 < n)]
    quote = quote[run[quote + 1] & ~edge[quote + 1]]
    for c in CONTRACTIONS:
        m = len(c)
        hit = quote[quote + m < n]
        for k, ch in enumerate(c):
            hit = hit[code[hit + 1 + k] == ord(ch)]
            if k:
                hit = hit[~edge[hit + 1 + k]]
        start[hit + 1] = False
        after = hit[hit + 1 + m < n] + 1 + m
        start[after] = np.where((kind[after] == LETTER) | start[after], True, start[after])
        quote = np.setdiff1d(quote, hit)
    return np.flatnonzero(start)
