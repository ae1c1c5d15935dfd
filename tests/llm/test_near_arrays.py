"""The array code of ``near``, ``words`` and ``passages`` against plain loops, without Spark."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from playlake.llm import near, passages
from playlake.llm import words as W


def brute_jaccard(a: str, b: str, n: int = 5) -> float:
    def grams(text):
        w = text.lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def components(nodes, links):
    root = {x: x for x in nodes}
    for _ in nodes:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {frozenset(x for x in nodes if root[x] == r) for r in set(root.values())}


@pytest.mark.parametrize("step", [1, 2, 3, 7, 100])
def test_stretches_keep_groups_whole_wherever_batches_end(step):
    group = [1, 1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    t = pa.record_batch([pa.array(group), pa.array([0] * 12), pa.array(range(12))], names=["g", "h", "row"])
    batches = [t.slice(0, 0), *(t.slice(i, step) for i in range(0, 12, step))]
    seen = []
    for table, at in near.stretches(iter(batches), 2):
        assert at[0] == 0 and at[-1] == table.num_rows
        seen += [(table.column("g")[int(i)].as_py(), table.column("row")[int(i) : int(j)].to_pylist()) for i, j in zip(at[:-1], at[1:])]
    assert seen == [(g, [i for i, x in enumerate(group) if x == g]) for g in (1, 2, 3, 4, 5)]
    assert list(near.stretches(iter([t.slice(0, 0)]), 2)) == []


def test_small_pairs_are_all_pairs_of_small_groups():
    i, j = near.small_pairs(np.array([0, 1, 4, 9, 11]), 3)
    assert list(zip(i.tolist(), j.tolist())) == [(1, 2), (1, 3), (2, 3), (9, 10)]


@pytest.mark.parametrize("size", [1, 2, 8, 9, 40])
@pytest.mark.parametrize("step", [5, 1000])
def test_verified_links_equal_brute_force(size, step):
    rng = np.random.default_rng(size)
    rows = []
    for g in range(6):
        base = [f"w{g}x{k}" for k in range(60)]
        texts = set()
        while len(texts) < size:
            w = list(base)
            for k in rng.integers(0, 60, rng.integers(0, 5)):
                w[k] = f"e{rng.integers(0, 1000)}"
            texts.add(" ".join(w))
        units = []
        for text in texts:
            key = near.unit_keys(W.word_batch([text.encode()]), [text.encode()])[0]
            units.append((bytes([g]), 0, 0, 0, key, int(rng.integers(1, 4)), text))
        # a row that repeats, and another text under the same key, count for nothing
        units += [units[0], (*units[0][:6], "another text under this very key")]
        rows += sorted(units, key=lambda u: u[4])
    names = ["root", "bi", "bj", "blk", "key", "copies", "text"]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.string()]
    whole = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    out = near.verified_links(5, 0.8)(whole.slice(i, step) for i in range(0, len(rows), step))
    out = [tuple(x.values()) for b in out for x in b.to_pylist()]
    units = {r[4]: r for r in rows if r[6] != "another text under this very key"}
    links = [(a, b) for a, b in itertools.combinations(units, 2) if brute_jaccard(units[a][6], units[b][6]) >= 0.8]
    count = {}
    for a, b in links:
        count[a] = count.get(a, 0) + units[b][5]
        count[b] = count.get(b, 0) + units[a][5]
    assert {a: n for a, b, n in out if b is None} == count
    assert components(list(units), [(a, b) for a, b, _ in out if b is not None]) == components(list(units), links)


def test_pairs_within_a_block_are_left_to_the_group_of_that_block():
    text = [" ".join(f"a{k}" for k in range(50)), " ".join(f"a{k}" for k in range(51)), " ".join(f"a{k}" for k in range(52))]
    key = [near.unit_keys(W.word_batch([t.encode()]), [t.encode()])[0] for t in text]
    rows = sorted(zip([b"r"] * 3, [0] * 3, [1] * 3, [0, 0, 1], key, [1] * 3, text), key=lambda r: r[4])
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["root", "bi", "bj", "blk", "key", "copies", "text"])
    out = [x for b in near.verified_links(5, 0.8)(iter([batch])) for x in b.to_pylist()]
    assert {x["a"]: x["links"] for x in out if x["b"] is None} == {key[0]: 1, key[1]: 1, key[2]: 2}


@pytest.mark.parametrize("size", [2, 32, 33, 70])
def test_likely_pairs_connect_all_signatures_that_agree(size):
    rng = np.random.default_rng(size)
    hashes, least = 72, 72 * 0.8 - near.SLACK * np.sqrt(72 * 0.8 * 0.2)
    rows, sig = [], {}
    for g in range(3):
        kinds = rng.integers(0, 256, (4, hashes), dtype=np.uint8)
        for k in range(size):
            s = kinds[rng.integers(0, 4)].copy()
            s[rng.integers(0, hashes, 20)] = rng.integers(0, 256, 20)
            sig[g, k] = s
            rows.append((g, 0, 0, bytes([g, k]), s.tobytes()))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    whole = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "bi", "bj", "key", "sig"])
    out = near.likely_pairs(hashes, 0.8)(whole.slice(i, 50) for i in range(0, len(rows), 50))
    found = [(x["a"], x["b"]) for b in out for x in b.to_pylist()]
    nodes = [bytes(k) for k in sig]
    want = [(bytes(a), bytes(b)) for a, b in itertools.combinations(sig, 2) if a[0] == b[0] and (sig[a] == sig[b]).sum() >= least]
    assert components(nodes, found) == components(nodes, want)


def test_rolled_hashes_tell_windows_apart_as_their_words_do():
    rng = np.random.default_rng(0)
    texts = ["", "one", *(" ".join(f"w{x}" for x in rng.integers(0, 2, n)) for n in (3, 4, 5, 40, 400))]
    h, at = W.rolled(W.word_batch([t.encode() for t in texts]), 4)
    windows = [tuple(t.split()[i : i + 4]) for t in texts for i in range(len(t.split()) - 3)]
    assert np.diff(at).tolist() == [max(0, len(t.split()) - 3) for t in texts]
    hash_of = {}
    assert all(hash_of.setdefault(w, x) == x for w, x in zip(windows, h.tolist()))
    assert len(set(hash_of.values())) == len(hash_of)


def test_runs_end_at_gaps_at_other_copies_and_at_the_text():
    n, span = 3, 2
    texts = ["é0 é1 é2 é3 é4 é5 é6 é7 é8 é9 é10 é11", "x0 x1 x2 x3 x4"]
    hits = [
        [{"pos": 5, "where": 7}, {"pos": 0, "where": 7}, {"pos": 2, "where": 7}, {"pos": 6, "where": 8}],
        [{"pos": 1, "where": 8}],
    ]
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("where", pa.int64())]))
    batch = pa.record_batch([pa.array([1, 2]), pa.array([10, 20]), pa.array(hits, kind), pa.array(texts)], names=["id", "h", "hits", "text"])
    out = [x for b in passages.run_rows(n, span)(iter([batch])) for x in b.to_pylist()]
    assert [(x["id"], x["text"]) for x in out] == [(1, "é0 é1 é2 é3 é4"), (1, "é5 é6 é7"), (1, "é6 é7 é8"), (2, "x1 x2 x3")]
    assert all(texts[x["id"] - 1][x["pos"] : x["end"]] == x["text"] for x in out)
