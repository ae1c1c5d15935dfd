"""Merkle manifest (operator 13) against a plain recursive tree."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from playlake.llm import merkle, queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        a = at // 8 * 8
        out.append((nodes[a:at], nodes[at + 1 : a + 8]))
        at //= 8
    return out


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = [(r, leaf(r, r[1])) for r in rows if r[2] == lang]
        mine.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = (mine, climb([d for _, d in mine]))
    top = climb([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        mine, levels = trees[lang]
        for at, (r, d) in enumerate(mine):
            sides = path(levels, at) + path(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf(r, lower(r[1])) if tampered else d
            for left, right in sides:
                node = h([*left, node, *right])
            proof = h(x for left, right in sides for x in [*left, *right])
            out.append((r[0], d, levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def table(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "abc", f"Text {i} Ünï", f"plain {i}"])
        rows.append((i * 7 + 1, text, rng.choice(["en", "en", "en", "de", None, "fr", ""]), rng.choice([None, "s"]), rng.choice([None, i])))
    return rows


def got(spark, rows, levels):
    docs = spark.createDataFrame(rows, DOCS)
    return [tuple(r) for r in merkle.proofs(queries.manifest_leaves(docs), ["doc_id"], levels).collect()]


@pytest.mark.parametrize(("n", "levels"), [(700, 1), (700, 2), (90, 4)])
def test_equals_brute_force(spark, n, levels):
    rows = table(n)
    assert sorted(map(str, got(spark, rows, levels))) == sorted(map(str, brute(rows)))


def test_many_trees_repeated_rows_and_null_ids(spark):
    rows = [(i, f"T{i}", f"l{i % 70}", "s", 2) for i in range(150)]
    rows += [(5, "Same", "en", "s", 4)] * 40 + [(None, "N", "en", None, None)] * 3 + [(None, "x", None, None, None), (2**60 + 1, "Big", "en", "s", 3)]
    assert sorted(map(str, got(spark, rows, 1))) == sorted(map(str, brute(rows)))


def test_one_row_and_no_row(spark):
    rows = [(3, "Only", "en", "s", 4)]
    assert got(spark, rows, 4) == brute(rows)
    assert got(spark, [], 4) == []


def test_very_long_text_and_other_columns(spark):
    rows = [(i, "Long " * 200_000 + str(i), "en", "s", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as node", "2 as size", "'x' as tree")
    out = [tuple(r) for r in merkle.proofs(queries.manifest_leaves(docs), ["doc_id"]).collect()]
    assert sorted(out) == sorted(brute(rows))
    with pytest.raises(ValueError):
        merkle.proofs(docs, ["root"])


def test_missing_nodes_are_minimal():
    """The nodes asked for are those that the plain proofs hold and the range cannot give."""
    size, top = 300, merkle.depth(300)
    for lo, hi in [(0, 8), (8, 24), (5, 19), (296, 300), (0, 300), (64, 128)]:
        have = {(0, i) for i in range(lo, hi)} | set(merkle.missing(0, lo, hi, size, top))
        need, n = set(), size
        for level in range(top):
            for i in range(lo, hi):
                a = (i // 8**level) // 8 * 8
                need |= {(level, x) for x in range(a, min(n, a + 8))}
            n = -(-n // 8)
        given, n = set(have), size
        for level in range(top):  # whatever has all children can be derived
            for i in range(-(-n // 8)):
                if all((level, c) in given for c in range(8 * i, min(n, 8 * i + 8))):
                    given.add((level + 1, i))
            n = -(-n // 8)
        assert need <= given
        for x in merkle.missing(0, lo, hi, size, top):
            assert x in need
