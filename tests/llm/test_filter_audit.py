"""Filter interaction audit (operator 12) against direct application of every order."""

from __future__ import annotations

import random
import re
from itertools import combinations, permutations

import numpy as np
import pytest

from playlake.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fails(row, rows):
    text = row[1] or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(w) < 200:
        out.add("A")
    if 100 * len(set(w)) < 50 * len(w):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if row[0] is not None and any(o[0] is not None and o[0] < row[0] and (o[1] or "") == text for o in rows):
        out.add("E")
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out = {}
    failing = [fails(r, rows) for r in rows]
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failing) if (r[3] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def table(spark, rows, labels):
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = filter_audit.audit(filter_audit.document_masks(docs, marks), list("ABCDE"), ["good", "toxic"]).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in got}


def corpus(seed=3):
    rng = random.Random(seed)
    texts = [None, "", "  \t\n", "short text", "Big $ TEXT"]
    for _ in range(25):
        words = [rng.choice(["a", "B", "É", "x#", "Über", "w%d" % rng.randrange(300), "UP"]) for _ in range(rng.choice([5, 199, 200, 201, 260]))]
        texts.append(rng.choice([" ", "\n", "\x0b ", " "]).join(words))
        texts.append(" ".join(f"w{rng.randrange(10**6)}" for _ in range(220)))
    rows = [(i, rng.choice(texts), "en", rng.choice(["s1", "s2", None, ""]), 0) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_equals_brute_force(spark):
    rows, labels = corpus()
    assert table(spark, rows, labels) == brute(rows, labels)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "x", "en", "s", 1)] * 3 + [(2, "x", "en", "s", 1)] * 2 + [(None, "x", "en", "s", 1)] * 2 + [(7, "y " * 300, None, None, None)]
    labels = [(1, 1, 0), (1, 0, 0), (2, 0, 1)]
    assert table(spark, rows, labels) == brute(rows, labels)


def test_empty_tables_and_clashing_columns(spark):
    assert table(spark, [], [(1, 1, 1)]) == {}
    rows = [(1, "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as id", "2 as part", "3 as key", "4 as n", "5 as low", "6 as mask")
    out = filter_audit.document_masks(docs, spark.createDataFrame([], LABELS))
    assert [tuple(r) for r in out.collect()] == [("s", 1, 1, 0, 0)]


def test_very_long_text(spark):
    rows = [(1, "word " * 2_000_000, "en", "s", 1), (2, "word " * 2_000_000, "en", "s", 1)]
    out = filter_audit.document_masks(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))
    assert sorted(r["mask"] for r in out.collect()) == [2, 18]


def test_survivors_of_every_subset():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 50, (4, 32, 3))
    states = filter_audit.survivors(cells, 5)
    for k in range(6):
        for chosen in combinations(range(5), k):
            active = sum(1 << f for f in chosen)
            free = [m for m in range(32) if not m & active]
            assert (states[:, active] == cells[:, free].sum(1)).all()


def test_names_are_checked(spark):
    with pytest.raises(ValueError):
        filter_audit.audit(spark.createDataFrame([], "part string, mask int, n bigint"), ["A", "A"], [])
