"""N-gram join and substring dedup against brute force, and their edge cases."""

from __future__ import annotations

import numpy as np
from llm_helpers import prose, shingles, similarity, word_list
from pyspark.sql import functions as F

from playlake.llm import near, passages
from playlake.llm import words as W
from playlake.llm.common import connected_components
from playlake.llm.ngram_join import keep_one, ngram_join
from playlake.llm.substring_dedup import substring_dedup


def near_texts() -> list[str | None]:
    out: list[str | None] = []
    for k in range(12):
        base = prose(k, 120)
        out.append(" ".join(base))
        for j in range(k % 4):
            copy = list(base)
            for x in range(j + 1):
                copy[(17 * x + 5 * j) % 120] = f"changed{k}{j}{x}"
            out.append(" ".join(copy))
    out += ["Short one.", "short ONE", "", "", None, "%%% ***", "%%% ***", "!!!", "a b c d e f"]
    return out


def brute_groups(texts: list[str | None], threshold: float = 0.8) -> tuple[list[int], list[int]]:
    sets = [shingles(t) for t in texts]
    n = len(texts)
    same = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if word_list(texts[i]) or word_list(texts[j]):
                same[i][j] = bool(sets[i] and sets[j]) and similarity(sets[i], sets[j]) >= threshold
            else:
                same[i][j] = (texts[i] or "") == (texts[j] or "")
    group = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if same[i][j]:
                    group[i] = group[j] = min(group[i], group[j])
    return group, [sum(same[i]) - 1 for i in range(n)]


def test_join_equals_brute_force(make_docs):
    texts = near_texts()
    rows = {r["doc_id"]: r for r in ngram_join(make_docs(texts)).collect()}
    group, links = brute_groups(texts)
    assert [rows[i]["class_id"] for i in range(len(texts))] == group
    assert [rows[i]["n_links"] for i in range(len(texts))] == links


def test_join_counts_links_across_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_ROWS", 4)
    base = prose(1, 150)
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(0, 150, 11)]
    rows = ngram_join(make_docs(texts)).collect()
    _, links = brute_groups(texts)
    assert {r["class_id"] for r in rows} == {0}
    assert [r["n_links"] for r in sorted(rows, key=lambda r: r["doc_id"])] == links


def test_keep_one_keeps_one_row_of_each_group(make_docs):
    texts = near_texts()
    docs = make_docs([*enumerate(texts), (3, texts[3]), (3, texts[3])])  # repeated rows
    kept = keep_one(docs, ngram_join(docs).cache())
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_groups(texts)[0]))


def test_join_of_empty_table_null_ids_and_clashing_columns(spark, make_docs):
    assert ngram_join(make_docs([])).count() == 0
    docs = spark.createDataFrame([(None, "one two three"), (None, "one two three"), (7, "other")], "doc_id bigint, text string")
    docs = docs.withColumns({"key": F.lit("k"), "root": F.lit(1), "links": F.lit(2), "bands": F.lit(3), "id": F.lit(4)})
    rows = ngram_join(docs).collect()
    assert sorted((r["class_id"] is None, r["n_links"]) for r in rows) == [(False, 0), (True, 1), (True, 1)]
    assert keep_one(docs, ngram_join(docs).cache()).count() == 2


def test_very_long_text(make_docs):
    long = " ".join(prose(5, 60_000, 50_000))
    rows = ngram_join(make_docs([long, long + " tail", "short"])).collect()
    assert sorted(r["n_links"] for r in rows) == [0, 1, 1]


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = W.choose_bands(threshold, 0.99)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99 and bands * rows <= 80


def test_words_and_grams_equal_brute_force():
    texts = ["The cat, THE cat sat!", "", "é1 日本-x", "...", "a b c d e f g h"]
    b = W.word_batch([t.encode() for t in texts])
    got = [[b.raw[s:e].tobytes().decode().lower() for s, e in zip(b.start[i:j], b.end[i:j])] for i, j in zip(b.first[:-1], b.first[1:])]
    assert got == [word_list(t) for t in texts]
    h, at = W.grams(b, 5)
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    words = [w for t in texts for w in word_list(t)]
    assert len(set(b.hash.tolist())) == len(set(words))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (100, 60), (60, 70), (5, 5), (200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 70: 50, 100: 50, 200: 200, 201: 200}


def test_substring_dedup_cuts_repeats(make_docs):
    passage = " ".join(prose(3, 60))
    changed = " ".join([*prose(3, 60)[:30], "other", *prose(3, 60)[31:]])
    own = [" ".join(prose(50 + i, 40)) for i in range(4)]
    texts = [f"{own[0]}\n{passage}", f"{passage}\n{own[1]}\nHello.", f"{own[2]}\n{changed}\nHello.", own[3], "", None, f"{own[3]} end"]
    rows = {r["doc_id"]: r for r in substring_dedup(make_docs(texts)).collect()}
    assert [rows[i]["text"] for i in range(6)] == [texts[0], f"{own[1]}\nHello.", f"{own[2]}\nHello.", own[3], "", None]
    assert rows[6]["text"] == ""  # a near copy of the paragraph above
    assert rows[1]["__kept_in"] == [0] and rows[0]["__kept_in"] == [0] and rows[3]["__removed"] == []


def test_substring_dedup_of_short_lines_equals_brute_force(make_docs):
    lines = [" ".join(prose(400 + k, k)) for k in range(1, 25)]  # 1 to 24 words
    notices = [" ".join(prose(500, 24)), " ".join(prose(500, 25))]  # similar: 20 of 21 n-grams
    texts = []
    for i in range(6):
        own = " ".join(prose(600 + i, 30))
        texts.append("\n".join([own, *lines[i::2], notices[i % 2], f"{own} tail", lines[(7 * i) % 24].upper()]))
    first: list[set] = []
    want = []
    for t in texts:
        left = []
        for line in t.split("\n"):
            s = shingles(line)
            whole = len(word_list(line)) >= 5
            if not (whole and any(similarity(s, x) >= 0.8 for x in first)):
                left.append(line)
            if whole:
                first.append(s)
        want.append("\n".join(left))
    rows = {r["doc_id"]: r["text"] for r in substring_dedup(make_docs(texts)).collect()}
    assert [rows[i] for i in range(6)] == want and want[5] != texts[5]


def test_substring_dedup_edges(spark, make_docs):
    assert substring_dedup(make_docs([])).count() == 0
    line = " ".join(prose(9, 30))
    docs = spark.createDataFrame([(1, f"{line}\nx\n{line}"), (1, f"{line}\nx\n{line}"), (None, line)], "doc_id bigint, text string")
    docs = docs.withColumns({"id": F.lit(1), "h": F.lit(2), "pos": F.lit(3)})
    out = substring_dedup(docs)
    assert out.columns[:5] == docs.columns
    # null ids come first, equal rows count as one document
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, line), (1, "x"), (1, "x")]


def test_substring_dedup_cuts_passages_inside_lines(make_docs):
    passage = " ".join(prose(3, 70))
    own = [" ".join(prose(80 + i, 90)) for i in range(8)]
    texts = [f"é {a} {passage[: len(passage) // 2]}{sep}{passage[len(passage) // 2 :]} {b}" for a, b, sep in zip(own[:4], own[4:], ["", "", "", ""])]
    texts += [f"{own[0][:60]} and {' '.join(prose(200, 80))}", " ".join(prose(201, 500)), None, ""]
    texts.append(" ".join([*prose(300, 40), *prose(3, 70)[5:65], *prose(301, 40)]))  # a part of the passage only
    rows = {r["doc_id"]: r for r in substring_dedup(make_docs(texts)).collect()}
    assert [rows[i]["text"] for i in (0, 4, 5, 6, 7)] == [texts[i] for i in (0, 4, 5, 6, 7)]
    windows = [{tuple(w[k : k + 47]) for k in range(len(w) - 46)} for w in (word_list(rows[i]["text"]) for i in range(len(texts)))]
    for i in range(len(texts)):
        assert not any(windows[i] & windows[j] for j in range(i)), i
    for i in (1, 2, 3):  # nothing else went
        left = word_list(rows[i]["text"])
        assert left[:91] == word_list("é " + own[i]) and left[-90:] == word_list(own[4 + i]) and len(left) < 181 + 31


def test_sampled_windows_equal_brute_force():
    rng = np.random.default_rng(5)
    h = rng.integers(1, 50, 400).astype(np.uint64)
    at = np.array([0, 0, 15, 31, 200, 216, 400])
    want = set()
    for i, j in zip(at[:-1], at[1:]):
        for s in range(i, j - 15):
            want |= {k for k in range(s, s + 16) if h[k] == h[s : s + 16].min()}
    assert passages.sampled(h, at, 16).tolist() == sorted(want)
