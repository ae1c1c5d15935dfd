"""The corpus pipeline stage by stage, against brute force on a small table."""

from __future__ import annotations

import duckdb
import pytest
from llm_helpers import prose, shingles, similarity, word_list

import __spark_entry__
import corpus_pipeline
from playlake.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages_on_planted_rows(spark, make_docs, tmp_path):
    passage, leak = " ".join(prose(1, 60)), " ".join(prose(2, 20))
    clean = [" ".join(prose(10 + i, 200)) for i in range(6)]
    near = " ".join([*clean[0].split()[:199], "changed"])
    texts = [clean[0], near, f"{clean[1]}\n{passage}", f"{clean[2]}\n{passage}", f"{clean[3]} {leak}", clean[4], None, "", clean[5]]
    docs = make_docs(texts)
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    kept = materialize(stages["ngram_join"](spark, docs, str(tmp_path)), "kept")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 8]
    cut = materialize(stages["substring_dedup"](spark, kept, str(tmp_path)), "cut")
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == docs.columns and rows[3]["text"] == clean[2] and rows[2]["text"] == texts[2]
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in rows.values())
    rows = {r["doc_id"]: r["text"] for r in stages["decontaminate"](spark, cut, str(tmp_path)).collect()}
    assert word_list(rows[4]) == word_list(clean[3]) and rows[5] == clean[4] and rows[6] is None


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of each stage over the smallest table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out.append((name, docs))
    return dict(out)


def test_no_pair_of_kept_documents_is_similar(stages):
    before = {r["doc_id"]: r["text"] for r in stages["toxicity"].collect()}
    after = {r["doc_id"] for r in stages["ngram_join"].collect()}
    sets = {i: shingles(t) for i, t in before.items()}
    for i in after:
        assert all(similarity(sets[i], sets[j]) < 0.8 for j in after if j < i and sets[i] and sets[j])
    for i in set(before) - after:  # each that went is similar to another
        assert any(similarity(sets[i], sets[j]) >= 0.8 for j in before if j != i)


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages["packing"].collect()))


def test_columns_and_full_cover(stages):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(stages[s].columns == names for s, _ in corpus_pipeline.STAGES[:-1])
    ids = {r["doc_id"] for r in stages["decontaminate"].collect()}
    assert {r["doc_id"] for r in stages["packing"].collect()} == ids


def test_registered_queries_and_oracles(spark):
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name in ("op6_chat_format", "op7_decontaminate", "op9_revisits", "op12_filter_audit", "op13_merkle"):
        got = names[name](spark, SF)
        table = con.execute(__spark_entry__.oracle_sql()[name]).to_arrow_table()
        assert sorted(table.column_names) == sorted(got.columns)
        want = sorted(str([r[c] for c in got.columns]) for r in table.to_pylist())
        assert sorted(str(list(r)) for r in got.collect()) == want
