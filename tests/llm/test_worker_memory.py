"""What Python workers keep from one task to the next."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers

from playlake.llm import common, packing, tokens, toxicity


def test_encoder_goes_when_another_operator_begins(spark):
    """Packing's tasks share one encoder; a task of another operator gives it up first."""

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(4)], "doc_id long, text string").coalesce(1)
    want = sorted(tuple(r) for r in packing.pieces(docs, path).collect())
    pack = common.lean(packing.piece_batches(path, 2048, 1, False))
    other = common.lean(toxicity.trigram_batches)

    def tasks(batches):  # a worker's tasks, one after another
        rows = list(batches)
        for run, cut in ((pack, 0), (pack, 0), (other, 1), (pack, 0)):
            list(run(iter([b.select(b.schema.names[cut:]) for b in rows])))
            yield pa.RecordBatch.from_arrays([pa.array([tokens.encoder.cache_info().currsize]), pa.array([len(common.KEPT)])], names=["n", "kept"])

    assert [tuple(r) for r in docs.mapInArrow(tasks, "n long, kept long").collect()] == [(1, 1), (1, 1), (0, 0), (1, 1)]
    assert sorted(tuple(r) for r in packing.pieces(docs, path).collect()) == want


def test_an_operators_own_task_keeps_it(monkeypatch):
    gone = []
    monkeypatch.setattr(common, "KEPT", {"a": lambda: gone.append("a"), "b": lambda: gone.append("b")})
    common.release_others("a")
    assert gone == ["b"] and list(common.KEPT) == ["a"]
