"""Fixtures of the tests of the training-data operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def make_docs(spark):
    """A documents table from texts (ids from 0) or (id, text) pairs."""

    def make(texts):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return make
