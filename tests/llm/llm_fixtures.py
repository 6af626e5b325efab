"""Documents for the tests of this folder."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, size string, id string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names clash with those of results."""

    def build(*rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, "k", "s", None, "i") for r in rows], DOCS
        )

    return build
