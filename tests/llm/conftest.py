from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Texts as the documents table; ``(id, text)`` pairs, dealt over several partitions."""
    from kilnwatch.llm.tables import shipped

    shipped(spark)

    def make(pairs, parts=3):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(parts)

    return make
