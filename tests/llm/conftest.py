from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or longer rows."""

    def build(rows):
        filled = [(*row, *[None] * (5 - len(row)))[:5] for row in rows]
        df = spark.createDataFrame(filled, DOCUMENT)
        return df.repartition(3) if rows else df

    return build
