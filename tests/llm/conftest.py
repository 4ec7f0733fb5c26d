from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import TEXTS  # noqa: E402

@pytest.fixture
def texts(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like those an operator makes."""
    rows = [(i, t, "en", None, 0, 1.0, "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, id string")


@pytest.fixture
def nothing(texts):
    return texts.limit(0)
