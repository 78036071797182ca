import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_helpers import prose

ODD_TEXTS = [
    None, "", "   \n\t", "!!! ???", "word", "two words", "Ünïcödé — 你好, мир", "a\x1cb c", prose(1, 40), prose(1, 40),
    prose(2, 4000), "x" * 30_000, "token = \"0123456789abcdef0123456789abcdef\"", "Licensed under the Apache License, Version 2.0.",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated ids, odd texts, repeated rows, and columns named like results."""
    rows = [(i if i % 5 else None, t, "en", "s", len(t or ""), 0.5, "x", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[8], (7, "other text under the same id", None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, shard int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
