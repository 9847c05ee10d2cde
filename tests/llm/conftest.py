from __future__ import annotations

import pytest

from fabpulse.llm.shipping import ship


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package on its workers."""
    return ship(spark)


@pytest.fixture
def documents(llm):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with a clashing extra column."""
    def build(*rows):
        full = [(*row, *(None,) * (4 - len(row))) for row in rows]
        return llm.createDataFrame(
            [(i, t, lang, source, None if t is None else len(t), "x", 1, 2)
             for i, t, lang, source in full],
            "doc_id long, text string, lang string, source string, n_chars long, "
            "fp string, score int, key int")
    return build
