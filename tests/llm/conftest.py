import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from odd_rows import CLASHING  # noqa: E402


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table out of (doc_id, text) pairs, with columns whose names clash."""

    def make(rows):
        extra = ", ".join(f"{c} string" for c in CLASHING)
        full = [(i, t, None if t is None else "xx", "src", *["own"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, {extra}").repartition(3)

    return make
