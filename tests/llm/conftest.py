import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# Python workers inherit it when the session starts
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keys string, node long, size long"


@pytest.fixture
def documents(spark):
    """Builds documents from texts or (id, text, source) rows; with columns whose names
    the operators use themselves."""
    spark.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (i, row, "s")
            full.append((doc_id, text, None, source, None, "k", 7, 3))
        return spark.createDataFrame(full, SCHEMA)

    return make
