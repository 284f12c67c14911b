import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__  # noqa: E402,F401  (ships task code to the workers)
from verification.local import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", " ", "\n\t", "one", "two words", "A b C d e F g", "a b c d e f g", "é ü ß", "日本語 の テキスト", "x" * 5000,
    "same again " * 400, "<|endoftext|> in text", "a  b   c\n\n d", "12 34, 56!", "..!!..", "ab\x00cd ef",
]


@pytest.fixture(scope="session")
def spark():
    session = local_session("llm-tests", "4", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def odd(spark):
    """Odd texts, a repeated row, a null id, and columns named like results."""
    rows = [(i, t, "s", "taken") for i, t in enumerate(ODD_TEXTS)] + [(6, ODD_TEXTS[6], "s", "taken"), (None, "a b c d e f g", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, SCORE string")


@pytest.fixture
def empty(odd):
    return odd.limit(0)
