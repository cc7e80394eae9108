import random

import public_tokenizers
import pytest

from shelfmark.llm import common


@pytest.fixture(scope="session")
def vocab():
    return public_tokenizers.path


@pytest.fixture(scope="session")
def documents(spark, small):
    return common.read(spark, small, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_texts():
    """Random texts of pieces on which tokenizers differ: blanks, scripts, special tokens."""
    pick = random.Random(7)
    parts = [*"abc  ABC\n\n\t'sdtrevl19!?.-éßÉŸ中文́  ​\U0001f600\x1c\x85　กẞİ\U0001e030ࡰΣ"]
    parts += ["<|endoftext|>", " <|startoftext|>", "'re", " the", " The,", "  ", "password"]
    found = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(1500)]
    return [*found, "", "a" * 3000, "aaaa" * 300 + " " + "ab" * 400, " ", "\n", "x" + " y" * 5000]


@pytest.fixture()
def rows(spark):
    """Documents as a table with a repeated row, null values and columns of clashing names."""

    def make(pairs, schema="doc_id long, text string"):
        names = "i int, t string, key string, id int, g int, kind string, spans int, gap int, v int"
        return spark.createDataFrame([(*p, 1, "x", None, 2, 3, "y", 4, 5, 6) for p in pairs], f"{schema}, {names}")

    return make
