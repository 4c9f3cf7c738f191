import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: nulls, empty and long texts, repeated rows and ids,
    a clashing column, another alphabet, special tokens."""
    long = " ".join(f"word{i % 977} and, the" for i in range(6000))
    rows = [(None, "a row without an id", None, None, None), (3, None, "en", "src0", 0), (3, "", "en", None, 0), (5, "", "en", "src1", 0),
            (7, long, "en", "src0", len(long)), (8, long + " end", "en", "src0", len(long) + 4),
            (9, "Ünïcode ШРИФТ 漢字 don't 12 <|endoftext|>!", "de", "src2", 39),
            (10, "one\ntwo\nthree\nfour", "en", "src0", 18), (11, "zero\none\ntwo\nthree\nfive", "en", "src0", 24),
            (11, "zero\none\ntwo\nthree\nfive", "en", "src0", 24), (12, "   \n\n\n\n  ", "en", "src0", 9), (13, "x" * 5000, "en", "src3", 5000),
            (14, "mail ana@mail.example.com or +1 (974) 555-3436 from 10.0.0.12 with 4111 1111 1111 1111", "en", "src0", 80)]
    rows += [(100 + i, f"copy of the same text with a few more words number {i % 3}", "en", "src0", 50) for i in range(40)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DOCS + ", fp int").repartition(3).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter("false")
